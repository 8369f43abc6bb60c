"""Problem 3: the best representative of each duplicate group, by Bayesian fusion with copy detection.

Records of one DOI claim values for a few fields. Every different value of a group is whole or
damaged; which, is a hidden variable whose posterior comes from four kinds of evidence:

* the *accuracy* of the sources that claim it. A source is a pair of ``doi_source`` and column;
* how often it is claimed *independently*. Claims are discounted by the probability that one source
  copies another (or itself), which shows in the damaged values they share;
* *signs* of damage in the text (markup, garbling, an omission, ...): a likelihood, not a verdict;
* whether another value of the group *says more*, and how it goes on.

Accuracies, dependences and how often damage shows in which way start from a prior and are
estimated over all groups in turn with the posteriors, until nothing moves any more. How often a
whole value shows a sign is a constant: where the sign is all there is to go by, an estimate would
only confirm itself. Values with the same evidence
share one row meanwhile, so a round works on counts. A field takes the values whose most probable
state is whole; among these the latest claim wins.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.format_duplicates import doi_core
from sluiceway.operators.skew import join_groups
from sluiceway.session import cut

#: Model constants: copied share of a copier's values, damaged values a source may choose from, prior of dependence.
COPY_RATE, FALSE_VALUES, DEPENDENT = 0.8, 100.0, 0.05
#: Prior of a source's accuracy, and how many claims it counts as.
ACCURACY, ACCURACY_CLAIMS = 0.8, 5
#: A value found in this share of all groups, and in so many at least, is a sign of a stand-in.
STAND_IN_SHARE, STAND_IN_LEAST = 0.004, 40
#: The estimation stops when no parameter moves more than this, or after so many rounds.
STILL, ROUNDS = 0.02, 12
#: Joins the elements of a list value; no text holds it.
SEP = "\u001f"

STAND_INS = r"(?i)^[\[(<]*\s*(n\.?/?[an]\.?|nan|nil|none|null|unknown|untitled|undefined|anonymous|anon\.?|staff|author|authors|tba|tbd|test|-+|\?+|\.+|(no|missing) (title|abstract|authors?)|see (the )?(full )?(text|paper|article|pdf)|(title|abstract|authors?) (pending|missing|unknown|not (yet )?available|unavailable|to be (added|announced)))[\s.]*[\])>]*$"
NOTICE = r"(?i)^(©|\(c\)|copyright\b)|all rights reserved\.?$"
GARBLED = r"\x{FFFD}|Ã[\x{80}-\x{BF}\s]|Â[\x{80}-\x{BF}\s]|â€|&#x?[0-9A-Fa-f]+;"
MARKUP = r"(?i)</?[a-z][^<>]*>|&(lt|gt|amp|quot|nbsp|apos);|<!\[CDATA"
OMISSION = r"(?i)(\.\.\.|…)\s*\]?\s*$|\[\s*(\.\.\.|…|truncated|abridged|continued|more)\s*\]|\(\s*(truncated|abridged|continued)\s*\)\s*$"
OTHERS = r"(?i)^(et al\.?|and others|others|u\. ?a\.|n\. ?n\.)$"
#: Longest stand-in of the pattern without the blanks, dots and brackets around it.
STAND_IN_LETTERS = 40

FIELDS = {"title_openalex": "title", "title_crossref": "title", "abstract_crossref": "abstract", "authors_crossref": "authors"}
FAMILIES = ("title", "abstract", "authors")
#: Signs of a value by itself, and prior claims with each sign among whole and among damaged values.
SIGNS = {"none": (50_000.0, 20.0), "blank": (1.0, 20.0), "garbled": (1.0, 20.0), "markup": (1.0, 20.0), "omission": (1.0, 20.0), "stand-in": (1.0, 20.0), "frequent": (1.0, 20.0), "no end": (1.0, 20.0)}
#: How a longer value of the group goes on beyond this one ("common": after a mark, in words that many values go on with), and prior values of each kind among whole and damaged ones without signs.
MORE = {"nothing": (5_000.0, 2.0), "subtitle": (150.0, 1.0), "common": (150.0, 1.0), "word": (2.0, 50.0), "inside": (1.0, 50.0), "names": (1.0, 100.0)}
#: Share of all continuations, and number of them, from which one is common.
COMMON_SHARE, COMMON_LEAST = 0.02, 5
MARK = r"^\s?[(:,;—–-]"
#: How a subtitle begins: with a colon, a bracket, or a dash between spaces.
SUBTITLE = r"^(:|\s?\(|\s[–—-]\s)"


def _screened(value: Column, screen: Column, pattern: str) -> Column:
    """Whether ``value`` has the pattern; only values that pass the cheap screen, as every match does, are searched for it."""
    return F.when(screen, value.rlike(pattern)).otherwise(False)


def _has(value: Column, *marks: str) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(value, F.lit(m)) for m in marks))


def sign(value: Column, family: Column | str) -> Column:
    """The first sign of damage of SIGNS that a text shows, else "none". ``value`` isn't null; of a list each element is asked by ``list_sign``."""
    family = F.lit(family) if isinstance(family, str) else family
    amp = _has(value, "&")
    bare = F.btrim(value, F.lit(" \t\r\n.[]()<>"))
    head = F.lower(F.substring(F.ltrim(value), 1, 9))
    return (
        F.when(F.trim(value) == "", "blank")
        .when(_screened(value, _has(value, "�", "Ã", "Â", "â€") | amp, GARBLED), "garbled")
        .when(_screened(value, _has(value, "<") | amp, MARKUP), "markup")
        .when(_screened(value, _has(value, "...", "…", "[", ")"), OMISSION), "omission")
        .when(_screened(F.btrim(value, F.lit(" \t\r\n ")), F.length(bare) <= STAND_IN_LETTERS, STAND_INS) | _screened(value, F.startswith(head, F.lit("©")) | F.startswith(head, F.lit("(c)")) | (head == "copyright") | F.endswith(F.lower(F.substring(value, -20, 20)), F.lit("reserved.")) | F.endswith(F.lower(F.substring(value, -20, 20)), F.lit("reserved")), NOTICE), "stand-in")
        .when((family == "abstract") & ~value.rlike(r"[.!?][)\]\"'”’]?$"), "no end")
        .when((family == "title") & F.substring(value, -1, 1).rlike(r"\s"), "no end")
        .otherwise("none")
    )


def list_sign(names: Column) -> Column:
    """The sign of a list of names: blank if it or an element is empty, else the first sign of an element, an omission if one says that others are left out."""
    of = lambda v: F.when(v.isNull(), "blank").when(v.rlike(OTHERS), "omission").otherwise(sign(v, "authors"))
    found = F.filter(F.transform(names, of), lambda s: s != "none")
    return F.when(F.size(names) <= 0, "blank").otherwise(F.coalesce(F.get(found, F.lit(0)), F.lit("none")))


def flat(field: str) -> Column:
    """The value of a field as one text; elements that are missing stay told apart from empty ones."""
    return F.array_join(F.col(field), SEP, "�") if FIELDS[field] == "authors" else F.col(field)


def hashed(records: DataFrame, key: str, doi: str, source: str, when: str, names: str) -> DataFrame:
    """``core, id, t, source, print, longest, h0..h3``: a small row for each record with a DOI, with hashes of its values. Equal ``print``: the same record again."""
    size = lambda c: F.greatest(F.size(c), F.lit(0))
    return records.select(
        doi_core(F.col(doi)).alias("core"), F.col(key).alias("id"), F.coalesce(F.col(when), F.lit("0001-01-01").cast("timestamp")).alias("t"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.xxhash64(*FIELDS, F.col(when)).alias("print"), F.greatest(size(F.col(names)), F.when(F.exists("authors_crossref", lambda v: v.isNull() | v.rlike(OTHERS)), 0).otherwise(size(F.col("authors_crossref")))).alias("longest"),
        *(F.when(F.col(f).isNotNull(), F.xxhash64(flat(f))).alias(f"h{i}") for i, f in enumerate(FIELDS)),
    ).filter("core is not null")


def votes(rows: DataFrame) -> DataFrame:
    """``core, family, h, size, longest, votes``: for each different value of a group which source claims it in how many different records, and the latest claim. ``rows``: those of ``hashed``, with what holds for their whole group.

    Counted in two steps keyed by value, source and record, so a group of any size is spread.
    """
    parts = F.array(*(F.struct(F.lit(f).alias("field"), F.lit(family).alias("family"), F.col(f"h{i}").alias("h")) for i, (f, family) in enumerate(FIELDS.items())))
    each = rows.select("core", "source", "print", "size", "longest", F.struct("t", (-F.col("id")).alias("neg")).alias("at"), F.explode(parts).alias("x")).filter("x.h is not null")
    src = F.concat_ws("/", "source", "x.field").alias("src")
    once = each.groupBy("core", "x.family", "x.h", src, "x.field", "print").agg(F.max("at").alias("at"), F.first("size").alias("size"), F.first("longest").alias("longest"))
    by = once.groupBy("core", "family", "h", "src", "field").agg(F.count("*").alias("k"), F.max("at").alias("at"), F.first("size").alias("size"), F.first("longest").alias("longest"))
    return by.groupBy("core", "family", "h").agg(F.first("size").alias("size"), F.first("longest").alias("longest"), F.array_sort(F.collect_list(F.struct("src", "k", "field", "at"))).alias("votes"))  # an element for each source


def valued(records: DataFrame, rows: DataFrame, groups: DataFrame, key: str, doi: str) -> DataFrame:
    """``core, family, h, size, longest, votes, value, n, sign``: the different values of all groups of two or more, as texts."""
    own = votes(join_groups(rows.drop("longest"), groups.select("core", "size", "longest"), ["core"], "size"))
    parts = F.array(*(F.struct(F.lit(family).alias("family"), flat(f).alias("value"), (F.size(f) if family == "authors" else F.lit(0)).alias("n")) for f, family in FIELDS.items()))
    texts = records.select(doi_core(F.col(doi)).alias("core"), F.explode(parts).alias("x")).filter("core is not null and x.value is not null")
    texts = texts.groupBy("core", "x.family", F.xxhash64("x.value").alias("h")).agg(F.first("x.value").alias("value"), F.first("x.n").alias("n"))
    listed = list_sign(F.transform(F.split("value", SEP), lambda v: F.when(v != "�", v)))
    told = F.when((F.col("family") == "authors") & (F.col("n") <= 0), "blank").when(F.col("family") == "authors", listed).otherwise(sign(F.col("value"), F.col("family")))
    return own.join(texts, ["core", "family", "h"]).withColumn("sign", told)


def frequent(rows: DataFrame) -> DataFrame:
    """``family, h`` of titles and abstracts that so many groups share that they stand in for missing ones; counted over all records."""
    parts = F.array(*(F.struct(F.lit(family).alias("family"), F.col(f"h{i}").alias("h")) for i, family in enumerate(FIELDS.values()) if family != "authors"))
    said = rows.select("core", F.explode(parts).alias("x")).filter("x.h is not null").select("core", "x.*").distinct().groupBy("family", "h").agg(F.count("*").alias("k"))
    total = rows.select("core").distinct().agg(F.count("*").alias("groups"))
    return said.filter(F.col("k") >= STAND_IN_LEAST).join(F.broadcast(total), F.col("k") >= F.col("groups") * STAND_IN_SHARE).select("family", "h", F.lit(True).alias("stands_in"))  # one row is broadcast


def continued(v: DataFrame) -> DataFrame:
    """``core, family, h, rest``: what another text of the group says beyond this one, for every text that another one continues.

    In code point order, a text that any other continues is continued by the next. The order is
    kept in ranges, each sorted by one task, so no group has to fit into one; what follows the last
    row of a range is the first of the next that has rows.
    """
    spread = max(1, int(v.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    texts = v.filter("sign = 'none' and family <> 'authors'").select("core", "family", "value", "h")
    rows = cut(texts.repartitionByRange(spread, "core", "family", "value").withColumn("part", F.spark_partition_id()))
    order = Window.partitionBy("part").orderBy("core", "family", "value")
    first = rows.groupBy("part").agg(F.min(F.struct("core", "family", "value")).alias("x"))  # a row for each range
    after = first.select("part", F.lead("x").over(Window.orderBy("part")).alias("over"))
    here = rows.withColumn("next", F.lead(F.struct("core", "family", "value")).over(order)).join(F.broadcast(after), "part")
    here = here.withColumn("next", F.coalesce("next", "over"))
    goes_on = (F.col("next.core") == F.col("core")) & (F.col("next.family") == F.col("family")) & F.startswith(F.col("next.value"), F.col("value"))
    return here.filter(goes_on).select("core", "family", "h", F.expr("substr(next.value, length(value) + 1)").alias("rest"))


def evidence(v: DataFrame) -> DataFrame:
    """``v`` with ``more`` (a kind of MORE) and, where another value says more, ``all``: how many claims its group may make of such values."""
    rest = continued(v)
    said = rest.groupBy(F.xxhash64("rest").alias("said")).agg(F.count("*").alias("times"))
    total = said.agg(F.sum("times").alias("every"))
    said = said.join(F.broadcast(total), (F.col("times") >= COMMON_LEAST) & (F.col("times") >= COMMON_SHARE * F.col("every")), "left")  # one row is broadcast
    kind = F.when(F.col("every").isNotNull() & F.col("rest").rlike(MARK), "common").when(F.col("rest").rlike(SUBTITLE), "subtitle").when(F.col("rest").rlike(r"^[\s,;]"), "word").otherwise("inside")
    rest = rest.withColumn("said", F.xxhash64("rest")).join(said, "said").select("core", "family", "h", kind.alias("goes_on"))
    k = F.aggregate("votes", F.lit(0).cast("bigint"), lambda a, x: a + x["k"])
    v = v.drop("value").join(rest, ["core", "family", "h"], "left")
    short = (F.col("family") == "authors") & (F.col("sign") == "none") & (F.col("n") < F.col("longest"))
    v = v.withColumn("more", F.when(short, "names").otherwise(F.coalesce("goes_on", F.lit("nothing")))).withColumn("k", k)
    chances = F.col("size") * F.when(F.col("family") == "title", sum(f == "title" for f in FIELDS.values())).otherwise(1)
    return v.withColumn("all", F.when(F.col("more") != "nothing", chances)).drop("goes_on", "n", "longest", "size")


class Parameters:
    """What is estimated: ``accuracy`` (src, a) and ``dependence`` (a, b, p) as tables, as long as there are sources; likelihoods of the fixed lists of signs as numbers."""

    def __init__(self, accuracy: DataFrame | None = None, dependence: DataFrame | None = None, sign: dict | None = None, more: dict | None = None, chance: dict | None = None):
        self.accuracy, self.dependence = accuracy, dependence
        self.sign = sign or {(f, s): _rates(SIGNS)[s] for f in FAMILIES for s in SIGNS}
        self.more = more or {(f, m): _rates(MORE)[m] for f in FAMILIES for m in MORE}
        self.chance = chance or {}


def _rates(prior: dict[str, tuple[float, float]]) -> dict[str, tuple[float, float]]:
    whole, damaged = (sum(x[i] for x in prior.values()) for i in (0, 1))
    return {k: (a / whole, b / damaged) for k, (a, b) in prior.items()}


def _pick(table: dict[tuple[str, str], float], *columns: str | Column) -> Column:
    """The number of a fixed short list that stands for the columns' values."""
    return F.element_at(F.create_map(*(F.lit(x) for k, v in table.items() for x in ("/".join(k), float(v)))), F.concat_ws("/", *columns))


def posterior(patterns: DataFrame, claims: DataFrame, pairs: DataFrame, by: Parameters) -> DataFrame:
    """``patterns`` with ``p``, the probability that a value with this evidence is whole.

    ``claims`` (pattern, src, k) and ``pairs`` (pattern, a, b) are the sources behind each pattern.
    A source's claims count as one and, as far as it doesn't repeat itself, as more; less by
    what it may have copied from the sources before it. The first claim is what makes a value
    exist; of further ones so many come by chance if the value is damaged, at the rate at which
    damaged claims fall together, and at any rate if it is whole.
    """
    own = claims if by.accuracy is None else claims.join(by.accuracy, "src", "left")
    a = F.lit(ACCURACY) if by.accuracy is None else F.coalesce("a", F.lit(ACCURACY))
    if by.dependence is None:
        own = own.withColumn("free", F.lit(1.0)).withColumn("again", F.lit(1.0))
    else:
        copied = F.log(1 - F.lit(COPY_RATE) * F.col("p"))
        freed = pairs.filter("a <> b").join(by.dependence, ["a", "b"]).groupBy("pattern", F.col("a").alias("src")).agg(F.exp(F.sum(copied)).alias("free"))
        alone = by.dependence.filter("a = b").select(F.col("a").alias("src"), F.exp(copied).alias("again"))
        own = own.join(freed, ["pattern", "src"], "left").join(alone, "src", "left").withColumn("free", F.coalesce("free", F.lit(1.0))).withColumn("again", F.coalesce("again", F.lit(1.0)))
    e = F.col("free") * (1 + (F.col("k") - 1) * F.col("again"))
    weight = own.groupBy("pattern").agg(F.sum(e).alias("m"), (F.sum(e * a) / F.sum(e)).alias("acc"), F.sum("k").alias("claimed"))
    out = patterns.join(weight, "pattern")
    whole, damaged = ({k: x[i] for k, x in by.sign.items()} for i in (0, 1))
    chance = {(f, s): by.chance.get((f, s), 1 / FALSE_VALUES) for f in FAMILIES for s in (*SIGNS, "names")}
    kind = F.when(F.col("more") == "names", "names").otherwise(F.col("sign"))
    p_w, p_d = _pick(whole, "family", "sign"), _pick(damaged, "family", "sign")
    rate = (1 - F.col("acc")) * p_d * _pick(chance, F.col("family"), kind)
    further = F.greatest(F.col("m") - 1, F.lit(0.0))
    others = F.greatest(F.coalesce(F.col("all"), F.lit(0)) - F.col("claimed"), F.lit(0)).cast("double")
    share = F.least(further / F.greatest(further + others, F.lit(1e-9)), F.lit(1 - 1e-9))
    repeated = F.when(p_w < rate, further * F.log(p_w / rate)).when(further * (1 - rate) > rate * others, further * F.log(F.greatest(share, F.lit(1e-12)) / rate) + others * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    room = F.when(F.col("all").isNotNull(), 0.5 * F.log(1 + further + others)).otherwise(0.0)
    more = _pick({k: math.log(w / d) for k, (w, d) in by.more.items()}, "family", "more")
    logit = F.log(F.col("acc") / (1 - F.col("acc"))) + F.log(p_w / p_d) + F.when(F.col("sign") == "none", more).otherwise(0.0) + repeated - room
    return out.withColumn("p", 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(50.0)), F.lit(-50.0)))))


def estimated(scored: DataFrame, claims: DataFrame, pairs: DataFrame, items: DataFrame, chance: dict) -> Parameters:
    """Parameters from posteriors over all values: ``scored`` has ``pattern, family, sign, more, times, p``."""
    s = cut(scored.select("pattern", "family", "sign", "more", "times", "p"))
    by_src = claims.join(s.select("pattern", "times", "p"), "pattern").groupBy("src").agg(F.sum(F.col("k") * F.col("times") * F.col("p")).alias("good"), F.sum(F.col("k") * F.col("times")).alias("n"))
    accuracy = cut(by_src.select("src", F.least(F.lit(0.99), F.greatest(F.lit(0.05), (F.col("good") + ACCURACY * ACCURACY_CLAIMS) / (F.col("n") + ACCURACY_CLAIMS))).alias("a")))
    both = pairs.join(s.select("pattern", "times", "p"), "pattern").groupBy("a", "b").agg(F.sum(F.col("times") * F.col("p")).alias("kt"), F.sum(F.col("times") * (1 - F.col("p"))).alias("kf"))
    acc = lambda side: accuracy.select(F.col("src").alias(side), F.col("a").alias(f"acc_{side}"))
    both = both.join(items, ["a", "b"]).join(acc("a"), "a").join(acc("b"), "b")
    x = F.least("acc_a", "acc_b")
    true, false = x * x, (1 - x) * (1 - x) / FALSE_VALUES
    apart = F.greatest(1 - true - false, F.lit(1e-9))
    c = COPY_RATE
    odds = math.log(DEPENDENT / (1 - DEPENDENT)) + F.col("kt") * F.log((x * c + true * (1 - c)) / true) + F.col("kf") * F.log(((1 - x) * c + false * (1 - c)) / false) + F.greatest(F.col("k") - F.col("kt") - F.col("kf"), F.lit(0.0)) * math.log(1 - c)
    dependence = cut(both.select("a", "b", (1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(30.0)), F.lit(-30.0))))).alias("p")))
    counted = s.groupBy("family", "sign", "more").agg(F.sum(F.col("times") * (1 - F.col("p"))).alias("d")).collect()  # at most families x signs x kinds

    def rates(prior: dict, of, use) -> dict:
        out = {}
        for f in FAMILIES:
            got = {k: list(v) for k, v in prior.items()}
            for r in counted:
                if r.family == f and use(r):
                    got[of(r)][1] += r.d
            out |= {(f, k): v for k, v in _rates(got).items()}
        return out

    return Parameters(accuracy, dependence, rates(SIGNS, lambda r: r.sign, lambda r: True), rates(MORE, lambda r: r.more, lambda r: r.sign == "none"), chance)


def moved(a: Parameters, b: Parameters) -> float:
    """How far the parameters are apart, at most: accuracies, and log likelihood ratios in units of ten."""
    if a.accuracy is None:
        return 1.0
    far = lambda x, y, on, c: x.join(y.withColumnRenamed(c, "_before"), on).agg(F.max(F.abs(F.col(c) - F.col("_before"))).alias("x"))
    most = [far(b.accuracy, a.accuracy, ["src"], "a").first().x or 0.0]
    ratio = lambda t, k: math.log(t[k][0] / t[k][1])
    return max([*most, *(abs(ratio(x, k) - ratio(y, k)) / 10 for x, y in ((a.sign, b.sign), (a.more, b.more)) for k in x)])


def chances(v: DataFrame) -> dict[tuple[str, str], float]:
    """For each family and sign, and for lists shorter than another, how probably two claims of the kind in one group are of the same value."""
    k = F.col("k").cast("double")
    per = v.withColumn("sign", F.when(F.col("more") == "names", "names").otherwise(F.col("sign"))).filter("sign <> 'none'").groupBy("core", "family", "sign").agg(F.sum(k * (k - 1) / 2).alias("same"), (F.sum(k) * (F.sum(k) - 1) / 2).alias("pairs"))
    got = per.groupBy("family", "sign").agg(F.sum("same").alias("same"), F.sum("pairs").alias("pairs")).collect()  # fixed lists
    return {(r.family, r.sign): (r.same + 1) / (r.pairs + FALSE_VALUES) for r in got}


def judged(records: DataFrame, key: str = "record_id", doi: str = "doi", source: str = "doi_source", when: str = "retrieved_at", names: str = "authors", rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, Parameters]:
    """Every different value of the groups of two or more with its posterior ``p``, the groups, and the parameters. ``rounds``: of estimation at most; 0 leaves the priors."""
    rows = cut(hashed(records, key, doi, source, when, names))
    groups = cut(rows.groupBy("core").agg(F.min("id").alias("first_record_id"), F.count("*").alias("size"), F.max("longest").alias("longest")).filter("size > 1"))
    v = valued(records, rows, groups, key, doi).join(frequent(rows), ["family", "h"], "left")
    v = cut(v.withColumn("sign", F.when(F.col("stands_in") & (F.col("sign") == "none"), "frequent").otherwise(F.col("sign"))).drop("stands_in"))
    v = evidence(v)
    sources = F.transform("votes", lambda x: F.struct(x["src"].alias("src"), x["k"].alias("k")))
    v = cut(v.withColumn("pattern", F.xxhash64("family", "sign", "more", "all", sources.cast("array<struct<src:string,k:bigint>>"))))
    patterns = cut(v.groupBy("pattern").agg(F.first("family").alias("family"), F.first("sign").alias("sign"), F.first("more").alias("more"), F.first("all").alias("all"), F.first(sources).alias("votes"), F.count("*").alias("times")))
    claims = patterns.select("pattern", F.explode("votes").alias("x")).select("pattern", "x.*")
    couple = lambda c: F.flatten(F.transform(c, lambda x: F.transform(F.filter(c, lambda y: (y["src"] < x["src"]) | ((y["src"] == x["src"]) & (x["k"] > 1))), lambda y: F.struct(x["src"].alias("a"), y["src"].alias("b")))))
    pairs = patterns.select("pattern", F.explode(couple(F.col("votes"))).alias("x")).select("pattern", "x.*")
    each = v.select("core", "family", F.explode(sources).alias("x")).groupBy("core", "family", "x.src").agg(F.sum("x.k").alias("k"))
    each = each.groupBy("core", "family").agg(F.array_sort(F.collect_list(F.struct("src", "k"))).alias("votes"))  # an element for each source
    items = cut(each.select(F.explode(couple(F.col("votes"))).alias("x")).groupBy("x.a", "x.b").agg(F.count("*").alias("k")))
    by = Parameters(chance=chances(v))
    for _ in range(rounds):
        before, by = by, estimated(posterior(patterns, claims, pairs, by), claims, pairs, items, by.chance)
        if moved(before, by) < STILL:
            break
    p = posterior(patterns, claims, pairs, by).select("pattern", "p")
    return v.join(p, "pattern"), groups, by


def best(records: DataFrame, key: str = "record_id", doi: str = "doi", source: str = "doi_source", when: str = "retrieved_at", names: str = "authors", rounds: int = ROUNDS) -> DataFrame:
    """For each group of two or more records with one DOI and each field the record to take the value from.

    Output: ``first_record_id, field, best_record_id``. A field for which no record of the group has
    a value that is more probably whole than damaged gives no row. Records without a DOI form no
    group; null times count as oldest; among whole values the latest claim wins, then the smallest
    key, so equal rows give the first of them; an empty table gives an empty result; further columns
    are ignored. Any number of sources may occur; they and their dependences are kept in tables.
    Values are told apart by 64-bit hashes within their group; equal records vote once.
    """
    v, groups, _ = judged(records, key, doi, source, when, names, rounds)
    whole = v.filter("p >= 0.5").select("core", F.explode("votes").alias("x"))
    top = whole.groupBy("core", "x.field").agg(F.max("x.at").alias("at"))
    return top.join(groups, "core").select("first_record_id", "field", (-F.col("at.neg")).alias("best_record_id"))


def survivors(records: DataFrame, **names: str) -> DataFrame:
    """One record built from each group of two or more: ``first_record_id`` and the best value of each field, null where no record has one."""
    key = names.get("key", "record_id")
    chosen = best(records, **names)
    values = records.select(F.col(key).alias("best_record_id"), F.explode(F.create_map(*(x for f, family in FIELDS.items() for x in (F.lit(f), F.array_join(f, SEP, "") if family == "authors" else F.col(f))))).alias("field", "value"))
    wide = chosen.join(values, ["best_record_id", "field"]).groupBy("first_record_id").pivot("field", list(FIELDS)).agg(F.first("value"))
    return wide.withColumns({f: F.split(f, SEP) for f, family in FIELDS.items() if family == "authors"})
