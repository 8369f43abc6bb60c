"""Problem 6: matching entities across sources without keys, by graph embeddings and hyperplane hashing.

Records of both sources (a work's author, a roster's row), their attributes (initial and surname,
year, employer; those of co-authors and of alternate names hang on the same record) and tokens
(q-grams of surnames, other attributes whole) make a graph. Random walks over it train skip-gram
vectors of the tokens; an attribute's vector is the sum of its tokens', less what all have in
common. Attributes of one initial whose vectors share a bucket in one of several tables of
hyperplane signs bring their names together. These are ranked exactly: a logistic curve over the
cosine and the likeness of the names gives the confidence, and a pair that is more probably a match
than not is linked. The curve is fitted to what a second spelling of the author, which none of the
two looks at, says. Years and what a record says of the author's employer must agree as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import names as N
from sluiceway.llm.variants import hash_of, keyed
from sluiceway.session import cut

#: Attributes at most that the vectors are trained on, and edges at most from records to these.
SAMPLE, EDGES = 8000, 40_000
#: Cosine that two spellings of a surname have at least, about, and the share of such pairs that the tables are to bring together.
LIKENESS, RECALL, LEAST_PLANES = 0.85, 0.99, 8
TRAINED, IDENTITY, IDENTITY_WEIGHT, WALKS, WALK_LENGTH, WINDOW, NEGATIVES = 24, 72, 0.25, 6, 8, 2, 4
#: How often a walk goes from an attribute over one of its records to another attribute, and records of an attribute from which that is the less frequent the more it has; attributes with a token from which it counts in full.
OVER_RECORDS, HUB, COMMON = 0.2, 5, 50
#: Weights of the curve before labels: constant, cosine, likeness of names; and labels at least of each kind to fit it to.
PRIOR, FEW_LABELS = (-8.5, 4.0, 7.5), 20
#: Confidence in the employer if the record doesn't name it for this author but for some author.
UNNAMED = 0.97
SEED = 11
YEAR = r"(?:19|20)[0-9]{2}"


def tokens(entry: str) -> list[tuple[str, float]]:
    """(token, weight) of an attribute: q-grams of the surname of "initial|surname"; another attribute, "kind=value", is a token itself."""
    if "|" not in entry:
        return [(entry, 1.0)] if "=" in entry else []
    surname = entry.partition("|")[2]
    if not surname:
        return []
    padded = f"^{surname}$"
    return [("s" + padded[i : i + 2], 1.0) for i in range(len(padded) - 1)] + [("S" + padded[i : i + 3], 0.7) for i in range(len(padded) - 2)]


def planes_for(entries: int) -> int:
    """Signs in a bucket's key: one for each doubling of the attributes, so buckets keep their size."""
    return max(LEAST_PLANES, round(math.log2(max(entries, 1))))


def tables_for(planes: int, likeness: float = LIKENESS, recall: float = RECALL) -> int:
    """Tables that bring a pair of this cosine together with this probability: two vectors at an angle share a plane's sign with 1 - angle / pi."""
    same = (1 - math.acos(likeness) / math.pi) ** planes
    return math.ceil(math.log(1 - recall) / math.log(1 - same))


@dataclass
class Vectors:
    """Token vectors of a bounded vocabulary; unknown tokens keep only their identity part. Rare tokens, which slips of the hand make, weigh less."""

    row: dict[str, int]
    trained: np.ndarray
    weight: np.ndarray
    mean: np.ndarray
    cache: dict[str, np.ndarray] = field(default_factory=dict)

    def token(self, t: str) -> np.ndarray:
        v = self.cache.get(t)
        if v is None:
            own = np.random.default_rng(hash_of(t) % 2**63).standard_normal(IDENTITY) * (IDENTITY_WEIGHT / np.sqrt(IDENTITY))
            i = self.row.get(t, -1)
            known = self.trained[i] if i >= 0 else np.zeros(TRAINED)
            v = self.cache[t] = np.concatenate([known, own]) * (self.weight[i] if i >= 0 else np.log(2) / np.log1p(COMMON))
        return v

    def of(self, entries: list[str]) -> np.ndarray:
        """Unit vectors of attributes; zero for those without letters."""
        out = np.zeros((len(entries), TRAINED + IDENTITY))
        for i, entry in enumerate(entries):
            for t, w in tokens(entry):
                out[i] += w * self.token(t)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        out = np.where(norm > 0, out / np.where(norm > 0, norm, 1) - self.mean, 0)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)

    def buckets(self, entries: list[str], planes: int, tables: int) -> np.ndarray:
        """The bucket of each attribute in each table, apart for each initial."""
        normal = np.random.default_rng(SEED).standard_normal((TRAINED + IDENTITY, planes * tables))
        signs = (self.of(entries) @ normal > 0).reshape(len(entries), tables, planes)
        apart = np.array([hash_of(e.partition("|")[0]) % 2**31 for e in entries], np.int64)
        with np.errstate(over="ignore"):
            key = signs @ (1 << np.arange(planes, dtype=np.int64)) + (np.arange(tables, dtype=np.int64) << planes)
            return (key * np.int64(-7046029254386353131)) ^ (apart[:, None] * np.int64(0x165667B19E3779F9))


def train(entries: list[str], edges: list[tuple[str, str]] = ()) -> Vectors:
    """Skip-gram vectors with negative sampling, from random walks over attributes, their tokens and, by ``edges`` (record, attribute), the records they stand in."""
    known = dict.fromkeys(entries)
    known.update((a, None) for _, a in edges)
    held = {e: [t for t, _ in tokens(e)] for e in known}
    names = [e for e in known if held[e]]
    at_name = {e: i for i, e in enumerate(names)}
    row: dict[str, int] = {}
    for e in names:
        for t in held[e]:
            row.setdefault(t, len(row))
    k = len(row)
    if not k:
        return Vectors({}, np.zeros((0, TRAINED)), np.zeros(0), np.zeros(TRAINED + IDENTITY))
    rng = np.random.default_rng(SEED)
    sizes = np.array([len(held[e]) for e in names])
    flat = np.array([row[t] for e in names for t in held[e]])
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(names)), sizes)
    order = np.argsort(flat, kind="stable")
    count = np.bincount(flat, minlength=k)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    # records: for each attribute the records it stands in, for each record its attributes
    number = {r: i for i, r in enumerate(dict.fromkeys(r for r, a in edges if a in at_name))}
    rec, att = (np.array([f(x) for x in edges if x[1] in at_name], np.int64) for f in (lambda x: number[x[0]], lambda x: at_name[x[1]]))
    by_att, by_rec = (np.argsort(x, kind="stable") for x in (att, rec))
    n_att, n_rec = np.bincount(att, minlength=len(names)), np.bincount(rec, minlength=max(len(number), 1))
    first_att, first_rec = (np.concatenate([[0], np.cumsum(x)[:-1]]) for x in (n_att, n_rec))
    at = np.tile(np.arange(len(names)), WALKS)
    steps = []
    for _ in range(WALK_LENGTH):
        over = (rng.random(len(at)) < OVER_RECORDS) & (n_att[at] > 0)
        if over.any():
            here = at[over]
            r = rec[by_att[first_att[here] + (rng.random(len(here)) * n_att[here]).astype(int)]]
            to = att[by_rec[first_rec[r] + (rng.random(len(r)) * n_rec[r]).astype(int)]]
            at[over] = np.where(rng.random(len(to)) < np.minimum(1, HUB / n_att[to]), to, here)  # seldom on to what most records share
        t = flat[start[at] + (rng.random(len(at)) * sizes[at]).astype(int)]
        steps.append(t)
        at = owner[order[first[t] + (rng.random(len(at)) * count[t]).astype(int)]]
    walks = np.stack(steps, axis=1)
    pairs = np.concatenate([np.stack([walks[:, i], walks[:, j]], axis=1) for i in range(WALK_LENGTH) for j in range(max(0, i - WINDOW), min(WALK_LENGTH, i + WINDOW + 1)) if i != j])
    rng.shuffle(pairs)
    inner, outer = rng.standard_normal((k, TRAINED)) * 0.1, np.zeros((k, TRAINED))
    noise = count**0.75 / (count**0.75).sum()
    for lo in range(0, len(pairs), 4096):
        c, o = pairs[lo : lo + 4096].T
        negatives = rng.choice(k, (len(c), NEGATIVES), p=noise)
        target = np.concatenate([o[:, None], negatives], axis=1)
        v, u = inner[c], outer[target]
        g = (np.arange(NEGATIVES + 1) == 0) - 1 / (1 + np.exp(-np.clip(np.einsum("nd,nkd->nk", v, u), -30, 30)))
        np.add.at(inner, c, 0.05 * np.einsum("nk,nkd->nd", g, u))
        np.add.at(outer, target.ravel(), 0.05 * (g[:, :, None] * v[:, None, :]).reshape(-1, TRAINED))
    inner /= np.maximum(np.linalg.norm(inner, axis=1, keepdims=True), 1e-9)
    out = Vectors(row, inner, np.minimum(np.log1p(count) / np.log1p(COMMON), 1.0), np.zeros(TRAINED + IDENTITY))
    own = out.of([e for e in names if "|" in e])
    out.mean = own.mean(axis=0) if len(own) > 50 else out.mean  # too few say nothing of all
    return out


def trained(entries: DataFrame, edges: DataFrame, sample: int = SAMPLE, most_edges: int = EDGES) -> Vectors:
    """Vectors from at most ``sample`` attributes, chosen by hash, and at most ``most_edges`` of their ``edges`` (record, entry)."""
    few = entries.select("entry").orderBy(F.xxhash64("entry"), "entry").limit(sample)
    chosen = [r.entry for r in few.collect()]
    order = [F.xxhash64("record"), "record", "entry"]  # whole records come together
    own = edges.select("record", "entry").orderBy(*order).limit(most_edges)
    known = set(chosen)
    return train(chosen, [(r.record, r.entry) for r in own.collect() if r.entry in known or "=" in r.entry])


def hashed(entries: DataFrame, vectors: Vectors, planes: int, tables: int) -> DataFrame:
    """``entry, bucket``: a row for each table."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo in range(0, len(batch), 1000):  # signs of all planes at once would take much memory
                part = batch["entry"].iloc[lo : lo + 1000]
                b = vectors.buckets(list(part), planes, tables)
                yield pd.DataFrame({"entry": np.repeat(part.to_numpy(), b.shape[1]), "bucket": b.ravel()})

    spread = max(2, int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a set number, or few tasks would hash all
    return entries.select("entry").repartition(spread, "entry").mapInPandas(run, "entry string, bucket bigint")


def candidates(left: DataFrame, right: DataFrame, vectors: Vectors) -> DataFrame:
    """``entry_a, entry_b``: attributes of both sides (column ``entry``, distinct) that share a bucket; the number of planes follows from that of the attributes, that of the tables from the collision curve."""
    planes = planes_for(max(left.count(), right.count()))
    tables = tables_for(planes)
    a, b = (hashed(x, vectors, planes, tables).withColumnRenamed("entry", n) for x, n in ((left, "entry_a"), (right, "entry_b")))
    return a.hint("merge").join(b, "bucket").select("entry_a", "entry_b").distinct()


def compared(pairs: DataFrame, vectors: Vectors) -> DataFrame:
    """``a, b, cosine, likeness`` of candidate pairs of names, ``a, b, given_a, given_b, entry_a, entry_b``; names whose order is unsure are read both ways."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = lambda g: frozenset(g) if g is not None else frozenset()
        for batch in batches:
            ways = {}
            for side in "ab":
                ways |= {n: N.readings(n, known(g)) for n, g in dict(zip(batch[side], batch[f"given_{side}"], strict=True)).items()}
            like = np.array([max(N.alike(x, y) for x in ways[a] for y in ways[b]) for a, b in zip(batch["a"], batch["b"], strict=True)], float)
            own = sorted({*batch["entry_a"], *batch["entry_b"]})
            at = {e: i for i, e in enumerate(own)}
            v = vectors.of(own)
            cosine = (v[[at[e] for e in batch["entry_a"]]] * v[[at[e] for e in batch["entry_b"]]]).sum(axis=1)
            yield batch.assign(cosine=cosine, likeness=like)[["a", "b", "cosine", "likeness"]]

    return pairs.select("a", "b", "given_a", "given_b", "entry_a", "entry_b").mapInPandas(run, "a string, b string, cosine double, likeness double")


def label(name: str, second: str) -> float:
    """1 if the second spelling of an author is that of the name letter for letter, 0 if its surname or first initial is another; else nan."""
    (s, g, _), (t, h, _) = N.split_name(name), N.split_name(second)
    if s == t and g == h:
        return 1.0
    if N.osa(s, t) > 3 or (g and h and N.NICKNAMES.get(g[0], g[0])[0] != N.NICKNAMES.get(h[0], h[0])[0]):
        return 0.0
    return float("nan")


def calibration(same: DataFrame, own: DataFrame, most: int = 20_000) -> tuple[float, float, float]:
    """Weights of constant, cosine and likeness: how probably a candidate pair is a match, judged by the second spelling of the author. Fitted on at most ``most`` mentions."""
    said = own.filter("second is not null").select(F.col("name").alias("b"), "second").distinct()
    few = same.join(said, "b").orderBy(F.xxhash64("a", "b", "second")).limit(most).select("a", "second", "cosine", "likeness").toPandas()
    y = np.array([label(a, s) for a, s in zip(few["a"], few["second"], strict=True)], float)
    kept = ~np.isnan(y)
    prior = np.array(PRIOR)
    if min((y == 1).sum(), (y == 0).sum()) < FEW_LABELS:
        return PRIOR
    design = np.column_stack([np.ones(kept.sum()), few["cosine"].to_numpy()[kept], few["likeness"].to_numpy()[kept]])
    y, w, ridge = y[kept], prior.copy(), 1.0
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = (design * (p * (1 - p))[:, None]).T @ design + np.eye(3) * ridge
        step = np.linalg.solve(h, design.T @ (y - p) - ridge * (w - prior))
        w = w + step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-9))
    return float(w[0]), float(w[1]), float(w[2])


def mentions(records: DataFrame, agency: str, key: str, authors: str, pairs: str, year: str, any_flag: str, lead_flag: str, second: str | None) -> DataFrame:
    """``key, name, year, named, second``: authors that may belong to the agency; ``named``: the record says so of this author; ``second``: the author in the column of second spellings, if that lists as many."""
    other = F.col(second) if second else F.lit(None).cast("array<string>")
    each = records.filter(F.col(year).isNotNull()).select(F.col(key).alias("key"), F.col(year).cast("int").alias("year"), F.col(any_flag).alias("some"), F.col(lead_flag).alias("lead"), F.col(pairs).alias("pairs"), F.size(authors).alias("n"), other.alias("others"), F.posexplode(authors).alias("pos", "name"))
    says = F.when(F.size("pairs") == F.col("n"), F.get(F.col("pairs"), F.col("pos"))["canonical_affiliation"])
    each = each.withColumn("employer", F.nullif(F.trim(says), F.lit("")))
    named = F.lower("employer") == agency.lower()
    open_ = F.col("employer").isNull() & F.coalesce("some", F.lit(True)) & ((F.col("pos") > 0) | F.coalesce("lead", F.lit(True)))
    return each.filter("name is not null").filter(named | open_).select("key", "name", "year", F.coalesce(named, F.lit(False)).alias("named"), F.when(F.size("others") == F.col("n"), F.get("others", F.col("pos"))).alias("second"))


def linked(records: DataFrame, roster: DataFrame, agency: str, key: str = "record_id", authors: str = "authors", pairs: str = "author_affiliations", year: str = "publication_year", any_flag: str = "dwr_author", lead_flag: str = "dwr_lead_author", second: str | None = "authors_crossref", roster_key: str = "roster_id", name: str = "employee_name", other_name: str = "employee_alternate_name", roster_year: str = "year") -> DataFrame:
    """``roster_key, key, confidence``: the roster row's person is an author of the record, in the row's year.

    Rows and records without a name or a readable year match nothing; authors whom a record gives
    another employer match nothing; names of any length are read whole; equal rows and records
    count each; a row is linked to a record once, with its best confidence; empty tables give an
    empty result; further columns are ignored. Distinct names are compared, never mentions; the
    mentions of a name are joined by name and year, a busy name's by salted keys. ``second``: a
    column with a second spelling of the authors, which only the calibration looks at; null or a
    missing column leaves the curve as it is set.
    """
    own = cut(mentions(records, agency, key, authors, pairs, year, any_flag, lead_flag, second if second in records.columns else None))
    alternates = F.filter(F.transform(F.split(F.coalesce(other_name, F.lit("")), r"[;|]"), lambda x: F.trim(x)), lambda x: x != "")
    typed = F.array_distinct(F.concat(F.when(F.col(name).isNotNull(), F.array(F.col(name))).otherwise(F.array().cast("array<string>")), alternates))
    staff = roster.select(F.col(roster_key).alias("row"), F.expr(f"try_cast(nullif(regexp_extract(cast(`{roster_year}` as string), '{YEAR}', 0), '') as int)").alias("year"), F.explode(typed).alias("a")).filter("year is not null")
    known = cut(N.with_given(staff.select(F.col("a").alias("name")).unionByName(own.select("name"))))
    keys = cut(keyed(known).select("name", "entry").distinct())
    left, right = (keys.join(x.distinct(), "name", "left_semi") for x in (staff.select(F.col("a").alias("name")), own.select("name")))
    at = lambda c: F.concat(F.lit(c), F.col("year").cast("string"))
    said = own.select(F.concat(F.lit("c"), F.col("key").cast("string")).alias("record"), "name", F.array(at("y="), F.when(F.col("named"), "e=own").otherwise("e=none")).alias("more")).unionByName(staff.select(F.concat(F.lit("r"), F.col("row").cast("string")).alias("record"), F.col("a").alias("name"), F.array(at("y="), F.lit("e=own")).alias("more")))
    some = said.orderBy(F.xxhash64("record"), "record", "name").limit(EDGES)
    edges = some.join(keys, "name").select("record", "entry").unionByName(some.select("record", F.explode("more").alias("entry"))).distinct()
    entries = cut(keys.select("entry").distinct())
    vectors = trained(entries, edges)
    near = candidates(cut(left.select("entry").distinct()), cut(right.select("entry").distinct()), vectors)
    surname = lambda c: F.substring_index(c, "|", -1)
    apart = F.levenshtein(surname("entry_a"), surname("entry_b"))  # a swap, one slip, counts as two here
    near = cut(near.filter(apart <= F.when(F.least(F.length(surname("entry_a")), F.length(surname("entry_b"))) >= N.TWO_SLIPS, 4).otherwise(2)))
    pairs_ = near.join(left.join(known, "name").select(F.col("name").alias("a"), F.col("given").alias("given_a"), F.col("entry").alias("entry_a")), "entry_a").join(right.join(known, "name").select(F.col("name").alias("b"), F.col("given").alias("given_b"), F.col("entry").alias("entry_b")), "entry_b")
    same = cut(compared(pairs_, vectors).groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.max("likeness").alias("likeness")))
    constant, slope, weight = calibration(same, own)
    same = same.withColumn("confidence", 1 / (1 + F.exp(-(F.lit(constant) + F.lit(slope) * F.col("cosine") + F.lit(weight) * F.col("likeness"))))).filter("confidence >= 0.5").select("a", "b", "confidence")
    salts = 16
    who = staff.join(same, "a").groupBy("row", "year", "b").agg(F.max("confidence").alias("confidence"))
    busy = own.groupBy("name", "year").agg(F.count("*").alias("n")).filter("n >= 20000").orderBy(F.desc("n"), "name", "year").limit(1000).select("name", "year", F.lit(True).alias("busy"))
    spread = own.drop("second").join(F.broadcast(busy), ["name", "year"], "left").withColumn("salt", F.when(F.col("busy"), F.pmod(F.xxhash64("key"), F.lit(salts))).otherwise(0).cast("int"))
    who = who.withColumnRenamed("b", "name").join(F.broadcast(busy), ["name", "year"], "left").withColumn("salt", F.explode(F.when(F.col("busy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    found = spread.join(who.drop("busy"), ["name", "year", "salt"]).withColumn("confidence", F.col("confidence") * F.when(F.col("named"), 1.0).otherwise(UNNAMED))
    return found.groupBy(F.col("row").alias(roster_key), F.col("key").alias(key)).agg(F.max("confidence").alias("confidence"))
