"""Authors matched to a roster by edit distance, with soft filters on year and last name.

Of an author's candidates those within the year gap are kept if there are any, of these those with
the same last name if there are any; the nearest by normalised edit distance wins, then the nearest
year, then the order of the roster; beyond the greatest distance there is no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions import let
from sluiceway.functions.text import icontains, latin_ascii, trimws
from sluiceway.session import cut


def simple_name(c: Column) -> Column:
    """Lower-case ASCII letters with single spaces; null if none is left."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(latin_ascii(c)), "[^a-z]+", " ")), F.lit(""))


def first_token(c: Column) -> Column:
    return F.get(F.split(c, " "), F.lit(0))


def last_token(c: Column) -> Column:
    return F.element_at(F.split(c, " "), -1)


def split_alternates(c: Column) -> Column:
    """Parts between ";" and "|", trimmed, without blank ones."""
    return F.filter(F.transform(F.split(c, r"\s*[;|]\s*"), trimws), lambda v: v != "")


def distance(a: Column, b: Column) -> Column:
    """Edits over the longer length, without regard to case; null for null."""
    return F.levenshtein(F.lower(a), F.lower(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def least_distance(a: Column, candidates: Column) -> Column:
    """The least distance to any candidate; null without candidates."""
    return F.array_min(F.filter(F.transform(candidates, lambda c: distance(a, c)), lambda d: d.isNotNull()))


def roster_index(roster: DataFrame, name: str = "employee_name", alternate: str = "employee_alternate_name", division: str = "division_adjusted", year: str = "year", order: str = "roster_id") -> DataFrame:
    """``place, division, year, candidates, last_names`` for each roster row with a name."""
    if missing := {name, division, year} - set(roster.columns):
        raise ValueError(f"the roster lacks {sorted(missing)}")
    others = F.transform(split_alternates(F.coalesce(F.col(alternate), F.lit(""))), simple_name)
    names = F.array_distinct(F.filter(F.concat(F.array(simple_name(F.col(name))), others), lambda v: v.isNotNull()))
    out = roster.select(F.col(order).alias("place"), F.col(division).alias("division"), F.trim(F.col(year)).try_cast("double").try_cast("int").alias("year"), names.alias("candidates"))
    return out.withColumn("last_names", F.array_distinct(F.transform("candidates", last_token)))


def first_affiliated(authors: Column, pairs: Column, pattern: str) -> Column:
    """``struct<author, position>`` of the first author one of whose affiliations has the pattern."""
    named = F.transform(authors, lambda a, i: F.struct(a.alias("author"), (i + 1).alias("position")))
    return F.get(F.filter(named, lambda x: F.exists(pairs, lambda p: (p["author"] == x["author"]) & icontains(p["canonical_affiliation"], pattern))), F.lit(0))


def grams(c: Column) -> Column:
    """The pairs of neighbouring letters of a simple name, each with the number of its like before it, so that lists compare as multisets."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(2)))
    numbered = lambda ps: F.transform(ps, lambda x, i: F.concat(x, F.size(F.filter(F.slice(ps, F.lit(1), i), lambda y: y == x)).cast("string")))
    return let(pairs, numbered)


def rarest_grams(texts: DataFrame, counts: DataFrame, max_distance: float) -> DataFrame:
    """``text, g``: for each distinct ``text`` so many of its rarest grams that any name within the distance shares one of them. ``counts``: ``g, n``, how often each gram stands.

    k edits leave all but 2k of a name's grams, so names of which the longer has n letters and that
    are within the distance share n - 1 - 2 floor(n d) grams; the least such number over all lengths a
    partner may have tells how many grams may be left out.
    """
    n = F.length("text")
    shared = F.transform(F.sequence(n, F.ceil(n / (1 - max_distance)).cast("int") + 1), lambda m: m - 1 - 2 * F.floor(m * max_distance + 1e-9).cast("int"))
    each = texts.select("text", F.explode(grams(F.col("text"))).alias("g")).join(counts, "g", "left")
    ordered = each.groupBy("text").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g"))).alias("gs"))
    kept = F.slice("gs", F.lit(1), F.greatest(F.lit(1), F.size("gs") - F.greatest(F.array_min(shared), F.lit(1)) + 1))
    return ordered.select("text", F.explode(kept).alias("x")).select("text", "x.g")


def matched(people: DataFrame, index: DataFrame, max_year_gap: int = 1, max_distance: float = 0.3) -> DataFrame:
    """``name, year, division, distance`` for each distinct ``name, year`` of ``people`` that has a match.

    Two equi-joins instead of comparing everybody with everybody. Whether the year filter holds
    depends on the roster's years alone, a short list. People with a candidate of their last name
    are joined by it; the others can only match within the greatest distance, so they are joined by
    their rarest pairs of letters, of which every such candidate shares one.
    """
    wanted = people.select("name", "year").distinct().withColumn("clean", simple_name(F.col("name"))).filter("clean is not null")
    entries = index.filter(F.size("candidates") > 0).groupBy("candidates", "last_names", "year", "division").agg(F.min("place").alias("place")).withColumnRenamed("year", "e_year")
    years = [r.year for r in index.select("year").distinct().filter("year is not null").collect()]  # calendar years
    gap = F.abs(F.col("e_year") - F.col("year"))
    some_near = F.exists(F.array(*map(F.lit, years)).cast("array<int>"), lambda y: F.abs(y - F.col("year")) <= max_year_gap)
    allowed = F.col("year").isNull() | ~some_near | F.coalesce(gap <= max_year_gap, F.lit(False))
    rank = F.struct(F.col("distance"), F.when(F.col("year").isNull(), 0).otherwise(F.coalesce(gap, F.lit(1 << 30))).alias("gap"), "place", "division")

    def best(pairs: DataFrame) -> DataFrame:
        d = pairs.withColumn("distance", least_distance(F.col("clean"), F.col("candidates")))
        return d.groupBy("name", "year", "clean").agg(F.min(rank).alias("x"))

    by_last = entries.withColumn("last", F.explode("last_names"))
    named = cut(best(wanted.withColumn("last", last_token(F.col("clean"))).join(by_last, "last").filter(allowed)))
    rest = wanted.join(named.select("name", F.col("year").alias("y")), (wanted["name"] == named["name"]) & wanted["year"].eqNullSafe(F.col("y")), "left_anti")
    spelled = entries.withColumn("c", F.explode("candidates"))
    counts = spelled.select(F.explode(grams(F.col("c"))).alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    rare = cut(rarest_grams(rest.select(F.col("clean").alias("text")).unionByName(spelled.select(F.col("c").alias("text"))).distinct(), counts, max_distance))
    left = rest.join(rare.withColumnRenamed("text", "clean"), "clean")
    right = spelled.join(rare.withColumnRenamed("text", "c"), "c").drop("candidates").withColumn("candidates", F.array("c"))
    close = left.join(right, "g").filter(allowed & (distance(F.col("clean"), F.col("c")) <= max_distance))
    found = named.unionByName(best(close))
    return found.select("name", "year", F.when(F.col("x.distance") <= max_distance, F.col("x.division")).alias("division"), F.col("x.distance").alias("distance"))


def annotate_divisions(works: DataFrame, roster: DataFrame, pattern: str, flag: str | None = None, prefix: str = "first_affiliated", max_year_gap: int = 1, max_distance: float = 0.3, **columns: str) -> DataFrame:
    """Appends ``<prefix>_author, _author_position, _author_division``; rows whose flag isn't true get nulls."""
    found = first_affiliated(F.col("authors"), F.col("author_affiliations"), pattern)
    out = works.withColumn("_first", F.when(F.col(flag), found) if flag else found)
    out = out.withColumns({f"{prefix}_author": F.col("_first.author"), f"{prefix}_author_position": F.col("_first.position").cast("int")}).drop("_first")
    people = out.filter(F.col(f"{prefix}_author").isNotNull()).select(F.col(f"{prefix}_author").alias("name"), F.col("publication_year").alias("year"))
    best = matched(people, roster_index(roster, **columns), max_year_gap, max_distance).select(F.col("name").alias("_name"), F.col("year").alias("_year"), F.col("division").alias(f"{prefix}_author_division"))
    return out.join(best, (F.col(f"{prefix}_author") == F.col("_name")) & F.col("publication_year").eqNullSafe(F.col("_year")), "left").drop("_name", "_year")


#: One hand-made override: DOI, author, position and, if the author is to be matched by another year than the row's, that year.
Override = tuple[str, str, int, int | None]


def override_first_affiliated(works: DataFrame, roster: DataFrame, overrides: list[Override], key: str = "record_id", prefix: str = "first_affiliated", max_year_gap: int = 1, max_distance: float = 0.3, **columns: str) -> DataFrame:
    """Sets author and position by hand and matches the division anew. Of several rows with a DOI the one with the smallest ``key`` is meant; the last override of a DOI wins."""
    spark = works.sparkSession
    last = {doi: (doi, author, position, year) for doi, author, position, year in overrides}
    if not last:
        return works
    made = spark.createDataFrame(list(last.values()), "_doi string, _author string, _position int, _year int")
    first = works.filter(F.col("doi").isin(list(last))).groupBy("doi").agg(F.min(key).alias("_key"))
    meant = first.join(F.broadcast(made), F.col("doi") == F.col("_doi")).drop("doi", "_doi")  # a row for each override
    out = works.join(F.broadcast(meant), F.col(key) == F.col("_key"), "left").withColumn("_year", F.coalesce("_year", F.col("publication_year")))
    people = out.filter("_key is not null").select(F.col("_author").alias("name"), F.col("_year").alias("year"))
    best = matched(people, roster_index(roster, **columns), max_year_gap, max_distance).select(F.col("name").alias("_name"), F.col("year").alias("_matched_year"), F.col("division").alias("_division"))
    out = out.join(F.broadcast(best), (F.col("_author") == F.col("_name")) & F.col("_year").eqNullSafe(F.col("_matched_year")), "left")
    changed = F.col("_key").isNotNull()
    out = out.withColumns({f"{prefix}_author": F.when(changed, F.col("_author")).otherwise(F.col(f"{prefix}_author")), f"{prefix}_author_position": F.when(changed, F.col("_position")).otherwise(F.col(f"{prefix}_author_position")), f"{prefix}_author_division": F.when(changed, F.col("_division")).otherwise(F.col(f"{prefix}_author_division"))})
    return out.select(*works.columns)
