"""Authors and affiliations inside nested records, as expressions over arrays of structs.

``author`` is an array of structs with given, family, name, literal and affiliation (an array of
strings); ``authorships`` one of structs with display_name, affiliation_raw and affiliations (an
array of structs with display_name). Null and empty arrays are treated alike throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.institutions import output_form
from sluiceway.functions.text import nonblank, squish, trimws

NO_STRINGS = "array<string>"


def filled(values: Column, kind: str = NO_STRINGS) -> Column:
    """An empty array for null."""
    return F.coalesce(values, F.array().cast(kind))


def distinct_text(values: Column) -> Column:
    """Trimmed, non-blank, in order of first appearance."""
    return F.array_distinct(F.filter(F.transform(filled(values), trimws), lambda v: v != ""))


def crossref_name(a: Column) -> Column:
    """The first filled of name, literal, "given family"; null without any."""
    both = F.nullif(F.concat_ws(" ", nonblank(a["given"]), nonblank(a["family"])), F.lit(""))
    return F.coalesce(nonblank(a["name"]), nonblank(a["literal"]), both)


def crossref_affiliation(a: Column, compat: bool = False) -> Column:
    """The first affiliation. With ``compat`` one that is listed but null is the text "NA"."""
    if compat:
        kept = F.filter(filled(a["affiliation"]), lambda v: v.isNull() | (trimws(v) != ""))
        return F.when(F.size(kept) > 0, F.coalesce(trimws(F.get(kept, F.lit(0))), F.lit("NA")))
    return F.get(distinct_text(a["affiliation"]), F.lit(0))


def crossref_authors(author: Column, compat: bool = False) -> Column:
    """``array<struct<author_name, author_affiliation>>``: one entry for each author."""
    one = lambda a: F.struct(crossref_name(a).alias("author_name"), crossref_affiliation(a, compat).alias("author_affiliation"))
    return F.transform(author, one)


def scalar_affiliations(a: Column, fields: list[str]) -> Column:
    """Affiliations of an author that stand in fields of their own (affiliation1, affiliation_name, ...), trimmed, without blank ones."""
    return distinct_text(F.array(*(a[f].cast("string") for f in fields if f.lower().startswith("affiliation"))))


def normalized_authors(works: DataFrame, column: str = "author", compat: bool = False) -> DataFrame:
    """The column in normalised form; one that is normalised already, by its schema, is left alone."""
    element = works.schema[column].dataType.elementType
    if "author_name" in element.names or "author_affiliation" in element.names:
        return works
    return works.withColumn(column, crossref_authors(F.col(column), compat))


def crossref_author_names(author: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(filled(author, "array<struct<name:string,literal:string,given:string,family:string,affiliation:array<string>>>"), crossref_name), lambda n: n.isNotNull()))


def crossref_pairs(author: Column, compat: bool = False) -> Column:
    """``array<struct<author, affiliation>>`` without entries that lack both."""
    one = lambda a: F.struct(crossref_name(a).alias("author"), crossref_affiliation(a, compat).alias("affiliation"))
    return F.filter(F.transform(author, one), lambda p: p["author"].isNotNull() | p["affiliation"].isNotNull())


def pair_affiliations(pairs: Column) -> Column:
    """The different affiliations of a work's pairs."""
    return distinct_text(F.transform(pairs, lambda p: p["affiliation"]))


def openalex_author_affiliations(a: Column) -> Column:
    """All affiliations of one authorship: as typed, then as recognised."""
    return distinct_text(F.concat(F.array(a["affiliation_raw"]), F.transform(filled(a["affiliations"], "array<struct<display_name:string>>"), lambda x: x["display_name"])))


def openalex_affiliations(authorships: Column) -> Column:
    """The different affiliations of a work, in the order of its authors."""
    return F.array_distinct(F.flatten(F.transform(F.filter(filled(authorships, "array<struct<display_name:string,affiliation_raw:string,affiliations:array<struct<display_name:string>>>>"), lambda a: a.isNotNull()), openalex_author_affiliations)))


def openalex_author_names(authorships: Column) -> Column:
    return distinct_text(F.transform(authorships, lambda a: a["display_name"]))


def affiliation_values(works: DataFrame, column: str) -> DataFrame:
    """``original``: the squished distinct affiliations of all works, the keys of the lookup."""
    return works.select(F.explode(column).alias("v")).select(squish(F.col("v")).alias("original")).filter("original <> ''").distinct()


def _canonical(rows: DataFrame, lookup: DataFrame, value: str) -> DataFrame:
    """Joins the lookup; ``canonical`` is null on a miss. Of several entries for one value the first by ``place`` counts, without that column the first by name. The lookup grows with the data and is shuffled unless it is small."""
    first = F.min_by("canonical", "place") if "place" in lookup.columns else F.min("canonical")
    one = lookup.groupBy("original").agg(first.alias("canonical"))
    return rows.join(one, squish(F.col(value)) == F.col("original"), "left").drop("original")


def canonical_affiliations(works: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """``key, canonical_affiliations``: the canonical names of a work's affiliations in order; misses are dropped."""
    rows = works.select(key, F.posexplode(column).alias("pos", "value"))
    found = _canonical(rows, lookup, "value").filter("canonical is not null")
    first = found.groupBy(key, "canonical").agg(F.min("pos").alias("pos"))
    each = F.transform(F.array_sort(F.collect_list(F.struct("pos", "canonical"))), lambda x: output_form(x["canonical"]))
    return first.groupBy(key).agg(F.filter(each, lambda v: v.isNotNull()).alias("canonical_affiliations"))


def crossref_canonical_pairs(works: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """``key, author_affiliations``: each pair with its canonical affiliation; pairs that lack both are dropped."""
    rows = works.select(key, F.posexplode(column).alias("pos", "pair")).select(key, "pos", F.col("pair.author").alias("author"), F.col("pair.affiliation").alias("affiliation"))
    return _regrouped(_canonical(rows, lookup, "affiliation"), key)


def openalex_canonical_pairs(works: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """As above, one row for each author and affiliation, one for authors without any; nothing at all without a lookup."""
    rows = works.select(key, F.posexplode(column).alias("pos", "a")).filter("a is not null")
    rows = rows.select(key, "pos", nonblank(F.col("a.display_name")).alias("author"), F.explode_outer(openalex_author_affiliations(F.col("a"))).alias("affiliation"))
    return _regrouped(_canonical(rows, lookup, "affiliation") if not lookup.isEmpty() else rows.withColumn("canonical", F.lit(None).cast("string")).limit(0), key)


def _regrouped(rows: DataFrame, key: str) -> DataFrame:
    rows = rows.withColumn("canonical_affiliation", output_form(F.col("canonical"))).filter("author is not null or canonical_affiliation is not null")
    entry = F.struct("pos", "author", "canonical_affiliation")
    distinct = rows.select(key, entry.alias("e")).distinct()
    return distinct.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("e")), lambda x: F.struct(x["author"].alias("author"), x["canonical_affiliation"].alias("canonical_affiliation"))).alias("author_affiliations"))


def in_order(df: DataFrame, by: list[str], order: list[str], size: int) -> DataFrame:
    """Adds ``chunk``: rows of each group of ``by`` in order, cut into chunks of ``size``."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("chunk", F.floor((place - 1) / max(1, size)).cast("int"))
