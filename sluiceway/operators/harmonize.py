"""Two metadata sources made one: full outer join on the DOI, and column by column the first value that is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.skew import SIDE, crowded, in_cells

SCALARS = ("title", "abstract", "journal", "publication_year", "landing_page_url", "cited_by_count", "volume", "publisher")
ONLY_FIRST = ("is_oa", "is_oa_anywhere", "oa_status", "pdf_url", "license", "first_page", "last_page", "issue")
LISTS = ("authors", "unique_affiliations", "canonical_affiliations")
FLAGS = ("dwr_author", "dwr_lead_author", "dwr_sole_author", "dwr_funding_other")


def first_list(a: Column, b: Column) -> Column:
    """``a`` if it has an element that isn't null, else ``b``."""
    return F.when(F.coalesce((F.size(a) > 0) & F.exists(a, lambda x: x.isNotNull()), F.lit(False)), a).otherwise(b)


def first_rows(a: Column, b: Column) -> Column:
    """``a`` if it has rows, else ``b``."""
    return F.when(F.coalesce(F.size(a) > 0, F.lit(False)), a).otherwise(b)


def either(a: Column, b: Column) -> Column:
    """Logical or, null counting as false."""
    return F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False))


def harmonized(first: DataFrame, second: DataFrame, key: str = "doi", known: DataFrame | None = None, side: int = SIDE) -> DataFrame:
    """Rows of both sources by ``key``; the first source's values come first. Duplicates on either side multiply.

    ``known`` has further columns for a key, which it has once. A full join holds all pairs of a key
    in memory before it passes on the first, so keys with many pairs are joined cell by cell of a
    grid. Such a key is in both sources, so what has no partner in a cell has one in another.
    """
    keys = crowded(first, second, key, side)
    first, second = in_cells(first, keys, key, "first"), in_cells(second, keys, key, "second")
    if known is not None:
        known = in_cells(known, keys, key, "every").drop("_crowded")
        first, second = (x.join(known, [key, "_cell"], "left") for x in (first, second))
    a, b = first.alias("a"), second.alias("b")
    joined = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a._cell") == F.col("b._cell")), "full")
    joined = joined.filter(~F.coalesce("a._crowded", "b._crowded") | (F.col("a._cell").isNotNull() & F.col("b._cell").isNotNull()))
    have = lambda side, c: F.col(f"{side}.{c}") if c in (first if side == "a" else second).columns else F.lit(None)
    both = lambda c, f: f(have("a", c), have("b", c)).alias(c)
    known = {*first.columns, *second.columns}
    return joined.select(
        F.coalesce(f"a.{key}", f"b.{key}").alias(key),
        *(both(c, F.coalesce) for c in (*SCALARS, "doi_source") if c in known),
        *(have("a", c).alias(c) for c in ONLY_FIRST if c in first.columns),
        *(both(c, first_list) for c in LISTS if c in first.columns and c in second.columns),
        *([both("author_affiliations", first_rows)] if "author_affiliations" in first.columns and "author_affiliations" in second.columns else []),
        *(both(c, either) for c in FLAGS if c in known),
    )


def since(works: DataFrame, year: int, column: str = "publication_year") -> DataFrame:
    """Works of a readable year, from ``year`` on."""
    return works.filter(F.col(column).try_cast("int") >= year)


def default_flag(works: DataFrame, flag: str, when: Column, flags: tuple[str, ...] = FLAGS) -> DataFrame:
    """Sets ``flag`` for rows that meet ``when`` and have no flag at all."""
    none = F.lit(True)
    for f in flags:
        none = none & ~F.coalesce(F.col(f), F.lit(False))
    return works.withColumn(flag, F.when(F.coalesce(when, F.lit(False)) & none, True).otherwise(F.col(flag)))
