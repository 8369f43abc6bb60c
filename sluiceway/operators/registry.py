"""The register of DOIs: cleaning, priorities of sources, lists of what to leave out, chunks."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.functions.doi import clean_doi


def doi_registry(sources: dict[str, DataFrame], column: str = "doi") -> DataFrame:
    """``doi, doi_source`` from sources in falling order of trust: each DOI once, from the first source that has it."""
    parts = [df.select(clean_doi(F.col(column)).alias("doi"), F.lit(i).alias("rank"), F.lit(name).alias("doi_source")) for i, (name, df) in enumerate(sources.items())]
    stacked = reduce(DataFrame.unionByName, parts).filter("doi is not null")
    return stacked.groupBy("doi").agg(F.min_by("doi_source", "rank").alias("doi_source"))


def extract_dois(works: DataFrame, column: str = "doi", clean: bool = True, distinct: bool = True, strict: bool = False) -> DataFrame:
    """``doi`` of a table of works. Without the column: an error if ``strict``, else a warning and no rows."""
    if column not in works.columns:
        if strict:
            raise ValueError(f"no column {column!r}")
        warnings.warn(f"no column {column!r}", stacklevel=2)
        return works.sparkSession.createDataFrame([], "doi string")
    out = works.select((clean_doi(F.col(column)) if clean else F.col(column)).alias("doi")).filter("doi is not null")
    return out.distinct() if distinct else out


def without(dois: DataFrame, dropped: DataFrame, column: str = "doi") -> DataFrame:
    """Rows whose DOI isn't in the list; both sides cleaned. Null DOIs stay."""
    listed = dropped.select(clean_doi(F.col(column)).alias("_dropped")).filter("_dropped is not null").distinct()
    return dois.join(listed, clean_doi(F.col(column)) == F.col("_dropped"), "left_anti")


def chunked(df: DataFrame, order: str, size: int) -> DataFrame:
    """Adds ``chunk``: rows in order, ``size`` in each.

    Places are counted within ranges of the order and shifted by the ranges' sizes, so no task sees
    all rows.
    """
    parts = df.repartitionByRange(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), order).withColumn("_part", F.spark_partition_id())
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    shift = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))  # a row for each partition
    placed = parts.withColumn("_row", F.row_number().over(Window.partitionBy("_part").orderBy(order))).join(F.broadcast(shift), "_part")
    return placed.withColumn("chunk", F.floor((F.col("_row") - 1 + F.coalesce("_before", F.lit(0))) / max(1, size)).cast("bigint")).drop("_part", "_n", "_before", "_row")


def chunk_list(values: list, size: int) -> list[list]:
    """A driver-side list in chunks, for requests."""
    return [values[i : i + max(1, size)] for i in range(0, len(values), max(1, size))]


def or_else(value, other):
    """``other`` if ``value`` is None."""
    return other if value is None else value
