"""Tables from files: CSV, lines, parquet snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.text import title_case, trimws


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header; a byte order mark is dropped, fields are trimmed, doubled quotes are one."""
    rows = spark.read.schema(schema).options(header=True, escape='"', multiLine=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True).csv(path)
    return rows.withColumns({c: trimws(F.col(c)) for c, kind in rows.dtypes if kind == "string"})


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the lines of text files."""
    return spark.read.text(path)


def read_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one of this schema if nothing is stored there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def title_cased(roster: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct roster rows with names in title case."""
    return roster.withColumns({c: title_case(F.col(c)) for c in columns}).distinct()
