"""The register of DOIs kept up to date from a stream of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.doi import clean_doi


def new_dois(lines: DataFrame, time: str, column: str = "doi", late: str = "1 day") -> DataFrame:
    """Each DOI of a stream when it first comes: later copies within ``late`` are dropped, and state beyond it is let go."""
    cleaned = lines.withColumn("doi", clean_doi(F.col(column))).filter("doi is not null")
    return cleaned.withWatermark(time, late).dropDuplicatesWithinWatermark(["doi"])
