"""Where results go."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str) -> None:
    """A parquet table, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header, doubled quotes and empty nulls; one file if ``single``, for results that one task may hold."""
    nested = [c for c, kind in df.dtypes if kind.startswith(("array", "map", "struct"))]
    if nested:
        raise ValueError(f"not flat: {nested}")
    (df.coalesce(1) if single else df).write.mode("overwrite").options(header=True, escape='"', nullValue="", emptyValue="").csv(path)
