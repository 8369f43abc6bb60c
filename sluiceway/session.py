"""Session helpers: tables, and cutting a plan's lineage on storage that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, an own one if the session runs in one process, as in tests; an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="sluiceway-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: no lineage, no loss with an executor, and its true size for the plans that use it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def swept(spark: SparkSession) -> None:
    """Deletes every table that ``cut`` has left in the shared folder; for when no plan uses them any more."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/cut-*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(pattern) or []:
        files.delete(found.getPath(), True)
