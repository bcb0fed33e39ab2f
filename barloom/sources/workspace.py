"""A folder that driver and executors share, for what a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in spark.checkpoint.dir; only a local session may go without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str) -> DataFrame:
    """df worked out once, as a Parquet table in that folder: for what several branches of a plan read. A lost executor repeats its tasks of the write only."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
