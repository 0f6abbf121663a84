"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only where that is unset and all runs on one machine (tests), a folder of our own."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("inkspan.shared.dir", None)
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="inkspan-")
        spark.conf.set("inkspan.shared.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written and read again: cuts lineage, survives lost executors, and gives the same rows at every use."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
