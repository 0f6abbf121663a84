"""The session that the engine is made for: UTC, ANSI, adaptive plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch that goes to a Python worker. By rows alone a batch of long texts takes tens of MB, several times over on its way.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Limits the session's Arrow batches to BATCH_BYTES, unless a smaller limit in bytes is set."""
    now = spark.conf.get(_BATCH).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
