"""Where intermediate tables go, and small helpers that all operators use."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from inkspan.session import small_batches  # noqa: F401  used through here

#: Bytes that a broadcast side may take; beyond it the join is left to a shuffle.
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only where that is unset and all runs on one machine (tests), a folder of our own."""
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    own = spark.conf.get("inkspan.shared.dir", None)
    if not own:
        own = "file://" + tempfile.mkdtemp(prefix="inkspan-")
        spark.conf.set("inkspan.shared.dir", own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Deletes, at its end, the tables that written() made within it, but for those whose paths were taken off the list."""
    made: list[str] = []
    _SCRATCH.append(made)
    try:
        yield made
    finally:
        _SCRATCH.pop()
        for path in made:
            forget(spark, path)


def kept(made: list[str], df: DataFrame) -> DataFrame:
    """Takes a table that written() made off a scratch list; an outer scratch, if any, has it then."""
    made.remove(df._inkspan_path)
    if len(_SCRATCH) > 1:
        _SCRATCH[-2].append(df._inkspan_path)
    return df


def written(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """The rows of df, written to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._inkspan_path = path
    return out


def forget(spark: SparkSession, path: str) -> None:
    """Deletes a table written by written() that nothing reads any more."""
    url = urlparse(path)
    if url.scheme in ("", "file"):
        shutil.rmtree(url.path, ignore_errors=True)
    else:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to clash with no column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
