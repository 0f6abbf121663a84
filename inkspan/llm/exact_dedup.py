"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

New rows are reduced to the least doc_id of each digest (with map-side
combining, so a hot text costs one row a task), then joined to the index by a
sort-merge anti-join: the index is bucketed like the shuffle, so it is read in
place. What remains is new and is appended, a file for each bucket. The index
is a folder of generations; any later session opens the latest by the folder's path.

Appends leave several sorted files in a bucket, which Spark then has to sort
again; compact() rewrites the index as a new generation with one file a bucket,
and with more buckets if it has grown: a bucket should stay within a task's
memory, some 10^7 digests. One writer at a time: a second one fails on the
index's lock file; unlock() removes that of a writer which is gone.

Defined cases: a null text counts as empty; texts are compared byte by byte; a
null doc_id stays only where no copy of a batch has one; repeated rows are copies; extra
columns are ignored; an empty table adds nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


class DigestIndex:
    """The digests seen so far, with the doc_id that brought each. An index that is there keeps its own number of buckets until compact() changes it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        there = self._generations()
        self._open(*(max(there) if there else (0, int(buckets))))

    def _fs(self):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _generations(self) -> list[tuple[int, int]]:
        """(number, buckets) of each generation that is complete."""
        fs, root = self._fs(), self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
        return [(int(n.split("-")[1]), int(n.split("-")[2])) for n in names if n.startswith("ready-")]

    def _open(self, generation: int, buckets: int) -> None:
        self.generation, self.buckets = generation, buckets
        self.name = self._create(generation, buckets)

    def _create(self, generation: int, buckets: int) -> str:
        at = f"{self.path}/generation-{generation:06d}-{buckets}"
        name = "digests_" + hashlib.md5(at.encode()).hexdigest()
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (doc_id BIGINT, digest BINARY) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{at}'")
        return name

    @contextmanager
    def _writing(self) -> Iterator[None]:
        lock = self._hadoop("_lock")
        self._fs().mkdirs(self._hadoop("."))
        try:
            made = self._fs().createNewFile(lock)
        except Exception as e:
            made = not self._fs().exists(lock)
            if made:
                raise
            raise RuntimeError(f"another writer holds {self.path}/_lock") from e
        if not made:
            raise RuntimeError(f"another writer holds {self.path}/_lock")
        try:
            yield
        finally:
            self._fs().delete(lock, False)

    def unlock(self) -> None:
        self._fs().delete(self._hadoop("_lock"), False)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def fresh(self, docs: DataFrame) -> DataFrame:
        """(doc_id, digest) of one document for each digest that the index lacks."""
        digest = F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
        firsts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest")).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
        known = self.table().select("digest").hint("merge")
        return firsts.repartition(self.buckets, "digest").join(known, "digest", "left_anti").select("doc_id", "digest")

    def absorb(self, docs: DataFrame) -> None:
        """Appends what is fresh."""
        with self._writing():
            self._append(self.fresh(docs), self.name, self.buckets)
            if not self._generations():
                self._fs().createNewFile(self._hadoop(f"ready-{self.generation}-{self.buckets}"))

    def _append(self, rows: DataFrame, name: str, buckets: int) -> None:
        rows.repartition(buckets, "digest").sortWithinPartitions("digest").write.insertInto(name)
        self.spark.catalog.refreshTable(name)

    def compact(self, buckets: int | None = None) -> None:
        """Rewrites the index with one file a bucket, and so many buckets; the old generation goes when the new one is complete."""
        with self._writing():
            old = (self.generation, self.buckets, self.name)
            new, n = self.generation + 1, int(buckets or self.buckets)
            # what an earlier attempt has left
            self._fs().delete(self._hadoop(f"generation-{new:06d}-{n}"), True)
            name = self._create(new, n)
            self._append(self.spark.table(old[2]), name, n)
            self._fs().createNewFile(self._hadoop(f"ready-{new}-{n}"))
            self.generation, self.buckets, self.name = new, n, name
            self._fs().delete(self._hadoop(f"ready-{old[0]}-{old[1]}"), False)
            self.spark.sql(f"DROP TABLE {old[2]}")
            self._fs().delete(self._hadoop(f"generation-{old[0]:06d}-{old[1]}"), True)
