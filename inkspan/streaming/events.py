"""Event streams: sliding counts, first occurrences, sessions, and a queue with claims that time out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from inkspan.operators.queues import TERMINAL


def read(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream, some a batch: the rate limit of a source of files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def sliding(events: DataFrame, size: str = "10 minutes", step: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", size, step)).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return counted.select(F.col("window.start").alias("start"), "n", "errors")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    counted = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def first_of_each(events: DataFrame, key: str, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def drained(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything that is there now, written to a table and read back; the checkpoint lets a later run go on from there."""
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def resumed(source: DataFrame, done: str, checkpoint: str, key: str, work) -> None:
    """Each batch's rows that aren't done go to work (a function of a DataFrame that gives key and status); what it completed is added to the done table."""

    def batch(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(done)
        there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
        # the first batch finds no table; one that is there and can't be read is an error
        known = spark.read.parquet(done).select(key) if there else rows.select(key).limit(0)
        result = work(rows.join(known, key, "left_anti"))
        result.where("status <> 'error'").write.mode("append").parquet(done)

    source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


TICKS = {"s": 1, "ms": 10**3, "us": 10**6, "ns": 10**9}
STATE = "status string, claim_id string, claimed_at double"
CLAIMS = "job long, task_key string, status string, claim_id string"


def claims(events: DataFrame, timeout_ms: int = 600_000, late: str = "10 minutes") -> DataFrame:
    """The status of each task (job, task_key) after its events (kind: claim, complete, fail, with claim_id): a claim whose time runs out makes it pending again; completion counts only with the claim that holds. Time is that of the events, so a drained stream comes to an end."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, claim, at = state.get if state.exists else ("pending", "", 0.0)
        if state.hasTimedOut:
            status, claim = ("pending", "") if status == "claimed" else (status, claim)
        else:
            rows = pd.concat(list(batches)).sort_values("event_id")
            for kind, claim_id, now in zip(rows["kind"].tolist(), rows["claim_id"].tolist(), (rows["ts"].astype("int64") / TICKS[rows["ts"].dt.unit]).tolist()):
                if status == "claimed" and now - at > timeout_ms / 1000:
                    status, claim = "pending", ""
                if kind == "claim" and status == "pending":
                    status, claim, at = "claimed", claim_id, now
                elif kind in ("complete", "fail") and status == "claimed" and claim_id == claim:
                    status = "updated" if kind == "complete" else "error"
        state.update((status, claim, at))
        if status == "claimed":
            state.setTimeoutTimestamp(max(int(at * 1000) + timeout_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], key[1], status, claim)], columns=["job", "task_key", "status", "claim_id"])

    return events.withWatermark("ts", late).groupBy("job", "task_key").applyInPandasWithState(step, CLAIMS, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def is_terminal(status: F.Column) -> F.Column:
    return status.isin(*TERMINAL)
