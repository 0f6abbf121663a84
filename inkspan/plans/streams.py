"""The event table as a stream, drained and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.registry import query
from inkspan.session import table
from inkspan.sources.shared_tables import folder
from inkspan.streaming import events as E


PARTS = 4


def _stream(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, str, str]:
    """The events in files of a quarter of their time each, a file a micro-batch; the last one holds the first day's events once more, too late to count."""
    base = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    at = F.least(F.lit(PARTS - 1), F.floor((F.unix_micros("ts") - lo) * PARTS / F.lit(hi - lo + 1)))
    for k in range(PARTS):
        part = events.where(at == k)
        if k == PARTS - 1:
            part = part.unionByName(events.where(F.unix_micros("ts") < lo + 86_400_000_000))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    return E.read(spark, f"{base}/in", events.schema), f"{base}/out", f"{base}/checkpoint"


@query("""WITH b AS (SELECT time_bucket(INTERVAL '1 minute', ts) AS m, unnest(range(10)) AS i, event_type FROM events), w AS (SELECT m - to_minutes(i::INTEGER) AS start, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM b GROUP BY 1)
    SELECT start, n, errors FROM w WHERE start + INTERVAL '10 minutes' <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '10 minutes' FROM events)""")
def stream_sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that the watermark closed: all that end ten minutes before the last event."""
    stream, out, checkpoint = _stream(spark, sf_dir, "sliding")
    return E.drained(E.sliding(stream), out, checkpoint)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first occurrence of each user's kind of event; they repeat within and across micro-batches."""
    stream, out, checkpoint = _stream(spark, sf_dir, "dedupe")
    keyed = stream.withColumn("key", F.concat_ws(":", "user_id", "event_type"))
    return E.drained(E.first_of_each(keyed, "key", "20000 days").select("user_id", "event_type"), out, checkpoint)


@query("SELECT event_id, event_type AS status FROM events WHERE event_type <> 'error'")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work done batch by batch, resumed once: what is in the result log isn't done again, failures are not in it."""
    stream, out, checkpoint = _stream(spark, sf_dir, "resume")
    work = lambda rows: rows.select("event_id", F.col("event_type").alias("status")).distinct()
    E.resumed(stream, out, checkpoint, "event_id", work)
    E.resumed(stream, out, f"{checkpoint}-again", "event_id", work)
    return spark.read.parquet(out)


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM s),
    r AS (SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '30 minutes' AS "end", count(*) AS n FROM g GROUP BY user_id, g.g) SELECT user_id, start, "end", n FROM r WHERE "end" <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '10 minutes' FROM events)""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user that the watermark closed."""
    stream, out, checkpoint = _stream(spark, sf_dir, "sessions")
    return E.drained(E.sessions(stream), out, checkpoint)
