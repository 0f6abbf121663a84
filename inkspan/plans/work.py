"""Work lists, shards, logs and claims, with documents and events in the place of files and log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.operators import queues as Q
from inkspan.registry import query
from inkspan.session import table

SPEC = "main:4,second:1.5,third:1"
STATUSES = {"view": "updated", "click": "updated_empty", "error": "error", "signup": "updated", "purchase": "claimed"}
SQL_STATUS = "CASE event_type WHEN 'view' THEN 'updated' WHEN 'click' THEN 'updated_empty' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'updated' ELSE 'claimed' END"


def status() -> F.Column:
    out = F.lit("pending")
    for kind, name in STATUSES.items():
        out = F.when(F.col("event_type") == kind, name).otherwise(out)
    return out


@query("WITH g AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents WHERE n_chars >= 50) SELECT doc_id, (i % 4)::INTEGER AS shard FROM g UNION ALL SELECT doc_id, unnest(range(4))::INTEGER FROM documents WHERE n_chars < 50")
def shard_modulo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over four shards by rank; those that are too short go to all."""
    return Q.shard(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", 4, F.col("n_chars") >= 50).select("doc_id", "shard")


@query("WITH c AS (SELECT unnest(" + repr(Q.cycle(SPEC)) + f") AS name, unnest(range({len(Q.cycle(SPEC))})) AS k), g AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT doc_id, name AS partition FROM g JOIN c ON i % {len(Q.cycle(SPEC))} = k")
def weighted_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.weighted(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SPEC)


@query("WITH g AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) SELECT doc_id, i // 150 AS chunk, (i // 150 % 3)::INTEGER AS worker FROM g")
def chunk_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.chunks(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 150, 3)


@query(f"SELECT user_id, arg_max({SQL_STATUS}, event_id) AS status FROM events GROUP BY 1")
def log_replay_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.replay(table(spark, sf_dir, "events").withColumn("status", status()), "user_id", "event_id")


@query(f"WITH l AS (SELECT user_id, event_id, {SQL_STATUS} AS status FROM events) SELECT user_id, arg_max(status, event_id) AS status FROM l WHERE status NOT IN ('error', 'updated_empty') GROUP BY 1")
def log_replay_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.replay(table(spark, sf_dir, "events").withColumn("status", status()), "user_id", "event_id", retry_failed=True)


@query(f"WITH l AS (SELECT user_id, arg_max({SQL_STATUS}, event_id) AS status FROM events GROUP BY 1) SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM l WHERE status = 'updated')")
def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), "event_id", status().alias("status"))
    return Q.remaining(table(spark, sf_dir, "customer").select("c_custkey"), log, "c_custkey", "event_id")


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'error'")
def failed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.failed_keys(table(spark, sf_dir, "events").withColumn("status", status()), "user_id")


@query(f"WITH t AS (SELECT event_id % 7 AS job, user_id AS item_path, {SQL_STATUS} AS status FROM events) SELECT job, count(*) AS tasks, count(*) FILTER (status <> 'claimed') AS processed, count(*) FILTER (status = 'claimed') AS remaining, count(*) FILTER (status = 'claimed') AS claimed, count(DISTINCT item_path) AS items, count(DISTINCT item_path) FILTER (status <> 'claimed') AS items_done FROM t GROUP BY job")
def queue_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.queue_status(table(spark, sf_dir, "events").select((F.col("event_id") % 7).alias("job"), F.col("user_id").alias("item_path"), status().alias("status")))


@query("WITH n AS (SELECT max(epoch(ts)) AS now FROM events), t AS (SELECT user_id AS job, event_id, event_type, epoch(ts) AS since FROM events) SELECT job, min('t' || lpad(event_id::VARCHAR, 9, '0')) AS task_key FROM t, n WHERE event_type = 'click' OR (event_type = 'purchase' AND now - since > 86400) GROUP BY job")
def claim_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next task of each user's queue: clicks are pending, purchases claimed, a day's claims stale."""
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("now"))
    kind = F.when(F.col("event_type") == "click", "pending").when(F.col("event_type") == "purchase", "claimed").otherwise("updated")
    tasks = e.crossJoin(F.broadcast(now)).select(F.col("user_id").alias("job"), F.col("event_id").alias("ordinal"), F.concat(F.lit("t"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("task_key"), kind.alias("status"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("claimed_at"), F.lit("c").alias("claim_id"), "now")
    return Q.next_claims(tasks, F.col("now"), 86400.0)


SQL_ITEMS = "i AS (SELECT conv_id, count(*)::INTEGER AS n FROM conversations GROUP BY 1)"


@query(f"WITH {SQL_ITEMS} SELECT conv_id, p AS page_number, 'c' || conv_id || '#page=' || lpad(p::VARCHAR, 4, '0') AS task_key FROM (SELECT conv_id, unnest(range(1, least(3, n) + 1))::INTEGER AS p FROM i)")
def page_task_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as items with as many pages as turns; a task for each of the pages that are to be read, three at most."""
    return Q.page_tasks(_items(spark, sf_dir), 3).select("conv_id", "page_number", "task_key")


@query(f"WITH {SQL_ITEMS} SELECT count(*) AS items, sum(least(3, n))::BIGINT AS pages FROM i")
def scheduled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.scheduled_pages(_items(spark, sf_dir), 3)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("pages_total")).withColumn("item_path", F.concat(F.lit("c"), "conv_id"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'list:pdf:' WHEN 1 THEN 'list:pdf:' ELSE 'list:metadata:' END || strftime(o_orderdate, '%Y-%m-%d') || ':' || strftime(o_orderdate, '%Y-%m-%d') AS state_key, 'search:' || year(o_orderdate) || ':' || CASE WHEN o_custkey % 2 = 0 THEN 'i' || o_custkey ELSE 'all' END || ':pdf' AS search_key FROM orders")
def state_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of windows; those of three parts are old."""
    d, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 3
    raw = F.when(k == 0, F.concat_ws(":", F.lit("list"), d, d)).otherwise(Q.state_key(F.lit("list"), d, d, F.when(k == 1, "pdf").otherwise("metadata")))
    return table(spark, sf_dir, "orders").select("o_orderkey", Q.migrated_key(raw).alias("state_key"), Q.search_key(F.year("o_orderdate"), F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("i"), "o_custkey")), F.lit("pdf")).alias("search_key"))
