"""Roll-ups of events and documents as logs and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.functions.nested import first_path
from inkspan.operators import reports as R
from inkspan.registry import query
from inkspan.session import table


@query("SELECT event_type, coalesce(nullif(props, ''), 'unknown') AS props, count(*) AS n FROM events GROUP BY ALL")
def status_category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.counts(table(spark, sf_dir, "events"), "event_type", "props")


@query("SELECT source, lang, count(*) AS n, grouping(source, lang)::BIGINT AS level FROM documents GROUP BY ROLLUP (source, lang)")
def rollup_source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By source and status, by source, and in all."""
    return R.funnel(table(spark, sf_dir, "documents"), "source", "lang")


@query("SELECT coalesce(nullif(props, ''), 'unknown') AS error, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY n DESC, error LIMIT 10")
def error_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report: the ten most frequent errors."""
    return R.top_errors(table(spark, sf_dir, "events").where("event_type = 'error'"), "props")


@query("SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS rank FROM documents QUALIFY rank <= 3")
def bounded_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report: the first three documents of each source."""
    return R.samples(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 3)


@query("""WITH r AS (SELECT user_id, CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'empty' ELSE 'ok' END AS status, CASE WHEN event_id % 10 = 0 THEN 0 ELSE value END AS latency, event_id % 500 AS chars, value / 1000 AS confidence, CASE WHEN event_id % 2 = 0 THEN value / 100 END AS cer FROM events)
    SELECT user_id, count(*) AS requests, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'empty') AS empty, count(*) FILTER (status = 'error') AS errors, round(count(*) / 3600::DOUBLE * 60, 3) AS pages_per_min,
    coalesce(((sum(round(latency * 1000000)::BIGINT) FILTER (latency <> 0) * 2 + count(latency) FILTER (latency <> 0) * 1000)::BIGINT // nullif(count(latency) FILTER (latency <> 0) * 2000, 0)) / 1000, 0) AS latency_avg, round(coalesce(quantile_cont(latency, 0.5) FILTER (latency <> 0), 0), 3) AS latency_p50, round(coalesce(quantile_cont(latency, 0.9) FILTER (latency <> 0), 0), 3) AS latency_p90,
    coalesce(((sum(round(chars * 1000000)::BIGINT) FILTER (status = 'ok') * 2 + count(chars) FILTER (status = 'ok') * 100000)::BIGINT // nullif(count(chars) FILTER (status = 'ok') * 200000, 0)) / 10, 0) AS chars_avg, coalesce(((sum(round(confidence * 1000000)::BIGINT) FILTER (status = 'ok') * 2 + count(confidence) FILTER (status = 'ok') * 1000)::BIGINT // nullif(count(confidence) FILTER (status = 'ok') * 2000, 0)) / 1000, 0) AS confidence_avg, ((sum(round(cer * 1000000000)::BIGINT) FILTER (status = 'ok') * 2 + count(cer) FILTER (status = 'ok') * 1000)::BIGINT // nullif(count(cer) FILTER (status = 'ok') * 2000, 0)) / 1000000 AS cer_avg FROM r GROUP BY user_id""")
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of each user: counts, mean, median and ninetieth percentile."""
    i, v = F.col("event_id"), F.col("value")
    r = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "empty").otherwise("ok").alias("status"), F.when(i % 10 == 0, 0.0).otherwise(v).alias("latency"), (i % 500).alias("chars"), (v / 1000).alias("confidence"), F.when(i % 2 == 0, v / 100).alias("cer"))
    return R.benchmark_summary(r, 3600.0, "user_id")


@query("""WITH j AS (SELECT user_id AS job, count(*) AS total_pages, count(*) FILTER (event_type <> 'error') AS processed_pages, date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts)))::DOUBLE AS elapsed FROM events GROUP BY 1), r AS (SELECT *, CASE WHEN processed_pages > 0 AND elapsed > 0 THEN processed_pages / elapsed ELSE 0 END AS r, total_pages - processed_pages AS remaining_pages FROM j),
    e AS (SELECT *, round_even(remaining_pages / nullif(r, 0), 0)::BIGINT AS s FROM r)
    SELECT job, total_pages, processed_pages, remaining_pages, round(r, 6) AS rate, round(processed_pages / total_pages * 100, 4) AS percent, CASE WHEN s IS NULL THEN '-' WHEN s >= 3600 THEN (s // 3600) || 'h' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || 'm' WHEN s >= 60 THEN (s // 60) || 'm' || lpad((s % 60)::VARCHAR, 2, '0') || 's' ELSE s || 's' END AS eta FROM e""")
def job_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as jobs: progress, rate and time left."""
    return R.progress(jobs(spark, sf_dir)).drop("elapsed")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = R.run_stats(F.date_trunc("second", F.min("ts")), F.date_trunc("second", F.max("ts")))
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("job")).agg(F.count(F.lit(1)).alias("total_pages"), F.count_if(F.col("event_type") != "error").alias("processed_pages"), seconds.cast("double").alias("elapsed"))


@query("""WITH j AS (SELECT user_id, count(*) AS total, count(*) FILTER (event_type <> 'error') AS done, date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts)))::DOUBLE AS elapsed FROM events GROUP BY 1)
    SELECT count(*) AS jobs, sum(total)::BIGINT AS total_pages, sum(done)::BIGINT AS processed_pages, sum(total - done)::BIGINT AS remaining_pages, round(sum(CASE WHEN elapsed > 0 THEN round(done / elapsed, 6) ELSE 0 END), 4) AS rate, round(sum(done) / sum(total) * 100, 4) AS percent FROM j""")
def job_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.total_progress(jobs(spark, sf_dir))


@query("""SELECT count(*) AS total, count(*) FILTER (n_chars > 100) AS passed, count(*) FILTER (n_chars <= 100) AS failed, printf('%.1f%%', count(*) FILTER (n_chars > 100) / count(*) * 100) AS pass_rate FROM documents""")
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.validation_summary(table(spark, sf_dir, "documents").withColumn("ok", F.col("n_chars") > 100), "ok")


@query("""WITH g AS (SELECT o_custkey AS page, o_orderstatus AS category, count(*) AS n, list(o_orderkey ORDER BY o_orderkey) AS ids, ascii(o_orderstatus)::INTEGER AS ordinal FROM orders GROUP BY ALL)
    SELECT page, sum(n)::BIGINT AS total, max(n) AS largest, count(*) AS groups, sum(len(ids))::BIGINT AS listed, arg_min(ids[1], ordinal) AS first_id, arg_max(ids[-1], ordinal) AS last_id FROM g GROUP BY page""")
def search_page_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("page"), F.col("o_orderstatus").alias("category")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("o_orderkey")).alias("ids")).withColumn("ordinal", F.ascii("category"))
    return R.search_pages(g)


@query("""SELECT event_id, (props->>'$.k')::BIGINT AS k, coalesce(nullif(trim(props->>'$.text'), ''), nullif(trim(props->>'$.k'), '')) AS reference FROM events""")
def props_json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number of each event's JSON, and the first of two paths that is filled."""
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), first_path(F.col("props"), "$.text", "$.k").alias("reference"))


@query("""WITH b AS (SELECT time_bucket(INTERVAL '1 minute', ts) AS m, unnest(range(10)) AS i, event_type FROM events) SELECT m - to_minutes(i::INTEGER) AS start, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM b GROUP BY 1""")
def sliding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and errors within ten minutes, at every minute."""
    w = table(spark, sf_dir, "events").groupBy(F.window("ts", "10 minutes", "1 minute")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return w.select(F.col("window.start").alias("start"), "n", "errors")


@query("SELECT date_trunc('minute', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 minute"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n")
