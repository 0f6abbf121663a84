"""Roll-ups: counts, samples, percentiles, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.functions.numbers import ratio
from inkspan.functions.text import duration, nz


def counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by keys, missing ones as unknown."""
    return df.groupBy(*[F.coalesce(nz(F.col(k).cast("string")), F.lit("unknown")).alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))


def funnel(df: DataFrame, source: str, status: str) -> DataFrame:
    """Rows by source and status, by source, and in all."""
    return df.rollup(source, status).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


def buckets(path: Column, root: str) -> Column:
    """The bucket of a file under a root: source/kind for PDFs, else the first part of its path."""
    inside = F.when(F.startswith(path, F.lit(root + "/")), F.substring(path, len(root) + 2, 4096)).otherwise(path)
    kind = F.regexp_extract(inside, "^([^/]+/(pdfs|issue_pdfs|partial_pdfs))/", 1)
    return F.when(kind != "", kind).otherwise(F.element_at(F.split(inside, "/"), 1))


def bucket_sizes(files: DataFrame, root: str) -> DataFrame:
    return files.groupBy(buckets(F.col("path"), root).alias("bucket")).agg(F.count(F.lit(1)).alias("files"), F.count_if("ok").alias("ok"), F.sum("size").alias("bytes"))


def top_errors(df: DataFrame, error: str, most: int = 10) -> DataFrame:
    """The most frequent errors; a report of the top."""
    return df.groupBy(F.coalesce(nz(F.col(error)), F.lit("unknown")).alias("error")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "error").limit(most)


def samples(df: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """The first rows of each key in an order, as a report shows them."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("rank") <= most)


def exact_mean(c: Column, places: int, digits: int = 6) -> Column:
    """The mean to so many places, half up, whatever order rows come in: values are taken to `digits` places and added up as integers."""
    n, total, unit = F.count(c), F.sum(F.round(c * 10**digits).cast("bigint")), 10 ** (digits - places)
    return F.call_function("div", total * 2 + n * unit, F.nullif(n * (2 * unit), F.lit(0))) / 10**places


def benchmark_summary(records: DataFrame, elapsed: float, *keys: str) -> DataFrame:
    """Requests by keys: counts by status, rates, latencies (zeros don't count) and qualities (of ok rows)."""
    ok = F.col("status") == "ok"
    lat = F.when(F.col("latency") != 0, F.col("latency"))
    of_ok = lambda c, n: F.coalesce(exact_mean(F.when(ok, F.col(c)), n), F.lit(0.0))
    return records.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(ok).alias("ok"), F.count_if(F.col("status") == "empty").alias("empty"), F.count_if(F.col("status") == "error").alias("errors"),
        F.round(F.count(F.lit(1)) / F.lit(float(elapsed)) * 60, 3).alias("pages_per_min"), F.coalesce(exact_mean(lat, 3), F.lit(0.0)).alias("latency_avg"), F.round(F.coalesce(F.percentile(lat, 0.5), F.lit(0.0)), 3).alias("latency_p50"), F.round(F.coalesce(F.percentile(lat, 0.9), F.lit(0.0)), 3).alias("latency_p90"),
        of_ok("chars", 1).alias("chars_avg"), of_ok("confidence", 3).alias("confidence_avg"), exact_mean(F.when(ok, F.col("cer")), 6, 9).alias("cer_avg"),
    )


def progress(jobs: DataFrame) -> DataFrame:
    """Jobs (job, total_pages, processed_pages, elapsed) with rate, rest and time left."""
    rate = F.when(F.col("processed_pages") > 0, ratio(F.col("processed_pages"), F.col("elapsed"))).otherwise(0.0)
    left = F.greatest(F.lit(0), F.col("total_pages") - F.col("processed_pages"))
    out = jobs.withColumns({"rate": rate, "remaining_pages": left, "percent": F.round(ratio(F.col("processed_pages"), F.col("total_pages")) * 100, 4)})
    eta = F.when(F.col("rate") > 0, F.col("remaining_pages") / F.col("rate"))
    return out.withColumn("eta", duration(eta)).withColumn("rate", F.round("rate", 6))


def total_progress(jobs: DataFrame) -> DataFrame:
    """All jobs of progress() together."""
    out = progress(jobs).agg(F.count(F.lit(1)).alias("jobs"), F.sum("total_pages").alias("total_pages"), F.sum("processed_pages").alias("processed_pages"), F.sum("remaining_pages").alias("remaining_pages"), F.round(F.sum("rate"), 4).alias("rate"))
    return out.withColumn("percent", F.round(ratio(F.col("processed_pages"), F.col("total_pages")) * 100, 4))


def validation_summary(df: DataFrame, ok: str) -> DataFrame:
    rate = F.count_if(ok) / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("passed"), F.count_if(~F.col(ok)).alias("failed"), F.format_string("%.1f%%", F.coalesce(rate, F.lit(0.0))).alias("pass_rate"))


def search_pages(groups: DataFrame) -> DataFrame:
    """Search answers (page, category, n, ids, ordinal) as totals: sum and maximum of counts, groups, listed ids, the first and last id."""
    listed = F.coalesce(F.size("ids"), F.lit(0))
    return groups.groupBy("page").agg(F.sum("n").alias("total"), F.max("n").alias("largest"), F.count(F.lit(1)).alias("groups"), F.sum(listed).alias("listed"), F.min_by(F.element_at("ids", 1), F.when(listed > 0, F.col("ordinal"))).alias("first_id"), F.max_by(F.element_at("ids", -1), F.when(listed > 0, F.col("ordinal"))).alias("last_id"))


def run_stats(started: Column, ended: Column) -> Column:
    return F.coalesce(F.timestamp_diff("SECOND", started, ended), F.lit(0))


def report(spark_rows: dict[str, DataFrame], samples_: dict[str, DataFrame], settings: dict) -> dict:
    """A run's report for JSON: small aggregates and bounded samples, collected."""
    rows = lambda d: [r.asDict(recursive=True) for r in d.collect()]
    return {"counts": {k: rows(v) for k, v in spark_rows.items()}, "samples": {k: rows(v) for k, v in samples_.items()}, "settings": settings}
