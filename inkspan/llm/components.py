"""Connected components of a table of links, by large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.shared import forget, written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in a link (a, b), a > b: component is the least id it is connected with."""
    spark = links.sparkSession
    size = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    last, at = size(links), None
    while last[0]:
        step = written(_small_star(_large_star(links)), "links")
        now = size(step)
        if at:
            forget(spark, at)
        links, at = step, step._inkspan_path
        if now == last:
            break
        last = now
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component"))).groupBy("id").agg(F.min("component").alias("component"))
