"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes all rows that the one before kept and returns the columns of
documents; the last adds the shard. run() writes each stage's rows to the shared
folder and reads them again, so a lost executor costs one stage's tasks at most,
and then deletes what the stage itself wrote there and the rows of the stage
before. The result reads the last stage's rows, which stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkspan.llm import decontam, langid, mixing, near_dedup, shards
from inkspan.llm.shared import forget, kept, scratch, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told."""
    return langid.identify_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return near_dedup.near_dedup(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents as the target weights say, sources at four epochs at most."""
    return mixing.mix(docs, weights=mixing.target_weights(docs), budget_share=mixing.BUDGET_SHARE)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's shard."""
    return shards.place(docs)


STAGES = [("language ID", language), ("near duplicates", near_duplicates), ("decontamination", benchmarks), ("mixing", mixture), ("sharding", sharding)]
#: SQL can't express the sampling, the walks and the filters; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with scratch(spark) as made:
            docs = kept(made, written(stage(spark, docs, sf_dir), "stage"))
        if last:
            forget(spark, last)
        last = docs._inkspan_path
    return STAGES[-1][1](spark, docs, sf_dir)
