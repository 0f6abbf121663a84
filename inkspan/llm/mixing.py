"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

A source of size s (characters) and weight w may contribute at most
MAX_EPOCHS * s. Of the budget it gets min(cap, level * w), where the level is
the one at which allotments add up to the budget: sources whose cap lies below
their share are clamped, and what they leave goes to the others in proportion,
until no share exceeds its cap. Sorted by cap / w that level is found with two
running sums, without iteration. If all caps together fall short of the budget,
every source gets its cap.

allotment / s is the number of repetitions r: each document appears floor(r)
times, and once more if a hash of its id and the seed falls below the fraction.

Defined cases: a null source is a source of its own; null and empty texts have
size 0 but are repeated like the rest of their source; a source of size 0 gets
nothing; a given weight that is null or not positive counts as 0, and such a
source gets nothing, as does one that the weights don't name; a null doc_id is
replaced by a digest of the text; equal rows share one draw; extra columns pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkspan.llm.shared import BROADCAST_BYTES, unused, written

MAX_EPOCHS, EXPONENT, SEED = 4.0, 0.5, 17
#: The mixture of the query and the pipeline: its size as a share of the corpus's, and how many times a source's weight may double.
BUDGET_SHARE, DOUBLINGS = 2.0, 6


def target_weights(docs: DataFrame, doublings: int = DOUBLINGS) -> DataFrame:
    """(source, weight) of a skewed target: each source's weight is a power of two, up to so many doublings, drawn by a digest of its name."""
    name = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select("source").distinct().select(F.col("source").cast("string").alias("source"), F.pow(F.lit(2.0), F.pmod(F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long"), F.lit(doublings + 1))).alias("weight"))


def allotments(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None, max_epochs: float = MAX_EPOCHS, exponent: float = EXPONENT, budget_share: float = 1.0) -> DataFrame:
    """source, size, weight, allotted, repetitions of each source. weights: (source, weight), else size to the exponent; budget in characters, else a share of the corpus's size."""
    size = docs.groupBy(F.col("source").cast("string").alias("source")).agg(F.sum(F.coalesce(F.length(F.col("text").cast("string")), F.lit(0))).cast("double").alias("size"))
    if weights is None:
        weighted = size.withColumn("weight", F.sqrt("size") if exponent == 0.5 else F.pow("size", F.lit(float(exponent))))
    else:
        given = weights.groupBy(F.col("source").cast("string").alias("__s")).agg(F.sum(F.col("weight").cast("double")).alias("weight"))
        weighted = size.join(given, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s").withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    # one row for each source from here on
    everything = Window.partitionBy()
    filled = weighted.withColumn("cap", F.col("size") * max_epochs).withColumn("budget", F.lit(float(budget)) if budget is not None else F.sum("size").over(everything) * budget_share)
    live = filled.where("size > 0 and weight > 0").withColumn("ratio", F.col("cap") / F.col("weight"))
    rise = Window.orderBy("ratio", "source")
    live = live.withColumn("clamped", F.coalesce(F.sum("cap").over(rise.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    live = live.withColumn("rest", F.sum("weight").over(rise.rowsBetween(0, Window.unboundedFollowing)))
    live = live.withColumn("level", (F.col("budget") - F.col("clamped")) / F.col("rest"))
    live = live.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(everything)["level"])
    live = live.withColumn("allotted", F.greatest(F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))), F.lit(0.0)))
    live = live.select("source", "size", "weight", "allotted", (F.col("allotted") / F.col("size")).alias("repetitions"))
    none = filled.where("not (size > 0 and weight > 0)").select("source", "size", "weight", F.lit(0.0).alias("allotted"), F.lit(0.0).alias("repetitions"))
    return live.unionByName(none)


def draw(seed: int = SEED) -> F.Column:
    """Uniform in [0, 1) by document and seed."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{seed}"))), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(docs: DataFrame, seed: int = SEED, copy_column: str | None = None, **options) -> DataFrame:
    """The rows of docs, each as often as its source's repetitions say; the copy's number from 1 in copy_column, if named."""
    s, r, copies, copy = unused(docs, "__source", "__r", "__copies", "__copy")
    plan = written(allotments(docs, **options).select(F.col("source").alias(s), F.col("repetitions").alias(r)), "mix-plan", 1)
    small = plan.count() * 64 <= BROADCAST_BYTES
    joined = docs.join(F.broadcast(plan) if small else plan, F.col("source").cast("string").eqNullSafe(F.col(s)))
    whole = F.floor(r) + F.when(draw(seed) < F.col(r) - F.floor(r), 1).otherwise(0)
    out = joined.withColumn(copies, whole.cast("int")).where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    if copy_column:
        out = out.withColumn(copy_column, F.col(copy))
    return out.select(*[f"`{c}`" for c in dict.fromkeys(docs.columns + ([copy_column] if copy_column else []))])


def oracle_sql(seed: int = SEED, max_epochs: float = MAX_EPOCHS, doublings: int = DOUBLINGS, budget_share: float = BUDGET_SHARE) -> str:
    """mix() in DuckDB at target_weights() and a budget of that share of the corpus's size."""
    return f"""
    WITH s AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS size FROM documents GROUP BY source),
    w AS (SELECT *, pow(2.0::DOUBLE, ('0x' || md5(coalesce(source, ''))[1:8])::BIGINT % {doublings + 1}) AS weight, size * {max_epochs}::DOUBLE AS cap, sum(size) OVER () * {budget_share}::DOUBLE AS budget FROM s),
    l AS (SELECT *, cap / weight AS ratio FROM w WHERE size > 0),
    r AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS clamped,
        sum(weight) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM l),
    v AS (SELECT arg_min((budget - clamped) / rest, ratio) AS level FROM r WHERE (budget - clamped) / rest <= ratio),
    a AS (SELECT source, greatest(least(cap, coalesce(level * weight, cap)), 0) / size AS r FROM l, v),
    d AS (SELECT d.*, floor(a.r)::INTEGER + CASE WHEN ('0x' || md5(coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, ''))) || ':{seed}')[1:8])::BIGINT / 4294967296.0::DOUBLE < a.r - floor(a.r) THEN 1 ELSE 0 END AS copies
        FROM documents d JOIN a ON d.source IS NOT DISTINCT FROM a.source)
    SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1))::INTEGER AS copy FROM d"""
