"""Work: tasks, shards, logs that are replayed, claims, state keys."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.functions.numbers import page_numbers

TERMINAL = ("updated", "updated_empty", "error", "json_error", "missing_pdf_path", "skipped_not_ocr_needed")


def task_key(path: Column, page: Column) -> Column:
    return F.format_string("%s#page=%04d", path, page)


def page_tasks(items: DataFrame, most: int) -> DataFrame:
    """Items (item_path, pages_total, target_pages) as a task for each page to read."""
    pages = page_numbers(F.col("target_pages") if "target_pages" in items.columns else F.array().cast("array<string>"), F.col("pages_total"), most)
    return items.withColumn("page_number", F.explode(pages)).withColumn("task_key", task_key(F.col("item_path"), F.col("page_number")))


def scheduled_pages(items: DataFrame, most: int) -> DataFrame:
    """The number of pages that the items come to; an unreadable item counts as most."""
    n = F.when(F.col("pages_total").isNull(), max(1, most)).otherwise(F.size(page_numbers(F.array().cast("array<string>"), F.col("pages_total"), most)))
    return items.agg(F.count(F.lit(1)).alias("items"), F.sum(n.cast("bigint")).alias("pages"))


def legacy_tasks(tasks: Column, items: Column) -> Column:
    """Tasks of a queue's state; of an old one, a first-page task for each item."""
    old = F.transform(items, lambda p: F.struct(p.alias("task_key"), p.alias("item_path"), F.lit(1).alias("page_number")))
    return F.coalesce(tasks, old)


def ordinal(df: DataFrame, order: Column | str) -> DataFrame:
    """Rows numbered from 1 in an order over all of them, without bringing them into one task: range partitions are sorted, counted and offset."""
    spark = df.sparkSession
    keyed = df.withColumn("__order", order if isinstance(order, Column) else F.col(order))
    sorted_ = keyed.repartitionByRange("__order").sortWithinPartitions("__order").withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    # the counts must see the same partitions as the rows, so the numbered rows are what is stored
    from inkspan.sources.shared_tables import stored

    sorted_ = stored(sorted_, "ordinal")
    counts = sorted_.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), F.min("__row").alias("__least"))
    rows = sorted(counts.collect())
    base, offsets = 0, []
    for part, n, least in rows:
        offsets.append((part, base, least))
        base += n
    table = spark.createDataFrame(offsets or [(-1, 0, 0)], "__part int, __base long, __least long")
    joined = sorted_.join(F.broadcast(table), "__part")
    return joined.withColumn("ordinal", F.col("__base") + F.col("__row") - F.col("__least") + 1).drop("__part", "__row", "__base", "__least", "__order")


def shard(rows: DataFrame, order: str, n: int, good: Column | None = None) -> DataFrame:
    """shard of each row by its rank among the good ones; bad rows go to every shard."""
    ok = F.lit(True) if good is None else F.coalesce(good, F.lit(False))
    placed = ordinal(rows.where(ok), order).withColumn("shard", F.pmod(F.col("ordinal") - 1, F.lit(n)).cast("int")).drop("ordinal")
    if good is None:
        return placed
    return placed.unionByName(rows.where(~ok).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("shard", F.col("shard").cast("int")))


def partition_spec(spec: str) -> list[tuple[str, float]]:
    parts = []
    for part in filter(None, (p.strip() for p in spec.split(","))):
        name, _, weight = part.partition(":")
        if not name.strip() or not weight or float(weight) <= 0:
            raise ValueError(f"not NAME:WEIGHT: {part}")
        parts.append((name.strip(), float(weight)))
    if len({n for n, _ in parts}) != len(parts):
        raise ValueError(f"names repeat: {spec}")
    return parts


def turns(spec: str, n: int) -> list[str]:
    """Who gets each of n rows: the one that lags most behind its share, in exact numbers, ties to the first in the spec."""
    parts, got, out = [(name, Fraction(str(w))) for name, w in partition_spec(spec)], {}, []
    whole = sum(w for _, w in parts)
    for k in range(1, n + 1):
        name = max(parts, key=lambda p: k * p[1] / whole - got.get(p[0], 0))[0]
        got[name] = got.get(name, 0) + 1
        out.append(name)
    return out


def cycle(spec: str) -> list[str]:
    """turns() over one period. With whole weights every deficit is back at zero after as many rows as they sum to, so the turns repeat from there, however many rows follow."""
    parts = partition_spec(spec)
    scale = 1
    while any(abs(w * scale - round(w * scale)) > 1e-9 for _, w in parts):
        scale *= 10
        if scale > 10**6:
            raise ValueError(f"weights need six places at most: {spec}")
    return turns(",".join(f"{n}:{round(w * scale)}" for n, w in parts), int(sum(round(w * scale) for _, w in parts)))


def weighted(rows: DataFrame, order: str, spec: str) -> DataFrame:
    """partition of each row by the turns of a spec of names and weights."""
    period = cycle(spec)
    numbered = ordinal(rows, order)
    names = F.array(*[F.lit(n) for n in period])
    return numbered.withColumn("partition", F.element_at(names, (F.pmod(F.col("ordinal") - 1, F.lit(len(period))) + 1).cast("int"))).drop("ordinal")


def chunks(rows: DataFrame, order: str, size: int, workers: int) -> DataFrame:
    """chunk of so many rows in order, and its worker in turn."""
    numbered = ordinal(rows, order)
    c = F.floor((F.col("ordinal") - 1) / size).cast("bigint")
    return numbered.withColumn("chunk", c).withColumn("worker", F.pmod(F.col("chunk"), F.lit(workers)).cast("int")).drop("ordinal")


def session_turns(tasks: DataFrame, order: str, sessions: DataFrame) -> DataFrame:
    """session and generation of each task: sessions (slot from 0, session, failed: a sorted array of the ordinals at which it failed) take turns; after each failure a slot has a fresh session, a generation later."""
    pool = sessions.select(F.col("slot").cast("bigint").alias("__slot"), "session", F.coalesce("failed", F.array().cast("array<bigint>")).alias("__failed"))
    n = pool.count()
    numbered = ordinal(tasks, order).withColumn("__turn", F.pmod(F.col("ordinal") - 1, F.lit(n)))
    joined = numbered.join(pool, F.col("__turn") == F.col("__slot"))
    return joined.withColumn("generation", F.size(F.filter("__failed", lambda x: x < F.col("ordinal")))).drop("__turn", "__slot", "__failed")


def replay(log: DataFrame, key: str, order: str, retry_failed: bool = False) -> DataFrame:
    """(key, status) by the last line of each key; with retry_failed, failures are dropped first, so they undo no success."""
    lines = log.where(~F.col("status").isin("error", "updated_empty")) if retry_failed else log
    return lines.groupBy(key).agg(F.max_by("status", order).alias("status"))


def overlaid(checkpoint: DataFrame, log: DataFrame, key: str, order: str, retry_failed: bool = False) -> DataFrame:
    """A checkpoint's statuses with the log's lines over them."""
    all_ = checkpoint.select(key, "status", F.lit(None).cast(log.schema[order].dataType).alias(order)).unionByName(log.select(key, "status", order))
    lines = all_.where(~F.col("status").isin("error", "updated_empty")) if retry_failed else all_
    return lines.groupBy(key).agg(F.max_by("status", F.struct(order)).alias("status"))


def remaining(work: DataFrame, log: DataFrame, key: str, order: str) -> DataFrame:
    """Work whose last status isn't "updated"."""
    return work.join(replay(log, key, order).where("status = 'updated'"), key, "left_anti")


def failed_keys(log: DataFrame, key: str) -> DataFrame:
    return log.where("status = 'error'").select(key).distinct().orderBy(key)


def queue_status(tasks: DataFrame) -> DataFrame:
    """Tasks (job, item_path, status) by job: processed, remaining, claimed, items."""
    done = F.col("status").isin(*TERMINAL)
    return tasks.groupBy("job").agg(F.count(F.lit(1)).alias("tasks"), F.count_if(done).alias("processed"), F.count_if(~F.coalesce(done, F.lit(False))).alias("remaining"), F.count_if(F.col("status") == "claimed").alias("claimed"), F.countDistinct("item_path").alias("items"), F.countDistinct(F.when(done, F.col("item_path"))).alias("items_done"))


def released(tasks: DataFrame, now: Column, timeout: float) -> DataFrame:
    """Tasks whose claims are older than the timeout are pending again; the old claim is noted."""
    stale = (F.col("status") == "claimed") & (now - F.col("claimed_at") > timeout)
    return tasks.withColumns({"stale_claim": F.when(stale, F.col("claim_id")), "status": F.when(stale, "pending").otherwise(F.coalesce("status", F.lit("pending")))})


def next_claims(tasks: DataFrame, now: Column, timeout: float) -> DataFrame:
    """(job, task_key): the first pending task of each job, in task order, after stale claims are released."""
    return released(tasks, now, timeout).groupBy("job").agg(F.min_by("task_key", F.when(F.col("status") == "pending", F.col("ordinal"))).alias("task_key")).where("task_key is not null")


def state_key(theme: Column, start: Column, end: Column, mode: Column) -> Column:
    """theme:mode:start:end."""
    return F.concat_ws(":", theme, mode, start, end)


def search_key(year: Column, institution: Column, mode: Column) -> Column:
    return F.concat_ws(":", F.lit("search"), year.cast("string"), F.coalesce(institution, F.lit("all")), mode)


def migrated_key(key: Column) -> Column:
    """Old keys of three parts get the mode that they had: pdf."""
    p = F.split(key, ":")
    return F.when(F.size(p) == 3, F.concat_ws(":", F.get(p, F.lit(0)), F.lit("pdf"), F.get(p, F.lit(1)), F.get(p, F.lit(2)))).otherwise(key)


def completed_windows(windows: DataFrame) -> DataFrame:
    """Windows that may be marked as done: no error, no failed download."""
    return windows.where(F.col("error").isNull() & (F.coalesce("failed_downloads", F.lit(0)) == 0))


def benchmark_pages(items: DataFrame, items_cap: int, pages_cap: int) -> DataFrame:
    """The pages that a benchmark reads: of the first items in path order, up to a number of pages over all of them; a sample is what it is for."""
    first = items.orderBy("item_path").limit(items_cap).withColumn("page", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("pages_total")))))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("item_path", "page"))
    return first.withColumn("__n", rank).where(F.col("__n") <= pages_cap).drop("__n")
