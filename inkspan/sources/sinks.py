"""Writers. Spark's commit protocol makes each write appear whole or not at all."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.functions import text as T
from inkspan.functions.dates import date_parts
from inkspan.functions.nested import flatten
from inkspan.operators.items import have


def items(df: DataFrame, folder: str) -> None:
    """Items as JSON by year and date; dates that are none as unknown."""
    parts = date_parts(F.col("date"), have(df, "keyword_field_regdate"))
    df.withColumns({"year": parts["year"], "date_key": parts["date_key"]}).write.mode("overwrite").partitionBy("year", "date_key").json(folder)


def single(payload: dict, path: str) -> None:
    """One small JSON file, written beside and moved into place."""
    target = Path(path)
    beside = target.with_name(target.name + ".tmp")
    target.parent.mkdir(parents=True, exist_ok=True)
    beside.write_text(json.dumps(payload, ensure_ascii=False, indent=2, sort_keys=True, default=str), encoding="utf-8")
    beside.replace(target)


def csv(df: DataFrame, folder: str, *structs: str) -> None:
    """A flat table as CSV, nested columns as prefixed ones or JSON. Each file's header begins with a byte order mark, for spreadsheets."""
    flat = flatten(df, *structs)
    first = flat.columns[0]
    flat.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option("header", True).csv(folder)


def by_category(df: DataFrame, folder: str) -> None:
    """Items as JSON by category; earlier categories go."""
    df.withColumn("category", F.coalesce(T.nz(F.col("category")), F.lit("unknown"))).write.mode("overwrite").partitionBy("category").json(folder)


def append_lines(df: DataFrame, folder: str) -> None:
    """Rows at the end of a JSON-lines log, keys in order."""
    df.select(*sorted(df.columns)).write.mode("append").json(folder)


def analytics(df: DataFrame, name: str, key: str, buckets: int = 32, path: str | None = None) -> None:
    """A table bucketed by its key, so that joins on it need no shuffle; in the warehouse, or at a path."""
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def flat_rows(df: DataFrame) -> DataFrame:
    """Eight text columns of items of either feed; rows without an id are left out, the first by date of each id stays."""
    c = lambda *n: T.first_filled(*[have(df, x) for x in n])
    flat = df.select(
        c("id", "stored_toc_seq").alias("id"), c("title", "stored_field_subject").alias("title"), c("date", "stored_field_month").alias("date"), c("category", "stored_category_name").alias("category"), c("agency", "stored_organ_nm").alias("agency"),
        c("law", "stored_laword_nm").alias("law"), c("viewer_path", "stored_field_url").alias("viewer_path"), F.to_json(F.struct(*[F.col(f"`{x}`") for x in sorted(df.columns)])).alias("raw"),
    )
    return flat.where("id <> ''").groupBy("id").agg(F.min(F.struct("date", *[x for x in flat.columns if x not in ("id", "date")])).alias("r")).select("id", "r.*")


def export_records(df: DataFrame) -> DataFrame:
    """Records for a dataset hub: text columns, rows with an id only, by source and category."""
    c = lambda n: F.coalesce(have(df, n), F.lit(""))
    return df.where(T.nz(have(df, "id")).isNotNull()).select(*[c(n).alias(n) for n in ("id", "title", "date", "agency", "law", "viewer_path", "source", "category")])


def export(df: DataFrame, folder: str) -> None:
    export_records(df).write.mode("overwrite").partitionBy("source", "category").parquet(folder)
