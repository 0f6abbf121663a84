"""Pages and tables: columns, classes, table shape and greedy removal of repeated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.functions.nested import once
from inkspan.functions.numbers import overlap, ratio
from inkspan.functions.text import form_score, readability, squash

GAP, LEAST_CLUSTER, LEAST_WORDS, MOST_COLUMNS, SPARSE, SAME = 80.0, 4, 8, 4, 30, 0.9
TABLE = "struct<table_id:string,strategy:string,bbox:array<double>,row_count:int,column_count:int,nonempty:int,density:double,raw_rows:array<array<string>>,text_chars:int,alternate:array<string>>"


def columns_of(words: DataFrame, key: str, x: str) -> DataFrame:
    """(key, words, estimated_columns): left edges that lie within GAP of each other form clusters; those of LEAST_CLUSTER words count."""
    order = Window.partitionBy(key).orderBy(x)
    jump = F.when(F.col(x) - F.lag(x).over(order) > GAP, 1).otherwise(0)
    placed = words.where(F.col(x).isNotNull()).withColumn("__jump", jump).withColumn("__cluster", F.sum("__jump").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = placed.groupBy(key, "__cluster").agg(F.count(F.lit(1)).alias("n"))
    grouped = sizes.groupBy(key).agg(F.sum("n").alias("words"), F.count_if(F.col("n") >= LEAST_CLUSTER).alias("c"))
    return grouped.select(key, "words", F.when(F.col("words") < LEAST_WORDS, 1).otherwise(F.greatest(F.lit(1), F.least(F.lit(MOST_COLUMNS), "c"))).cast("int").alias("estimated_columns"))


def _class(chars: Column, tables: Column, share: Column, form: Column, columns: Column) -> Column:
    return F.when(chars < SPARSE, "sparse_text").when((tables > 0) & (share >= 0.5), "table_heavy").when(tables > 0, "table_with_body").when(form >= 0.35, "form_like").when(columns >= 2, "multi_column_text").otherwise("body_text")


def page_class(df: DataFrame) -> DataFrame:
    """page_class of page metrics (text_chars, table_count, table_text_ratio, form_score, estimated_columns)."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    return df.withColumn("page_class", _class(n("text_chars"), n("table_count"), n("table_text_ratio"), n("form_score"), n("estimated_columns")))


def page_metrics(pages: DataFrame, text: str = "text") -> DataFrame:
    """Pages of text with text_chars, word_count, line_count, text_quality, form_score."""
    t = F.coalesce(F.col(text), F.lit(""))
    return pages.withColumns({"text_chars": F.length(squash(t)), "word_count": F.size(F.filter(F.split(squash(t), " "), lambda w: w != "")), "line_count": F.size(F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")), "text_quality": readability(t), "form_score": form_score(t)})


def quality_fold(quality: Column) -> Column:
    """A document's quality from its pages': suspect if any is, sparse if all are, readable if any is."""
    q = F.coalesce(quality, F.lit("unknown"))
    return F.when(F.bool_or(q == "suspect_or_encoded"), "suspect_or_encoded").when(F.bool_and(q == "empty_or_sparse"), "empty_or_sparse").when(F.bool_or(q == "readable"), "readable").otherwise("unknown")


def documents(pages: DataFrame, key: str) -> DataFrame:
    """The layout of each document from its page metrics, with class and confidence; pages: also table_count, table_chars, estimated_columns."""
    g = pages.groupBy(key).agg(
        F.count(F.lit(1)).alias("pages_scanned"), F.sum("text_chars").alias("total_chars"), F.sum("table_chars").alias("table_chars"), F.sum("table_count").alias("table_count"), F.sum("line_count").alias("line_count"), F.sum("word_count").alias("word_count"),
        F.max("estimated_columns").alias("estimated_columns"), F.avg(F.coalesce("form_score", F.lit(0.0))).alias("form_score"), quality_fold(F.col("text_quality")).alias("text_quality"),
    )
    share = ratio(F.col("table_chars"), F.col("total_chars"))
    g = g.withColumn("table_text_ratio", share)
    kind = F.when((F.col("total_chars") <= 0) & (F.col("pages_scanned") == 0), "unknown_text").otherwise(_class(F.col("total_chars"), F.col("table_count"), share, F.col("form_score"), F.col("estimated_columns")))
    sure = {"sparse_text": F.lit(0.75), "table_heavy": F.least(F.lit(0.95), F.col("table_text_ratio") * 0.27 + 0.68), "table_with_body": F.lit(0.72), "form_like": F.least(F.lit(0.9), F.col("form_score") * 0.25 + 0.65), "multi_column_text": F.lit(0.7), "body_text": F.lit(0.68)}
    confidence = F.lit(0.5)
    for name, value in sure.items():
        confidence = F.when(F.col("document_class") == name, value).otherwise(confidence)
    return g.withColumn("document_class", kind).withColumn("confidence", F.round(confidence, 2)).withColumns({"form_score": F.round("form_score", 4), "table_text_ratio": F.round("table_text_ratio", 4)})


def table_shape(rows: Column) -> Column:
    """Raw table rows as a struct: cells cleaned, empty rows gone, padded, the first row as labels of col_1 to col_n, records as maps, counts and density."""
    clean = F.filter(F.transform(rows, lambda r: F.transform(r, lambda x: squash(F.coalesce(x, F.lit(""))))), lambda r: F.exists(r, lambda x: x != ""))

    def shape(rs: Column) -> Column:
        n = F.coalesce(F.array_max(F.transform(rs, F.size)), F.lit(0))
        padded = F.transform(rs, lambda r: F.concat(r, F.array_repeat(F.lit(""), n - F.size(r))))
        keys = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.lit("col_"), i.cast("string")))).otherwise(F.array().cast("array<string>"))
        cells = F.flatten(padded)
        full = F.size(F.filter(cells, lambda x: x != ""))
        chars = F.aggregate(cells, F.lit(0), lambda a, x: a + F.length(x))
        data = F.slice(padded, 2, F.greatest(F.size(padded) - 1, F.lit(0)))
        return F.struct(F.size(padded).alias("row_count"), n.alias("column_count"), full.alias("nonempty"), F.round(ratio(full, F.size(cells)), 4).alias("density"), F.arrays_zip(keys.alias("key"), F.coalesce(F.get(padded, F.lit(0)), keys).alias("label")).alias("columns"), F.transform(data, lambda r: F.map_from_arrays(keys, r)).alias("records"), padded.alias("raw_rows"), chars.alias("text_chars"))

    return F.transform(F.array(clean), shape)[0]


def valid_table(t: Column) -> Column:
    """Two rows, two columns and two filled cells at least; tables found by text alignment also need density."""
    return (t["row_count"] >= 2) & (t["column_count"] >= 2) & (t["nonempty"] >= 2) & ~((t["strategy"] == "text") & (t["density"] < 0.35))


def distinct_tables(tables: Column) -> Column:
    """The valid tables of a page in order, without repeats: one that overlaps an earlier or has its first rows joins it, the better one in its place with the strategies of both."""
    quality = lambda t: F.coalesce(t["text_chars"], F.lit(0)) + F.coalesce(t["row_count"], F.lit(0)) * 10 + F.coalesce(t["column_count"], F.lit(0)) * 5
    # the first rows as text, and what place a new table takes, are made once, not for each pair
    with_head = lambda t: F.struct(t.alias("t"), F.when(F.size(t["raw_rows"]) > 0, F.to_json(F.slice(t["raw_rows"], 1, 3))).alias("head"))
    same = lambda a, b: F.coalesce(a["head"] == b["head"], F.lit(False)) | (overlap(a["t"]["bbox"], b["t"]["bbox"]) >= SAME)

    def joined(old: Column, new: Column) -> Column:
        a, b = old["t"], new["t"]
        names = F.array_sort(F.array_distinct(F.filter(F.concat(F.array(a["strategy"], b["strategy"]), F.coalesce(a["alternate"], F.array().cast("array<string>")), F.coalesce(b["alternate"], F.array().cast("array<string>"))), lambda s: s.isNotNull() & (s != ""))))
        return once(F.when(quality(b) > quality(a), new).otherwise(old), lambda w: F.struct(w["t"].withField("alternate", names).alias("t"), w["head"].alias("head")))

    def add(chosen: Column, t: Column) -> Column:
        place = F.array_position(F.transform(chosen, lambda c: same(c, t)), True).cast("int")
        return once(place, lambda at: F.when(at == 0, F.array_append(chosen, t)).otherwise(F.transform(chosen, lambda c, i: F.when(i == at - 1, joined(c, t)).otherwise(c))))

    kept = F.aggregate(F.transform(F.filter(tables, valid_table), with_head), F.array().cast(f"array<struct<t:{TABLE},head:string>>"), add)
    return F.transform(kept, lambda x: x["t"])


def renumbered(tables: Column, page_index: Column) -> Column:
    return F.transform(tables, lambda t, i: t.withField("table_id", F.format_string("p%03d-t%03d", page_index + 1, i + 1)))


def strategies(name: str, settings: dict | None = None) -> list[tuple[str, dict]]:
    """The table finders to try, with their settings."""
    if settings is not None:
        return [("custom", settings)]
    known = {"auto": ["lines", "lines_strict", "text"], "lines": ["lines"], "lines-strict": ["lines_strict"], "text": ["text"]}
    if name not in known:
        raise ValueError(f"unknown table strategy: {name}")
    near = dict.fromkeys(("snap_tolerance", "join_tolerance", "intersection_tolerance"), 3)
    loose = {"min_words_vertical": 3, "min_words_horizontal": 1, "text_tolerance": 3}
    return [(s, {f"{way}_strategy": s for way in ("vertical", "horizontal")} | near | (loose if s == "text" else {})) for s in known[name]]
