"""Layout of documents cut into pages, columns of words, and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.operators import layout as L
from inkspan.registry import query
from inkspan.session import table

PAGE = 2000
SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SQL_PAGES = rf"""p AS (SELECT doc_id, unnest(range(greatest(1, ceil(length(text) / {PAGE}.0)::INTEGER)))::INTEGER AS page_index, text FROM documents),
    t AS (SELECT doc_id, page_index, substr(text, page_index * {PAGE} + 1, {PAGE}) AS text FROM p),
    c AS (SELECT *, trim(regexp_replace(text, '{SPACE}+', ' ', 'g'), ' ') AS s, regexp_replace(text, '{SPACE}+', '', 'g') AS z, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda x: x <> '') AS lines FROM t),
    m AS (SELECT doc_id, page_index, length(s) AS text_chars, len(list_filter(string_split(s, ' '), lambda w: w <> '')) AS word_count, len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) AS line_count,
        CASE WHEN length(z) < 20 THEN 'empty_or_sparse' WHEN contains(lower(z), '(cid:') THEN 'suspect_or_encoded' WHEN length(regexp_replace(z, '[\x{{00}}-\x{{7f}}가-힣\x{{1100}}-\x{{11ff}}\x{{3130}}-\x{{318f}}\x{{4e00}}-\x{{9fff}}·ㆍ℃㎞㎡㎥％]', '', 'g')) / length(z) >= 0.2 AND length(regexp_replace(z, '[^0-9A-Za-z가-힣]', '', 'g')) / length(z) < 0.55 THEN 'suspect_or_encoded' ELSE 'readable' END AS text_quality,
        coalesce(len(list_filter(lines, lambda x: regexp_matches(x, '[:：]{SPACE}*[^\s]') OR regexp_matches(x, '^[0-9A-Za-z가-힣][.)]{SPACE}') OR contains(x, ' - ') OR regexp_matches(x, '[ㆍ·]'))) / nullif(len(lines), 0), 0) AS form_score,
        CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END AS table_count, CASE WHEN doc_id % 11 = 0 THEN (page_index % 2) * 0.9 + 0.05 ELSE 0 END AS table_text_ratio, (1 + doc_id % 3)::INTEGER AS estimated_columns FROM c)"""


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into pages, with metrics; tables and columns are made up from its number."""
    slices = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))
    cut = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.when(F.length("text") > 0, slices).otherwise(F.array(F.lit("")))).alias("page_index", "text"))
    has = F.col("doc_id") % 11 == 0
    return L.page_metrics(cut).withColumns({"table_count": F.when(has, 1).otherwise(0), "table_text_ratio": F.when(has, F.col("page_index") % 2 * 0.9 + 0.05).otherwise(0.0), "estimated_columns": (F.col("doc_id") % 3 + 1).cast("int")})


@query(f"""WITH {SQL_PAGES} SELECT doc_id, page_index, text_chars::INTEGER AS text_chars, word_count::INTEGER AS word_count, line_count::INTEGER AS line_count, text_quality, round(form_score, 6) AS form_score, CASE WHEN text_chars < 30 THEN 'sparse_text' WHEN table_count > 0 AND table_text_ratio >= 0.5 THEN 'table_heavy' WHEN table_count > 0 THEN 'table_with_body'
    WHEN form_score >= 0.35 THEN 'form_like' WHEN estimated_columns >= 2 THEN 'multi_column_text' ELSE 'body_text' END AS page_class FROM m""")
def page_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.page_class(pages(spark, sf_dir)).select("doc_id", "page_index", "text_chars", "word_count", "line_count", "text_quality", F.round("form_score", 6).alias("form_score"), "page_class")


@query(f"""WITH {SQL_PAGES}, d AS (SELECT doc_id, count(*) AS pages_scanned, sum(text_chars)::BIGINT AS total_chars, sum(floor(text_chars * table_text_ratio + 1e-9))::BIGINT AS table_chars, sum(table_count)::BIGINT AS table_count, max(estimated_columns) AS estimated_columns, avg(form_score) AS form_score,
        CASE WHEN bool_or(text_quality = 'suspect_or_encoded') THEN 'suspect_or_encoded' WHEN bool_and(text_quality = 'empty_or_sparse') THEN 'empty_or_sparse' WHEN bool_or(text_quality = 'readable') THEN 'readable' ELSE 'unknown' END AS text_quality FROM m GROUP BY doc_id),
    r AS (SELECT *, coalesce(table_chars / nullif(total_chars, 0), 0) AS ratio FROM d),
    k AS (SELECT *, CASE WHEN total_chars < 30 THEN 'sparse_text' WHEN table_count > 0 AND ratio >= 0.5 THEN 'table_heavy' WHEN table_count > 0 THEN 'table_with_body' WHEN form_score >= 0.35 THEN 'form_like' WHEN estimated_columns >= 2 THEN 'multi_column_text' ELSE 'body_text' END AS document_class FROM r)
    SELECT doc_id, pages_scanned, total_chars, table_chars, table_count, text_quality, document_class, round(CASE document_class WHEN 'sparse_text' THEN 0.75 WHEN 'table_heavy' THEN least(0.95, ratio * 0.27::DOUBLE + 0.68::DOUBLE) WHEN 'table_with_body' THEN 0.72 WHEN 'form_like' THEN least(0.9, form_score * 0.25::DOUBLE + 0.65::DOUBLE) WHEN 'multi_column_text' THEN 0.7 ELSE 0.68 END, 2) AS confidence FROM k""")
def document_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pages(spark, sf_dir).withColumn("table_chars", F.floor(F.col("text_chars") * F.col("table_text_ratio") + 1e-9).cast("bigint"))
    return L.documents(p, "doc_id").select("doc_id", "pages_scanned", "total_chars", "table_chars", "table_count", "text_quality", "document_class", "confidence")


@query("""WITH w AS (SELECT user_id, value * 4 AS x FROM events), j AS (SELECT *, CASE WHEN x - lag(x) OVER o > 80 THEN 1 ELSE 0 END AS j FROM w WINDOW o AS (PARTITION BY user_id ORDER BY x)),
    c AS (SELECT *, sum(j) OVER (PARTITION BY user_id ORDER BY x ROWS UNBOUNDED PRECEDING) AS c FROM j), s AS (SELECT user_id, c, count(*) AS n FROM c GROUP BY ALL)
    SELECT user_id, sum(n)::BIGINT AS words, CASE WHEN sum(n) < 8 THEN 1 ELSE greatest(1, least(4, count(*) FILTER (n >= 4))) END::INTEGER AS estimated_columns FROM s GROUP BY user_id""")
def column_clusters_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events' values as left edges of words, a page for each user."""
    return L.columns_of(table(spark, sf_dir, "events").select("user_id", (F.col("value") * 4).alias("x")), "user_id", "x")


@query("""SELECT o_custkey, count(*)::INTEGER + 1 AS row_count, 3 AS column_count, (sum(CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 3 END) + 3)::INTEGER AS nonempty, round((sum(CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 3 END) + 3) / ((count(*) + 1) * 3), 4) AS density, arg_min(o_orderkey, o_orderkey)::VARCHAR AS first_value FROM orders GROUP BY 1""")
def table_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as a table's raw rows under a header."""
    row = F.struct("o_orderkey", F.array(F.concat(F.lit(" "), F.col("o_orderkey").cast("string")), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority"))).alias("cells"))
    rows = F.concat(F.array(F.array(F.lit("key"), F.lit("status"), F.lit("priority")), F.array(F.lit(""), F.lit(None).cast("string"))), F.transform(F.array_sort(F.collect_list(row)), lambda r: r["cells"]))
    t = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(L.table_shape(rows).alias("t"))
    return t.select("o_custkey", "t.row_count", "t.column_count", "t.nonempty", "t.density", F.try_element_at(F.get("t.records", F.lit(0)), F.lit("col_1")).alias("first_value"))


@query()
def distinct_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each order as tables found by three strategies, some over each other; repeats removed in order. (Greedy: checked by brute force.)"""
    q, k = F.col("l_quantity"), F.col("l_linenumber")
    strategy = F.when(k % 3 == 0, "text").when(k % 3 == 1, "lines").otherwise("lines_strict")
    y = (k % 3 * 100).cast("double")
    t = F.struct(F.lit("").alias("table_id"), strategy.alias("strategy"), F.array(F.lit(0.0), y, F.lit(100.0), y + 90 + q / 25).alias("bbox"), (k % 4 + 1).cast("int").alias("row_count"), F.lit(3).alias("column_count"), (k + 1).cast("int").alias("nonempty"), (q / 50).alias("density"), F.array(F.array(F.col("l_partkey").cast("string"))).alias("raw_rows"), q.cast("int").alias("text_chars"), F.array().cast("array<string>").alias("alternate"))
    each = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", t.alias("t"))
    tables = F.transform(F.array_sort(F.collect_list(each)), lambda x: x["t"])
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(tables.alias("found"))
    kept = L.renumbered(L.distinct_tables(F.col("found")), F.lit(0))
    return g.select("l_orderkey", F.size("found").alias("found"), F.explode(kept).alias("t")).select("l_orderkey", "found", "t.table_id", "t.strategy", "t.text_chars", F.array_join("t.alternate", ",").alias("alternate"))
