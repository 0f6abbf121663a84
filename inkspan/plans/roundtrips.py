"""Sources and sinks: tables written by a sink, or as the files that a source reads, and read back whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.operators import audits as A
from inkspan.operators import queues as Q
from inkspan.operators import reports as R
from inkspan.registry import query
from inkspan.session import table
from inkspan.sources import copies, files, records, sinks
from inkspan.sources.shared_tables import folder


def place(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def one_by_one(df: DataFrame, key: str, at: str) -> str:
    """A JSON file for each row of a small table, its name ending in .json, from its text column value."""
    df.select(key, "value").repartition(1).write.partitionBy(key).text(at)
    spark = df.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder_ in fs.listStatus(root):
        if folder_.isDirectory():
            for f in fs.listStatus(folder_.getPath()):
                fs.rename(f.getPath(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder_.getPath(), "item.json"))
    return at


@query("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 7 <> 0 THEN n_name END AS name, n_nationkey % 7 = 0 AS json_error FROM nation")
def items_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as JSON files in folders, some broken, some no object."""
    k = F.col("n_nationkey")
    value = F.when(k % 14 == 0, "[1, 2]").when(k % 7 == 0, "{broken").otherwise(F.to_json(F.struct(F.col("n_name").alias("name"), k.alias("id"))))
    at = one_by_one(table(spark, sf_dir, "nation").select("n_nationkey", value.alias("value")), "n_nationkey", place(spark, "items"))
    return records.typed_items(spark, at, "name string").select(F.regexp_extract("path", r"n_nationkey=(\d+)/", 1).cast("int").alias("k"), "name", "json_error")


@query("SELECT n_nationkey::VARCHAR AS id, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END::INTEGER AS v, n_name AS name FROM nation")
def store_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as one aggregate file, every second one overlaid by a file of its own."""
    n = table(spark, sf_dir, "nation")
    item = lambda v: F.to_json(F.struct(F.col("n_nationkey").cast("string").alias("id"), F.lit(v).alias("v"), F.col("n_name").alias("name")))
    at = place(spark, "store")
    whole = F.concat(F.lit("{"), F.array_join(F.collect_list(F.concat(F.lit('"'), F.col("n_nationkey"), F.lit('": '), item(1))), ","), F.lit("}"))
    n.agg(whole.alias("value")).coalesce(1).write.text(f"{at}/all")
    one_by_one(n.where("n_nationkey % 2 = 0").select("n_nationkey", item(2).alias("value")), "n_nationkey", f"{at}/single")
    return records.store(spark, f"{at}/all", f"{at}/single").select("id", F.get_json_object("raw", "$.v").cast("int").alias("v"), F.get_json_object("raw", "$.name").alias("name"))


SQL_SUPPLIERS = "s AS (SELECT s_suppkey::VARCHAR AS id, strftime(DATE '1995-01-01' + (s_suppkey % 40)::INTEGER, '%Y-%m-%d') AS date, s_name AS title FROM supplier)"


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format(F.date_add(F.to_date(F.lit("1995-01-01")), (F.col("s_suppkey") % 40).cast("int")), "yyyy-MM-dd")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), day.alias("date"), F.col("s_name").alias("title"))


def _stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = place(spark, "partitioned")
    sinks.items(suppliers(spark, sf_dir), at)
    return spark.read.schema("id string, date string, title string, year string, date_key string").json(at)


@query(f"WITH {SQL_SUPPLIERS} SELECT id, date, title, date[1:4] AS year, replace(date, '-', '') AS date_key FROM s")
def partitioned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as items by year and date, read back."""
    return _stored_items(spark, sf_dir)


@query(f"WITH {SQL_SUPPLIERS} SELECT id, date, title, date[1:4] AS year, replace(date, '-', '') AS date_key FROM s WHERE id = '7'")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item from its own partition."""
    return records.lookup(_stored_items(spark, sf_dir), "1995", "19950108", "7")


SQL_LINES = "l AS (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey) - 1 AS n FROM customer)"


def lines(spark: SparkSession, sf_dir: str, broken: bool) -> str:
    """Customers as JSON lines in one file, in order; some lines blank, some malformed."""
    k, at = F.col("c_custkey"), place(spark, "lines")
    value = F.to_json(F.struct(k.cast("string").alias("id"), F.col("c_name").alias("name")))
    if broken:
        value = F.when(k % 10 == 0, "").when(k % 7 == 0, F.concat(F.lit("not json "), k)).otherwise(value)
    table(spark, sf_dir, "customer").select("c_custkey", value.alias("value")).coalesce(1).sortWithinPartitions("c_custkey").select("value").write.text(at)
    return at


@query(f"WITH {SQL_LINES} SELECT n::INTEGER AS line_number, CASE WHEN k % 7 = 0 THEN 'malformed line: not json ' || k END AS manifest_error, CASE WHEN k % 7 <> 0 THEN k::VARCHAR END AS id FROM l WHERE k % 10 <> 0")
def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.manifest(spark, lines(spark, sf_dir, True), "id string")


@query(f"WITH {SQL_LINES} SELECT (n + 1)::INTEGER AS _line_number, k::VARCHAR AS id, c_name AS name FROM l JOIN customer ON k = c_custkey")
def strict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.strict_lines(spark, lines(spark, sf_dir, False), "id string, name string")


@query("SELECT c_custkey::VARCHAR AS id, c_name AS name FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 7 <> 0")
def tolerant_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.tolerant_lines(spark, lines(spark, sf_dir, True), "id string, name string")


@query("SELECT CASE WHEN p_partkey % 3 = 0 THEN '/abs/' || p_partkey || '.pdf' ELSE '/root/x/' || p_partkey || '.pdf' END AS path FROM part WHERE p_partkey % 5 <> 0")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a list of files, some absolute, some commented out or blank."""
    k, at = F.col("p_partkey"), place(spark, "listed")
    name = F.concat(k, F.lit(".pdf"))
    table(spark, sf_dir, "part").select(F.when(k % 10 == 0, F.concat(F.lit("# "), name)).when(k % 5 == 0, " ").when(k % 3 == 0, F.concat(F.lit("/abs/"), name)).otherwise(name)).write.text(at)
    return records.listed(spark, at, "/root/x/")


@query("SELECT n_regionkey AS region, sum(strlen(n_name) + 1)::BIGINT AS size FROM nation GROUP BY 1")
def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a text file for each region; the objects below the folder, without reading them."""
    at = place(spark, "objects")
    table(spark, sf_dir, "nation").select("n_name", "n_regionkey").repartition(1).write.partitionBy("n_regionkey").text(at)
    found = records.objects(spark, at, "pre/").where("key like 'pre/n_regionkey=%'")
    return found.select(F.regexp_extract("key", r"^pre/n_regionkey=(\d+)/", 1).cast("int").alias("region"), "size")


@query("SELECT p_partkey AS key, p_size::BIGINT AS size FROM part WHERE p_partkey % 3 <> 0")
def download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote parts, of which a third is here, a third here with another size."""
    remote = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_size").cast("bigint").alias("size"))
    local = remote.where("key % 3 <> 2").withColumn("size", F.when(F.col("key") % 3 == 1, F.col("size") + 1).otherwise(F.col("size")))
    return records.download_plan(remote, local)


@query("""WITH c AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '%PDF-1.4' || text || '%%EOF' WHEN 1 THEN '%PDF-1.4' || text WHEN 2 THEN '<html>' || text || '%%EOF' ELSE '%PDF-1.4%%EOF' || text END AS c, strlen(text) AS n FROM documents),
    f AS (SELECT doc_id, strlen(c) AS size, doc_id % 4 <> 2 AS header, strlen(c) > 100 AS structure, doc_id % 4 = 0 OR (doc_id % 4 = 3 AND n + 5 <= 4096) AS complete, sha256(c) AS digest, md5(c) AS md5 FROM c)
    SELECT doc_id, size::BIGINT AS size, size > 0 AS not_empty, header, structure, complete, digest, md5, header AND structure AND complete AS ok FROM f""")
def file_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, some without end mark, head, or with the mark too early."""
    k, t = F.col("doc_id") % 4, F.col("text")
    body = F.when(k == 0, F.concat(F.lit("%PDF-1.4"), t, F.lit("%%EOF"))).when(k == 1, F.concat(F.lit("%PDF-1.4"), t)).when(k == 2, F.concat(F.lit("<html>"), t, F.lit("%%EOF"))).otherwise(F.concat(F.lit("%PDF-1.4%%EOF"), t))
    found = table(spark, sf_dir, "documents").select("doc_id", F.encode(body, "UTF-8").alias("content")).withColumn("size", F.octet_length("content").cast("bigint"))
    return files.checks(found).drop("content")


@query("SELECT s_suppkey::VARCHAR AS id, s_nationkey::VARCHAR AS pdf_nation, s_name AS pdf_name, '{\"k\":\"' || s_suppkey || '\"}' AS tags, 'a,\"' || s_suppkey || '\"' AS title FROM supplier")
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as CSV with a byte order mark, nested columns flattened, read back."""
    k, at = F.col("s_suppkey").cast("string"), place(spark, "csv")
    df = table(spark, sf_dir, "supplier").select(k.alias("id"), F.struct(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")).alias("pdf"), F.create_map(F.lit("k"), k).alias("tags"), F.concat(F.lit('a,"'), k, F.lit('"')).alias("title"))
    sinks.csv(df, at, "pdf")
    back = spark.read.schema("id string, pdf_nation string, pdf_name string, tags string, title string").csv(at, header=True, enforceSchema=True)
    return back


@query("SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_suppkey % 5 = 0 THEN 'unknown' ELSE 'n' || s_nationkey END AS category FROM supplier")
def category_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as JSON by category, written twice: the later write replaces the earlier."""
    k, at = F.col("s_suppkey"), place(spark, "category")
    df = table(spark, sf_dir, "supplier").select(k.cast("string").alias("id"), F.when(k % 10 == 0, "").when(k % 5 != 0, F.concat(F.lit("n"), "s_nationkey")).alias("category"))
    sinks.by_category(df.withColumn("id", F.concat(F.lit("old"), "id")), at)
    sinks.by_category(df, at)
    return spark.read.schema("id string, category string").json(at)


@query("SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) * 2 AS n FROM events GROUP BY ALL)")
def appended_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended twice to a log of JSON lines, and counted."""
    at = place(spark, "log")
    for _ in range(2):
        sinks.append_lines(table(spark, sf_dir, "events").select("user_id", "event_type"), at)
    return spark.read.schema("event_type string, user_id long").json(at).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_brand, count(*) AS parts, sum(ps)::BIGINT AS lines FROM part JOIN (SELECT l_partkey, count(*) AS ps FROM lineitem GROUP BY 1) ON l_partkey = p_partkey GROUP BY 1")
def analytics_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts and the number of their lines as tables bucketed alike, joined without a shuffle."""
    names = [f"inkspan_{uuid.uuid4().hex}" for _ in range(2)]
    sinks.analytics(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), names[0], "p_partkey", 8, place(spark, "parts"))
    sinks.analytics(table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("ps")), names[1], "p_partkey", 8, place(spark, "part-lines"))
    return spark.table(names[0]).join(spark.table(names[1]).hint("merge"), "p_partkey").groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"), F.sum("ps").alias("lines"))


@query("SELECT 'counts' AS part, source AS name, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT 'settings', 'most', 3")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's report as one JSON document, written and read back."""
    made = R.report({"by_source": R.counts(table(spark, sf_dir, "documents"), "source")}, {}, {"most": 3})
    at = place(spark, "report")
    spark.createDataFrame([(made["counts"]["by_source"], made["settings"])], "counts array<struct<source string, n bigint>>, settings map<string, bigint>").coalesce(1).write.json(at)
    back = spark.read.schema("counts array<struct<source string, n bigint>>, settings map<string, bigint>").json(at)
    return back.select(F.lit("counts").alias("part"), F.explode("counts").alias("c")).select("part", F.col("c.source").alias("name"), "c.n").unionByName(back.select(F.lit("settings").alias("part"), F.explode("settings").alias("name", "n")))


@query("""SELECT doc_id::VARCHAR AS path, CASE WHEN text = '' THEN 0 ELSE ceil(length(text) / 1000.0) END::INTEGER AS pages, length(trim(regexp_replace(text, '[\\s\\x{0b}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g'), ' ')) > 0 AS text_extractable, md5(text[1:60]) AS head FROM documents""")
def text_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' bytes read as pages of a thousand characters by a plug-in reader, and folded to metadata of each file."""
    found = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content"))
    pages = files.read_pages(found, "cut", {"cut": _cut})
    heads = pages.where("page <= 1").select("path", F.md5(F.left("text", F.lit(60))).alias("head"))
    return files.text_metadata(pages).select("path", "pages", "text_extractable").join(heads, "path")


def _cut(content: bytes) -> list[str]:
    text = content.decode()
    return [text[i : i + 1000] for i in range(0, len(text), 1000)]


@query("SELECT n_regionkey AS region, CASE WHEN n_regionkey = 4 THEN 'error' ELSE 'copied' END AS status, CASE WHEN n_regionkey = 4 THEN 0 ELSE sum(strlen(n_name) + 1) END::BIGINT AS bytes, CASE WHEN n_regionkey <> 4 THEN sum(strlen(n_name) + 1) END::BIGINT AS size FROM nation GROUP BY 1 UNION ALL SELECT 9, 'deleted', 0, NULL")
def synced_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for each region, copied by a sync plan to a target, where a file that the source lacks goes; one file is gone before its turn."""
    at = place(spark, "sync")
    # the first target takes nothing (a file stands where its folder would be), the second is the fallback
    text = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.concat(F.array_join(F.collect_list("n_name"), "\n"), F.lit("\n")).alias("value"))
    one_by_one(text.withColumn("value", F.rtrim(F.col("value"), F.lit("\n"))), "n_regionkey", f"{at}/source")
    one_by_one(table(spark, sf_dir, "region").limit(1).select(F.lit(9).alias("n_regionkey"), F.lit("x").alias("value")), "n_regionkey", f"{at}/target")
    mine = lambda d: records.objects(spark, f"{at}/{d}").where("key like '%.json'")
    plan = A.sync_plan(mine("source").withColumn("key", F.replace("key", F.lit("=4/"), F.lit("=4/gone-"))), mine("target")).select("key", "action")
    done = place(spark, "copied")
    copies.copied(plan, f"{at}/source", f"{at}/target/n_regionkey=9/item.json", f"{at}/target").write.parquet(done)
    now = records.objects(spark, f"{at}/target").select(F.col("key").alias("k"), "size")
    out = spark.read.parquet(done)
    return out.join(now, F.col("k") == F.col("key"), "left").select(F.regexp_extract("key", r"=(\d+)/", 1).cast("int").alias("region"), "status", "bytes", "size")


@query("SELECT c_custkey, CASE (n - 1) % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS session, CASE WHEN (n - 1) % 3 = 1 THEN (n > 2)::INTEGER + (n > 20)::INTEGER ELSE 0 END AS generation FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS n FROM customer)")
def session_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as requests over three sessions in turn, of which one failed twice and was replaced."""
    pool = spark.createDataFrame([(0, "a", None), (1, "b", [2, 20]), (2, "c", [])], "slot int, session string, failed array<bigint>")
    return Q.session_turns(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", pool).select("c_custkey", "session", "generation")


@query("SELECT doc_id, md5('x' || regexp_replace(text, '[^A-Za-z0-9.,]', '_', 'g')) AS text, 1 AS pages FROM documents")
def pdf_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a PDF of one page, read back by the reader of PDF files."""
    body = F.concat(F.lit("BT /F 10 Tf 50 700 Td (x"), F.regexp_replace("text", "[^A-Za-z0-9.,]", "_"), F.lit(") Tj ET"))
    head = "%PDF-1.4\n1 0 obj <</Type /Catalog /Pages 2 0 R>> endobj 2 0 obj <</Kids [3 0 R]>> endobj 3 0 obj <</Type /Page /Contents 4 0 R>> endobj 4 0 obj <</Length "
    content = F.encode(F.concat(F.lit(head), F.length(body), F.lit(">>\nstream\n"), body, F.lit("\nendstream endobj\n%%EOF")), "UTF-8")
    found = files.read_pages(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), content.alias("content")))
    return found.groupBy(F.col("path").cast("bigint").alias("doc_id")).agg(F.md5(F.first("text")).alias("text"), F.max("page").alias("pages"))
