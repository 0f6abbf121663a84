"""Projections, predicates and names, each over a whole table, with the SQL that restates them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.functions import dates as D
from inkspan.functions import nested as N
from inkspan.functions import numbers as M
from inkspan.functions import text as T
from inkspan.operators import audits as A
from inkspan.operators import gazetteer as G
from inkspan.operators import items as I
from inkspan.operators import layout as L
from inkspan.operators import queues as Q
from inkspan.operators import recovery as V
from inkspan.registry import query
from inkspan.session import table
from inkspan.sources import feeds, files


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END, 'pending') AS status, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, 'nobody') AS clerk FROM orders")
def merged_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs in structs, filled from defaults."""
    k = F.col("o_orderkey")
    s = F.struct(F.when(k % 3 != 0, F.col("o_orderstatus")).alias("status"), F.struct(F.when(k % 2 == 0, F.col("o_orderpriority")).alias("clerk")).alias("by"))
    m = table(spark, sf_dir, "orders").select("o_orderkey", N.with_defaults(s, {"status": F.lit("pending"), "by.clerk": F.lit("nobody")}).alias("m"))
    return m.select("o_orderkey", "m.status", F.col("m.by.clerk").alias("clerk"))


@query("SELECT o_custkey, 'done' AS status, count(*)::INTEGER AS table_count FROM orders GROUP BY 1")
def layout_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as the tables of a layout, of which only their number stays."""
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("tables"))
    made = g.select("o_custkey", I.layout_compact(F.struct(F.lit("done").alias("status")), F.col("tables")).alias("l"))
    return made.select("o_custkey", "l.status", "l.table_count")


@query("SELECT doc_id, 'metadata_only' AS status, 'skipped' AS pdf_status, CASE WHEN doc_id % 2 = 0 THEN 'p' || doc_id ELSE '' END AS path, CASE WHEN doc_id % 3 = 0 THEN n_chars ELSE 0 END::BIGINT AS size_bytes FROM documents")
def metadata_only_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    pdf = F.struct(F.lit("pending").alias("status"), F.when(k % 2 == 0, F.concat(F.lit("p"), k)).alias("path"), F.when(k % 3 == 0, F.col("n_chars").cast("bigint")).alias("size_bytes"))
    out = I.metadata_only(table(spark, sf_dir, "documents").select("doc_id", F.lit("completed").alias("status"), pdf.alias("pdf")))
    return out.select("doc_id", "status", F.col("pdf.status").alias("pdf_status"), "pdf.path", "pdf.size_bytes")


@query("SELECT doc_id, to_json({backend: 'a', attempts: [{backend: 'a', chars: n_chars}]})::VARCHAR AS recovery FROM documents")
def recovery_without_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.struct(F.lit("a").alias("backend"), F.col("n_chars").alias("chars"), F.col("text").alias("sample_text"))
    r = F.struct(F.lit("a").alias("backend"), F.col("text").alias("sample_text"), F.array(a).alias("attempts"))
    return table(spark, sf_dir, "documents").select("doc_id", F.to_json(V.without_samples(r)).alias("recovery"))


@query("SELECT n_nationkey, lpad(n_nationkey::VARCHAR, 2, '0') || '00000000' AS admin_code, r_name AS sido, n_name AS sigungu, n_name AS eupmyeondong, n_name AS name FROM nation JOIN region ON r_regionkey = n_regionkey")
def offline_place_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    c = F.struct(F.concat(F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit("00000000")).alias("admin_code"), F.col("n_name").alias("name"), F.array("r_name", "n_name").alias("parent_chain"), F.lit("x").alias("parent_name"))
    return n.select("n_nationkey", I.place_record(c).alias("r")).select("n_nationkey", "r.*")


@query("SELECT doc_id, source FROM documents WHERE source IN ('src0', 'src3', 'src7')")
def source_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(F.col("source").isin("src0", "src3", "src7")).select("doc_id", "source")


@query("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality = 1 OR doc_id % 9 = 0")
def ocr_needed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return V.needs_ocr(d.select("doc_id", (F.col("quality") == 1).alias("needs_ocr"), (F.col("doc_id") % 9 == 0).alias("json_error"))).select("doc_id")


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) IN (1993, 1995)")
def years_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(A.year_allowed(F.date_format("o_orderdate", "yyyy-MM-dd"), ["1993", "1994", "1995"], ["1994"])).select("o_orderkey")


@query("SELECT p_partkey, p_partkey % 3 = 0 AS trusted FROM part")
def trusted_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    path = F.when(k % 3 == 0, F.concat(F.lit("file:///data/a/"), k)).when(k % 3 == 1, F.concat(F.lit("/data/a/../b/"), k)).otherwise(F.concat(F.lit("/data/ab/"), k))
    return table(spark, sf_dir, "part").select("p_partkey", files.inside(path, "/data/a").alias("trusted"))


@query("""SELECT l_orderkey, l_linenumber, l_linenumber % 4 + 1 >= 2 AND l_quantity % 3 + 1 >= 2 AND l_linenumber >= 2 AND NOT (l_linenumber % 2 = 0 AND l_quantity / 50 < 0.35) AS valid,
    CASE WHEN l_linenumber > 10 THEN 0 ELSE round((10 - l_linenumber) * 10 / (200 - (10 - l_linenumber) * 10), 6) END AS iou FROM lineitem""")
def table_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as tables: whether they count, and how they overlap a fixed box."""
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    t = F.struct((n % 4 + 1).alias("row_count"), (q % 3 + 1).alias("column_count"), n.alias("nonempty"), F.when(n % 2 == 0, "text").otherwise("lines").alias("strategy"), (q / 50).alias("density"))
    x = n.cast("double")
    box, fixed = F.array(x, F.lit(0.0), x + 10, F.lit(10.0)), F.array(F.lit(0.0), F.lit(0.0), F.lit(10.0), F.lit(10.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", L.valid_table(t).alias("valid"), F.round(M.overlap(box, fixed), 6).alias("iou"))


@query("""WITH f AS (SELECT s_suppkey AS k, 'artifacts/list/pdfs/' || s_suppkey || '.pdf' AS path FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 'other/' || s_suppkey || '.pdf' FROM supplier WHERE s_suppkey % 3 = 0)
    SELECT k::VARCHAR AS id, path, min(CASE WHEN path LIKE 'artifacts/list%' THEN 1 ELSE 3 END)::INTEGER AS prio FROM f GROUP BY ALL""")
def candidate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as items with a legacy path; their files are in the new place, elsewhere under the same name, both or neither."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier")
    items = s.select(k.cast("string").alias("id"), F.concat(F.lit("artifacts/pdfs/"), k, F.lit(".pdf")).alias("path"), F.lit("").alias("date"))
    there = s.where("s_suppkey % 2 = 0").select(F.concat(F.lit("artifacts/list/pdfs/"), k, F.lit(".pdf")).alias("path")).unionByName(s.where("s_suppkey % 3 = 0").select(F.concat(F.lit("other/"), k, F.lit(".pdf")).alias("path")))
    return A.candidates(items, there, "root")


@query("SELECT o_custkey, '3,1,2' AS pages FROM orders GROUP BY 1")
def pages_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given pages in their order, each once, without what is none."""
    return table(spark, sf_dir, "orders").select("o_custkey").distinct().select("o_custkey", M.page_numbers(F.array(*map(F.lit, ("3", "1", "x", "3", "-1", "2", "1", "9"))), F.lit(5), 3).cast("array<string>").alias("pages")).withColumn("pages", F.array_join("pages", ","))


@query("SELECT l_orderkey, l_linenumber, printf('p%03d-t%03d', (l_orderkey % 50 + 1)::INTEGER, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)::INTEGER) AS table_id FROM lineitem")
def tables_renumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", F.lit("").alias("table_id"))
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(t)).alias("t"))
    return g.select("l_orderkey", F.explode(L.renumbered(F.col("t"), (F.col("l_orderkey") % 50).cast("int"))).alias("t")).select("l_orderkey", "t.l_linenumber", "t.table_id")


@query("SELECT p_partkey, row_number() OVER (ORDER BY p_name || '/' || lpad(p_partkey::VARCHAR, 9, '0')) AS ordinal FROM part")
def path_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts numbered by path over range partitions."""
    return Q.ordinal(table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit("/"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("path")), "path").select("p_partkey", "ordinal")


@query("""WITH l AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'updated_empty' ELSE 'updated' END AS status FROM events), r AS (SELECT user_id, arg_max(status, event_id) AS status FROM l WHERE status = 'updated' GROUP BY 1)
    SELECT c_custkey AS user_id, coalesce(r.status, 'seen') AS status FROM customer LEFT JOIN r ON user_id = c_custkey UNION ALL SELECT user_id, status FROM r WHERE user_id NOT IN (SELECT c_custkey FROM customer)""")
def checkpoint_overlaid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' statuses in a checkpoint, with the log's over them; failures undo nothing."""
    log = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "click", "updated_empty").otherwise("updated").alias("status"))
    return Q.overlaid(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.lit("seen").alias("status")), log, "user_id", "event_id", True)


@query(r"SELECT doc_id, md5(regexp_replace(lower(regexp_replace(text, '[^\x{00}-\x{7f}]', '', 'g')), '[^0-9a-z]', '', 'g')) AS folded, md5(lower(regexp_replace(regexp_replace(text, '[^\x{00}-\x{7f}]', '', 'g'), '[^0-9A-Za-z_]', '', 'g'))[1:2000]) AS similar FROM documents")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of texts, without signs beyond ASCII."""
    t = F.regexp_replace("text", r"[^\x00-\x7F]", "")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.fold_key(t)).alias("folded"), F.md5(T.similarity_key(t)).alias("similar"))


@query("SELECT p_partkey, array_to_string(list_filter(list_distinct([regexp_replace(p_name, '[^0-9A-Za-z]', '', 'g'), regexp_replace(p_name || '(' || p_brand || ')', '[^0-9A-Za-z]', '', 'g')]), lambda x: length(x) >= 8), '; ') AS needles FROM part".replace("list_distinct", ""))
def needles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to look for: the title before a bracket, and whole."""
    return table(spark, sf_dir, "part").select("p_partkey", T.title_needles(F.concat("p_name", F.lit("("), "p_brand", F.lit(")"))).alias("needles")).withColumn("needles", F.array_join("needles", "; "))


@query("SELECT s_suppkey, 'TOC' || s_suppkey || '; a, \"b\"; ' || s_name AS arguments FROM supplier")
def script_arguments(spark: SparkSession, sf_dir: str) -> DataFrame:
    call = F.concat(F.lit("x(); fnDetail('TOC"), "s_suppkey", F.lit("', 'a, \"b\"', '"), "s_name", F.lit("'); y('z')"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(T.call_arguments(call), "; ").alias("arguments"))


@query("SELECT s_suppkey, 'qwen3-' || s_suppkey AS dashless, 'Qwen-3-' || s_suppkey AS kept, s_name || '; b' AS parts, s_name || '; c d' AS listed, s_nationkey || '||' || s_name AS identity FROM supplier")
def small_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model ids, comma and arrow lists, composite keys."""
    m = F.concat(F.lit("Qwen-3-"), "s_suppkey")
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.model_id(m, True).alias("dashless"), T.model_id(m, False).alias("kept"), F.array_join(T.csv_parts(F.concat(F.lit(" ,"), "s_name", F.lit(", ,b　"))), "; ").alias("parts"), F.array_join(N.as_list(F.concat("s_name", F.lit(" > > c d "))), "; ").alias("listed"), I.identity(F.col("s_nationkey"), F.lit(None), F.col("s_name")).alias("identity"))


@query("WITH v(k, name, aliases) AS (VALUES (0, '서울특별시', ['서울', '서울시']), (1, '강원도 춘천시', ['강원특별자치도 춘천시']), (2, '경상북도', ['경북'])) SELECT n_nationkey, name, array_to_string(aliases, '; ') AS aliases FROM nation JOIN v ON n_nationkey % 3 = k")
def place_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey") % 3
    name = F.when(k == 0, "서울특별시").when(k == 1, "강원도 춘천시").otherwise("경상북도")
    return table(spark, sf_dir, "nation").select("n_nationkey", name.alias("name"), F.array_join(F.array_sort(G.aliases(name)), "; ").alias("aliases"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN 'unknown' ELSE year(o_orderdate)::VARCHAR END AS year, CASE o_orderkey % 4 WHEN 3 THEN 'unknown' WHEN 2 THEN 'unknown' ELSE strftime(o_orderdate, '%Y%m%d') END AS date_key, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate::DATE END AS prefix, o_orderdate::DATE AS strict,
    strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS stamp FROM orders""")
def date_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years and keys of dates, or of registrations, that are whole, years only or none; dates of prefixes; stamps written and read."""
    k, iso = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(k == 0, F.concat(iso, F.lit("T01:02"))).when(k == 1, "soon").when(k == 2, F.concat(F.left(iso, F.lit(4)), F.lit(" or so"))).otherwise("never")
    p = D.date_parts(text, F.when(k == 1, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("x"))
    stamp = D.iso_stamp(D.parse_stamp(D.iso_stamp(F.col("o_orderdate").cast("timestamp"))))
    return table(spark, sf_dir, "orders").select("o_orderkey", p["year"].alias("year"), p["date_key"].alias("date_key"), D.prefix_date(text).alias("prefix"), D.date_or_raise(F.date_format("o_orderdate", "yyyy.M.d")).alias("strict"), stamp.alias("stamp"))


@query("""SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN DATE '2006-07-01' WHEN 2 THEN DATE '2012-07-01' END AS valid_from, CASE n_nationkey % 4 WHEN 0 THEN DATE '2024-01-17' END AS valid_to FROM nation""")
def validity_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey") % 4
    v = D.inferred_validity(F.when(k == 0, "4511000000").when(k == 1, "5011000000").otherwise("1100000000"), F.when(k == 2, "세종특별자치시 한솔동").otherwise("x"))
    return table(spark, sf_dir, "nation").select("n_nationkey", v["valid_from"].alias("valid_from"), v["valid_to"].alias("valid_to"))


@query("SELECT doc_id, doc_id % 3 <> 0 AS uncertain, true AS always, false AS never FROM documents")
def peers_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    reasons = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("short_text:3")))
    return table(spark, sf_dir, "documents").select("doc_id", V.ask_peers("uncertain", reasons).alias("uncertain"), V.ask_peers("always", reasons).alias("always"), V.ask_peers("off", reasons).alias("never"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'missing_pdf' WHEN 1 THEN 'invalid_pdf' WHEN 2 THEN 'already_ok' WHEN 3 THEN 'repaired_legacy_path' ELSE 'repaired_existing_pdf' END AS repair FROM part""")
def repair_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey") % 5, F.col("p_size").cast("bigint")
    path = F.when(k == 3, "artifacts/pdfs/a.pdf").otherwise("x/a.pdf")
    d = table(spark, sf_dir, "part").select("p_partkey", path.alias("path"), F.when(k > 1, F.when(k == 3, "artifacts/list/pdfs/a.pdf").otherwise(path)).alias("valid_path"), F.lit("completed").alias("status"), F.lit("completed").alias("pdf_status"), F.when(k != 4, size).alias("size_bytes"), size.alias("valid_size"), F.lit("d").alias("sha256"), F.lit("d").alias("valid_sha"), (k == 1).alias("present"))
    return A.repair_status(d).select("p_partkey", "repair")


@query("SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 2 = 0 THEN 'completed' ELSE 'pending' END AS status, CASE WHEN p_partkey % 2 = 0 THEN 'f/' || p_partkey ELSE 'old' END AS path, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 0 END::BIGINT AS size_bytes, 'then' AS downloaded_at FROM part")
def found_pdfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as items, of which every second one's file was found."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey").cast("string").alias("id")
    pdf = F.struct(F.lit("pending").alias("status"), F.lit("old").alias("path"), F.lit(0).cast("bigint").alias("size_bytes"), F.lit("x").alias("sha256"), F.lit("then").alias("downloaded_at"))
    found = p.where("p_partkey % 2 = 0").select(k, F.concat(F.lit("f/"), "p_partkey").alias("path"), F.col("p_size").cast("bigint").alias("size_bytes"), F.lit("y").alias("sha256"))
    return I.with_pdf(p.select(k, F.lit("pending").alias("status"), pdf.alias("pdf")), found).select("id", "status", "pdf.path", "pdf.size_bytes", "pdf.downloaded_at")


SQL_KEYED = "k AS (SELECT s_suppkey::VARCHAR AS id, '2024-01-01' AS date, CASE WHEN s_suppkey % 3 <> 0 THEN 'T' || s_suppkey END AS toc_id, CASE WHEN s_suppkey % 3 = 1 THEN 'C1' END AS content_id FROM supplier)"


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    path = F.when(k % 3 == 1, F.concat(F.lit("/v?contentId=C1&tocId=T"), k)).when(k % 3 == 2, F.concat(F.lit("/v?tocId=T"), k)).otherwise("")
    return table(spark, sf_dir, "supplier").select(k.cast("string").alias("id"), F.lit("2024-01-01").alias("date"), path.alias("viewer_path"), F.lit("t").alias("title"), F.when(k % 2 == 0, "search").otherwise("list").alias("source_detail"), F.when(k % 2 == 0, "failed").otherwise("downloaded").alias("outcome"), F.lit("e").alias("error"), F.lit("now").alias("failed_at"))


@query(f"WITH {SQL_KEYED} SELECT id, date, 'why' AS reason, toc_id, content_id FROM k WHERE id::BIGINT % 2 = 0 AND toc_id IS NOT NULL")
def download_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.download_manifest(keyed(spark, sf_dir), F.lit("why"))


@query(f"WITH {SQL_KEYED} SELECT id AS item_id, 'e' AS error, coalesce(content_id, '') AS content_id, coalesce(toc_id, '') AS toc_id, date, 't' AS title, 'now' AS failed_at FROM k WHERE id::BIGINT % 2 = 0")
def failure_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.failure_log(keyed(spark, sf_dir)).drop("viewer_path")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'first_' || p_size || '_pages' ELSE 'all_pages' END || ':dpi=250:limit=0.5' AS signature FROM part")
def scope_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", V.scope_signature(F.when(F.col("p_size") % 2 == 0, F.col("p_size")), {"limit": 0.5, "dpi": 250}).alias("signature"))


@query("SELECT o_custkey, CASE WHEN o_custkey % 2 = 0 THEN 't' ELSE 'i' || o_custkey END AS task_key, CASE WHEN o_custkey % 2 = 0 THEN 4 ELSE 1 END::INTEGER AS page_number FROM orders GROUP BY 1")
def legacy_queues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue states with tasks, and old ones with items only."""
    c = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    task = F.when(F.col("o_custkey") % 2 == 0, F.array(F.struct(F.lit("t").alias("task_key"), F.lit("p").alias("item_path"), F.lit(4).alias("page_number"))))
    return c.select("o_custkey", F.explode(Q.legacy_tasks(task, F.array(F.concat(F.lit("i"), "o_custkey")))).alias("t")).select("o_custkey", "t.task_key", "t.page_number")


@query("""WITH i AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1 ORDER BY 'c' || conv_id LIMIT 5), p AS (SELECT 'c' || conv_id AS item_path, unnest(range(1, n + 1))::INTEGER AS page FROM i) SELECT item_path, page FROM p ORDER BY item_path, page LIMIT 12""")
def benchmark_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample, which is what it is for: twelve pages of the first five items."""
    i = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("pages_total")).withColumn("item_path", F.concat(F.lit("c"), "conv_id"))
    return Q.benchmark_pages(i, 5, 12).select("item_path", "page")


@query("SELECT s_suppkey, 'JSESSIONID=v' || s_suppkey || ' d.kr/ b=2 own/x' AS jar, 'v' || s_suppkey AS session FROM supplier")
def cookie_jars(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = lambda n, v, d, p: F.struct(n.alias("name"), v.alias("value"), d.alias("domain"), p.alias("path"))
    x, none = F.lit, F.lit(None).cast("string")
    given = F.array(c(x(""), x("1"), none, none), c(x("JSESSIONID"), F.concat(x("v"), "s_suppkey"), none, x("")), c(x("a"), none, none, none), c(x("b"), x("2"), x("own"), x("/x")))
    jar = N.cookies(given, "d.kr")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(F.transform(jar, lambda j: F.concat(j["name"], x("="), j["value"], x(" "), j["domain"], j["path"])), " ").alias("jar"), N.session_id(jar).alias("session"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'T' || s_suppkey ELSE 'U' END AS toc FROM supplier")
def first_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of search answers the first hit that has a URL."""
    hit = lambda toc, url: F.concat(F.lit('{"stored_toc_seq": "'), toc, F.lit(f'", "stored_field_url": "{url}"}}'))
    first = F.when(F.col("s_suppkey") % 2 == 0, hit(F.concat(F.lit("T"), "s_suppkey"), "/v")).otherwise(hit(F.lit("none"), ""))
    payload = F.concat(F.lit('{"data": [{"category_name": "c", "count": "2", "list": ['), first, F.lit(", "), hit(F.lit("U"), "/w"), F.lit("]}]}"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", feeds.first_hit(payload)["stored_toc_seq"].alias("toc"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name || ' 가' ELSE s_name END AS body FROM supplier")
def decoded_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response bodies in UTF-8 and in a Korean character set."""
    k = F.col("s_suppkey") % 2 == 0
    body = F.when(k, F.concat(F.encode("s_name", "UTF-8"), F.lit(b"\x20\xb0\xa1"))).otherwise(F.encode("s_name", "UTF-8"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", N.decoded(body, F.when(k, "text/html; charset=EUC-KR")).alias("body"))


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '/user/common/ofcttCntntDownload.do;jsessionid=a' || s_suppkey WHEN 1 THEN '/user/common/ofcttDownload.do' ELSE 'error' END AS endpoint FROM supplier")
def viewer_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 3
    html = F.concat(F.lit('<form action="/user/common/ofcttCntntDownload.do;jsessionid=a'), "s_suppkey", F.lit('"><a href="/user/common/ofcttDownload.do?x=1">'))
    return table(spark, sf_dir, "supplier").select("s_suppkey", I.endpoint(html, F.when(k == 0, "t"), F.when(k == 1, "c")).alias("endpoint"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'C' || (s_nationkey % 5) END AS admin_code, s_suppkey % 4 <> 0 AS needs_service FROM supplier")
def offline_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that the offline places answer before any service is asked."""
    places = table(spark, sf_dir, "region").select(G.fold_key(F.concat(F.lit("Town "), "r_regionkey")).alias("key"), F.concat(F.lit("C"), "r_regionkey").alias("admin_code"), F.col("r_name").alias("admin_name"), F.array("r_name").alias("parent_chain"), F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"), F.col("r_regionkey").alias("ins_ord"))
    a = table(spark, sf_dir, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lit("TOWN-"), F.col("s_nationkey") % 5)).otherwise(F.col("s_name")).alias("address"))
    return G.match_offline(a, places).select("s_suppkey", "place.admin_code", "needs_service")


@query("SELECT p_partkey, 'Batang; Gulim' AS fonts, (p_partkey % 3)::INTEGER AS images, true AS has_digital_evidence, p_partkey % 3 > 0 AS has_images FROM part")
def digital_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    body = F.concat(F.lit("%PDF-1.4 1 0 obj <</BaseFont /Gulim>> endobj 2 0 obj <</BaseFont/Batang>> endobj 3 0 obj <</BaseFont /Gulim>> endobj"), F.when(k % 3 > 0, " 4 0 obj <</Subtype /Image>> endobj").otherwise(""), F.when(k % 3 > 1, " 5 0 obj <</Subtype /Image>> endobj").otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", files.digital_origin(F.encode(body, "UTF-8")).alias("o")).select("p_partkey", F.array_join("o.fonts", "; ").alias("fonts"), "o.images", "o.has_digital_evidence", "o.has_images")


@query("SELECT event_id FROM events WHERE event_type <> 'error' AND event_id % 4 = 0")
def windows_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a crawl that may be marked as done."""
    w = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", "e").alias("error"), F.when(F.col("event_id") % 2 == 1, 1).when(F.col("event_id") % 4 == 2, 2).alias("failed_downloads"))
    return Q.completed_windows(w).select("event_id")
