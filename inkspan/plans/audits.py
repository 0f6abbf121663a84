"""Coverage, references, sync and repair of documents, orders and events in the place of items, files and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.operators import audits as A
from inkspan.operators import reports as R
from inkspan.registry import query
from inkspan.session import table


@query("""SELECT doc_id::VARCHAR AS id, lang AS category, source AS agency, 'documents' AS source, 'missing_metadata' AS reason FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def coverage_gap_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label."""
    listed = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("category"), F.col("source").alias("agency"))
    missing = A.gap(listed, table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id")))
    return A.gap_manifest(missing, "documents", "missing_metadata").select("id", "category", "agency", "source", "reason")


@query("""SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id)::INTEGER AS occurrence, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1 AS is_duplicate FROM documents""")
def seen_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The occurrence of each text in arrival order."""
    return A.first_seen(table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest")), "digest", "doc_id").drop("digest")


@query("""WITH l AS (SELECT doc_id AS key, n_chars AS size FROM documents), r AS (SELECT doc_id + 3 AS key, CASE WHEN quality = 1 THEN n_chars ELSE n_chars + 1 END AS size FROM labels JOIN documents USING (doc_id))
    SELECT coalesce(l.key, r.key) AS key, l.size AS local_size, r.size AS remote_size, CASE WHEN l.key IS NULL THEN 'delete' WHEN l.size = r.size THEN 'keep' ELSE 'upload' END AS action FROM l FULL JOIN r ON l.key = r.key""")
def sync_plan_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remote = table(spark, sf_dir, "labels").join(docs.select("doc_id", "n_chars"), "doc_id").select((F.col("doc_id") + 3).alias("key"), F.when(F.col("quality") == 1, F.col("n_chars")).otherwise(F.col("n_chars") + 1).alias("size"))
    return A.sync_plan(docs.select(F.col("doc_id").alias("key"), F.col("n_chars").alias("size")), remote)


SQL_REFS = """refs AS (SELECT o_orderkey AS ref_id, CASE WHEN o_custkey % 5 = 0 THEN 'artifacts/pdfs/' || (o_custkey % 9000) ELSE 'artifacts/list/pdfs/' || (o_custkey * 2) END AS path, CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 100 END::BIGINT AS size_bytes, CASE WHEN o_custkey % 11 = 0 THEN 'bad' WHEN o_custkey % 11 = 1 THEN 'ok' END AS sha256 FROM orders),
    files AS (SELECT 'artifacts/list/pdfs/' || c_custkey AS path, 100::BIGINT AS size, 'ok' AS digest FROM customer)"""


def references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("o_custkey")
    path = F.when(k % 5 == 0, F.concat(F.lit("artifacts/pdfs/"), k % 9000)).otherwise(F.concat(F.lit("artifacts/list/pdfs/"), k * 2))
    refs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ref_id"), path.alias("path"), F.when(k % 7 == 0, 1).otherwise(100).cast("bigint").alias("size_bytes"), F.when(k % 11 == 0, "bad").when(k % 11 == 1, "ok").alias("sha256"))
    files = table(spark, sf_dir, "customer").select(F.concat(F.lit("artifacts/list/pdfs/"), "c_custkey").alias("path"), F.lit(100).cast("bigint").alias("size"), F.lit("ok").alias("digest"))
    return refs, files


@query(f"""WITH {SQL_REFS}, m AS (SELECT *, CASE WHEN starts_with(path, 'artifacts/pdfs/') THEN 'artifacts/list/pdfs/' || substr(path, 16) END AS moved FROM refs)
    SELECT ref_id, m.path, size_bytes, sha256, coalesce(f.path, g.path) AS actual_path, coalesce(f.size, g.size) AS actual_size, CASE WHEN f.path IS NULL AND g.path IS NULL THEN 'missing' WHEN size_bytes <> coalesce(f.size, g.size) THEN 'size_mismatch'
        WHEN sha256 <> coalesce(f.digest, g.digest) THEN 'hash_mismatch' WHEN f.path IS NULL THEN 'migrated' ELSE 'ok' END AS finding FROM m LEFT JOIN files f ON m.path = f.path LEFT JOIN files g ON m.moved = g.path""")
def reference_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.reference_check(*references(spark, sf_dir))


@query(f"""WITH {SQL_REFS} SELECT path, size, digest FROM files WHERE path NOT IN (SELECT path FROM refs) AND path NOT IN (SELECT 'artifacts/list/pdfs/' || substr(path, 16) FROM refs WHERE starts_with(path, 'artifacts/pdfs/'))""")
def orphan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs, files = references(spark, sf_dir)
    return A.orphans(files, refs)


@query(f"WITH {SQL_REFS} SELECT path, arg_min(sha256, ref_id) AS sha256 FROM refs WHERE sha256 IS NOT NULL GROUP BY path")
def hash_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.hash_targets(references(spark, sf_dir)[0], "ref_id")


@query("""WITH r AS (SELECT md5(text) AS id, source || '/' || lpad(doc_id::VARCHAR, 9, '0') AS path, n_chars % 3 = 0 AS completed, doc_id % 4 = 0 AS canonical FROM documents)
    SELECT id, path FROM r QUALIFY row_number() OVER (PARTITION BY id ORDER BY completed DESC, (NOT completed AND canonical) DESC, path) = 1""")
def choose_record_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record of each text: complete, canonical, least path."""
    r = table(spark, sf_dir, "documents").select(F.md5("text").alias("id"), F.concat_ws("/", "source", F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("path"), "n_chars", "doc_id")
    return A.choose_record(r, "id", F.col("n_chars") % 3 == 0, F.col("doc_id") % 4 == 0).select("id", "path")


@query("""WITH c AS (SELECT l_partkey AS id, 's' || l_suppkey || '/' || l_orderkey || '/' || l_linenumber AS path, l_returnflag = 'R' AS dated, l_quantity = 10 AS sized FROM lineitem)
    SELECT id, path FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY dated DESC, sized DESC, path) = 1""")
def choose_candidate_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.concat(F.lit("s"), "l_suppkey", F.lit("/"), "l_orderkey", F.lit("/"), "l_linenumber").alias("path"), (F.col("l_returnflag") == "R").alias("dated"), (F.col("l_quantity") == 10).alias("sized"))
    return A.choose_candidate(c).select("id", "path")


@query("""WITH f AS (SELECT o_custkey AS id, CASE WHEN count(o_orderkey) = 0 THEN NULL END AS x, bool_or(o_orderstatus = 'F') AS any_complete FROM orders GROUP BY 1),
    r AS (SELECT c_custkey AS id, CASE WHEN f.id IS NULL THEN 'missing_pdf' WHEN NOT any_complete THEN 'invalid_pdf' END AS reason, c_nationkey FROM customer LEFT JOIN f ON f.id = c_custkey)
    SELECT (2000 + c_nationkey)::VARCHAR AS year, CASE WHEN id % 10 = 0 THEN 'missing_download_key' ELSE reason END AS reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL""")
def year_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a finished order, as items without a complete file, by year and final reason."""
    items = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), (F.col("c_nationkey") + 2000).cast("string").alias("date"), F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("T"), "c_custkey")).alias("toc_id"))
    found = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id"), (F.col("o_orderstatus") == "F").alias("complete"))
    return A.year_reasons(A.catch_up(items, found))


@query("""WITH y AS (SELECT DISTINCT year(o_orderdate)::INTEGER AS year FROM orders), i AS (SELECT r_name AS institution FROM region UNION ALL SELECT NULL), d AS (SELECT DISTINCT year(o_orderdate)::INTEGER AS year, r_name AS institution FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE o_orderstatus = 'F' AND r_regionkey % 2 = 0)
    SELECT y.year, i.institution FROM y, i WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.year = y.year AND d.institution IS NOT DISTINCT FROM i.institution)""")
def combo_cross_minus_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    places = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(table(spark, sf_dir, "region").where("r_regionkey % 2 = 0"), F.col("r_regionkey") == F.col("n_regionkey"))
    done = orders.where("o_orderstatus = 'F'").join(places, F.col("c_custkey") == F.col("o_custkey")).select("year", F.col("r_name").alias("institution"))
    return A.combinations(orders.select("year").distinct(), table(spark, sf_dir, "region").select(F.col("r_name").alias("institution")), done)


@query("""WITH e AS (SELECT event_id AS id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'T' || event_id END AS toc_id, CASE WHEN event_id % 4 = 0 THEN 'C' || event_id END AS content_id, event_type = 'purchase' AS issue_complete, '/p/' || CASE WHEN event_id % 3 = 0 THEN 'X' ELSE 'T' END || event_id || '.pdf' AS stored, event_type, user_id % 4 AS k FROM events)
    SELECT id::VARCHAR AS id, CASE WHEN event_type = 'view' THEN 'not_diagnosed' WHEN event_type = 'error' THEN 'content_request_error' WHEN k = 0 THEN 'content_endpoint_500_minimal_html' WHEN k = 1 THEN 'content_empty_response' WHEN k = 2 THEN 'content_pdf_complete' ELSE 'content_status_404' END AS primary_class,
        CASE WHEN issue_complete THEN 'issue_pdf_fallback_downloaded' WHEN content_id IS NOT NULL THEN 'issue_pdf_fallback_pending' ELSE 'manual_review_missing_content_id' END AS management_class, coalesce(toc_id, '') <> '' AND regexp_extract(stored, '([^/]+)\\.pdf$', 1) <> coalesce(toc_id, '') AS file_id_differs FROM e""".replace("\\\\", "\\"))
def retry_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as failed downloads, with and without a diagnosis."""
    e, i, k = table(spark, sf_dir, "events"), F.col("event_id"), F.col("user_id") % 4
    manifest = e.select(i.cast("string").alias("id"), F.when(i % 6 != 0, F.concat(F.lit("T"), i)).alias("toc_id"), F.when(i % 4 == 0, F.concat(F.lit("C"), i)).alias("content_id"), (F.col("event_type") == "purchase").alias("issue_complete"), F.concat(F.lit("/p/"), F.when(i % 3 == 0, "X").otherwise("T"), i, F.lit(".pdf")).alias("stored_pdf_file_path"))
    seen = e.where("event_type <> 'view'").select(i.cast("string").alias("id"), F.when(F.col("event_type") == "error", "HTTP").alias("error"), F.when(k == 0, 500).when(k == 3, 404).otherwise(200).alias("status"), F.when(k == 0, 73).when(k == 1, 0).otherwise(900).alias("bytes"), (k == 2).alias("starts_pdf"), (k == 2).alias("pdf_complete"))
    return A.classify_retries(manifest, seen).select("id", "primary_class", "management_class", "file_id_differs")


@query("""SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'manifest_error' WHEN toxic = 1 THEN 'metadata_error' WHEN quality = 1 THEN 'skipped_existing' WHEN n_chars > 2000 THEN 'downloaded' ELSE 'failed' END AS outcome FROM documents LEFT JOIN labels l USING (doc_id)""")
def manifest_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rows = d.select("doc_id", F.when(F.col("quality").isNull(), "no row").alias("manifest_error"), F.when(F.col("toxic") == 1, "bad").alias("metadata_error"), (F.col("quality") == 1).alias("complete"), (F.col("n_chars") > 2000).alias("downloaded"))
    return A.outcome(rows).select("doc_id", "outcome")


@query("""SELECT s.source, c.category, count(d.doc_id) AS items, count(d.doc_id) > 0 AS present FROM (SELECT DISTINCT source FROM documents) s CROSS JOIN (SELECT DISTINCT lang AS category FROM documents UNION SELECT 'ko') c LEFT JOIN documents d ON d.source = s.source AND d.lang = c.category GROUP BY ALL""")
def artifact_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", F.col("lang").alias("category"))
    return A.presence(d, d.select("source").distinct(), d.select("category").union(spark.createDataFrame([("ko",)], "category string")).distinct())


@query("""WITH f AS (SELECT source || '/' || CASE WHEN doc_id % 3 = 0 THEN 'pdfs' WHEN doc_id % 3 = 1 THEN 'issue_pdfs' ELSE 'misc' END || '/' || doc_id AS path, n_chars AS size, n_chars > 100 AS ok, source, doc_id FROM documents)
    SELECT CASE WHEN doc_id % 3 = 2 THEN source ELSE source || '/' || CASE WHEN doc_id % 3 = 0 THEN 'pdfs' ELSE 'issue_pdfs' END END AS bucket, count(*) AS files, count(*) FILTER (ok) AS ok, sum(size)::BIGINT AS bytes FROM f GROUP BY 1""")
def bucket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    files = table(spark, sf_dir, "documents").select(F.concat_ws("/", F.lit("root"), "source", F.when(k == 0, "pdfs").when(k == 1, "issue_pdfs").otherwise("misc"), "doc_id").alias("path"), F.col("n_chars").alias("size"), (F.col("n_chars") > 100).alias("ok"))
    return R.bucket_sizes(files, "root")


@query("""WITH a AS (SELECT user_id, event_type AS method, event_id, event_type IN ('click', 'signup') AND value > 20 AS ok FROM events)
    SELECT user_id, arg_min(method, event_id) FILTER (ok) AS chosen, count(*) AS attempts, bool_or(ok) AS recovered FROM a GROUP BY 1""")
def attempt_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as attempts in order: the first that succeeded."""
    a = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("method"), "event_id", (F.col("event_type").isin("click", "signup") & (F.col("value") > 20)).alias("ok"))
    return A.first_ok(a, "user_id", "event_id")


@query("""WITH d AS (SELECT doc_id, n_chars % 3 = 0 AS done, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) SELECT doc_id FROM d WHERE NOT (done OR coalesce(quality = 1, false) OR coalesce(toxic = 1, false))""")
def resume_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that a resumed crawl still has to do."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    status = F.when(F.col("toxic") == 1, "metadata_only").otherwise("completed")
    return d.where(~A.resume_done(F.lit("pdf"), F.col("n_chars") % 3 == 0, F.coalesce(F.col("quality") == 1, F.lit(False)), status)).select("doc_id")
