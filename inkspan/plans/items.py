"""Envelopes and projections: documents stand for items, labels for their metadata, pages for viewer links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.functions import nested as N
from inkspan.functions import text as T
from inkspan.operators import items as I
from inkspan.registry import query
from inkspan.session import table
from inkspan.sources.sinks import export_records, flat_rows


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as items of the feeds: the path's language as category, its number as toc_id where it is even."""
    number = F.regexp_extract("url", r"/(\d+)", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", F.when(number.try_cast("int") % 2 == 0, number).alias("toc_id"), F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/viewer?contentId=C"), "page_id", F.lit("&amp;tocId=T"), number)).alias("viewer_path"),
        F.when(F.startswith(F.col("url"), F.lit("https")), "searchApi").otherwise("listPage").alias("source"), F.concat(F.lit("https://host/"), "page_id").alias("source_url"),
    )


SQL_LINKED = r"""linked AS (SELECT page_id, url, CASE WHEN try_cast(n AS INTEGER) % 2 = 0 THEN n END AS toc_id, CASE WHEN page_id % 3 = 0 THEN '/viewer?contentId=C' || page_id || '&amp;tocId=T' || n END AS viewer_path,
    CASE WHEN starts_with(url, 'https') THEN 'searchApi' ELSE 'listPage' END AS source, 'https://host/' || page_id AS source_url FROM (SELECT *, regexp_extract(url, '/(\d+)', 1) AS n FROM pages)),
    ids AS (SELECT *, nullif(regexp_extract(replace(viewer_path, '&amp;', '&'), '[?&]tocId=([^&#]*)', 1), '') AS url_toc, nullif(regexp_extract(replace(viewer_path, '&amp;', '&'), '[?&]contentId=([^&#]*)', 1), '') AS url_content FROM linked)"""


@query(f"""WITH {SQL_LINKED} SELECT page_id, 'item.v1' AS schema_version, 'gazette' AS source_system, CASE WHEN contains(lower(source), 'list') THEN 'list' ELSE 'search' END AS source_detail,
    CASE WHEN contains(lower(source), 'list') THEN 'list_page' ELSE 'search_api' END AS source_endpoint, coalesce(toc_id, url_toc) AS toc, url_content AS content, source_url AS source_link, url AS viewer_link, viewer_path AS path_link, 'pending' AS text_status, 0 AS dimensions FROM ids""")
def envelope_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = I.envelope(linked(spark, sf_dir))
    get = lambda m, k: F.try_element_at(F.col(m), F.lit(k))
    return e.select("page_id", "schema_version", "source_system", "source_detail", "source_endpoint", get("source_ids", "toc_id").alias("toc"), get("source_ids", "content_id").alias("content"), get("urls", "source").alias("source_link"), get("urls", "viewer").alias("viewer_link"), get("urls", "viewer_path").alias("path_link"), F.col("pdf_text.status").alias("text_status"), F.col("embedding.dimensions").alias("dimensions"))


@query("""SELECT doc_id, coalesce(nullif(lang, 'de'), 'other') AS language, coalesce(CASE WHEN n_chars > 1000 THEN 'long' END, 'short') AS size, source FROM documents""")
def map_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults overlaid by what is filled."""
    defaults = F.create_map(F.lit("language"), F.lit("other"), F.lit("size"), F.lit("short"))
    current = F.create_map(F.lit("language"), F.coalesce(F.when(F.col("lang") != "de", F.col("lang")), F.lit("")), F.lit("source"), F.col("source"), F.lit("size"), F.when(F.col("n_chars") > 1000, "long"))
    m = N.overlay(defaults, N.without_blanks(current))
    return table(spark, sf_dir, "documents").withColumn("m", m).select("doc_id", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("language", "size", "source")])


@query("""SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'pending' WHEN l.quality = 1 THEN 'ok' ELSE 'ok' END AS text_status, CASE WHEN l.quality = 1 THEN 'skipped_text_extractable' ELSE 'pending' END AS ocr_status,
    CASE WHEN l.quality = 1 THEN 'text_extractable_pdf' END AS skip_reason FROM documents d LEFT JOIN labels l USING (doc_id)""")
def text_metadata_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text metadata from labels, mirrored into the OCR status."""
    docs = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    stored = F.struct(F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("boolean").alias("text_extractable"))
    given = F.when(F.col("quality").isNotNull(), F.struct(F.lit("").alias("status"), F.lit("").alias("error"), (F.col("quality") == 1).alias("text_extractable")))
    return docs.select("doc_id", I.text_synced(stored, given, F.lit("")).alias("s")).select("doc_id", "s.*")


@query("""SELECT doc_id, lang AS item_lang, n_chars AS item_n_chars, '{"source":"' || source || '"}' AS item_tags FROM documents""")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct("lang", "n_chars", F.create_map(F.lit("source"), F.col("source")).alias("tags"))
    return N.flatten(table(spark, sf_dir, "documents").select("doc_id", item.alias("item")), "item")


@query("""SELECT d.doc_id, d.lang, coalesce(l.quality, -1)::INTEGER AS quality, CASE WHEN l.doc_id IS NULL THEN 'stored' ELSE 'updated' END AS state FROM documents d LEFT JOIN labels l USING (doc_id)""")
def item_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels merged over the stored records by id."""
    old = table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit(-1).alias("quality"), F.lit("stored").alias("state"))
    new = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("quality"), F.lit("updated").alias("state"))
    return I.upsert(old, new, "doc_id", merge=True)


@query("""SELECT d.doc_id, d.source, CASE WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'poor' END AS verdict, l.toxic::INTEGER AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)""")
def item_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("verdict"), F.col("toxic").cast("int").alias("toxic"))
    return I.write_back(table(spark, sf_dir, "documents").select("doc_id", "source"), updates, "doc_id", ["verdict", "toxic"])


@query(r"""SELECT page_id, regexp_replace(regexp_replace(url, '[^0-9A-Za-z가-힣_.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS name, 'items/unknown/unknown/' || page_id || '.json' AS item_path,
    'store/pdfs/2024/20240' || (1 + page_id % 9) || '15/' || page_id || '.pdf' AS pdf_path, CASE WHEN page_id % 2 = 0 THEN 'artifacts/list/pdfs/' || page_id END AS migrated FROM pages""")
def safe_filename_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("page_id").cast("string")
    date = F.concat(F.lit("2024-0"), (F.col("page_id") % 9 + 1).cast("string"), F.lit("-15"))
    old = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("artifacts/pdfs/"), key)).otherwise(key)
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "pages").select("page_id", T.safe_filename(F.col("url")).alias("name"), I.item_path(none, key).alias("item_path"), I.expected_path("store", "pdfs", date, none, key).alias("pdf_path"), I.migrated_path(old).alias("migrated"))


@query(f"""WITH {SQL_LINKED} SELECT page_id, coalesce(toc_id, url_toc, '') AS toc_id, coalesce(url_content, '') AS content_id, CASE WHEN coalesce(toc_id, url_toc) IS NOT NULL THEN 'content' WHEN url_content IS NOT NULL THEN 'issue' END AS endpoint FROM ids""")
def download_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = I.download_keys(linked(spark, sf_dir))
    return keyed.select("page_id", "toc_id", "content_id", I.download_request(F.col("toc_id"), F.col("content_id"))["endpoint"].alias("endpoint"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.when(F.col("n_chars") >= 50, F.col("doc_id").cast("string")).alias("id"), F.concat_ws(" ", "source", "doc_id").alias("title"), F.lit("2024-01-01").alias("date"), F.col("source").alias("agency"), F.lit(None).cast("string").alias("law"), F.concat(F.lit("/v/"), "doc_id").alias("viewer_path"), F.lit("documents").alias("source"), F.col("lang").alias("category"))


@query("""SELECT doc_id::VARCHAR AS id, source || ' ' || doc_id AS title, '2024-01-01' AS date, source AS agency, '' AS law, '/v/' || doc_id AS viewer_path, 'documents' AS source, lang AS category FROM documents WHERE n_chars >= 50""")
def dataset_export_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export_records(catalogue(spark, sf_dir))


@query("""SELECT doc_id::VARCHAR AS id, source || ' ' || doc_id AS title, '2024-01-01' AS date, lang AS category, source AS agency, '' AS law, '/v/' || doc_id AS viewer_path FROM documents WHERE n_chars >= 50""")
def flat_analytics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_rows(catalogue(spark, sf_dir)).drop("raw")


@query("""SELECT vec_id, 'ready' AS status, len(embedding)::INTEGER AS dimensions, label FROM embeddings""")
def embedding_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embedding field of an item: its status and size."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.lit("ready").alias("status"), F.size("embedding").alias("dimensions"), "label")
