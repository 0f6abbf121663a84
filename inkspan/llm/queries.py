"""One query for each operator, over its whole table, and the SQL that DuckDB answers alike where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm import chat, decontam, exact_dedup, langid, mixing, near_dedup, shards, url_filter, warc, word_lm
from inkspan.llm.shared import fresh_path, table


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the best place."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus at target weights and twice its size, which clamps several sources: every document as often as its source's repetitions say, with the copy's number."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, copy_column="copy", weights=mixing.target_weights(docs), budget_share=mixing.BUDGET_SHARE)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest index after two deliveries, one half of the sources each, and compaction: of each text the document that brought it."""
    docs = table(spark, sf_dir, "documents")
    index = exact_dedup.DigestIndex(spark, fresh_path(spark, "digests"))
    first = F.substring(F.md5(F.coalesce(F.col("source").cast("string"), F.lit(""))), 1, 1) < "8"
    index.absorb(docs.where(first))
    index.absorb(docs.where(~first))
    index.compact()
    return index.table().select("doc_id", F.lower(F.hex("digest")).alias("digest"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of the archives written from all pages, without the files' places."""
    manifest = warc.write_archives(warc.records(table(spark, sf_dir, "pages")), warc.archive_folder(spark))
    return manifest.select("page_id", "warc_type", "target_uri", "payload_digest", "record_id", "refers_to", "content_length")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maximal conversations, rendered."""
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document against the documents of good quality."""
    return word_lm.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id of every document that near-dedup keeps."""
    return near_dedup.survivors(spark, table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision of the URL rules on every page."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    return shards.place(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_decontam, op2_langid, op3_mixing, op4_exact_dedup, op5_warc, op6_chat, op7_lm_score, op8_near_dedup, op9_url_filter, op10_sharding)}
ORACLE: dict[str, str] = {
    "op3_mixing": mixing.oracle_sql(),
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS digest, CASE WHEN md5(coalesce(source, ''))[1:1] < '8' THEN 0 ELSE 1 END AS delivery FROM documents),
        k AS (SELECT digest, delivery, min(doc_id) AS doc_id FROM d GROUP BY ALL)
        SELECT arg_min(doc_id, delivery) AS doc_id, digest FROM k GROUP BY digest""",
    "op5_warc": """
        WITH r AS (SELECT DISTINCT page_id, replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS uri, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n FROM pages),
        k AS (SELECT *, md5(coalesce(page_id::VARCHAR, '') || '|' || uri || '|' || digest) AS key FROM r),
        o AS (SELECT *, first_value(key) OVER (PARTITION BY digest ORDER BY page_id NULLS LAST, uri, key) AS original FROM k),
        u AS (SELECT *, '<urn:uuid:' || key[1:8] || '-' || key[9:12] || '-' || key[13:16] || '-' || key[17:20] || '-' || key[21:32] || '>' AS id,
            '<urn:uuid:' || original[1:8] || '-' || original[9:12] || '-' || original[13:16] || '-' || original[17:20] || '-' || original[21:32] || '>' AS oid FROM o)
        SELECT page_id, CASE WHEN key = original THEN 'response' ELSE 'revisit' END AS warc_type, uri AS target_uri, 'sha256:' || digest AS payload_digest, id AS record_id,
            CASE WHEN key <> original THEN oid END AS refers_to, CASE WHEN key = original THEN 77 + length(n::VARCHAR) + n ELSE 59 END AS content_length FROM u""",
    "op6_chat": chat.ORACLE,
    "op9_url_filter": url_filter.oracle_sql(),
    "op10_sharding": shards.oracle_sql(),
}
