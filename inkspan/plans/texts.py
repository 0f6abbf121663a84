"""Normalised texts, their quality and their distance, over whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkspan.functions import text as T
from inkspan.operators.recovery import pair_similarity
from inkspan.registry import query
from inkspan.session import table

SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(rf"SELECT doc_id, md5(trim(regexp_replace(text, '{SPACE}+', ' ', 'g'), ' ')) AS squashed, md5(regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+\n', chr(10), 'g'), '\n\n\n+', chr(10) || chr(10), 'g'), '^{SPACE}+|{SPACE}+$', '', 'g')) AS tidied, md5(regexp_replace(text, '[^0-9A-Za-z가-힣]', '', 'g')) AS compacted FROM documents")
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of three normal forms of every text."""
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.squash(t)).alias("squashed"), F.md5(T.tidy(t)).alias("tidied"), F.md5(T.compact(t)).alias("compacted"))


@query(rf"""WITH c AS (SELECT doc_id, regexp_replace(text, '{SPACE}+', '', 'g') AS t FROM documents), n AS (SELECT doc_id, t, length(t) AS n, length(regexp_replace(t, '[\x{{00}}-\x{{7f}}가-힣\x{{1100}}-\x{{11ff}}\x{{3130}}-\x{{318f}}\x{{4e00}}-\x{{9fff}}·ㆍ℃㎞㎡㎥％]', '', 'g')) AS odd, length(regexp_replace(t, '[^0-9A-Za-z가-힣]', '', 'g')) AS fine FROM c)
    SELECT doc_id, CASE WHEN n < 20 THEN 'empty_or_sparse' WHEN contains(lower(t), '(cid:') THEN 'suspect_or_encoded' WHEN odd / n >= 0.2 AND fine / n < 0.55 THEN 'suspect_or_encoded' ELSE 'readable' END AS text_quality FROM n""")
def text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.readability(F.col("text")).alias("text_quality"))


@query(rf"""WITH t AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+\n', chr(10), 'g'), '\n\n\n+', chr(10) || chr(10), 'g'), '^{SPACE}+|{SPACE}+$', '', 'g') AS t FROM documents),
    l AS (SELECT doc_id, t, length(t) AS chars, length(t) - length(regexp_replace(t, '{SPACE}', '', 'g')) AS spaces, length(t) - length(regexp_replace(t, '[가-힣]', '', 'g')) AS hangul, length(t) - length(regexp_replace(t, '\p{{Nd}}', '', 'g')) AS digits,
        list_filter(list_transform(regexp_split_to_array(t, '\r\n|[\n\r\x{{0b}}\x{{0c}}\x{{1c}}\x{{1d}}\x{{1e}}\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda x: x <> '') AS lines FROM t),
    r AS (SELECT *, coalesce(1 - len(list_distinct(lines)) / nullif(len(lines), 0), 0) AS repeated FROM l)
    SELECT doc_id, chars::INTEGER AS chars, len(lines)::INTEGER AS lines, digits::INTEGER AS digits, round(hangul / greatest(1, chars - spaces), 4) AS hangul_ratio, round(repeated, 4) AS duplicate_line_ratio, (chars - length(regexp_replace(t, '[一-鿿]', '', 'g')))::INTEGER AS hanja_chars, round((chars - (chars - length(regexp_replace(t, '[\x{{00}}-\x{{08}}\x{{0e}}-\x{{1b}}\x{{7f}}-\x{{84}}\x{{86}}-\x{{9f}}\p{{Cf}}\p{{Co}}]', '', 'g')))) / greatest(1, chars), 4) AS printable_ratio, (chars - length(replace(t, chr(65533), '')))::INTEGER AS replacement_chars, (len(string_split(t, '(cid:')) - 1)::INTEGER AS cid_markers,
        chars = 0 OR contains(t, chr(65533)) OR contains(t, '(cid:') OR (chars >= 100 AND hangul / greatest(1, chars - spaces) < 0.05) OR repeated > 0.45 AS suspect FROM r""")
def transcript_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = T.transcript_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "q")
    return q.select("doc_id", "q.chars", "q.lines", "q.digits", "q.hangul_ratio", "q.duplicate_line_ratio", "q.suspect", "q.hanja_chars", "q.printable_ratio", "q.replacement_chars", "q.cid_markers")


@query(rf"""WITH l AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\r\n|[\n\r\x{{0b}}\x{{0c}}\x{{1c}}\x{{1d}}\x{{1e}}\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda x: x <> '') AS lines FROM documents)
    SELECT doc_id, round(coalesce(len(list_filter(lines, lambda x: regexp_matches(x, '[:：]{SPACE}*[^\s]') OR regexp_matches(x, '^[0-9A-Za-z가-힣][.)]{SPACE}') OR contains(x, ' - ') OR regexp_matches(x, '[ㆍ·]'))) / nullif(len(lines), 0), 0), 6) AS form_score FROM l""")
def form_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.round(T.form_score(F.col("text")), 6).alias("form_score"))


@query(rf"""WITH t AS (SELECT doc_id, trim(regexp_replace(text, '{SPACE}+', ' ', 'g'), ' ') AS t FROM documents)
    SELECT doc_id, CASE WHEN len(regexp_extract_all(t, '\(cid:\d+\)')) >= 5 THEN 'suspect_cid_placeholders' WHEN t = '' THEN 'empty' WHEN length(t) - length(regexp_replace(t, '[가-힣]', '', 'g')) < 50 THEN 'unknown_short_text' ELSE 'ok' END AS status FROM t""")
def mojibake_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.mojibake(F.col("text"))["status"].alias("status"))


@query(rf"""WITH c AS (SELECT conv_id, turn, regexp_replace(coalesce(text, ''), '[^\x{{00}}-\x{{7f}}]', '?', 'g') AS text, regexp_replace(coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text), ''), '[^\x{{00}}-\x{{7f}}]', '?', 'g') AS before FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
    z AS (SELECT conv_id, turn, regexp_replace(before, '{SPACE}+', '', 'g') AS r, regexp_replace(text, '{SPACE}+', '', 'g') AS c FROM c), d AS (SELECT *, levenshtein(r, c) AS d FROM z)
    SELECT conv_id, turn, length(r)::INTEGER AS reference_chars, length(c)::INTEGER AS candidate_chars, d::INTEGER AS distance, round(d / greatest(1, length(r)), 6) AS cer, round(greatest(0, 1 - d / greatest(1, length(r))), 6) AS similarity, round(length(c) / greatest(1, length(r)), 4) AS length_ratio FROM d""")
def error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a reading of the one before it in its conversation: character distance of the whole texts. (Signs beyond ASCII count as one each; DuckDB's distance counts bytes.)"""
    ascii_only = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\x00-\x7F]", "?")
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").distinct().withColumn("before", before)
    return turns.select("conv_id", "turn", T.error_rate(ascii_only(F.col("before")), ascii_only(F.col("text"))).alias("m")).select("conv_id", "turn", "m.*")


@query()
def pairwise_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each two roles of a conversation say, as two readings of one text."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    said = table(spark, sf_dir, "conversations").groupBy("conv_id", F.col("role").alias("method")).agg(F.array_join(F.transform(turns, lambda t: t["text"]), " ").alias("sample_text"))
    return pair_similarity(said.withColumn("status", F.lit("ok")), "conv_id")


@query(r"""SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents""")
def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5"))


@query(r"""WITH u AS (SELECT user_id, sum(value) AS seconds FROM events GROUP BY 1), s AS (SELECT user_id, round_even(seconds, 0)::BIGINT AS s FROM u)
    SELECT user_id, CASE WHEN s >= 3600 THEN (s // 3600) || 'h' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || 'm' WHEN s >= 60 THEN (s // 60) || 'm' || lpad((s % 60)::VARCHAR, 2, '0') || 's' ELSE s || 's' END AS duration FROM s""")
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds of each user, added in the order of events: where a sum ends at a half, the order of additions says how it rounds."""
    so_far = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    running = table(spark, sf_dir, "events").select("user_id", "event_id", F.sum("value").over(so_far).alias("seconds"))
    return running.groupBy("user_id").agg(F.max_by("seconds", "event_id").alias("seconds")).select("user_id", T.duration(F.col("seconds")).alias("duration"))


@query(r"""WITH e AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'HTTP 50' || (event_id % 5) || ' from host' WHEN 'click' THEN 'Too Many Requests' WHEN 'view' THEN 'TransferEncodingError: x' ELSE 'unknown' END AS error FROM events)
    SELECT event_id, CASE WHEN error = 'Too Many Requests' THEN 'rate_limit' WHEN error LIKE 'HTTP 500%' OR error LIKE 'HTTP 502%' OR error LIKE 'HTTP 503%' THEN 'session' WHEN error LIKE 'Transfer%' THEN 'transfer' ELSE 'other' END AS kind FROM e""")
def failure_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = F.when(F.col("event_type") == "error", F.concat(F.lit("HTTP 50"), F.col("event_id") % 5, F.lit(" from host"))).when(F.col("event_type") == "click", "Too Many Requests").when(F.col("event_type") == "view", "TransferEncodingError: x").otherwise("unknown")
    return table(spark, sf_dir, "events").select("event_id", T.failure_kind(error).alias("kind"))


@query(r"""WITH s AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '(04524) City ' || s_name || 'ro 11, ( annex )' WHEN 1 THEN 'City Namdong 12-3' WHEN 2 THEN 'City 남대로 ' || s_nationkey || ' ,  end' ELSE s_name END AS raw FROM supplier)
    SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN regexp_replace(regexp_replace(raw, '^\(04524\) ', ''), ', \( annex \)', ' (annex)') WHEN 2 THEN replace(raw, ' ,  ', ' ') ELSE raw END AS address, CASE WHEN s_suppkey % 4 = 2 THEN 'road' ELSE 'unknown' END AS kind,
        NULL::VARCHAR AS error FROM s""")
def address_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("(04524) City "), "s_name", F.lit("ro 11, ( annex )"))).when(k == 1, "City Namdong 12-3").when(k == 2, F.concat(F.lit("City 남대로 "), "s_nationkey", F.lit(" ,  end"))).otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", T.address(raw).alias("address"), T.address_type(raw).alias("kind"), T.keyword_error(raw).alias("error"))
