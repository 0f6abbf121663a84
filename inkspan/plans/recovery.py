"""Decisions on transcripts: events and conversations as readings, peers and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.operators import recovery as V
from inkspan.registry import query
from inkspan.session import table

METHODS = {"click": "pdf_text", "view": "markitdown", "signup": "image_ocr", "purchase": "pdf_text", "error": "other"}
SQL_METHODS = "m AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'pdf_text' WHEN 'view' THEN 'markitdown' WHEN 'signup' THEN 'image_ocr' WHEN 'purchase' THEN 'pdf_text' ELSE 'other' END AS method, CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 9 = 0 THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN user_id % 4 = 0 THEN 0 ELSE (floor(value) * 10)::BIGINT END AS text_chars FROM events)"


def methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.lit("other")
    for kind, method in METHODS.items():
        name = F.when(F.col("event_type") == kind, method).otherwise(name)
    status = F.when(F.col("event_type") == "error", "error").when(F.col("event_id") % 9 == 0, "skipped").otherwise("ok")
    return table(spark, sf_dir, "events").select("user_id", name.alias("method"), status.alias("status"), F.when(F.col("user_id") % 4 == 0, 0).otherwise(F.floor("value") * 10).cast("bigint").alias("text_chars"), F.lit("E").alias("error"), F.lit("S").alias("skip_reason"))


SQL_BEST = """b AS (SELECT user_id, arg_max(method, (text_chars, CASE method WHEN 'markitdown' THEN 3 WHEN 'pdf_text' THEN 2 WHEN 'image_ocr' THEN 1 ELSE 0 END, method)) FILTER (status = 'ok' AND text_chars > 0) AS best_method, max(text_chars) FILTER (status = 'ok' AND text_chars > 0) AS best_chars FROM m GROUP BY user_id)"""


@query(f"WITH {SQL_METHODS}, {SQL_BEST} SELECT * FROM b")
def peer_best_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.best_method(methods(spark, sf_dir), "user_id")


@query(f"""WITH {SQL_METHODS}, {SQL_BEST}, d AS (SELECT user_id, bool_or(status = 'ok' AND text_chars > 0 AND method IN ('pdf_text', 'markitdown')) AS layer, bool_or(status = 'ok' AND text_chars > 0 AND method = 'image_ocr') AS ocr FROM m GROUP BY 1)
    SELECT user_id, layer OR ocr AS text_extractable, CASE WHEN layer THEN best_method WHEN ocr THEN 'image_ocr' END AS preferred_source, NOT layer AS needs_ocr, CASE WHEN layer THEN 'text layer' WHEN ocr THEN 'only OCR' ELSE 'no text' END AS reason FROM d JOIN b USING (user_id)""")
def extraction_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.decision(methods(spark, sf_dir), "user_id")


@query(f"""WITH {SQL_METHODS}, {SQL_BEST}, w AS (SELECT user_id, CASE status WHEN 'error' THEN method || ' failed: E' WHEN 'skipped' THEN method || ' skipped: S' END AS w FROM m UNION ALL SELECT m.user_id, method || ' gave much less text than ' || best_method FROM m JOIN b USING (user_id) WHERE status = 'ok' AND method <> best_method AND text_chars < best_chars * 0.3 UNION ALL SELECT user_id, 'no method gave text' FROM b WHERE best_method IS NULL)
    SELECT user_id, coalesce(string_agg(DISTINCT w, '; ' ORDER BY w), '') AS warnings FROM w GROUP BY 1""")
def extraction_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.warnings(methods(spark, sf_dir), "user_id").select("user_id", F.array_join("warnings", "; ").alias("warnings"))


SQL_PEERS = "peers AS (SELECT user_id, lpad(event_id::VARCHAR, 9, '0') AS peer, CASE WHEN event_type = 'error' THEN 'unparsed' ELSE 'ok' END AS status, CASE event_type WHEN 'click' THEN 'accept' WHEN 'view' THEN 'revise' WHEN 'signup' THEN 'reject' ELSE '' END AS verdict, CASE WHEN event_type = 'view' AND event_id % 3 > 0 THEN 'text ' || event_id ELSE '' END AS corrected_text, least(1.0, value / 150)::DOUBLE AS confidence FROM events)"


def peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, i = F.col("event_type"), F.col("event_id")
    said = F.when(t == "click", "accept").when(t == "view", "revise").when(t == "signup", "reject").otherwise("")
    return table(spark, sf_dir, "events").select("user_id", F.lpad(i.cast("string"), 9, "0").alias("peer"), F.when(t == "error", "unparsed").otherwise("ok").alias("status"), said.alias("verdict"), F.when((t == "view") & (i % 3 > 0), F.concat(F.lit("text "), i)).otherwise("").alias("corrected_text"), F.least(F.lit(1.0), F.col("value") / 150).alias("confidence"))


@query(f"""WITH {SQL_PEERS}, g AS (SELECT user_id, arg_min(corrected_text, (-confidence, peer)) FILTER (status = 'ok' AND verdict = 'revise' AND corrected_text <> '' AND confidence >= 0.8) AS revision, bool_or(status = 'ok' AND verdict = 'reject' AND confidence >= 0.85) AS rejected FROM peers GROUP BY 1), p AS (SELECT DISTINCT user_id FROM events)
    SELECT user_id, coalesce(revision, 'primary ' || user_id) AS final_text, CASE WHEN revision IS NOT NULL THEN 'peer_revision' WHEN rejected THEN 'peer_rejected_primary' ELSE 'vlm_primary' END AS text_source FROM p LEFT JOIN g USING (user_id)""")
def final_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary = table(spark, sf_dir, "events").select("user_id").distinct().select("user_id", F.lit("vlm").alias("engine"), F.concat(F.lit("primary "), "user_id").alias("text"))
    return V.final_text(primary, peers(spark, sf_dir), "user_id")


@query(f"""WITH {SQL_PEERS} SELECT user_id, peer, coalesce(status = 'ok' AND ((verdict = 'accept' AND confidence >= 0.75) OR (verdict = 'revise' AND corrected_text <> '' AND confidence >= 0.8) OR (verdict = 'reject' AND confidence >= 0.85)), false) AS conclusive FROM peers""")
def peer_conclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peers(spark, sf_dir).select("user_id", "peer", V.conclusive(F.col("status"), F.col("verdict"), F.col("corrected_text"), F.col("confidence")).alias("conclusive"))


@query("""WITH e AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN '' ELSE 'error' END AS s, repeat('x', (event_id % 40)::INTEGER) AS t, least(1.0, floor(value) / 50)::DOUBLE AS c, CASE WHEN event_id % 5 = 0 THEN 'length' ELSE 'stop' END AS f FROM events)
    SELECT event_id, array_to_string(list_filter([CASE WHEN s <> 'ok' THEN 'primary_status:' || coalesce(nullif(s, ''), 'missing') END, CASE WHEN t = '' THEN 'empty_text' WHEN length(t) < 20 THEN 'short_text:' || length(t) END, CASE WHEN c < 0.85 THEN 'low_confidence:' || printf('%.3f', c) END, CASE WHEN f <> 'stop' THEN 'finish_reason:' || f END], lambda x: x IS NOT NULL), ';') AS reasons FROM e""")
def review_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    status = F.when(i % 3 == 0, "ok").when(i % 3 == 1, "").otherwise("error")
    reasons = V.review_reasons(status, F.repeat(F.lit("x"), (i % 40).cast("int")), F.floor("value") / 50, F.when(i % 5 == 0, "length").otherwise("stop"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(reasons, ";").alias("reasons"))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN '' WHEN 'click' THEN 'accept' ELSE 'revise' END AS verdict, CASE WHEN event_type = 'error' THEN 'unparsed' ELSE 'ok' END AS status, round(CASE WHEN event_type = 'error' THEN 0.0 ELSE least(1.0, value / 50) END, 4)::DOUBLE AS confidence, CASE WHEN event_type IN ('error', 'click') THEN 0 ELSE 2 END AS n_issues FROM events""")
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as peers' raw answers, parsed."""
    t = F.col("event_type")
    body = F.concat(F.lit('{"verdict": "'), F.when(t == "click", " ACCEPT ").otherwise("revise"), F.lit('", "corrected_text": "t", "confidence": '), (F.col("value") / 50).cast("string"), F.when(t == "click", "}").otherwise(', "issues": ["a", "b"]}'))
    raw = F.when(t == "error", "cannot say").when(t == "view", F.concat(F.lit("Well: "), body)).otherwise(body)
    return table(spark, sf_dir, "events").select("event_id", V.verdict(raw).alias("v")).select("event_id", "v.verdict", "v.status", F.round("v.confidence", 4).alias("confidence"), F.size("v.issues").alias("n_issues"))


@query("""SELECT conv_id, count(*) AS pages, regexp_replace(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> ''), '^\\s+|\\s+$', '', 'g') AS text, length(regexp_replace(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (text <> ''), '^\\s+|\\s+$', '', 'g'))::INTEGER AS chars, 'updated' AS item_status FROM conversations GROUP BY conv_id""".replace("\\\\", "\\"))
def transcript_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation's turns as pages, joined in order."""
    pages = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page"), F.lit("ok").alias("status"), "text")
    return V.item_texts(pages, "conv_id").select("conv_id", "pages", "text", "chars", "item_status")


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN 'json_error' WHEN quality = 0 THEN 'not_completed' WHEN n_chars % 5 = 0 THEN 'missing_pdf_path' WHEN n_chars % 2 = 0 THEN 'current' ELSE 'needs_update' END AS reason FROM documents LEFT JOIN labels USING (doc_id)""")
def eligibility_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    reason = V.update_reason(F.col("quality").isNull(), F.when(F.col("quality") == 1, "completed").otherwise("failed"), F.when(F.col("n_chars") % 5 != 0, "p").otherwise(" "), F.col("n_chars") % 2 == 0)
    return d.select("doc_id", reason.alias("reason"))


@query("""WITH r AS (SELECT source, CASE WHEN quality IS NULL THEN 'json_error' WHEN quality = 0 THEN 'not_completed' WHEN n_chars % 5 = 0 THEN 'missing_pdf_path' WHEN n_chars % 2 = 0 THEN 'current' ELSE 'needs_update' END AS reason FROM documents LEFT JOIN labels USING (doc_id)) SELECT source, reason, count(*) AS n FROM r GROUP BY ALL""")
def eligibility_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return eligibility_reasons(spark, sf_dir).join(d, "doc_id").groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, quality IS NOT NULL AND n_chars % 2 = 0 AND (quality = 0 OR toxic = 0) AS current FROM documents LEFT JOIN labels USING (doc_id)""")
def staleness_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a document's metadata is up to date: labels as metadata, the parity of its length as scope, toxicity as a flag that does not fit."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    there = F.col("quality").isNotNull()
    scope = F.when(F.col("n_chars") % 2 == 0, "all_pages").otherwise("first_2_pages")
    ocr = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "skipped_text_extractable").otherwise("pending")
    current = V.metadata_current(F.col("quality") == 1, F.when(there, "c"), F.when(there, F.lit(False)), F.lit("p"), F.lit("p"), scope, F.lit("all_pages"), ocr, F.lit("text_extractable_pdf"))
    return d.select("doc_id", current.alias("current"))


@query("""SELECT user_id, arg_min(event_type, event_id) FILTER (value > 30 AND event_type <> 'error') AS backend, bool_or(value > 30 AND event_type <> 'error') AS recovered, count(*)::INTEGER AS attempts FROM events GROUP BY 1""")
def recovery_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as recovery attempts: the first usable one."""
    a = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("step"), F.col("event_type").alias("backend"), (F.col("value") > 30).alias("extractable"), F.when(F.col("event_type") == "error", "suspect_mojibake").otherwise("ok").alias("quality"), F.lit(1).alias("chars"))
    return V.ladder(a, "user_id").select("user_id", "backend", "recovered", F.size("attempts").alias("attempts"))


@query("""SELECT doc_id, CASE WHEN quality IS NULL THEN 'error' WHEN toxic = 1 THEN 'digital_text_recovered' WHEN quality = 1 THEN 'text_extractable' WHEN n_chars % 3 = 0 THEN 'digital_text_unrecovered' WHEN n_chars % 3 = 1 THEN 'image_or_scanned' ELSE 'unknown_unextractable' END AS pdf_text_class,
    NOT coalesce(toxic = 1 OR quality = 1, false) AS needs_ocr FROM documents LEFT JOIN labels USING (doc_id)""")
def text_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    c = V.text_class(F.col("quality").isNull(), F.col("toxic") == 1, F.col("quality") == 1, F.col("n_chars") % 3 == 0, F.col("n_chars") % 3 == 1)
    return d.select("doc_id", c.alias("c")).select("doc_id", "c.*")


@query("""WITH h AS (SELECT o_custkey, o_orderkey % 30 + 1 AS page, length('title' || o_custkey || o_orderstatus) AS matched FROM orders WHERE o_orderstatus <> 'P')
    SELECT o_custkey, arg_min(page, (page <= 10, -matched, page))::INTEGER AS target_page, count(*) AS hit_count FROM h GROUP BY 1""")
def target_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a customer's pages, of which those not pending hold its title."""
    key = F.concat(F.lit("title"), F.col("o_custkey").cast("string"))
    p = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") % 30 + 1).cast("int").alias("page"), F.concat(F.lit("-- "), F.when(F.col("o_orderstatus") != "P", key), "o_orderstatus").alias("text"), F.array(F.concat(key, F.lit("F")), F.concat(key, F.lit("O"))).alias("needles"))
    return V.target_page(p, "o_custkey", 10)
