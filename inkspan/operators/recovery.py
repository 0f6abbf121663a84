"""Reading texts from files and images: which attempt counts, what peers say of it, which text is final."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.functions import text as T
from inkspan.functions.nested import json_object, once
from inkspan.functions.numbers import unit
from inkspan.operators.queues import ordinal

PREFERENCE = {"image_ocr": 1, "pdf_text": 2, "markitdown": 3}
ACCEPT, REVISE, REJECT = 0.75, 0.8, 0.85


def preference(method: Column) -> Column:
    out = F.lit(0)
    for name, rank in PREFERENCE.items():
        out = F.when(method == name, rank).otherwise(out)
    return out


def text_class(error: Column, recovered: Column, extractable: Column, evidence: Column, images: Column) -> Column:
    """Struct of pdf_text_class and needs_ocr: error, recovered, extractable, unrecovered, scanned or unknown, the first that holds."""
    flag = lambda c: F.coalesce(c, F.lit(False))
    name = F.when(flag(error), "error").when(flag(recovered), "digital_text_recovered").when(flag(extractable), "text_extractable").when(flag(evidence), "digital_text_unrecovered").when(flag(images), "image_or_scanned").otherwise("unknown_unextractable")
    return F.struct(name.alias("pdf_text_class"), (~name.isin("digital_text_recovered", "text_extractable")).alias("needs_ocr"))


def usable(extractable: Column, quality: Column) -> Column:
    """Whether recovered text can be used: it is there and not suspect."""
    return F.coalesce(extractable, F.lit(False)) & ~F.coalesce(F.startswith(quality, F.lit("suspect_")), F.lit(False))


def ladder(attempts: DataFrame, key: str) -> DataFrame:
    """Attempts (key, step, backend, extractable, quality, chars): the first usable one, and all of them, compact, in order."""
    good = usable(F.col("extractable"), F.col("quality"))
    each = F.struct("step", "backend", "extractable", "quality", "chars")
    g = attempts.groupBy(key).agg(F.min_by("backend", F.when(good, F.col("step"))).alias("backend"), F.bool_or(good).alias("recovered"), F.array_sort(F.collect_list(each)).alias("attempts"))
    return g.withColumn("attempts", F.transform("attempts", lambda a: a.dropFields("step")))


def without_samples(recovery: Column) -> Column:
    """A recovery struct without sample texts, its own and its attempts'."""
    return recovery.dropFields("sample_text").withField("attempts", F.transform(recovery["attempts"], lambda a: a.dropFields("sample_text")))


def best_method(methods: DataFrame, key: str) -> DataFrame:
    """Of methods (key, method, status, text_chars) that gave text, the one that gave most; ties by preference."""
    good = (F.col("status") == "ok") & (F.col("text_chars") > 0)
    return methods.groupBy(key).agg(F.max_by("method", F.when(good, F.struct("text_chars", preference(F.col("method")), "method"))).alias("best_method"), F.max(F.when(good, F.col("text_chars"))).alias("best_chars"))


def decision(methods: DataFrame, key: str) -> DataFrame:
    """Whether a document has text, from where, and whether it needs OCR."""
    good = (F.col("status") == "ok") & (F.col("text_chars") > 0)
    layer, ocr = F.bool_or(good & F.col("method").isin("pdf_text", "markitdown")), F.bool_or(good & (F.col("method") == "image_ocr"))
    g = methods.groupBy(key).agg(layer.alias("layer"), ocr.alias("ocr"))
    b = best_method(methods, key)
    return g.join(b, key).select(key, (F.col("layer") | F.col("ocr")).alias("text_extractable"), F.when(F.col("layer"), F.col("best_method")).when(F.col("ocr"), "image_ocr").alias("preferred_source"), (~F.col("layer")).alias("needs_ocr"), F.when(F.col("layer"), "text layer").when(F.col("ocr"), "only OCR").otherwise("no text").alias("reason"))


def warnings(methods: DataFrame, key: str) -> DataFrame:
    """(key, warnings): failed and skipped methods, and those with much less text than the best."""
    joined = methods.join(best_method(methods, key), key)
    said = F.when(F.col("status") == "error", F.concat("method", F.lit(" failed: "), F.coalesce("error", F.lit("")))).when(F.col("status") == "skipped", F.concat("method", F.lit(" skipped: "), F.coalesce("skip_reason", F.lit(""))))
    less = F.when((F.col("status") == "ok") & (F.col("method") != F.col("best_method")) & (F.col("text_chars") < F.col("best_chars") * 0.3), F.concat("method", F.lit(" gave much less text than "), "best_method"))
    none = F.when(F.col("best_method").isNull(), F.lit("no method gave text"))
    return joined.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_compact(F.array(said, less, none)))))).alias("warnings"))


def pair_similarity(methods: DataFrame, key: str) -> DataFrame:
    """(key, pair, similarity) of each two methods that gave a sample, by name."""
    s = methods.where((F.col("status") == "ok") & (F.col("sample_text") != "")).select(key, "method", T.similarity_key(F.col("sample_text")).alias("s"))
    a, b = s.alias("a"), s.alias("b")
    pairs = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.method") < F.col("b.method")))
    return pairs.select(F.col(f"a.{key}").alias(key), F.concat("a.method", F.lit(":"), "b.method").alias("pair"), T.similarity(F.col("a.s"), F.col("b.s")).alias("similarity"))


def verdict(raw: Column) -> Column:
    """A peer's raw answer as a struct: status, verdict, corrected_text, confidence, issues."""

    def parts(said: Column, corrected: Column, sure: Column, issues: Column) -> Column:
        v = F.when(said.isin("accept", "revise", "reject"), said).otherwise("")
        listed = F.when(F.startswith(F.ltrim(issues), F.lit("[")), F.from_json(issues, "array<string>")).when(T.nz(issues).isNotNull(), F.array(issues)).otherwise(F.array().cast("array<string>"))
        return F.struct(F.when(v != "", "ok").otherwise("unparsed").alias("status"), v.alias("verdict"), T.tidy(F.coalesce(corrected, F.lit(""))).alias("corrected_text"), unit(sure).alias("confidence"), listed.alias("issues"))

    def read(j: Column) -> Column:
        get = lambda p: F.get_json_object(j, p)
        return F.struct(F.lower(T.strip(F.coalesce(get("$.verdict"), F.lit("")))).alias("v"), get("$.corrected_text").alias("c"), get("$.confidence").alias("s"), get("$.issues").alias("i"))

    return once(once(json_object(F.coalesce(raw, F.lit(""))), read), lambda x: parts(x["v"], x["c"], x["s"], x["i"]))


def conclusive(status: Column, said: Column, corrected: Column, confidence: Column) -> Column:
    return (status == "ok") & (((said == "accept") & (confidence >= ACCEPT)) | ((said == "revise") & (F.coalesce(corrected, F.lit("")) != "") & (confidence >= REVISE)) | ((said == "reject") & (confidence >= REJECT)))


def review_reasons(status: Column, text: Column, confidence: Column, finish: Column, threshold: float = 0.85, least: int = 20) -> Column:
    """Why a primary transcript needs peers."""
    n, c = F.length(T.strip(F.coalesce(text, F.lit("")))), unit(confidence)
    s, f = F.coalesce(status, F.lit("")), F.coalesce(finish, F.lit(""))
    return F.array_compact(F.array(
        F.when(s != "ok", F.concat(F.lit("primary_status:"), F.coalesce(T.nz(s), F.lit("missing")))),
        F.when(n == 0, "empty_text").when(n < least, F.concat(F.lit("short_text:"), n.cast("string"))),
        F.when(c < threshold, F.concat(F.lit("low_confidence:"), F.format_string("%.3f", c))),
        F.when((f != "") & (f != "stop"), F.concat(F.lit("finish_reason:"), f)),
    ))


def ask_peers(policy: str, reasons: Column) -> Column:
    """Whether peers are asked: never, when there are reasons, or always."""
    if policy not in ("off", "uncertain", "always"):
        raise ValueError(f"unknown policy: {policy}")
    return F.lit(policy == "always") if policy != "uncertain" else F.size(reasons) > 0


def final_text(primary: DataFrame, peers: DataFrame, key: str) -> DataFrame:
    """(key, final_text, text_source) of primary (key, engine, text) and peers (key, peer, status, verdict, corrected_text, confidence)."""
    ok = F.col("status") == "ok"
    revises = ok & (F.col("verdict") == "revise") & (F.col("corrected_text") != "") & (F.col("confidence") >= REVISE)
    g = peers.groupBy(key).agg(F.min_by("corrected_text", F.when(revises, F.struct(-F.col("confidence"), "peer"))).alias("__revision"), F.bool_or(ok & (F.col("verdict") == "reject") & (F.col("confidence") >= REJECT)).alias("__rejected"))
    joined = primary.join(g, key, "left")
    return joined.select(key, F.coalesce("__revision", "text", F.lit("")).alias("final_text"), F.when(F.col("__revision").isNotNull(), "peer_revision").when(F.col("__rejected"), "peer_rejected_primary").otherwise(F.concat(F.coalesce(T.nz(F.col("engine")), F.lit("primary")), F.lit("_primary"))).alias("text_source"))


def item_texts(pages: DataFrame, key: str) -> DataFrame:
    """Pages (key, page, status, text) of each item as one text in page order; the item's status from its pages'."""
    texts = F.array_sort(F.collect_list(F.when(T.nz(F.col("text")).isNotNull(), F.struct("page", "text"))))
    g = pages.groupBy(key).agg(T.strip(F.array_join(F.transform(texts, lambda x: x["text"]), "\n\n")).alias("text"), F.bool_or(F.col("status") == "error").alias("__error"), F.count(F.lit(1)).alias("pages"))
    return g.select(key, "pages", "text", F.length("text").alias("chars"), F.when(F.col("text") != "", "updated").when(F.col("__error"), "error").otherwise("updated_empty").alias("item_status"))


def target_page(pages: DataFrame, key: str, front: int = 10) -> DataFrame:
    """Pages (key, page, text, needles): of those that hold a needle the one that holds the longest, behind the front matter if any is there; ties by page."""
    t = T.compact(F.coalesce("text", F.lit("")))
    longest = F.array_max(F.transform(F.filter("needles", lambda n: F.contains(t, n)), F.length))
    hits = pages.withColumn("matched", longest).where("matched is not null")
    first = F.min_by("page", F.struct(F.col("page") <= front, -F.col("matched"), "page"))
    return hits.groupBy(key).agg(first.alias("target_page"), F.count(F.lit(1)).alias("hit_count"))


def scope_signature(most: Column, settings: dict[str, float]) -> Column:
    """Name of an OCR run: its pages and all its settings."""
    from inkspan.functions.numbers import scope

    return F.concat_ws(":", scope(most), *[F.lit(f"{k}={v:g}") for k, v in sorted(settings.items())])


def needs_ocr(items: DataFrame) -> DataFrame:
    """Items whose text metadata says so, strictly, and those that could not be read."""
    return items.where(F.col("needs_ocr").eqNullSafe(F.lit(True)) | F.col("json_error"))


def metadata_current(extractable: Column, cls: Column, need: Column, path: Column, want_path: Column, scope: Column, want_scope: Column, ocr_status: Column, skip: Column) -> Column:
    """Whether text metadata is up to date: all there, of the same file and scope, with the skip flags that it implies."""
    there = extractable.isNotNull() & cls.isNotNull() & need.isNotNull()
    flags = ~extractable | (ocr_status.eqNullSafe(F.lit("skipped_text_extractable")) & skip.eqNullSafe(F.lit("text_extractable_pdf")))
    return F.coalesce(there & path.eqNullSafe(want_path) & scope.eqNullSafe(want_scope) & flags, F.lit(False))


def update_reason(json_error: Column, pdf_status: Column, path: Column, current: Column, force: bool = False, all_statuses: bool = False) -> Column:
    """json_error, not_completed, missing_pdf_path, current or needs_update: the first that holds."""
    out = F.when(json_error, "json_error")
    if not all_statuses:
        out = out.when(~pdf_status.eqNullSafe(F.lit("completed")), "not_completed")
    out = out.when(T.nz(F.trim(F.coalesce(path, F.lit("")))).isNull(), "missing_pdf_path")
    return out.otherwise("needs_update") if force else out.when(current, "current").otherwise("needs_update")


def eligible(df: DataFrame, reason: Column, order: str, most: int | None = None) -> DataFrame:
    """Rows with reason and, where that is null, the rank among the eligible; picked up to most, if given."""
    judged = df.withColumn("reason", reason)
    good = ordinal(judged.where("reason is null"), order).withColumnRenamed("ordinal", "rank")
    ranked = good.unionByName(judged.where("reason is not null").withColumn("rank", F.lit(None).cast("bigint")))
    return ranked.withColumn("picked", F.col("rank").isNotNull() & ((F.col("rank") <= most) if most else F.lit(True)))
