"""Coverage, references and sync: anti-joins, diffs, manifests and the choice between files and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.functions import text as T
from inkspan.functions.dates import date_parts
from inkspan.operators.items import best_of, download_keys, expected_path, have, migrated_path, stem_differs


def gap(listed: DataFrame, saved: DataFrame, key: str = "id") -> DataFrame:
    """Listed rows whose key isn't saved, one for each key: of several the one that is least as JSON."""
    row = F.struct(*[F.col(f"`{c}`") for c in listed.columns])
    one = listed.groupBy(F.col(key).alias("__key")).agg(F.min_by(row, F.to_json(row)).alias("__row"))
    return one.join(saved.select(F.col(key).alias("__key")).distinct(), "__key", "left_anti").select("__row.*")


def gap_manifest(missing: DataFrame, source: str, reason: str, **extra: Column) -> DataFrame:
    c = lambda n: have(missing, n)
    return missing.select(
        F.lit(source).alias("source"), F.coalesce(c("id"), F.lit("")).alias("id"), T.first_filled(c("date"), c("keyword_field_regdate")).alias("date"), T.first_filled(c("title"), c("stored_field_subject")).alias("title"), T.first_filled(c("category"), c("stored_category_name")).alias("category"),
        T.first_filled(c("agency"), c("stored_organ_nm")).alias("agency"), T.first_filled(c("viewer_path"), c("stored_field_url")).alias("viewer_path"), T.first_filled(c("pdf_path"), F.lit("")).alias("pdf_path"), F.lit(reason).alias("reason"), *[v.alias(k) for k, v in extra.items()],
    )


def first_seen(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Rows with their occurrence: the first of each key by ordinal is 1, later ones are duplicates."""
    w = Window.partitionBy(key).orderBy(ordinal)
    return rows.withColumn("occurrence", F.row_number().over(w)).withColumn("is_duplicate", F.col("occurrence") > 1)


def sync_plan(local: DataFrame, remote: DataFrame, key: str = "key", size: str = "size") -> DataFrame:
    """(key, action): upload what is missing or of another size, delete what is only remote, keep the rest."""
    a, b = local.select(key, F.col(size).alias("local_size")), remote.select(key, F.col(size).alias("remote_size"))
    action = F.when(F.col("local_size").isNull(), "delete").when(F.col("local_size").eqNullSafe(F.col("remote_size")), "keep").otherwise("upload")
    return a.join(b, key, "full_outer").withColumn("action", action)


def reference_check(refs: DataFrame, files: DataFrame) -> DataFrame:
    """References (ref_id, path, size_bytes, sha256) against files (path, size, digest): where each really is and what is wrong with it."""
    f = files.select(F.col("path").alias("__p"), F.col("size").alias("__s"), F.col("digest").alias("__d"))
    g = f.select(F.col("__p").alias("__p2"), F.col("__s").alias("__s2"), F.col("__d").alias("__d2"))
    moved = refs.withColumn("__m", migrated_path(F.col("path")))
    # most paths have not moved: by a null key all these rows would meet in one task, so they go by their path, which then matches nothing
    legacy = F.coalesce(F.col("__m"), F.col("path")) == F.col("__p2")
    joined = moved.join(f, F.col("path") == F.col("__p"), "left").join(g, legacy & F.col("__m").isNotNull(), "left")
    size, digest = F.coalesce("__s", "__s2"), F.coalesce("__d", "__d2")
    return joined.select(
        *refs.columns, F.coalesce("__p", "__p2").alias("actual_path"), size.alias("actual_size"),
        F.when(F.col("__p").isNull() & F.col("__p2").isNull(), "missing").when(F.col("size_bytes") != size, "size_mismatch").when(T.nz(F.col("sha256")) != digest, "hash_mismatch").when(F.col("__p").isNull(), "migrated").otherwise("ok").alias("finding"),
    )


def orphans(files: DataFrame, refs: DataFrame) -> DataFrame:
    """Files that no reference names, by its path or where that path has moved to."""
    named = refs.select(F.explode(F.array_compact(F.array(F.col("path"), migrated_path(F.col("path"))))).alias("path"))
    return files.join(named, "path", "left_anti")


def hash_targets(refs: DataFrame, ordinal: str) -> DataFrame:
    """(path, sha256): for each path the digest that its first reference gives."""
    return refs.where(T.nz(F.col("sha256")).isNotNull()).groupBy("path").agg(F.min_by("sha256", ordinal).alias("sha256"))


def candidates(items: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """(id, path, prio) of each file that may be an item's: the declared path, its legacy place, the expected path, files of the same name; each path once."""
    p = items.withColumns({"__legacy": migrated_path(F.col("path")), "__expected": expected_path(root, "pdfs", F.col("date"), F.lit(None).cast("string"), F.col("id"))})
    direct = p.select("id", F.posexplode(F.array("path", "__legacy", "__expected")).alias("prio", "candidate")).where("candidate is not null and candidate <> ''")
    there = direct.join(files.select(F.col("path").alias("candidate")), "candidate", "left_semi")
    name = F.element_at(F.split("path", "/"), -1)
    by_name = files.select(F.col("path").alias("candidate"), name.alias("__name"))
    names = p.select("id", F.explode(F.array_distinct(F.array(name, F.concat(T.safe_filename(F.col("id")), F.lit(".pdf"))))).alias("__name")).where("__name is not null and __name <> ''")
    named = names.join(by_name, "__name").select("id", F.lit(3).alias("prio"), "candidate")
    return there.select("id", "prio", "candidate").unionByName(named).groupBy("id", "candidate").agg(F.min("prio").alias("prio")).select("id", F.col("candidate").alias("path"), "prio")


def choose_candidate(found: DataFrame, key: str = "id") -> DataFrame:
    """Of the valid candidates (key, path, dated, sized) the one to take: of the right date, then size, then the least path."""
    return best_of(found, key, F.desc("dated"), F.desc("sized"), F.asc("path"))


def choose_record(records: DataFrame, key: str, completed: Column, canonical: Column) -> DataFrame:
    """One record for each key: completed ones first, else the one at its canonical path, else by path."""
    return best_of(records, key, F.desc(completed), F.desc(~completed & canonical), F.asc("path"))


def missing_reason(found: DataFrame, key: str = "id") -> DataFrame:
    """(key, reason) from candidates (key, complete): invalid_pdf where one is there but none complete, missing_pdf where none is."""
    return found.groupBy(key).agg(F.when(F.bool_or("complete"), F.lit(None)).when(F.count("complete") > 0, "invalid_pdf").otherwise("missing_pdf").alias("reason"))


def repair_status(df: DataFrame) -> DataFrame:
    """repair of items joined with their chosen file (path, valid_path, status, pdf_status, size_bytes, valid_size, sha256, valid_sha)."""
    same = F.col("pdf_status").eqNullSafe(F.lit("completed")) & F.col("status").eqNullSafe(F.lit("completed")) & F.col("path").eqNullSafe(F.col("valid_path")) & F.col("size_bytes").eqNullSafe(F.col("valid_size"))
    hashed = F.col("sha256").isNull() | (F.col("sha256") == F.col("valid_sha"))
    repaired = F.when(F.startswith(F.col("path"), F.lit("artifacts/pdfs/")), "repaired_legacy_path").otherwise("repaired_existing_pdf")
    return df.withColumn("repair", F.when(F.col("valid_path").isNull(), F.when(F.col("present"), "invalid_pdf").otherwise("missing_pdf")).when(same & hashed & F.col("sha256").isNotNull(), "already_ok").otherwise(repaired))


def download_manifest(items: DataFrame, reason: Column) -> DataFrame:
    """What is to be fetched again: items of the search feed with a toc_id or a viewer path."""
    keyed = download_keys(items)
    path = T.first_filled(have(items, "viewer_path"), have(items, "stored_field_url"))
    return keyed.where((F.col("source_detail") == "search") & ((F.col("toc_id") != "") | (path != ""))).select("id", "date", reason.alias("reason"), T.nz(F.col("toc_id")).alias("toc_id"), T.nz(F.col("content_id")).alias("content_id"))


def catch_up(items: DataFrame, found: DataFrame) -> DataFrame:
    """Items without a complete file, with the final reason: missing_download_key where nothing can be asked for."""
    reasons = missing_reason(items.select("id").join(found, "id", "left"))
    keyed = download_keys(items).join(reasons, "id").where("reason is not null")
    no_key = (F.col("toc_id") == "") & (F.col("content_id") == "")
    return keyed.withColumn("reason", F.when(no_key, "missing_download_key").otherwise(F.col("reason")))


def year_reasons(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce(T.nz(F.left("date", F.lit(4))), F.lit("unknown")).alias("year"), "reason").agg(F.count(F.lit(1)).alias("n"))


def year_allowed(date: Column, include: list[str] = (), exclude: list[str] = ()) -> Column:
    year = F.coalesce(F.left(date, F.lit(4)), F.lit(""))
    return (year.isin(list(include)) if include else F.lit(True)) & (~year.isin(list(exclude)) if exclude else F.lit(True))


def failure_class(error: Column, status: Column, size: Column, starts: Column, complete: Column) -> Column:
    """What a direct PDF request came to, by error, HTTP status and the body's size and ends."""
    known = {(500, 73): "content_endpoint_500_minimal_html", (500, 651): "content_endpoint_500_error_html", (200, 0): "content_empty_response"}
    out = F.when(T.nz(error).isNotNull(), "content_request_error").when(complete, "content_pdf_complete").when((status == 200) & starts, "content_pdf_incomplete")
    for (code, n), name in known.items():
        out = out.when((status == code) & (size == n), name)
    return out.when(status == 200, "content_non_pdf_or_empty_200").when(status.isNull() & error.isNull() & size.isNull(), "not_diagnosed").otherwise(F.concat(F.lit("content_status_"), F.coalesce(status.cast("string"), F.lit("unknown"))))


def management_class(issue_complete: Column, content_id: Column) -> Column:
    return F.when(issue_complete, "issue_pdf_fallback_downloaded").when(T.nz(F.trim(content_id)).isNotNull(), "issue_pdf_fallback_pending").otherwise("manual_review_missing_content_id")


def classify_retries(manifest: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """Manifest rows (id, toc_id, content_id, stored_pdf_file_path, issue_complete) with their diagnostic (id, error, status, bytes, starts_pdf, pdf_complete), if any, as classes."""
    d = diagnostics.withColumnRenamed("id", "__id")
    joined = manifest.join(d, F.col("__id") == F.coalesce(T.nz(F.col("id")), F.col("toc_id")), "left")
    primary = F.when(F.col("__id").isNull(), "not_diagnosed").otherwise(failure_class(F.col("error"), F.col("status"), F.col("bytes"), F.coalesce("starts_pdf", F.lit(False)), F.coalesce("pdf_complete", F.lit(False))))
    return joined.select(*manifest.columns, primary.alias("primary_class"), management_class(F.col("issue_complete"), F.col("content_id")).alias("management_class"), stem_differs(F.col("stored_pdf_file_path"), F.col("toc_id")).alias("file_id_differs"))


def outcome(df: DataFrame) -> DataFrame:
    """outcome of manifest rows (manifest_error, metadata_error, complete, downloaded), the first that holds."""
    return df.withColumn("outcome", F.when(T.nz(F.col("manifest_error")).isNotNull(), "manifest_error").when(T.nz(F.col("metadata_error")).isNotNull(), "metadata_error").when(F.col("complete"), "skipped_existing").when(F.col("downloaded"), "downloaded").otherwise("failed"))


def failure_log(rows: DataFrame) -> DataFrame:
    """The log of the rows that failed."""
    keyed = download_keys(rows)
    return keyed.where("outcome = 'failed'").select(F.col("id").alias("item_id"), "error", have(rows, "viewer_path").alias("viewer_path"), "content_id", "toc_id", have(rows, "date").alias("date"), have(rows, "title").alias("title"), "failed_at")


#: Rows of a side that is broadcast for a grid; a larger one is left to Spark.
GRID_ROWS = 200_000


def _small(side: DataFrame) -> DataFrame:
    return F.broadcast(side) if side.limit(GRID_ROWS + 1).count() <= GRID_ROWS else side


def combinations(years: DataFrame, institutions: DataFrame, done: DataFrame) -> DataFrame:
    """Each year with no institution and with each one, without what is done (year, institution; null for none)."""
    all_ = institutions.select("institution").unionByName(institutions.sparkSession.createDataFrame([(None,)], "institution string"))
    grid = years.crossJoin(_small(all_))
    return grid.join(done.distinct(), (grid["year"] == done["year"]) & grid["institution"].eqNullSafe(done["institution"]), "left_anti")


def first_ok(attempts: DataFrame, key: str, ordinal: str, ok: str = "ok") -> DataFrame:
    """A ladder of attempts: for each key the first that succeeded and how many were made."""
    return attempts.groupBy(key).agg(F.min_by("method", F.when(F.col(ok), F.col(ordinal))).alias("chosen"), F.count(F.lit(1)).alias("attempts"), F.bool_or(ok).alias("recovered"))


def presence(items: DataFrame, sources: DataFrame, categories: DataFrame) -> DataFrame:
    """(source, category, items, present) over the grid of all sources and categories."""
    n = items.groupBy("source", "category").agg(F.count(F.lit(1)).alias("items"))
    return sources.crossJoin(_small(categories)).join(n, ["source", "category"], "left").select("source", "category", F.coalesce("items", F.lit(0)).cast("bigint").alias("items"), F.col("items").isNotNull().alias("present"))


def resume_done(mode: Column, state_done: Column, pdf_complete: Column, status: Column) -> Column:
    """Whether a crawl may skip an item: its window is done, or it is there, and complete or wanted as metadata only."""
    return state_done | F.when(mode == "metadata", status.isNotNull()).otherwise(pdf_complete | (status == "metadata_only"))
