"""The item envelope and its projections, upserts and write-backs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkspan.functions import text as T
from inkspan.functions.dates import date_parts
from inkspan.functions.nested import once, without_blanks
from inkspan.functions.numbers import admin_code

VERSION = "item.v1"
TEXT_DEFAULT = "struct<status:string,text_extractable:boolean,pages:int,text_pages:int,total_chars:bigint,pdf_text_class:string,needs_ocr:boolean,analysis_scope:string,pdf_path_text:string>"


def have(df: DataFrame, name: str) -> Column:
    """A column, or null text where the table lacks it."""
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def source_detail(theme: Column, detail: Column, source: Column, has_stored: Column) -> Column:
    """Which of the two feeds an item comes from: as it says, else by its source's name, else by its stored keys."""
    low = F.lower(F.coalesce(source, F.lit("")))
    return F.coalesce(T.nz(theme), T.nz(detail), F.when(F.contains(low, F.lit("list")), "list").when(F.contains(low, F.lit("search")), "search"), F.when(has_stored, "search").otherwise("list"))


def source_endpoint(detail: Column) -> Column:
    return F.when(detail == "search", "search_api").otherwise("list_page")


def source_ids(toc_id: Column, stored: Column, content_id: Column, url: Column) -> Column:
    """Map of the ids that are there: given, stored, or in the URL's query."""
    toc = F.coalesce(T.nz(toc_id), T.nz(stored), T.query_value(url, "tocId"))
    content = F.coalesce(T.nz(content_id), T.query_value(url, "contentId"))
    return without_blanks(F.create_map(F.lit("toc_id"), toc, F.lit("content_id"), content))


def urls(source_url: Column, url: Column, viewer_url: Column, viewer_path: Column, stored_url: Column, pdf_url: Column) -> Column:
    return without_blanks(F.create_map(F.lit("source"), source_url, F.lit("viewer"), F.coalesce(T.nz(url), viewer_url), F.lit("viewer_path"), F.coalesce(T.nz(viewer_path), stored_url), F.lit("pdf"), pdf_url))


def envelope(items: DataFrame) -> DataFrame:
    """The versioned envelope: blanks in it filled, ids and URLs gathered, default structs added; all columns stay."""
    c = lambda n: have(items, n)
    detail = source_detail(c("theme"), c("source_detail"), c("source"), c("stored_toc_seq").isNotNull())
    null = lambda kind: F.lit(None).cast(kind)
    added = {
        "schema_version": T.first_filled(c("schema_version"), F.lit(VERSION)),
        "source_system": T.first_filled(c("source_system"), F.lit("gazette")),
        "source_detail": detail,
        "source_endpoint": T.first_filled(c("source_endpoint"), source_endpoint(detail)),
        "source_ids": source_ids(c("toc_id"), c("stored_toc_seq"), c("content_id"), F.coalesce(T.nz(c("viewer_path")), c("stored_field_url"))),
        "urls": urls(c("source_url"), c("url"), c("viewer_url"), c("viewer_path"), c("stored_field_url"), c("pdf_url")),
    }
    if "pdf_text" not in items.columns:
        added["pdf_text"] = F.struct(F.lit("pending").alias("status"), *[null(k).alias(n) for n, k in (("text_extractable", "boolean"), ("pages", "int"), ("text_pages", "int"), ("total_chars", "bigint"), ("pdf_text_class", "string"), ("needs_ocr", "boolean"), ("analysis_scope", "string"), ("pdf_path_text", "string"))])
    if "pdf_layout" not in items.columns:
        added["pdf_layout"] = F.struct(F.lit("pending").alias("status"), F.lit(0).alias("table_count"))
    if "graph" not in items.columns:
        added["graph"] = F.struct(F.lit("pending").alias("status"), F.array().cast("array<string>").alias("nodes"), F.array().cast("array<string>").alias("edges"))
    if "embedding" not in items.columns:
        added["embedding"] = F.struct(F.lit("pending").alias("status"), F.lit("").alias("model"), F.lit(0).alias("dimensions"))
    return items.withColumns(added)


def text_synced(pdf_text: Column, given: Column, ocr_status: Column) -> Column:
    """Struct of text_status, ocr_status, skip_reason after text metadata (struct of status, error, text_extractable) was given or not."""
    chosen = F.coalesce(given, pdf_text)
    status = F.coalesce(T.nz(chosen["status"]), F.when(T.nz(chosen["error"]).isNotNull(), "error").otherwise("ok"))
    readable = F.coalesce(chosen["text_extractable"], F.lit(False))
    return F.struct(status.alias("text_status"), F.when(readable, "skipped_text_extractable").otherwise(F.coalesce(T.nz(ocr_status), F.lit("pending"))).alias("ocr_status"), F.when(readable, "text_extractable_pdf").alias("skip_reason"))


def layout_compact(layout: Column, tables: Column) -> Column:
    """A layout struct with the number of tables for the tables."""
    return layout.withField("table_count", F.coalesce(F.size(tables), F.lit(0)))


def metadata_only(items: DataFrame) -> DataFrame:
    """Items marked as without a PDF: status metadata_only, the pdf struct skipped and filled."""
    return items.withColumns({"status": F.lit("metadata_only"), "pdf": F.col("pdf").withField("status", F.lit("skipped")).withField("path", F.coalesce("pdf.path", F.lit(""))).withField("size_bytes", F.coalesce("pdf.size_bytes", F.lit(0).cast("bigint")))})


def with_pdf(items: DataFrame, files: DataFrame) -> DataFrame:
    """Items whose PDF was found (files: id, path, size_bytes, sha256) as completed; the earlier download time stays."""
    f = files.select(F.col("id").alias("__id"), F.struct("path", "size_bytes", "sha256").alias("__f"))
    joined = items.join(f, F.col("id") == F.col("__id"), "left")
    pdf = F.struct(F.lit("completed").alias("status"), "__f.path", "__f.size_bytes", "__f.sha256", F.col("pdf.downloaded_at").alias("downloaded_at"))
    found = F.col("__f").isNotNull()
    return joined.withColumns({"pdf": F.when(found, pdf).otherwise(F.struct(*[F.col(f"pdf.{n}").alias(n) for n in ("status", "path", "size_bytes", "sha256", "downloaded_at")])), "status": F.when(found, "completed").otherwise(F.col("status"))}).drop("__id", "__f")


def upsert(old: DataFrame, new: DataFrame, key: str, merge: bool) -> DataFrame:
    """Rows of new over those of old by key; merge keeps old values where new has null, else a new row replaces the whole one."""
    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    fresh = F.col(f"n.{key}").isNotNull()

    def one(c: str) -> Column:
        if c not in new.columns:
            return F.col(f"o.{c}") if merge else F.when(~fresh, F.col(f"o.{c}"))
        if c not in old.columns:
            return F.col(f"n.{c}")
        return F.coalesce(f"n.{c}", f"o.{c}") if merge else F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    return joined.select(*[one(c).alias(c) for c in dict.fromkeys(old.columns + new.columns)])


def write_back(items: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Items with columns set from matching updates; missing columns are added, unmatched rows keep what they have."""
    u = updates.select(F.col(key).alias("__key"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = items.join(u, F.col(key) == F.col("__key"), "left")
    new = {c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c) if c in items.columns else F.lit(None)) for c in columns}
    return joined.withColumns(new).select(*items.columns, *[c for c in columns if c not in items.columns])


def download_keys(df: DataFrame) -> DataFrame:
    """toc_id and content_id by the order of their places: own columns first, then the URLs' queries."""
    c = lambda n: T.strip(have(df, n))
    links = [c(n) for n in ("viewer_path", "stored_field_url", "url")]
    toc = T.first_filled(*[c(n) for n in ("toc_id", "stored_toc_seq", "keyword_toc_seq")], *[T.query_value(u, "tocId") for u in links])
    return df.withColumns({"toc_id": toc, "content_id": T.first_filled(c("content_id"), *[T.query_value(u, "contentId") for u in links])})


def expected_path(root: str, kind: str, date: Column, registered: Column, item_id: Column) -> Column:
    """root/kind/year/yyyymmdd/id.pdf."""
    p = date_parts(date, registered)
    return F.concat_ws("/", F.lit(root), F.lit(kind), p["year"], p["date_key"], F.concat(T.safe_filename(item_id), F.lit(".pdf")))


def item_path(date: Column, item_id: Column) -> Column:
    p = date_parts(date, F.lit(None).cast("string"))
    return F.concat_ws("/", F.lit("items"), p["year"], p["date_key"], F.concat(T.safe_filename(item_id), F.lit(".json")))


def migrated_path(path: Column, old: str = "artifacts/pdfs/", new: str = "artifacts/list/pdfs/") -> Column:
    """A legacy path in its new place, else null."""
    return F.when(F.startswith(path, F.lit(old)), F.concat(F.lit(new), F.substring(path, len(old) + 1, 4096)))


def stem(path: Column) -> Column:
    return F.regexp_extract(F.trim(F.coalesce(path, F.lit(""))), r"([^/]+?)(\.[^./]*)?$", 1)


def stem_differs(path: Column, toc_id: Column) -> Column:
    return (stem(path) != "") & (F.coalesce(toc_id, F.lit("")) != "") & (stem(path) != toc_id)


def download_request(toc_id: Column, content_id: Column) -> Column:
    """Struct of endpoint and form of a PDF's request: the content's, else the issue's, else null."""
    return F.when(T.nz(toc_id).isNotNull(), F.struct(F.lit("content").alias("endpoint"), F.create_map(F.lit("cntnt_seq_no"), toc_id).alias("form"))).when(T.nz(content_id).isNotNull(), F.struct(F.lit("issue").alias("endpoint"), F.create_map(F.lit("downType"), F.lit("1"), F.lit("ofctt_seq_no"), content_id).alias("form")))


def endpoint(html: Column, toc_id: Column, content_id: Column) -> Column:
    """The download endpoint that a viewer page names: the content's if there is a toc_id, else the issue's, else an error."""
    content, issue = F.regexp_extract(html, r"(/user/common/ofcttCntntDownload\.do(;jsessionid=[^\"'?]*)?)", 1), F.regexp_extract(html, r"(/user/common/ofcttDownload\.do(;jsessionid=[^\"'?]*)?)", 1)
    return F.when((content != "") & T.nz(toc_id).isNotNull(), content).when((issue != "") & T.nz(content_id).isNotNull(), issue).otherwise("error")


def address_record(juso: Column) -> Column:
    """A struct of an address service's answer (a struct of text): fields trimmed, numbers as integers, the best address first filled."""
    s = lambda n: F.trim(F.coalesce(juso[n], F.lit("")))
    return F.struct(
        s("roadAddr").alias("road_address"), s("jibunAddr").alias("jibun_address"), s("zipNo").alias("zip_no"), s("admCd").alias("admin_code"), s("rnMgtSn").alias("road_name_code"), s("bdNm").alias("building_name"),
        s("siNm").alias("sido"), s("sggNm").alias("sigungu"), s("emdNm").alias("eupmyeondong"), s("buldMnnm").try_cast("int").alias("building_main_no"), s("buldSlno").try_cast("int").alias("building_sub_no"),
        s("lnbrMnnm").try_cast("int").alias("lot_main_no"), s("lnbrSlno").try_cast("int").alias("lot_sub_no"), s("udrtYn").alias("underground"), s("hstryYn").alias("history"), T.first_filled(s("roadAddr"), s("roadAddrPart1"), s("jibunAddr")).alias("canonical_address"),
    )


COORDINATE_KEYS = {"admCd": "admin_code", "rnMgtSn": "road_name_code", "udrtYn": "underground", "buldMnnm": "building_main_no", "buldSlno": "building_sub_no"}


def coordinate_request(record: Column) -> Column:
    """Struct of the five identifiers that a coordinate request needs and the names of those missing."""
    texts = {k: F.coalesce(record[v].cast("string"), F.lit("")) for k, v in COORDINATE_KEYS.items()}
    missing = F.array_compact(F.array(*[F.when(c == "", F.lit(k)) for k, c in texts.items()]))
    return F.struct(*[c.alias(k) for k, c in texts.items()], missing.alias("missing"))


ANSWER = "results struct<common struct<errorCode string, errorMessage string, totalCount string, currentPage string, countPerPage string>, juso array<struct<roadAddr string, roadAddrPart1 string, jibunAddr string, zipNo string, admCd string, rnMgtSn string, bdNm string, siNm string, sggNm string, emdNm string, buldMnnm string, buldSlno string, lnbrMnnm string, lnbrSlno string, udrtYn string, hstryYn string>>>"


def address_answer(payload: Column) -> Column:
    """Struct of an address service's answer: ok, error, counts with defaults, the first record, whether it is historic, all records."""
    none = F.from_json(F.lit("[]"), ANSWER.split("juso ", 1)[1][:-1])

    def answer(a: Column, records: Column) -> Column:
        number = lambda n, d: F.coalesce(a["common"][n].try_cast("int"), F.lit(d))
        first = F.get(records, F.lit(0))
        return F.struct((a["common"]["errorCode"] == "0").alias("ok"), a["common"]["errorMessage"].alias("error"), number("totalCount", 0).alias("total"), number("currentPage", 1).alias("page"), number("countPerPage", 10).alias("per_page"), first.alias("first"), F.coalesce(first["history"] == "1", F.lit(False)).alias("historic"), records.alias("records"))

    # the text is parsed and the records made once, however many fields are asked for
    return once(F.from_json(payload, ANSWER)["results"], lambda a: once(F.transform(F.coalesce(a["juso"], none), address_record), lambda r: answer(a, r)))


def place_record(c: Column) -> Column:
    """An offline place candidate (struct with admin_code, name, parent_chain) as an address record's places."""
    chain = F.coalesce(c["parent_chain"], F.array().cast("array<string>"))
    return F.struct(admin_code(c["admin_code"]).alias("admin_code"), F.get(chain, F.lit(0)).alias("sido"), F.coalesce(F.get(chain, F.lit(1)), c["parent_name"]).alias("sigungu"), F.get(chain, F.size(chain) - 1).alias("eupmyeondong"), c["name"].alias("name"))


def identity(*cs: Column) -> Column:
    """A key of several fields, null as empty."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cs])


def best_of(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """The first row of each key in an order; by window, so nothing is collected."""
    w = Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
