"""PDF files: inventory, completeness, digests and text readers as a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from inkspan.session import small_batches
from inkspan.sources import pdf

#: Bytes of files whose pages a worker holds before it hands them on.
HELD_BYTES = 1 << 20
HEAD, TAIL, TAIL_BYTES, LEAST_BYTES = b"%PDF-", b"%%EOF", 4096, 100


def pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, modified, content) of every PDF below a folder. Columns that a query leaves out are not read, and Spark lists no file of 0 bytes."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").load(folder)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")


def has_head(content: Column) -> Column:
    """The weak check: a PDF's first bytes."""
    return F.coalesce(F.startswith(content, F.lit(HEAD)), F.lit(False))


def complete(content: Column) -> Column:
    """A PDF's first bytes, and its end mark among the last TAIL_BYTES."""
    n = F.octet_length(content)
    tail = F.substring(content, F.greatest(F.lit(1), n - TAIL_BYTES + 1), F.lit(TAIL_BYTES))
    return F.coalesce((n > 0) & F.startswith(content, F.lit(HEAD)) & F.contains(tail, F.lit(TAIL)), F.lit(False))


def inside(path: Column, root: str) -> Column:
    """Whether a path lies below a root, without steps upward."""
    plain = F.regexp_replace(path, "^file:/*", "/")
    return F.startswith(plain, F.lit(root.rstrip("/") + "/")) & ~F.contains(plain, F.lit("/../"))


def checks(files: DataFrame) -> DataFrame:
    """Each check of a file (path, size, content) and all of them together."""
    head, tail = has_head(F.col("content")), complete(F.col("content"))
    out = files.withColumns({"not_empty": F.col("size") > 0, "header": head, "structure": F.col("size") > LEAST_BYTES, "complete": tail, "digest": F.sha2("content", 256), "md5": F.md5("content")})
    return out.withColumn("ok", F.col("not_empty") & F.col("header") & F.col("structure") & F.col("complete"))


def body_summary(content: Column) -> Column:
    """What a diagnosis says of a response's body."""
    return F.struct(F.octet_length(content).alias("bytes"), F.sha2(content, 256).alias("sha256"), has_head(content).alias("starts_pdf"), complete(content).alias("pdf_complete"), F.hex(F.substring(content, 1, 16)).alias("head"))


def _text(content: bytes) -> list[str]:
    return [p.text() for p in pdf.pages(content)]


Reader = Callable[[bytes], list[str]]
READERS: dict[str, Reader] = {"streams": _text}


def read_pages(files: DataFrame, method: str = "streams", readers: dict[str, Reader] | None = None) -> DataFrame:
    """(path, method, status, error, page, text) of each page that a reader finds; a file that fails, or a reader that isn't there, gives one error row."""
    reader, columns = (readers or READERS).get(method), ["path", "method", "status", "error", "page", "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, held = [], 0
            for path, content in zip(b["path"], b["content"]):
                try:
                    if reader is None:
                        raise LookupError(f"no reader named {method}")
                    pages = reader(bytes(content))
                    rows += [(path, method, "ok", None, i, t) for i, t in enumerate(pages, 1)] or [(path, method, "ok", None, 0, "")]
                except Exception as e:  # a file's fault is its row's status
                    rows.append((path, method, "error", f"{type(e).__name__}: {e}", 0, ""))
                held += len(content or b"")
                if held >= HELD_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns)

    small_batches(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, "path string, method string, status string, error string, page int, text string")


def text_metadata(pages: DataFrame, sample: int = 500) -> DataFrame:
    """Pages of read_pages() as text metadata of each file and method."""
    from inkspan.functions.text import mojibake, squash

    t = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n")
    g = pages.groupBy("path", "method").agg(F.max("status").alias("status"), F.first("error", True).alias("error"), F.max("page").alias("pages"), F.count_if(F.trim("text") != "").alias("text_pages"), F.sum(F.length(squash(F.col("text")))).alias("total_chars"), t.alias("__t"))
    return g.withColumns({"text_extractable": F.col("total_chars") > 0, "avg_chars": F.round(F.coalesce(F.try_divide("total_chars", "pages"), F.lit(0.0)), 2), "quality": mojibake(F.col("__t"))["status"], "sample_text": F.left(squash(F.col("__t")), F.lit(sample))}).drop("__t")


LAYOUT = "path string, status string, error string, page int, words array<struct<x:double,y:double,size:double,text:string>>, tables array<struct<bbox:array<double>,rows:array<array<string>>>>, images int"


def read_layout(files: DataFrame) -> DataFrame:
    """(path, status, error, page, words, tables, images) of each page: words with their places, ruled tables with their cells' texts. A file that can't be read gives one error row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    for i, p in enumerate(pdf.pages(bytes(content)), 1):
                        rows.append((path, "ok", None, i, [dict(zip(("x", "y", "size", "text"), w)) for w in p.words], p.tables(), p.images))
                except Exception as e:  # a file's fault is its row's status
                    rows.append((path, "error", f"{type(e).__name__}: {e}", 0, [], [], 0))
            yield pd.DataFrame(rows, columns=["path", "status", "error", "page", "words", "tables", "images"])

    small_batches(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, LAYOUT)


@F.pandas_udf(StructType([StructField("fonts", ArrayType(StringType())), StructField("images", IntegerType())]))
def _origin(contents: pd.Series) -> pd.DataFrame:
    out = []
    for c in contents:
        try:
            out.append(([], 0) if c is None else pdf.Document(bytes(c)).origin())
        except Exception:  # what can't be read shows no evidence
            out.append(([], 0))
    return pd.DataFrame(out, columns=["fonts", "images"])


def digital_origin(content: Column) -> Column:
    """Struct of fonts, images and evidence: what a file's objects, those in object streams too, say of how it was made."""
    return F.transform(F.array(_origin(content)), lambda o: F.struct(o["fonts"].alias("fonts"), o["images"].alias("images"), (F.size(o["fonts"]) > 0).alias("has_digital_evidence"), (o["images"] > 0).alias("has_images")))[0]
