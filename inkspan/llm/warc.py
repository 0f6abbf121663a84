"""WARC archives with revisit resolution.

Only headers (record key, URI, digests) are shuffled: the least response of each
payload digest is the original, and every other record of that digest, response
or revisit, is joined to it. Payloads stay where they are read, as long as the
decisions fit BROADCAST_BYTES; beyond that they are shuffled once, by key. The
archives that are written hold each payload once; the other records become
revisits, with fresh headers that refer to the original.

Each write goes to a folder of its own within the given one, so it neither
touches earlier archives nor what it reads. Tasks write the archives; the
manifest, which is written by Spark's commit protocol, names the files that
count, and what lost or repeated attempts have left in that folder is deleted.

A payload is what follows the HTTP head, or the whole block of a response that
is not HTTP, as it is stored (transfer codings are not undone). Its SHA-256 is
computed, whatever digest the header declares. A revisit is resolved by the
digest that it declares: sha256 in hexadecimal, or sha1 in base 32, which is
computed of every response that is read for that end.

Defined cases: a null URL counts as empty, a null payload of a response as empty;
rows equal in page_id, url and payload are one record, as are records equal in
id, URI, date and payload; of equal payloads the least page_id is the original (null last,
then by URL); a revisit whose payload is nowhere in the input, or that declares
no digest or one of another kind, keeps its own headers; the HTTP head, the date and all
further headers of a record are kept; records of other types, and segments of a
response, are passed on as they are; line breaks in a URL are percent-encoded;
header bytes that are not UTF-8 are read as Latin-1; a record
without Content-Length ends where the next one begins; an archive may be plain or
gzip, in one member or many; one that is cut short or damaged ends the
job with its name, or, with strict=False, is read as far as it goes; extra columns
are ignored; an empty table gives no archive and an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm.shared import BROADCAST_BYTES, forget, fresh_path, small_batches, written

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3
MANIFEST = "page_id long, warc_type string, target_uri string, payload_digest string, record_id string, refers_to string, content_length long, archive string, offset long, size long"
#: kind: response, revisit or other. head: the HTTP head, of other records the WARC head. refers: a revisit's own reference; extra: further header lines; declared: a digest as the header has it.
RECORD = "page_id long, uri string, digest string, sha1 string, declared string, key string, record_id string, date string, kind string, refers string, extra string, head binary, payload binary"
#: Headers that are written anew.
FRESH = {"warc-type", "warc-record-id", "warc-date", "warc-target-uri", "warc-payload-digest", "warc-block-digest", "warc-source-page", "content-length"}
REFERENCE = {"warc-profile", "warc-refers-to", "warc-refers-to-target-uri", "warc-refers-to-date"}


def clean_uri(url: F.Column) -> F.Column:
    return F.replace(F.replace(F.coalesce(url.cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, date: str = DATE) -> DataFrame:
    """The columns of RECORD of each page, as responses."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), clean_uri(F.col("url")).alias("uri"), F.sha2(payload, 256).alias("digest"), payload.cast("binary").alias("payload"))
    key = F.md5(F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("|"), F.col("uri"), F.lit("|"), F.col("digest")))
    parts = [F.substring(key, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    none = lambda kind: F.lit(None).cast(kind)
    more = {"key": key, "record_id": F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")), "date": F.lit(date), "kind": F.lit("response"), "head": none("binary")} | {c: none("string") for c in ("sha1", "declared", "refers", "extra")}
    return out.withColumns(more).select(*[c.split()[0] for c in RECORD.split(", ")])


def resolve(found: DataFrame) -> DataFrame:
    """(__key, original, original_uri, original_date, repeats) of each response or revisit that isn't the original of its payload, or that is repeated; original is the record's id."""
    names = ["key", "page_id", "uri", "digest", "sha1", "record_id", "date", "kind"]
    headers = found.where("kind <> 'other'").groupBy(*names).agg(F.count(F.lit(1)).alias("repeats"))
    lost = "kind = 'revisit' and digest is null and sha1 is not null"
    of_sha1 = headers.where("kind = 'response' and sha1 is not null").groupBy("sha1").agg(F.min("digest").alias("digest"))
    headers = headers.where(f"not coalesce({lost}, false)").unionByName(headers.where(lost).drop("digest").join(of_sha1, "sha1", "left"))
    order = F.struct(F.col("page_id").isNull(), "page_id", "uri", "key")
    originals = headers.where("kind = 'response'").groupBy("digest").agg(F.min(order).alias("o"), F.min_by(F.struct("record_id", "date"), order).alias("r")).select("digest", F.col("o.key").alias("__first"), F.col("r.record_id").alias("original"), F.col("o.uri").alias("original_uri"), F.col("r.date").alias("original_date"))
    joined = headers.join(originals, "digest", "left")
    return joined.where("(__first is not null and key <> __first) or repeats > 1").select(F.col("key").alias("__key"), F.col("digest").alias("__digest"), *[F.when(F.col("key") != F.col("__first"), F.col(c)).alias(c) for c in ("original", "original_uri", "original_date")], "repeats")


def _planned(found: DataFrame) -> tuple[DataFrame, str]:
    plan = written(resolve(found), "warc-plan")
    small = plan.count() * 300 <= BROADCAST_BYTES
    joined = found.join(F.broadcast(plan) if small else plan, F.col("key") == F.col("__key"), "left")
    revisit = (F.col("kind") == "revisit") | F.col("original").isNotNull()
    out = joined.withColumns({"digest": F.coalesce("digest", "__digest"), "kind": F.when(revisit, "revisit").otherwise(F.col("kind")), "payload": F.when(~revisit, F.col("payload")), "repeats": F.coalesce("repeats", F.lit(1))}).drop("__key", "__digest")
    if not plan.where("repeats > 1").isEmpty():
        out = out.where("repeats = 1").unionByName(out.where("repeats > 1").dropDuplicates(["key"]))
    return out.drop("repeats"), plan._inkspan_path


def deduplicated(found: DataFrame) -> DataFrame:
    """The records to write: the columns of RECORD, payload null in revisits, with original, original_uri, original_date of resolved revisits."""
    return _planned(found)[0]


def head_of(fields: list[tuple[str, str]], extra: str) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + extra + "\r\n").encode()


def http_head(length: int | None) -> bytes:
    return ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + (f"Content-Length: {length}\r\n" if length is not None else "") + "\r\n").encode()


def record_of(r: dict) -> tuple[bytes, int, str | None, str | None]:
    """(the record's bytes, Content-Length, digest, what it refers to) of a row of deduplicated()."""
    payload = r["payload"] or b""
    if r["kind"] == "other":
        return r["head"] + payload + b"\r\n\r\n", len(payload), r["declared"], None
    revisit, digest = r["kind"] == "revisit", f"sha256:{r['digest']}" if r["digest"] else r["declared"]
    block = (r["head"] if r["head"] is not None else http_head(None if revisit else len(payload))) + payload
    fields = [("WARC-Type", r["kind"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["date"]), ("WARC-Target-URI", r["uri"]), ("WARC-Payload-Digest", digest)]
    if r["page_id"] is not None:
        fields.append(("WARC-Source-Page", str(r["page_id"])))
    extra, refers = r["extra"] or "", r["original"]
    if revisit and refers:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers), ("WARC-Refers-To-Target-URI", r["original_uri"]), ("WARC-Refers-To-Date", r["original_date"])]
    elif revisit:
        extra += r["refers"] or f"WARC-Profile: {PROFILE}\r\n"
    if "\r\ncontent-type:" not in "\r\n" + extra.lower():
        fields.append(("Content-Type", "application/http; msgtype=response"))
    fields.append(("Content-Length", str(len(block))))
    return head_of(fields, extra) + block + b"\r\n\r\n", len(block), digest, refers


def write_archives(found: DataFrame, folder: str) -> DataFrame:
    """Writes found (RECORD), deduplicated, below a folder: one archive a task, a gzip member a record; the manifest of what was written, archive: its path within the folder."""
    spark = found.sparkSession
    small_batches(spark)
    run = f"run-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, offset = TaskContext.get(), None, 0
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if out is None:
                    system, base = fs.FileSystem.from_uri(f"{folder}/{run}")
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                record, length, digest, refers = record_of(r)
                packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = packer.compress(record) + packer.flush()
                out.write(member)
                rows.append({"page_id": r["page_id"], "warc_type": r["declared_type"] if r["kind"] == "other" else r["kind"], "target_uri": r["uri"], "payload_digest": digest, "record_id": r["record_id"], "refers_to": refers, "content_length": length, "archive": f"{run}/{name}", "offset": offset, "size": len(member)})
                offset += len(member)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if out is not None:
            out.close()

    schema = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in (c.split() for c in MANIFEST.split(", "))])
    rows, plan = _planned(found)
    # the type of other records is kept in refers, which they don't use
    manifest = written(rows.withColumn("declared_type", F.col("refers")).mapInArrow(write, MANIFEST), "warc-manifest")
    counted = {r[0].partition("/")[2] for r in manifest.select("archive").distinct().toLocalIterator()}
    system, base = fs.FileSystem.from_uri(f"{folder}/{run}")
    for f in system.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        if f.base_name not in counted:
            system.delete_file(f.path)
    forget(spark, plan)
    return manifest


def inflated(stream) -> Iterator[bytes]:
    """The bytes of an archive, plain or of gzip members, piece by piece."""
    held = stream.read(1 << 16)
    if held[:2] != b"\x1f\x8b":
        while held:
            yield held
            held = stream.read(1 << 16)
        return
    member, inside = zlib.decompressobj(31), False
    while held:
        yield member.decompress(held)
        held, inside = member.unused_data, not member.eof
        if member.eof:
            member = zlib.decompressobj(31)
            held = held.lstrip(b"\0")  # padding between members
        held = held or stream.read(1 << 16)
    if inside:
        raise ValueError("the last gzip member is cut short")


def parse(pieces: Iterator[bytes]) -> Iterator[dict]:
    """The records of an archive: head (bytes), lines (name and value of each header), fields (the same by name, in lower case), block."""
    text, ended = bytearray(), False
    while not ended:
        piece = next(pieces, None)
        ended = piece is None
        text += piece or b""
        while True:
            while text[:2] == b"\r\n":
                del text[:2]
            end = text.find(b"\r\n\r\n")
            if end < 0:
                break
            head = bytes(text[: end + 4])
            try:
                said = head.decode()
            except UnicodeDecodeError:
                said = head.decode("latin-1")
            lines = [tuple(y.strip() for y in x.split(":", 1)) for x in re.sub(r"\r\n[ \t]+", " ", said).split("\r\n")[1:] if ":" in x]
            fields = {k.lower(): v for k, v in lines}
            size = fields.get("content-length", "")
            if size.isdigit():
                stop = end + 4 + int(size)
                if len(text) < stop:
                    break
            else:
                stop = text.find(b"\r\n\r\nWARC/", end)
                if stop < 0 and not ended:
                    break
                stop = max(stop, end + 4) if stop >= 0 else len(text.rstrip(b"\r\n")) if len(text) > end + 4 else end + 4
            yield {"head": head, "lines": lines, "fields": fields, "block": bytes(text[end + 4 : stop])}
            del text[:stop]
    if text.strip(b"\r\n"):
        raise ValueError("the last record is cut short")


def row_of(r: dict) -> dict:
    """A parsed record as a row of RECORD."""
    f, block = r["fields"], r["block"]
    declared, record_id, uri, page = f.get("warc-payload-digest"), f.get("warc-record-id", ""), f.get("warc-target-uri", ""), f.get("warc-source-page", "")
    out = {"page_id": int(page) if re.fullmatch(r"-?\d{1,18}", page) else None, "uri": uri, "digest": None, "sha1": None, "declared": declared, "record_id": record_id, "date": f.get("warc-date"), "refers": None, "extra": None}
    kind = f.get("warc-type", "").lower()
    if kind not in ("response", "revisit") or "warc-segment-number" in f:
        out |= {"kind": "other", "refers": kind, "head": r["head"], "payload": block}
        digest = hashlib.sha256(r["head"] + block).hexdigest()
    else:
        head, blank, body = block.partition(b"\r\n\r\n")
        http = block.startswith(b"HTTP/") and blank
        out |= {"kind": kind, "head": head + blank if http else b"" if kind == "response" else block, "payload": (body if http else block) if kind == "response" else None}
        algorithm, _, value = (declared or "").partition(":")
        if kind == "response":
            out["sha1"] = base64.b32encode(hashlib.sha1(out["payload"]).digest()).decode()
            out["digest"] = hashlib.sha256(out["payload"]).hexdigest()
        elif algorithm.lower() == "sha256" and re.fullmatch("[0-9a-fA-F]{64}", value):
            out["digest"] = value.lower()
        elif algorithm.lower() == "sha1":
            out["sha1"] = value.upper()
        kept = lambda names, other: "".join(f"{k}: {v}\r\n" for k, v in r["lines"] if (k.lower() in names) is not other)
        out["extra"] = kept(FRESH | REFERENCE, True)
        out["refers"] = kept(REFERENCE, False) if kind == "revisit" else None
        digest = out["digest"] or declared or ""
    out["key"] = hashlib.md5("|".join((record_id, uri, out["date"] or "", out["kind"], page, digest)).encode()).hexdigest()
    return out


def read_archives(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    """The columns of RECORD of each record in the archives (.warc, .warc.gz) below a folder: what write_archives takes."""
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in RECORD.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                system, at = fs.FileSystem.from_uri(path)
                rows, size = [], 0
                with system.open_input_stream(at, compression=None) as stream:
                    try:
                        for r in parse(inflated(stream)):
                            rows.append(row_of(r))
                            size += len(r["block"])
                            if size > 8 << 20:
                                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                                rows, size = [], 0
                    except (ValueError, zlib.error) as e:
                        if strict:
                            raise ValueError(f"{path}: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc,warc.gz}").option("recursiveFileLookup", True).load(folder).select("path")
    return paths.mapInArrow(read, RECORD)


def archive_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "warc")
