"""Language ID with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds, at each slot, a mask with a bit for each
language; the AND of an n-gram's slots gives all languages that contain it. A
document's bits are counted by language, corrected for the filter's false
positives (known from each slice's fill), and the greatest share decides.

N-grams are N bytes of folded text: lower case, runs of all but letters one
space, a space before and after the text. The filter is fitted on TRAIN_ROWS
labelled rows and TRAIN_BYTES of text at most, those least by a hash of doc_id;
it holds all n-grams of these rows, and has SLOTS slots for each.
Identification reads the whole text of all documents.

Defined cases: a text that is null, without letters, or too short for an n-gram
has 0 n-grams, share null and language "und", as has one whose best share is under MIN_SHARE; ties
go to the language that is first in alphabetical order; without any labelled
row all are "und"; repeated rows are each identified; a column that is named
like a result (predicted) does not clash, results are selected by name; extra
columns pass through identify_filter.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm import kernel as K
from inkspan.llm.shared import small_batches

N, SLOTS, HASHES, MIN_SHARE = 4, 16, 2, 0.2
#: The bounded sample that the filter is fitted on.
TRAIN_ROWS, TRAIN_BYTES = 4000, 16 << 20
U = np.uint64


class Grams:
    """N-byte grams of folded text, as numbers, with the offset of each document's first."""

    def __init__(self) -> None:
        self.fold = K.fold_table()
        self.fold[48:58] = 0
        self.fold[self.fold == 0] = 32

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        docs = offs.size - 1
        # a space before and after each document
        x = np.full(buf.size + 2 * docs, 32, np.uint8)
        lead = offs[:-1] + 2 * np.arange(docs)
        text = np.ones(x.size, bool)
        text[lead] = text[offs[1:] + 2 * np.arange(docs) + 1] = False
        x[text] = K.folded(buf, self.fold)
        space = x == 32
        keep = np.ones(x.size, bool)
        keep[1:] = ~(space[1:] & space[:-1])
        keep[lead] = True
        y = x[keep]
        at = np.append(np.cumsum(keep)[lead] - 1, y.size)
        size = np.maximum(np.diff(at) - N + 1, 0)
        out_at = np.zeros(docs + 1, np.int64)
        np.cumsum(size, out=out_at[1:])
        if y.size < N:
            return np.zeros(0, np.uint32), out_at
        code = y[: y.size - N + 1].astype(np.uint32)
        for i in range(1, N):
            code = (code << np.uint32(8)) | y[i : y.size - N + 1 + i]
        own = np.zeros(code.size + 1, np.int32)
        some = size > 0
        np.add.at(own, at[:-1][some], 1)
        np.add.at(own, at[:-1][some] + size[some], -1)
        return code[np.cumsum(own[:-1]) > 0], out_at


def slots(code: np.ndarray, bits: int) -> list[np.ndarray]:
    h = K.mix(code.astype(np.uint64) + U(0x9E3779B97F4A7C15))
    return [((h >> U(32 * i)) & U((1 << bits) - 1)).astype(np.int64) for i in range(HASHES)]


def fit(rows: list[tuple[str, str]]) -> dict:
    """The filter from (language, text), with all their n-grams: languages, masks (words of languages by slots) and false-positive rates. Slots are SLOTS for each n-gram of the language that has most."""
    grams = Grams()
    languages = sorted({x for x, _ in rows})
    own = []
    for language in languages:
        raw = [(t or "").encode() for x, t in rows if x == language]
        own.append(np.unique(grams(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64))[0]))
    bits = min(32, max(10, int(np.ceil(np.log2(max([1, *(x.size for x in own)]) * SLOTS)))))
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= 8 * t().itemsize or t is np.uint64)
    masks = np.zeros((max(1, -(-len(languages) // 64)), 1 << bits), kind)
    rate = np.zeros(len(languages))
    for i, chosen in enumerate(own):
        for s in slots(chosen, bits):
            masks[i // 64, s] |= kind(1) << kind(i % 64)
        rate[i] = np.mean((masks[i // 64] >> kind(i % 64)) & kind(1)) ** HASHES
    return {"languages": languages, "masks": masks, "rate": rate, "bits": bits}


def training_rows(docs: DataFrame, most: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> list[tuple[str, str]]:
    """(lang, text) of the labelled documents that are least by hash of doc_id, as many as stay within most rows and, whole, within most_bytes: ids are chosen first, so no text is shuffled."""
    spark = docs.sparkSession
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("doc_id is not null and lang is not null and lang <> '' and text is not null")
    sizes = labelled.select("doc_id", F.octet_length("text").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id", "n").limit(most).collect()
    left, chosen = most_bytes, []
    for r in sizes:
        left -= r["n"]
        if left >= 0:
            chosen.append((r["doc_id"],))
    picked = labelled.join(F.broadcast(spark.createDataFrame(chosen, "doc_id long").distinct()), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(F.octet_length("text").alias("n"), "lang", "text")).alias("r"))
    return [(r["lang"], r["text"]) for r in picked.select("r.lang", "r.text").orderBy("lang", "text").collect()]


def counts(grams: Grams, model: dict, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams of each document, how many the filter gives to each language: documents by languages)."""
    code, at = grams(buf, offs)
    n = np.diff(at)
    out = np.zeros((n.size, len(model["languages"])), np.int64)
    some = np.flatnonzero(n)
    if some.size:
        places = slots(code, model["bits"])
        for w, mask in enumerate(model["masks"]):
            hit = mask[places[0]]
            for p in places[1:]:
                hit = hit & mask[p]
            for i in range(w * 64, min(len(model["languages"]), w * 64 + 64)):
                bit = ((hit >> hit.dtype.type(i % 64)) & hit.dtype.type(1)).astype(np.int32)
                out[some, i] = np.add.reduceat(bit, at[some])
    return n, out


def decide(model: dict, n: np.ndarray, found: np.ndarray, min_share: float) -> tuple[list[str], np.ndarray]:
    """(language, corrected share of the best; NaN without n-grams) of each document."""
    if not model["languages"]:
        return ["und"] * n.size, np.full(n.size, np.nan)
    raw = found / np.maximum(n, 1)[:, None]
    share = np.clip((raw - model["rate"]) / (1 - np.minimum(model["rate"], 0.999)), 0, 1)
    best = share.argmax(axis=1)
    top = np.where(n > 0, share[np.arange(n.size), best], np.nan)
    return [model["languages"][b] if t >= min_share else "und" for b, t in zip(best, top)], top


def _predict(model, min_share: float):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grams, m = Grams(), model.value
        for col in batches:
            names, shares, sizes = [], [np.zeros(0)], [np.zeros(0, np.int64)]
            for _, _, buf, offs in K.chunks(col):
                n, found = counts(grams, m, buf, offs)
                name, share = decide(m, n, found, min_share)
                names += name
                shares.append(share)
                sizes.append(n)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate(shares), from_pandas=True), pa.array(np.concatenate(sizes))], ["predicted", "share", "n_grams"])

    return F.arrow_udf(run, "predicted string, share double, n_grams long")


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS, min_share: float = MIN_SHARE) -> DataFrame:
    """doc_id, predicted, share, n_grams of every row: one pass after the fit, no shuffle."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(training_rows(docs, train_rows)))
    p = _predict(model, min_share)(F.col("text").cast("string"))
    return docs.select("doc_id", p.alias("p")).select("doc_id", "p.predicted", "p.share", "p.n_grams")


def identify_filter(docs: DataFrame, train_rows: int = TRAIN_ROWS, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of docs, with all their columns, whose language can be told."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(training_rows(docs, train_rows)))
    return docs.where(_predict(model, min_share)(F.col("text").cast("string"))["predicted"] != "und")
