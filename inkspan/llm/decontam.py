"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

Texts are compared as sequences of folded words (case and punctuation do not
count). A document is contaminated by an item of n words if some window of it,
of n - e to n + e words, is within e = floor(MAX_EDITS * n) word edits of it.

1. Screen, without loss: each edit spoils at most two word pairs of the item,
   so a true window holds at least n - 1 - 2e pairs of it, each
   within e places of where it is in the item. Only starts of such windows go on. (Items of one word are looked up directly.)
2. The CGK random walk (Chakraborty, Goldenberg, Koucky 2016) embeds the window
   of n words and each item of n words, whole, in 2n steps; edit distance
   becomes Hamming distance. Repetitions draw new walks and sample coordinates;
   equal samples make a candidate. Their number comes from simulated pairs at
   exactly e edits, spread or crowded at either end or the middle, and runs of
   insertions and deletions, and gives TARGET_RECALL for each of these kinds.
   Where MAX_REPETITIONS don't reach it, all items of the length are candidates.
3. Candidates are verified by exact edit distance.

The benchmark is handled in slices whose index stays within SLICE_BYTES; each
slice costs one scan. Defined cases: null or wordless texts and items match
nothing; an item that occurs several times is reported under each item_id, a
null one as null; rows
with equal doc_id count as one document; null doc_id rows are reported under
null, and removed by decontaminate if they match; an empty benchmark removes
nothing; extra columns pass through.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm import kernel as K
from inkspan.llm.shared import small_batches

MAX_EDITS = 0.2
TARGET_RECALL = 0.98
SLICE_BYTES = 64 << 20
#: Repetitions at most; a length that needs more is verified exhaustively.
MAX_REPETITIONS = 384
#: Kinds of edits that repetitions are tuned on: where (shares of the item between which all lie), and of which kind (0 substitution, 1 insertion, 2 deletion, None any).
KINDS = ((0, 1, None), (0, 0.4, None), (0.3, 0.7, None), (0.6, 1, None), (0, 0.2, 1), (0, 0, 1), (0, 0.2, 2), (0.5, 0.5, 1))
#: Stands for a null item_id within an index.
NO_ID = -(1 << 63)
U = np.uint64
STEP = U(0x9E3779B97F4A7C15)


def edits_allowed(n: int, share: float = MAX_EDITS) -> int:
    if not 0 <= share <= 0.25:
        raise ValueError("the screen needs a share of 0.25 at most")
    return int(np.floor(share * n + 1e-9))


def walk(words: np.ndarray, seed: int, steps: int) -> np.ndarray:
    """Where the CGK walk of each row of word hashes stands at each step: steps by rows. It does not depend on where the row ends, so windows of every length share it."""
    rows, wide = words.shape
    flat, line = np.ascontiguousarray(words).reshape(-1), np.arange(rows) * wide
    out = np.empty((steps, rows), np.int64)
    salt = K.mix(np.arange(1, steps + 1, dtype=np.uint64) * STEP + K.mix(np.full(1, seed, np.uint64)))
    at, last, coin = line.copy(), line + wide - 1, np.empty(rows, np.uint64)
    for j in range(steps):
        out[j] = at
        np.take(flat, at, out=coin, mode="clip")
        coin ^= salt[j]
        coin *= K.M1
        coin >>= U(63)
        at += coin.view(np.int64)
        np.minimum(at, last, out=at)
    out -= line
    return out


def key_of(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A key of the symbols at the sampled steps (at: samples by rows) of the embedding of each row's first n words; 0 stands for the end."""
    line, k = np.arange(len(words)), np.zeros(len(words), np.uint64)
    for c, p in enumerate(at):
        k = K.mix(k * STEP + np.where(p < n, words[line, p], U(0)) + U(c + 1))
    return k


def coordinates(n: int, seed: int, sampled: int) -> np.ndarray:
    """Distinct coordinates to sample, among the 2n of the embedding."""
    most = 2 * n
    return np.sort(np.random.default_rng([seed, n]).choice(most, min(sampled, most), replace=False))


def spoiled(words: np.ndarray, edits: int, rng: np.random.Generator, lo: float = 0, hi: float = 1, only: int | None = None) -> np.ndarray:
    """A copy after so many random edits between two shares of its length, of one kind or any, cut or padded to its length."""
    out, n = list(words), len(words)
    for _ in range(edits):
        kind = int(rng.integers(3)) if only is None else only
        p = min(int(lo * n) + int(rng.integers(max(1, int((hi - lo) * n)))), max(0, len(out) - 1))
        new = U(rng.integers(1, 1 << 62))
        if kind == 0 and out:
            out[p] = new
        elif kind == 1:
            out.insert(p, new)
        elif out:
            del out[p]
    out = (out + [U(rng.integers(1, 1 << 62)) for _ in range(n)])[:n]
    return np.array(out, np.uint64)


def ended(words: np.ndarray) -> np.ndarray:
    """With a column for the end, where walks stay: as in a longer window, they must not stay at the last word."""
    return np.pad(words, ((0, 0), (0, 1)))


@lru_cache(1024)
def repetitions(n: int, edits: int, sampled: int, target: float, most: int = MAX_REPETITIONS, pairs: int = 100) -> int | None:
    """Least number of repetitions, as they are drawn, that finds the target share of simulated pairs of every kind at so many edits; None where most don't."""
    if not edits:
        return 1
    rng = np.random.default_rng([n, edits, sampled])
    a = rng.integers(1, 1 << 62, (pairs * len(KINDS), n), dtype=np.uint64)
    b = np.stack([spoiled(x, edits, rng, *KINDS[i // pairs]) for i, x in enumerate(a)])
    a, b, kind = ended(a), ended(b), np.arange(len(a)) // pairs
    for s in range(most):
        c = coordinates(n, s, sampled)
        missed = key_of(a, walk(a, s, 2 * n)[c], n) != key_of(b, walk(b, s, 2 * n)[c], n)
        a, b, kind = a[missed], b[missed], kind[missed]
        if np.bincount(kind, minlength=1).max() <= (1 - target) * pairs:
            return s + 1
    return None


_TUNED: dict[tuple[int, int, int, float], int | None] = {}


def tune(spark: SparkSession, wanted: list[tuple[int, int, int]], target: float) -> None:
    """Finds repetitions() of each (n, edits, sampled), a task each, once a session."""
    new = sorted({x for x in wanted if (*x, target) not in _TUNED})
    if not new:
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [tuple(r.values()) for r in b.to_pylist()]
            yield pa.record_batch([*b.columns, pa.array([repetitions(*r, target) for r in rows], pa.int32())], names=["n", "edits", "sampled", "repetitions"])

    rows = spark.createDataFrame(new, "n int, edits int, sampled int").repartition(len(new)).mapInArrow(run, "n int, edits int, sampled int, repetitions int").collect()
    _TUNED.update({(r["n"], r["edits"], r["sampled"], target): r["repetitions"] for r in rows})


def samples(items: int) -> int:
    """Coordinates to sample where so many items share a length."""
    return max(2, int(np.ceil(np.log2(items + 1) / 4)))


def build_index(items: list[tuple[int, str]], share: float = MAX_EDITS, target: float = TARGET_RECALL, spark: SparkSession | None = None) -> dict:
    """What workers need to find these (item_id, text): by length the words, edits, walks and sampled keys; and the pair table."""
    words = K.Words()
    by_n: dict[int, list[tuple[int, np.ndarray]]] = {}
    for item_id, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        h = words(raw, np.array([0, raw.size]))[0]
        if h.size:
            by_n.setdefault(h.size, []).append((item_id, h))
    pairs = np.concatenate([pair_hashes(h) for n, of in by_n.items() if n > 1 for _, h in of] or [np.zeros(0, np.uint64)])
    bits = max(16, int(np.ceil(np.log2(max(1, pairs.size) * 128))))
    table = np.zeros(1 << min(bits, 27), bool)
    table[(pairs >> U(64 - min(bits, 27))).astype(np.int64)] = True
    if spark:
        tune(spark, [(n, edits_allowed(n, share), samples(len(of))) for n, of in by_n.items() if edits_allowed(n, share)], target)
    lengths = []
    for n in sorted(by_n):
        ids = np.array([i for i, _ in by_n[n]], np.int64)
        texts = np.stack([h for _, h in by_n[n]])
        e = edits_allowed(n, share)
        sampled = samples(len(ids))
        walks, padded = [], ended(texts)
        known = (n, e, sampled, target)
        reps = _TUNED[known] if known in _TUNED else repetitions(*known)
        for s in range(reps or 0):
            c = coordinates(n, s, sampled)
            keys = key_of(padded, walk(padded, s, 2 * n)[c], n)
            order = np.argsort(keys, kind="stable")
            walks.append((c, keys[order], order))
        own = np.concatenate([pair_hashes(h) for h in texts])
        order = np.argsort(own, kind="stable")
        lengths.append({"n": n, "edits": e, "ids": ids, "words": texts, "pairs": own[order], "places": order, "walks": walks, "all": reps is None})
    return {"bits": min(bits, 27), "table": table, "lengths": lengths}


def pair_hashes(h: np.ndarray) -> np.ndarray:
    return K.mix(h[:-1] * STEP + h[1:])


def distances(items: np.ndarray, windows: np.ndarray, edits: int, length: np.ndarray) -> np.ndarray:
    """For each row the least edit distance from the item to a window that starts where the row does and has n - edits to n + edits words; n + edits + 1 where that is more than edits. length: words that the row really has."""
    rows, n = items.shape
    out, live = np.full(rows, n + edits + 1, np.int32), np.arange(rows)
    # a band of 2 edits + 1 diagonals: column k at item word i is the window's first i - edits + k words
    k = np.arange(2 * edits + 1, dtype=np.int32)
    windows = np.pad(windows, ((0, 0), (edits + 1, max(0, n + edits - windows.shape[1]))))
    far = np.int32(2 * n + 2 * edits)
    d = np.broadcast_to(np.where(k >= edits, k - edits, far), (rows, k.size)).astype(np.int32)
    for i in range(1, n + 1):
        # window word j = i - edits + k, counted from 1, is at j + edits
        t = d + (windows[:, i : i + k.size] != items[:, i - 1 : i])
        t[:, :-1] = np.minimum(t[:, :-1], d[:, 1:] + 1)
        if i <= edits:
            t[:, : edits - i] = far
            t[:, edits - i] = i
        d = np.minimum.accumulate(t - k, axis=1) + k
        if i % 4 == 0 and not (on := d.min(axis=1) <= edits).all():
            d, windows, items, length, live = d[on], windows[on], items[on], length[on], live[on]
            if not live.size:
                return out
    j = n - edits + k
    least = np.where(j[None, :] <= length[:, None], d, far).min(axis=1)
    out[live] = np.where(least <= edits, least, n + edits + 1)
    return out


class Finder:
    """Finds the items of an index in documents: screen() takes chunks, found() then gives what is in them."""

    def __init__(self, index: dict) -> None:
        self.index, self.words = index, K.Words()
        self.wide = max([g["n"] + g["edits"] for g in index["lengths"]], default=1)
        self.reset()

    def reset(self) -> None:
        self.best: dict[tuple[int, int], tuple[int, int, int]] = {}
        # per screened start: row of its document, first word, words left, its window; and per length which of these it is for
        self.rows, self.starts, self.left, self.windows = [], [], [], []
        self.of_length: list[list[np.ndarray]] = [[] for _ in self.index["lengths"]]
        self.waiting = 0

    def add(self, doc: int, item: int, distance: int, start: int, n: int) -> None:
        here = (distance, start, n)
        if (doc, item) not in self.best or here < self.best[doc, item]:
            self.best[doc, item] = here

    def screen(self, row: int, buf: np.ndarray, offs: np.ndarray) -> None:
        """Keeps the starts of windows in this chunk, whose first document is of that row, that can match."""
        h, word_at, _, _ = self.words(buf, offs)
        hits, pair = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if h.size > 1:
            pair = pair_hashes(h)
            hits = np.flatnonzero(self.index["table"][(pair >> U(64 - self.index["bits"])).astype(np.int64)])
            hits = hits[hits + 1 < word_at[np.searchsorted(word_at, hits, "right")]]
            pair = pair[hits]
        doc_of_hit = np.searchsorted(word_at, hits, "right") - 1
        per_length = []
        for group in self.index["lengths"]:
            n, e = group["n"], group["edits"]
            per_length.append(np.zeros(0, np.int64))
            if n == 1:
                order = np.argsort(group["words"][:, 0])
                known = group["words"][order, 0]
                lo, hi = np.searchsorted(known, h), np.searchsorted(known, h, "right")
                for s in np.flatnonzero(hi > lo):
                    doc = int(np.searchsorted(word_at, s, "right") - 1)
                    for k in range(lo[s], hi[s]):
                        self.add(row + doc, int(group["ids"][order[k]]), 0, int(s - word_at[doc]), 1)
                continue
            need = n - 1 - 2 * e
            if hits.size < need:
                continue
            first, last = np.searchsorted(group["pairs"], pair), np.searchsorted(group["pairs"], pair, "right")
            many = last - first
            if many.sum() < need:
                continue
            place = group["places"][np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())]
            item, at = np.divmod(place, n - 1)
            doc = np.repeat(doc_of_hit, many)
            begin = np.repeat(hits, many) - at
            order = np.lexsort((begin, doc, item))
            item, doc, begin = item[order], doc[order], begin[order]
            ahead = begin.size - need + 1
            j = np.flatnonzero((begin[need - 1 :] - begin[:ahead] <= 2 * e) & (doc[need - 1 :] == doc[:ahead]) & (item[need - 1 :] == item[:ahead]))
            lo = np.maximum(begin[j + need - 1] - e, word_at[doc[j]])
            hi = np.minimum(begin[j] + e, word_at[doc[j] + 1] - (n - e))
            span = np.maximum(hi - lo + 1, 0)
            per_length[-1] = np.unique(np.repeat(lo - np.cumsum(span) + span, span) + np.arange(span.sum()))
        starts = np.unique(np.concatenate(per_length)) if per_length else np.zeros(0, np.int64)
        if not starts.size:
            return
        doc = np.searchsorted(word_at, starts, "right") - 1
        left = word_at[doc + 1] - starts
        padded, cols = np.concatenate([h, np.zeros(self.wide, np.uint64)]), np.arange(self.wide)
        self.windows.append(np.where(cols < left[:, None], padded[starts[:, None] + cols], U(0)))
        self.rows.append(row + doc)
        self.starts.append(starts - word_at[doc])
        self.left.append(left)
        for at, s in zip(self.of_length, per_length):
            at.append(self.waiting + np.searchsorted(starts, s))
        self.waiting += starts.size
        if self.waiting > 1 << 13:
            self.match()

    def match(self) -> None:
        """Searches and verifies the screened windows."""
        if not self.waiting:
            return
        wide, rows, starts, left = np.concatenate(self.windows), np.concatenate(self.rows), np.concatenate(self.starts), np.concatenate(self.left)
        of_length = [np.concatenate(x) for x in self.of_length]
        used = [(group, of, [(of[:, None] * len(group["ids"]) + np.arange(len(group["ids"]))).reshape(-1)] if group["all"] else []) for group, of in zip(self.index["lengths"], of_length) if of.size]
        live: list = []
        for s in range(max((len(group["walks"]) for group, _, _ in used), default=0)):
            if s == 0 or any(s >= len(group["walks"]) for group, _, _, _ in live):
                going = [x for x in used if s < len(x[0]["walks"])]
                walking = np.unique(np.concatenate([of for _, of, _ in going]))
                steps = 2 * max(group["n"] for group, _, _ in going)
                on = ended(wide[walking])
                live = [(*x, np.searchsorted(walking, x[1])) for x in going]
            path = walk(on, s, steps)
            for group, of, pairs, at in live:
                coords, keys, order = group["walks"][s]
                k = key_of(on[at], path[coords[:, None], at], group["n"])
                lo, hi = np.searchsorted(keys, k), np.searchsorted(keys, k, "right")
                w = np.flatnonzero(hi > lo)
                if w.size:
                    many = hi[w] - lo[w]
                    which = np.repeat(lo[w] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
                    pairs.append(np.repeat(of[w], many) * len(order) + order[which])
        for group, _, pairs in used:
            pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
            for p in range(0, pairs.size, 4096):
                w, i = np.divmod(pairs[p : p + 4096], len(group["ids"]))
                d = distances(group["words"][i], wide[w][:, : group["n"] + group["edits"]], group["edits"], left[w])
                for x in np.flatnonzero(d <= group["edits"]):
                    self.add(int(rows[w[x]]), int(group["ids"][i[x]]), int(d[x]), int(starts[w[x]]), group["n"])
        best = self.best
        self.reset()
        self.best = best

    def found(self) -> list[tuple[int, int, int, int, int]]:
        """(row, item_id, distance, first word, words of the item) at the best place for each row and item, of all chunks since the last call."""
        self.match()
        out = [(doc, item, d, s, n) for (doc, item), (d, s, n) in self.best.items()]
        self.reset()
        return out


def slices(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items, in parts whose index takes at most about SLICE_BYTES: keys of MAX_REPETITIONS, and for each byte of text up to half a word's hash, pair, place and slots of the pair table."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text") * 76 + MAX_REPETITIONS * 16)).first()[0] or 0
    n = max(1, -(-size // SLICE_BYTES))
    part = F.pmod(F.xxhash64("text"), F.lit(n))
    for k in [0] if n == 1 else [r[0] for r in items.select(part.alias("k")).distinct().orderBy("k").collect()]:
        yield [(NO_ID if r[0] is None else r[0], r[1]) for r in items.where(part == k).orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = MAX_EDITS, target: float = TARGET_RECALL) -> DataFrame:
    """(doc_id, item_id, distance, start_word, item_words) of every document and item found in it, at its best place."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, item_id long, distance int, start_word long, item_words int"
    out = None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for items in slices(benchmark):
        shipped = docs.sparkSession.sparkContext.broadcast(build_index(items, share, target, docs.sparkSession))

        def find(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            finder = Finder(shipped.value)
            for b in batches:
                for i, _, buf, offs in K.chunks(b.column(1)):
                    finder.screen(i, buf, offs)
                if rows := finder.found():
                    doc, item, d, s, n = zip(*rows)
                    yield pa.record_batch([b.column(0).take(pa.array(doc)), pa.array([None if x == NO_ID else x for x in item], pa.int64()), pa.array(d, pa.int32()), pa.array(s, pa.int64()), pa.array(n, pa.int32())], names=["doc_id", "item_id", "distance", "start_word", "item_words"])

        part = texts.mapInArrow(find, schema)
        out = part if out is None else out.unionByName(part)
    best = out.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "start_word", "item_words")).alias("b"))
    return best.select("doc_id", "item_id", "b.distance", "b.start_word", "b.item_words")


def _holds(shipped):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = Finder(shipped.value)
        for col in batches:
            flag = np.zeros(len(col), bool)
            for i, _, buf, offs in K.chunks(col):
                finder.screen(i, buf, offs)
            for row, *_ in finder.found():
                flag[row] = True
            yield pa.array(flag)

    return F.arrow_udf(run, "boolean")


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: float = MAX_EDITS, target: float = TARGET_RECALL) -> DataFrame:
    """The rows of docs that hold no item, with all their columns; one pass, no shuffle."""
    small_batches(docs.sparkSession)
    out = docs
    for items in slices(benchmark):
        holds = _holds(docs.sparkSession.sparkContext.broadcast(build_index(items, share, target, docs.sparkSession)))
        out = out.where(~holds(F.col("text").cast("string")))
    return out
