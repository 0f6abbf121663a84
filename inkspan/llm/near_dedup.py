"""Near-duplicate removal: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

1. One scan counts, for each of FEATURES hash buckets of shingles, the documents
   that hold it. The table has a fixed size; its sum over tasks is the only
   thing gathered. IDF of a shingle is ln(1 + N / (df + SMOOTH * N)), df of its
   bucket: without SMOOTH the odd words of a copy, unique, would outweigh by far
   what a group of thousands shares.
2. A second scan draws BANDS * ROWS improved consistent weighted samples of each
   document's tf*idf shingles (Ioffe 2010) and packs them into band keys.
   Documents with the same weighted shingles collapse to their least doc_id.
3. Band keys that hold several representatives link those whose samples agree
   often enough that a pair at the threshold is lost with a chance of ~0.1%.
   Links form coarse components (large-star, small-star rounds).
4. Within each coarse component weighted Jaccard decides, exactly. Pairs already
   joined through others are skipped, and pairs that a prefix filter shows to be
   below the threshold; neither changes a component. Coarse components grow
   faster than the corpus, as short texts chain through lines they share.
Bands and components of any size are compared in blocks of bounded bytes (blocks.py).

A group is a connected component of pairs at THRESHOLD or more; its least
doc_id stays. A pair at 0.6 shares a band with a chance of 98 %, one at 0.7 of
99.9 %; of a group of several documents any link that joins them suffices. Very
long texts are vectors of their own length; one is held by a task, with a block. Defined cases: texts that are null or have no word are never
near-duplicates of anything; rows with a null doc_id are kept and not compared;
rows that repeat a doc_id count as that one document with all its texts being
compared, and near_dedup keeps one row of it if the texts are equal; extra columns pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm import kernel as K
from inkspan.llm.blocks import links
from inkspan.llm.components import components
from inkspan.llm.shared import BROADCAST_BYTES, kept, scratch, small_batches, unused, written

SHINGLE, THRESHOLD = 2, 0.6
BANDS, ROWS = 16, 3
SMOOTH = 1 / 64
FEATURE_BITS = 20
FEATURES = 1 << FEATURE_BITS
#: Partial count tables are added up in so many lanes first, so that no task reads those of all others.
LANES = 256
ID_BITS = 44
#: Bytes of signatures and of vectors that are compared in one task; larger groups are compared in blocks.
SIGNATURE_BLOCK, VECTOR_BLOCK = 1 << 20, 16 << 20
POOL = 1 << 16
U = np.uint64


class Vectors:
    """The weighted shingle set of each document of a chunk."""

    def __init__(self, shingle: int) -> None:
        self.words, self.shingle = K.Words(), shingle

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, shingle of ID_BITS, term frequency), sorted by document, then shingle."""
        h, word_at, _, _ = self.words(buf, offs)
        sh, at = K.shingles(h, word_at, self.shingle)
        key = np.repeat(np.arange(offs.size - 1, dtype=np.uint64) << U(ID_BITS), np.diff(at))
        key |= sh >> U(64 - ID_BITS)
        key.sort()
        if not key.size:
            z = np.zeros(0, np.int64)
            return z, key, z
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key, tf = key[head], np.diff(np.append(head, key.size))
        return (key >> U(ID_BITS)).astype(np.int64), key & U((1 << ID_BITS) - 1), tf


def feature(ids: np.ndarray) -> np.ndarray:
    return (ids >> U(ID_BITS - FEATURE_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame, shingle: int = SHINGLE) -> tuple[int, np.ndarray]:
    """(documents with a shingle, FEATURES document counts), over all documents."""
    block = 1 << 14

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, df, n, waiting, size = Vectors(shingle), np.zeros(FEATURES, np.int64), 0, [], 0
        for b in batches:
            for _, _, buf, offs in K.chunks(b.column(0)):
                doc, ids, _ = vectors(buf, offs)
                if doc.size:
                    n += 1 + int(np.count_nonzero(np.diff(doc)))
                    waiting.append(feature(ids))
                    size += ids.size
                if size > 1 << 21:
                    df += np.bincount(np.concatenate(waiting), minlength=FEATURES)
                    waiting, size = [], 0
        if waiting:
            df += np.bincount(np.concatenate(waiting), minlength=FEATURES)
        if n:
            parts = df.astype(np.uint32).reshape(-1, block)
            yield pa.record_batch([pa.array([*range(len(parts)), -1], pa.int32()), pa.array([*(p.tobytes() for p in parts), np.array([n], np.uint64).tobytes()], pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1)):
                a = np.frombuffer(counts.as_buffer(), np.uint32 if part >= 0 and len(counts.as_buffer()) == 4 * block else np.uint64).astype(np.uint64)
                total[part] = total[part] + a if part in total else a
        if total:
            yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([a.tobytes() for a in total.values()], pa.binary())], names=["part", "counts"])

    schema = "part int, counts binary"
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, schema).withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(LANES)))
    rows = rows.repartition("part", "lane").select("part", "counts").mapInArrow(add, schema).repartition(8, "part").mapInArrow(add, schema).collect()
    df, n = np.zeros(FEATURES, np.int64), 0
    for r in rows:
        a = np.frombuffer(r["counts"], np.uint64).astype(np.int64)
        if r["part"] < 0:
            n = int(a[0])
        else:
            df[r["part"] * block : (r["part"] + 1) * block] = a
    return n, df


def idf_table(n: int, df: np.ndarray) -> np.ndarray:
    return np.log1p(n / (np.maximum(df, 1) + SMOOTH * n)).astype(np.float32)


class Sampler:
    """Improved consistent weighted samples. Random draws come from a pool by a hash of the shingle for each sample.

    A sample is the shingle of least a, and ln a lies less than r below ln c - ln w.
    A first pass takes ln c - r - ln w, by one draw, and leaves the shingles that may
    come below REACH / sum of weights, as the least a does with a chance of
    1 - exp(-REACH); a is computed for them alone. Where none of them does, it is
    computed for all shingles of the document. So the samples are those of all.
    """

    #: Rounding of ln a in 32 bits is far less than SLACK.
    REACH, SLACK = 6.0, 0.01

    def __init__(self, samples: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2, 1, POOL).astype(np.float32)
        self.inv_r = (1 / self.r).astype(np.float32)
        self.beta = rng.random(POOL).astype(np.float32)
        self.ln_c = np.log(rng.gamma(2, 1, POOL)).astype(np.float32)
        self.low = self.ln_c - self.r
        self.odd = rng.integers(1 << 62, 1 << 63, samples, dtype=np.uint64) | U(1)

    def __call__(self, doc_at: np.ndarray, ids: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Sample hashes: a row for each document that starts at doc_at, a column for each sample."""
        ln_w, spread = np.log(weight).astype(np.float32), K.mix(ids)
        n = np.diff(np.append(doc_at, ids.size))
        reach = np.log(self.REACH / np.add.reduceat(weight, doc_at, dtype=np.float64)).astype(np.float32)
        bound = ln_w + np.repeat(reach + np.float32(self.SLACK), n)
        out = np.empty((doc_at.size, self.odd.size), np.uint64)
        h, low = np.empty(ids.size, np.uint64), np.empty(ids.size, np.float32)
        for k, odd in enumerate(self.odd):
            np.multiply(spread, odd, out=h)
            np.right_shift(h, U(48), out=h)
            draw = h.view(np.int64)
            self.low.take(draw, out=low, mode="clip")
            some = np.flatnonzero(low < bound)
            first = np.searchsorted(some, doc_at)
            docs = np.flatnonzero(np.diff(np.append(first, some.size)))
            sure = np.zeros(doc_at.size, bool)
            if docs.size:
                sure[docs], out[docs, k] = self._least(first[docs], some, draw, ln_w, spread, reach[docs])
            if not sure.all():
                docs = np.flatnonzero(~sure)
                some = ragged(doc_at[docs], n[docs])
                _, out[docs, k] = self._least(np.cumsum(n[docs]) - n[docs], some, draw, ln_w, spread, reach[docs])
        return out

    def _least(self, at: np.ndarray, some: np.ndarray, draw: np.ndarray, ln_w: np.ndarray, spread: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each run of shingles that starts at at: whether its least a is within reach, and the hash of the sample."""
        i = draw[some]
        r, beta = self.r[i], self.beta[i]
        t = np.floor(ln_w[some] * self.inv_r[i] + beta)
        # ln a = ln c - r (t - beta) - r; shifted to be positive, so that its bits sort as it does
        a = np.maximum(self.ln_c[i] - r * (t - beta + 1) + np.float32(512), np.float32(1e-3))
        order = (a.view(np.uint32).astype(np.uint64) << U(32)) | np.arange(some.size, dtype=np.uint64)
        least = (np.minimum.reduceat(order, at) & U(0xFFFFFFFF)).astype(np.int64)
        return a[least] - np.float32(512) <= reach, K.mix(spread[some[least]] * U(0x9E3779B97F4A7C15) + t[least].astype(np.int64).astype(np.uint64))


def signatures(docs: DataFrame, n: int, df: np.ndarray, shingle: int, bands: int, rows: int) -> DataFrame:
    """doc_id, a digest of the weighted set (d1, d2), band keys, and 16 bits of each sample; only documents with a word and a doc_id."""
    idf = docs.sparkSession.sparkContext.broadcast(idf_table(n, df))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sampler, table = Vectors(shingle), Sampler(bands * rows), idf.value
        for b in batches:
            ids_of_docs = b.column(0)
            for i, _, buf, offs in K.chunks(b.column(1)):
                doc, ids, tf = vectors(buf, offs)
                if not doc.size:
                    continue
                at = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                s = sampler(at, ids, tf * table[feature(ids)])
                each = K.mix(ids * U(0xD6E8FEB86659FD93) + tf.astype(np.uint64))
                keys = np.zeros((at.size, bands), np.uint64)
                for band in range(bands):
                    k = np.full(at.size, U(band + 1))
                    for c in range(band * rows, (band + 1) * rows):
                        k = K.mix(k + s[:, c])
                    keys[:, band] = k
                small = (s & U(0xFFFF)).astype(np.uint16)
                yield pa.record_batch(
                    [
                        ids_of_docs.take(pa.array(i + doc[at])),
                        pa.array(np.add.reduceat(each, at).view(np.int64)),
                        pa.array(np.add.reduceat(K.mix(each), at).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(at.size + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1).view(np.int64))),
                        pa.array([x.tobytes() for x in small], pa.binary()),
                    ],
                    names=["doc_id", "d1", "d2", "bands", "sig"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null").mapInArrow(sign, "doc_id long, d1 long, d2 long, bands array<long>, sig binary")


def least_agreement(samples: int, threshold: float) -> int:
    """Agreeing samples below which a pair at the threshold falls with a chance of about 0.1% (three deviations)."""
    return max(1, int(np.floor(samples * threshold - 3 * np.sqrt(samples * threshold * (1 - threshold)))))


def agreeing(samples: int, least: int):
    """Which payloads (16 bits of each sample) agree with that at a place in enough samples."""

    def alike(payloads: list):
        sigs = np.frombuffer(b"".join(memoryview(v) for v in payloads), np.uint16).reshape(len(payloads), samples)

        def near(x: int, open_: np.ndarray) -> np.ndarray:
            rest = np.flatnonzero(open_)
            return rest[np.count_nonzero(sigs[rest] == sigs[x], axis=1) >= least]

        return near

    return alike


def coarse_links(reps: DataFrame, samples: int, threshold: float, most: int = SIGNATURE_BLOCK) -> DataFrame:
    """Links (a, b), a > b, that join all representatives that share a band and agree enough."""
    keyed = reps.select(F.explode("bands").alias("key"), F.col("rep").alias("id"), F.lit(2 * samples).alias("size"))
    sigs = reps.select(F.col("rep").alias("id"), F.col("sig").alias("v"))
    return links(keyed, lambda some: some.join(sigs, "id"), agreeing(samples, least_agreement(samples, threshold)), most, "near-coarse")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of least over sum of greatest weights; 0 where both are empty."""
    (ia, wa), (ib, wb) = a, b
    sa, sb = float(wa.sum(dtype=np.float64)), float(wb.sum(dtype=np.float64))
    both = np.searchsorted(ib, ia)
    both[both == ib.size] = 0
    hit = ib[both] == ia if ib.size else np.zeros(ia.size, bool)
    common = float(np.minimum(wa[hit], wb[both[hit]]).sum(dtype=np.float64))
    return common / (sa + sb - common) if sa + sb > 0 else 0.0


def ragged(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The n places from each of at on, one after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if n.size else 0) + np.repeat(at - (ends - n), n)


class Overlaps:
    """Which vectors of a block are at the threshold with one of them, exactly, without looking at all.

    Each vector's shingles are in order of how many vectors of the block hold them,
    rarest first. Its leading ones are those without which less than the threshold
    of its weight is left. Two vectors at the threshold share a leading shingle of
    both: otherwise all they share lies behind the leading ones of one of them,
    which is less than the threshold of its weight (prefix filter, Bayardo et al.
    2007). So a line that thousands of short texts hold makes no pair of them.
    """

    #: Blocks up to so many members are compared pair by pair.
    FEW = 8

    def __init__(self, payloads: list, threshold: float) -> None:
        vectors, self.threshold = [unpacked(v) for v in payloads], threshold
        self.n = np.array([i.size for i, _ in vectors])
        self.at = np.cumsum(self.n) - self.n
        owner = np.repeat(np.arange(self.n.size, dtype=np.int32), self.n)
        _, place, often = np.unique(np.concatenate([i for i, _ in vectors]), return_inverse=True, return_counts=True)
        rank = np.empty(often.size, np.int32)
        rank[np.argsort(often, kind="stable")] = np.arange(often.size, dtype=np.int32)
        place = rank[place]
        order = np.lexsort((place, owner))
        self.ids, self.w = place[order], np.concatenate([w for _, w in vectors])[order]
        del vectors, place, order
        self.total = np.bincount(owner, self.w, self.n.size)
        run = np.append(0.0, np.cumsum(self.w, dtype=np.float64))
        # a little less than the threshold, so that rounding loses no pair
        self.least = threshold - 1e-6
        lead = run[(self.at + self.n)[owner]] - run[:-1] >= self.least * self.total[owner]
        self.leading = np.bincount(owner[lead], minlength=self.n.size)
        e = np.flatnonzero(lead)
        e = e[np.argsort(self.ids[e], kind="stable")]
        self.holders, self.held = owner[e], np.searchsorted(self.ids[e], np.arange(often.size + 1))
        self.one = np.zeros(often.size, np.float32)

    def __call__(self, x: int, open_: np.ndarray) -> np.ndarray:
        """The places among the open ones whose vectors are at the threshold with that at x."""
        rest = np.flatnonzero(open_)
        lead = self.ids[self.at[x] : self.at[x] + self.leading[x]]
        lists = self.held[lead + 1] - self.held[lead]
        if lists.sum() < self.n[rest].sum():
            hit = np.zeros(self.n.size, bool)
            hit[self.holders[ragged(self.held[lead], lists)]] = True
            rest = np.flatnonzero(hit & open_)
        low, high = np.minimum(self.total[rest], self.total[x]), np.maximum(self.total[rest], self.total[x])
        rest = rest[(low > 0) & (low >= self.least * high)]
        if not rest.size:
            return rest
        n, mine = self.n[rest], slice(self.at[x], self.at[x] + self.n[x])
        e = ragged(self.at[rest], n)
        self.one[self.ids[mine]] = self.w[mine]
        common = np.bincount(np.repeat(np.arange(rest.size), n), np.minimum(self.one[self.ids[e]], self.w[e]), rest.size)
        self.one[self.ids[mine]] = 0
        return rest[common / (self.total[x] + self.total[rest] - common) >= self.threshold]


def overlapping(threshold: float):
    """Which payloads (packed vectors) are at the threshold with that at a place."""

    def alike(payloads: list):
        if len(payloads) > Overlaps.FEW:
            return Overlaps(payloads, threshold)
        vectors = [unpacked(v) for v in payloads]
        return lambda x, open_: np.array([y for y in np.flatnonzero(open_) if weighted_jaccard(vectors[x], vectors[y]) >= threshold], np.int64)

    return alike


def exact_links(docs: DataFrame, candidates: DataFrame, n: int, df: np.ndarray, shingle: int, threshold: float, most: int = VECTOR_BLOCK) -> DataFrame:
    """Links (a, b), a > b, that join what is at the threshold within each coarse component; candidates: id, component."""
    spark = docs.sparkSession
    idf = spark.sparkContext.broadcast(idf_table(n, df))
    small = candidates.count() * 16 <= BROADCAST_BYTES

    def payload(some: DataFrame) -> DataFrame:
        def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vectors, table = Vectors(shingle), idf.value
            for b in batches:
                for i, j, buf, offs in K.chunks(b.column(0)):
                    doc, ids, tf = vectors(buf, offs)
                    at = np.searchsorted(doc, np.arange(j - i + 1))
                    w = (tf * table[feature(ids)]).astype(np.float32)
                    packed = pa.array([ids[x:y].tobytes() + w[x:y].tobytes() for x, y in zip(at, at[1:])], pa.binary())
                    yield pa.record_batch([*(c.slice(i, j - i) for c in b.columns[1:]), packed], names=names)

        names = [*some.columns, "v"]
        return texts.join(F.broadcast(some) if small else some, "id").select("text", *some.columns).mapInArrow(vectorise, ", ".join(f"{c} {t}" for c, t in some.dtypes) + ", v binary")

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    sized = texts.select("id", F.octet_length("text").alias("size")).join(F.broadcast(candidates) if small else candidates, "id").groupBy(F.col("component").alias("key"), "id").agg((F.sum("size") * 2).alias("size"))
    # a document that occurs with several texts has several vectors under its id
    return links(written(sized, "near-sized"), payload, overlapping(threshold), most, "near-exact")


def unpacked(v) -> tuple[np.ndarray, np.ndarray]:
    n = len(v) // 12
    return np.frombuffer(v, np.uint64, n), np.frombuffer(v, np.float32, n, 8 * n)


def near_groups(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, keep_id) of each document that goes because keep_id, the least of its group, stays."""
    small_batches(docs.sparkSession)
    with scratch(docs.sparkSession) as made:
        n, df = document_frequencies(docs, shingle)
        sigs = written(signatures(docs, n, df, shingle, bands, rows), "near-signatures")
        exact = sigs.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
        copies = sigs.select("doc_id", "d1", "d2").join(exact, ["d1", "d2"]).where("doc_id <> rep").select("doc_id", "rep")
        reps = sigs.join(exact, ["d1", "d2"]).where("doc_id = rep").select("rep", "bands", "sig")
        coarse = written(components(written(coarse_links(reps, bands * rows, threshold), "near-links")), "near-coarse")
        fine = written(components(written(exact_links(docs, coarse, n, df, shingle, threshold), "near-exact")), "near-fine").withColumnsRenamed({"id": "doc_id", "component": "label"})
        of_copies = copies.join(fine.withColumnRenamed("doc_id", "rep"), "rep", "left").select("doc_id", F.coalesce("label", "rep").alias("keep_id"))
        groups = of_copies.unionByName(fine.where("doc_id <> label").select("doc_id", F.col("label").alias("keep_id"))).groupBy("doc_id").agg(F.min("keep_id").alias("keep_id"))
        return kept(made, written(groups, "near-groups"))


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay, with all their columns: one document of each group."""
    g, n, t = unused(docs, "__gone", "__n", "__twice")
    gone = near_groups(docs, **options).select(F.col("doc_id").alias(g))
    small = gone.count() * 8 <= BROADCAST_BYTES
    stay = docs.join(F.broadcast(gone) if small else gone, F.col("doc_id").cast("long") == F.col(g), "left_anti")
    twice = stay.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(F.col("doc_id").alias(t))
    twice = written(twice, "near-twice")
    if twice.isEmpty():
        return stay
    same = F.col("doc_id") == F.col(t)
    return stay.join(twice, same, "left_anti").unionByName(stay.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def survivors(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """doc_id of each document that stays."""
    gone = near_groups(docs, **options).select("doc_id")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().join(gone, "doc_id", "left_anti")
