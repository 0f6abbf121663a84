"""Cross-entropy difference (Moore and Lewis 2010) of word bigram models over one vocabulary taken from the corpus.

The vocabulary is every word (kernel.Words) of all documents, and END, which
stands before a document's first word and after its last. Counts of words and
of pairs are exact and cover all documents: the target is those labelled
quality 1, the background all. Background counts are scaled to the target's
number of tokens, so that smoothing weighs alike. A pair's probability is
smoothed by a Dirichlet prior of the word's, that by a uniform one.

score = (loss under target - loss under background) per token, in bits.

The counts are a table partitioned by key over the executors; no task or driver
holds it whole. Documents are cut into blocks. A block asks each part of the
table once for each distinct word and pair it holds, with its own counts, so a
hot word costs one key a block; the part adds up all blocks' counts and answers
with the totals; the block, which travels along as word numbers, is scored with
them. Two shuffles, of packed arrays.

Defined cases: a text without words has 0 tokens and null losses and score;
END counts as a token of every other; without target tokens all scores are
null; a very long text is a block of its own, held whole by one task in each
step; a document is in the target if any of its labels has quality 1; repeated
rows count and are scored each; labels of unknown documents count nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm import kernel as K
from inkspan.llm.shared import BROADCAST_BYTES, small_batches

#: Weight of the smoothing priors, in tokens.
PRIOR = 8.0
#: Bytes of text of a block, and rows that go to the JVM at once.
BLOCK_BYTES, ROWS = 8 << 20, 32
U = np.uint64
END, STEP, ONE = U(0x5851F42D4C957F2D), U(0x9E3779B97F4A7C15), U(1)
ASKED = "dest int, block long, bucket int, a binary, b binary, c binary"
ANSWERED = "block long, bucket int, a binary, b binary, c binary, n_words long, n_tokens long, n_target long"
SCORED = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


def pack(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, so that those of small numbers compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(x.size, x.itemsize).T).tobytes()


def unpack(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and each key's place among them."""
    order = np.argsort(keys)
    s = keys[order]
    head = np.ones(s.size, bool)
    head[1:] = s[1:] != s[:-1]
    place = np.empty(s.size, np.int64)
    place[order] = np.cumsum(head) - 1
    return s[head], place


def keys_of(seq: np.ndarray) -> np.ndarray:
    """Keys of the tokens (odd), then of the pairs that end at them (even). seq: word hashes, END after each document."""
    before = np.concatenate(([END], seq[:-1]))
    return np.concatenate((seq | ONE, K.mix(before * STEP + seq) & ~ONE))


def ask(parts: int, block_bytes: int):
    """(doc_id, text, in target) to requests of each block to every part, and its own row (bucket -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number, held = K.Words(), TaskContext.get().partitionId() << 32, 0
        ids, valid, flags, sizes, hashes = [], [], [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            size, h, flag = np.concatenate(sizes), np.concatenate(hashes), np.concatenate(flags)
            seq = np.insert(h, np.cumsum(size)[size > 0], END)
            tokens = size + (size > 0)
            keys, place = ranked(keys_of(seq))
            n = np.bincount(place, minlength=keys.size).astype(np.uint32)
            n_target = np.bincount(place[np.tile(np.repeat(flag, tokens), 2)], minlength=keys.size).astype(np.uint32)
            cut = np.searchsorted((keys >> U(32)) * U(parts) >> U(32), np.arange(parts + 1).astype(np.uint64))
            rows = [(p, number, p, *(pack(x[i:j]) for x in (keys, n, n_target))) for p, i, j in zip(range(parts), cut[:-1], cut[1:])]
            vocabulary, at = ranked(seq)
            doc = np.concatenate((np.concatenate(ids), np.concatenate(valid).astype(np.int64), size))
            rows.append((number % parts, number, -1, pack(doc), pack(vocabulary), pack(at.astype(np.uint32))))
            for i in range(0, len(rows), ROWS):
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows[i : i + ROWS]), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["dest", "block", "bucket", "a", "b", "c"])
            number += 1
            for x in (ids, valid, flags, sizes, hashes):
                x.clear()

        for b in batches:
            flag = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            doc = b.column(0)
            for i, j, buf, offs in K.chunks(b.column(1)):
                h, at, _, _ = words(buf, offs)
                part = doc.slice(i, j - i)
                ids.append(part.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
                valid.append(part.is_valid().to_numpy(zero_copy_only=False))
                flags.append(flag[i:j])
                sizes.append(np.diff(at).astype(np.int64))
                hashes.append(h)
                held += buf.size + 8 * (j - i)
                if held >= block_bytes:
                    yield from flush()
                    held = 0
        if ids:
            yield from flush()

    return run


def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The totals of a part of the table, to each block in the order of its keys; n_words, n_tokens, n_target: of the whole part."""
    names = ["block", "bucket", "a", "b", "c", "n_words", "n_tokens", "n_target"]
    types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    who, keys, n, n_target = [], [], [], []
    for b in batches:
        for _, block, bucket, x, y, z in zip(*(c.to_pylist() for c in b.columns)):
            if bucket < 0:
                yield pa.record_batch([pa.array([v], t) for v, t in zip((block, bucket, x, y, z, 0, 0, 0), types)], names=names)
                continue
            who.append((block, bucket))
            keys.append(unpack(x, np.uint64))
            n.append(unpack(y, np.uint32))
            n_target.append(unpack(z, np.uint32))
    if not who:
        return
    ends = np.cumsum([k.size for k in keys])
    known, place = ranked(np.concatenate(keys))
    total = np.bincount(place, np.concatenate(n), known.size).astype(np.uint64)
    target = np.bincount(place, np.concatenate(n_target), known.size).astype(np.uint64)
    word = (known & ONE).astype(bool)
    of = (int(word.sum()), int(total[word].sum()), int(target[word].sum()))
    del keys, n, n_target
    for k, (block, bucket) in enumerate(who):
        p = place[ends[k - 1] if k else 0 : ends[k]]
        yield pa.record_batch([pa.array([v], t) for v, t in zip((block, bucket, None, pack(total[p]), pack(target[p]), *of), types)], names=names)


def losses(seq: np.ndarray, place: np.ndarray, n: np.ndarray, n_words: int, n_tokens: float, prior: float) -> np.ndarray:
    """Bits for each token. place: of each token's word, then of its pair, among the counts n."""
    of_word, of_pair = n[place[: seq.size]], n[place[seq.size :]]
    # a document's first word follows the END of another; all ENDs count alike
    end = of_word[-1:]
    p = (of_word + prior / n_words) / (n_tokens + prior)
    return -np.log2((of_pair + prior * p) / (np.concatenate((end, of_word[:-1])) + prior))


def scored(parts: int, prior: float):
    """Scores each block when all parts have answered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, dict[int, tuple]] = {}
        for b in batches:
            for block, bucket, *rest in zip(*(c.to_pylist() for c in b.columns)):
                got = waiting.setdefault(block, {})
                got[bucket] = rest
                if len(got) == parts + 1:
                    yield of_block(waiting.pop(block))
        if waiting:
            raise RuntimeError("a block lacks an answer")

    def of_block(got: dict[int, tuple]) -> pa.RecordBatch:
        doc, vocabulary, at = unpack(got[-1][0], np.int64), unpack(got[-1][1], np.uint64), unpack(got[-1][2], np.uint32)
        ids, valid, size = doc.reshape(3, -1)
        n_words, n_tokens, n_target = (sum(got[p][k] for p in range(parts)) for k in (3, 4, 5))
        tokens = size + (size > 0)
        some, means = np.flatnonzero(tokens), [np.full(size.size, np.nan), np.full(size.size, np.nan)]
        if some.size and n_target:
            seq = vocabulary[at]
            _, place = ranked(keys_of(seq))
            first = (np.cumsum(tokens) - tokens)[some]
            for mean, column, scale in zip(means, (2, 1), (1.0, n_target / n_tokens)):
                n = np.concatenate([unpack(got[p][column], np.uint64) for p in range(parts)]) * scale
                mean[some] = np.add.reduceat(losses(seq, place, n, n_words, n_target, prior), first) / tokens[some]
        t, g = means
        return pa.record_batch([pa.array(ids, mask=valid == 0), pa.array(tokens), *(pa.array(x, from_pandas=True) for x in (t, g, t - g))], names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, prior: float = PRIOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score of every row; losses in bits per token."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("__id")).distinct()
    if target.count() * 8 <= BROADCAST_BYTES:
        target = F.broadcast(target)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(target, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", F.col("__id").isNotNull().alias("t"))
    asked = texts.mapInArrow(ask(parts, block_bytes), ASKED).repartitionById(parts, F.col("dest"))
    return asked.mapInArrow(answer, ANSWERED).repartition(parts, "block").mapInArrow(scored(parts, prior), SCORED)
