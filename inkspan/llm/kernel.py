"""Vectorised text kernel: word hashes and byte n-grams straight from Arrow buffers, without Python strings.

A batch is cut into chunks of a bounded number of bytes at document borders,
so that scratch arrays stay small whatever the batch size; a single longer
document forms a chunk of its own. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
CHUNK_ROWS = 1 << 19
U = np.uint64
M1, M2 = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x = x * M1
    x ^= x >> U(33)
    x *= M2
    x ^= x >> U(33)
    return x


def fold_table() -> np.ndarray:
    """Byte to folded byte: ASCII letters lower, digits and bytes of non-ASCII characters as they are, all else 0."""
    t = np.zeros(256, np.uint8)
    for c in range(48, 58):
        t[c] = c
    for c in range(97, 123):
        t[c] = c
        t[c - 32] = c
    t[128:] = np.arange(128, 256)
    return t


def folded(buf: np.ndarray, fold: np.ndarray) -> np.ndarray:
    """Applies the fold table, lowers À to Þ (UTF-8 C3 80 to C3 9E without C3 97), and takes signs beyond ASCII for what separates words: U+0080 to U+00BF but for ª µ º, U+2000 to U+206F, U+3000 to U+303F."""
    x = fold[buf]
    if buf.size > 1 and (lead := np.flatnonzero(buf[:-1] == 0xC2)).size:
        nxt = buf[lead + 1]
        lead = lead[(nxt != 0xAA) & (nxt != 0xB5) & (nxt != 0xBA)]
        x[lead] = x[lead + 1] = fold[0]
    for first, second in ((0xE2, (0x80, 0x81)), (0xE3, (0x80,))):
        if buf.size > 2 and (lead := np.flatnonzero(buf[:-2] == first)).size:
            lead = lead[np.isin(buf[lead + 1], second)]
            x[lead] = x[lead + 1] = x[lead + 2] = fold[0]
    if buf.size > 1 and (lead := np.flatnonzero(buf[:-1] == 0xC3)).size:
        nxt = buf[lead + 1]
        lead = lead[(nxt >= 0x80) & (nxt <= 0x9E) & (nxt != 0x97)]
        x[lead + 1] += 0x20
    return x


def chunks(col: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of each chunk of a string column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    n = len(col)
    if not n:
        return
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, at, data = col.buffers()
    offs = np.frombuffer(at, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most, "right")) - 1
        j = min(max(j, i + 1), n, i + CHUNK_ROWS)
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


class Words:
    """Hashes of the words of a chunk. A word is a run of folded letters, digits and non-ASCII bytes within a document; of scripts that are written without spaces (Thai to Lao, kana, Han: UTF-8 E0 B8 to E0 BB, E3 81 to E9 BF) each character."""

    def __init__(self) -> None:
        self.fold = fold_table()
        rng = np.random.default_rng(20231)
        self.byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = 0x9E3779B97F4A7C15 | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.pow = self.inv = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if self.pow.size < n:
            n = max(n, CHUNK_BYTES + 1)
            for name, b in (("pow", self.base), ("inv", self.inverse)):
                a = np.full(n, U(b))
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word hashes, offset of each document's first word, byte where each word starts, byte after its last)."""
        docs = offs.size - 1
        if not buf.size:
            z = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), np.zeros(docs + 1, np.int64), z, z
        self._grow(buf.size)
        x = folded(buf, self.fold)
        is_word = x != 0
        first = np.zeros(buf.size + 1, bool)
        first[offs] = True
        first = first[:-1]
        before = np.empty_like(is_word)
        before[0] = False
        before[1:] = is_word[:-1]
        lone = np.zeros(0, np.int64)
        if buf.size > 2 and (lead := np.flatnonzero((buf[:-2] >= 0xE0) & (buf[:-2] <= 0xE9))).size:
            b, c = buf[lead], buf[lead + 1]
            lone = lead[is_word[lead] & (((b == 0xE0) & (c >= 0xB8) & (c <= 0xBB)) | ((b == 0xE3) & (c >= 0x81)) | (b >= 0xE4))]
        begins = ~before | first
        begins[lone] = True
        behind = lone + 3
        begins[behind[behind < buf.size]] = True
        start = np.flatnonzero(is_word & begins)
        after = np.empty_like(is_word)
        after[-1] = False
        after[:-1] = is_word[1:] & ~begins[1:]
        end = np.flatnonzero(is_word & ~after)
        sums = self.byte[x]
        sums *= self.pow[: buf.size]
        np.cumsum(sums, out=sums)
        h = sums[end]
        inner = start > 0
        h[inner] -= sums[start[inner] - 1]
        h *= self.inv[start]
        h += (end - start).astype(np.uint64)
        return mix(h), np.searchsorted(start, offs), start, end + 1


def shingles(h: np.ndarray, word_at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, offset of each document's first). A document of fewer than k words, but any, has one shingle of all of them."""
    n = np.diff(word_at)
    if h.size == 0:
        return h, np.zeros(n.size + 1, np.int64)
    rolled = h.copy()
    for i in range(1, k):
        rolled[: h.size - i] = rolled[: h.size - i] * U(0x9FB21C651E98DF25) + h[i:]
    per = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.zeros(n.size + 1, np.int64)
    np.cumsum(per, out=at[1:])
    # the shingle's place among the words: its document's first word, plus its rank there
    place = np.repeat(word_at[:-1] - at[:-1], per) + np.arange(at[-1])
    out = rolled[place]
    for d in np.flatnonzero((n > 0) & (n < k)):
        v = h[word_at[d]]
        for j in range(word_at[d] + 1, word_at[d + 1]):
            v = v * U(0x9FB21C651E98DF25) + h[j]
        out[at[d]] = v + U(n[d])
    return mix(out), at
