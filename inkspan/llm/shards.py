"""Sharding by a permutation-filled lookup table (the table of Maglev, Eisenbud et al. 2016).

Each shard prefers the slots of a prime-sized table in an order of its own,
(offset + i * skip) mod size; shards take turns to claim their next free slot
until all are taken. Shares differ by one slot at most, and when a shard goes,
few documents of other shards move. The table has a fixed size and is
broadcast; a document's slot is a hash of its id.

Defined cases: a null doc_id is replaced by a digest of the text; null texts
count as empty there; equal ids go to one shard; extra columns pass through,
and a column named like the result's is replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.shared import unused

SIZE, SHARDS = 65537, 64


def names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def fill(shards: list[str], size: int = SIZE) -> np.ndarray:
    """For each slot the index of the shard that owns it. size must be a prime above the number of shards."""
    if not shards or len(set(shards)) != len(shards) or size <= len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("needs distinct shards and a prime size above their number")
    digests = [hashlib.md5(s.encode()).digest() for s in shards]
    at = [int.from_bytes(d[:8], "big") % size for d in digests]
    skip = [int.from_bytes(d[8:], "big") % (size - 1) + 1 for d in digests]
    owner, left = np.full(size, -1, np.int32), size
    while left:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            owner[at[i]] = i
            left -= 1
            if not left:
                break
    return owner


def slot(size: int = SIZE) -> F.Column:
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"), F.lit(size))


def place(docs: DataFrame, shards: list[str] | int = SHARDS, size: int = SIZE, column: str = "shard") -> DataFrame:
    """The rows of docs with the index of their shard."""
    owner = fill(names(shards) if isinstance(shards, int) else shards, size)
    at, number, shard = unused(docs, "__at", "__slot", "__shard")
    lookup = docs.sparkSession.createDataFrame(pd.DataFrame({number: np.arange(size, dtype=np.int64), shard: owner}))
    joined = docs.withColumn(at, slot(size)).join(F.broadcast(lookup), F.col(at) == F.col(number))
    return joined.select(*[f"`{c}`" for c in docs.columns if c.lower() != column.lower()], F.col(shard).cast("int").alias(column))


def oracle_sql(shards: int = SHARDS, size: int = SIZE) -> str:
    """place() in DuckDB; the lookup table is a string with a character for each slot."""
    lookup = "".join(chr(48 + i) for i in fill(names(shards), size)).replace("'", "''")
    return f"""
    WITH t AS (SELECT '{lookup}' AS lookup),
    d AS (SELECT *, ('0x' || md5(coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))))[1:15])::BIGINT % {size} AS slot FROM documents)
    SELECT doc_id, text, lang, source, n_chars, (ascii(substr(lookup, slot + 1, 1)) - 48)::INTEGER AS shard FROM d, t"""
