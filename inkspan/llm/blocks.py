"""Links within keyed groups of any size, without ever gathering a group: in blocks of a bounded number of bytes.

1. A group of up to `most` bytes is one block: it is searched breadth first, each
   pair being looked at unless already joined or, by what alike knows of the
   block, not alike.
2. A larger group is cut into blocks by a hash of the id. What a block joins is
   represented by its first member, and these heads meet in further rounds, in
   ever fewer blocks, until they fit one or no longer become fewer. Payloads of
   such groups are made once, as a table, which all rounds and step 3 read.
3. Members of one group that are still not joined, through whatever groups, are
   compared across blocks, pair of blocks by pair of blocks, each a task's work;
   pairs that are joined by then are skipped. So no link between members of
   different components is lost, and copies, which joined in the first rounds,
   cost nothing here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.llm.components import components
from inkspan.llm.shared import BROADCAST_BYTES, written

#: Which members of a block are alike to one of them, among those still open (a mask): called once with a block's payloads, it gives near(place, open), which gives places.
Alike = Callable[[list], Callable[[int, np.ndarray], np.ndarray]]
LINK = "key long, a long, b long"


def spread(n: int, alike: Alike, payloads: list) -> np.ndarray:
    """The place of the first member that each of n is joined to, directly or through others."""
    near, label, todo, left = alike(payloads), np.full(n, -1), np.ones(n, bool), n
    for s in range(n):
        if label[s] >= 0:
            continue
        label[s], todo[s], front, left = s, False, [s], left - 1
        while front and left:
            found = near(front.pop(), todo)
            label[found], todo[found], left = s, False, left - found.size
            front.extend(found.tolist())
    return label


def _members(column) -> Iterator[tuple[list[int], list]]:
    """(ids, payloads), by id, of each row of a list column of structs id, v."""
    at, flat = column.offsets.to_numpy(), column.values
    ids, values = flat.field("id").to_numpy(zero_copy_only=False), flat.field("v")
    for i in range(len(column)):
        order = at[i] + np.argsort(ids[at[i] : at[i + 1]], kind="stable")
        yield ids[order], [values[int(k)].as_buffer() for k in order]


def _search(alike: Alike, heads: bool):
    """Rows (key, list of members) to links; with heads also (key, id, id) of each component's first member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple[int, int, int]] = []
            for key, (ids, payloads) in zip(b.column(0).to_pylist(), _members(b.column(1))):
                label = spread(len(ids), alike, payloads)
                first = label == np.arange(len(ids))
                # members are in order of their ids, so the first is the least
                rows += [(key, int(ids[x]), int(ids[label[x]])) for x in np.flatnonzero(~first) if ids[x] != ids[label[x]]]
                if heads:
                    rows += [(key, i, i) for i in np.unique(ids[first]).tolist()]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ((), (), ()))], names=["key", "a", "b"])

    return run


def _across(alike: Alike):
    """Rows (list of members with label and side) to links between the two sides of members whose labels differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple[int, int]] = []
            at, flat = b.column(0).offsets.to_numpy(), b.column(0).values
            ids, labels, sides = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "side"))
            values = flat.field("v")
            for lo, hi in zip(at, at[1:]):
                payloads, side, up = [values[k].as_buffer() for k in range(lo, hi)], sides[lo:hi], labels[lo:hi].copy()
                near, second = alike(payloads), side == 1
                for x in np.flatnonzero(side == 0):
                    for y in near(int(x), second & (up != up[x])):
                        if up[y] != up[x]:
                            rows.append(tuple(sorted((int(ids[lo + x]), int(ids[lo + y])), reverse=True)))
                            up[up == up[y]] = up[x]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ((), ()))], names=["a", "b"])

    return run


def _cut(df: DataFrame, blocks: str) -> DataFrame:
    return df.withColumn("block", F.pmod(F.xxhash64("id"), F.greatest(F.col(blocks), F.lit(1)).cast("long")))


def _sized(members: DataFrame, most: int) -> DataFrame:
    return members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.sum("size") / most).cast("long").alias("blocks")).where("n > 1")


def _joined(members: DataFrame, keys: DataFrame) -> DataFrame:
    return members.join(F.broadcast(keys) if keys.count() * 24 <= BROADCAST_BYTES else keys, "key")


def links(members: DataFrame, payload: Callable[[DataFrame], DataFrame], alike: Alike, most: int, name: str) -> DataFrame:
    """Links (a, b), a > b, which join within each key all that is alike, directly or through others. members: key, id, size (bytes of its payload, about), a table; payload adds the payload (binary) as v to some of them, by id."""
    keys = written(_sized(members, most), f"{name}-keys")
    gather = F.collect_list(F.struct("id", "v")).alias("members")
    grouped = lambda df, *by: df.groupBy(*by).agg(gather).select("key", "members")
    small = _joined(members, keys.where("blocks <= 1"))
    out = grouped(payload(small.select("key", "id")), "key").mapInArrow(_search(alike, False), LINK).select("a", "b")
    if keys.where("blocks > 1").isEmpty():
        return out.distinct()
    parts = [written(out.distinct(), f"{name}-small")]
    whole = written(_joined(members, keys.where("blocks > 1")).select("key", "id", "size"), f"{name}-hot")
    loaded = written(payload(whole.select("id").distinct()), f"{name}-payload")
    level, count = whole, whole.count()
    while True:
        blocks = written(_sized(level, most), f"{name}-level")
        cut = _cut(_joined(level, blocks), "blocks")
        found = written(grouped(cut.select("key", "id", "block").join(loaded, "id"), "key", "block").mapInArrow(_search(alike, True), LINK), f"{name}-found")
        parts.append(found.where("a <> b").select("a", "b"))
        done = blocks.where("blocks > 1").select("key")
        heads = found.where("a = b").select("key", F.col("a").alias("id")).join(done, "key", "left_semi")
        level = written(level.join(heads, ["key", "id"], "left_semi"), f"{name}-heads")
        now = level.count()
        if not now or now * 2 > count:
            break
        count = now
    joined = written(reduce(DataFrame.unionByName, parts).distinct(), f"{name}-joined")
    labelled = whole.join(written(components(joined), f"{name}-components"), "id", "left").select("key", "id", "size", F.coalesce("component", "id").alias("label"))
    apart = written(labelled.groupBy("key").agg(F.sum("size").alias("bytes"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key", F.greatest(F.lit(2), F.ceil(F.col("bytes") * 2 / most)).cast("long").alias("blocks")), f"{name}-apart")
    if apart.isEmpty():
        return joined
    placed = _cut(_joined(labelled, apart), "blocks")
    # block i meets every block j >= i; within a block all was compared if blocks were cut alike, so i meets itself too
    each = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    sides = F.when(F.col("block") < F.col("other"), F.array(F.lit(0))).when(F.col("block") > F.col("other"), F.array(F.lit(1))).otherwise(F.array(F.lit(0), F.lit(1)))
    pairs = each.select("key", "id", "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.explode(sides).alias("side"))
    rest = pairs.join(loaded, "id").groupBy("key", "i", "j").agg(F.collect_list(F.struct("id", "label", "side", "v")).alias("members")).select("members").mapInArrow(_across(alike), "a long, b long")
    return written(joined.unionByName(rest).distinct(), f"{name}-all")
