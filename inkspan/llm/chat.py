"""Chat formatting with cumulative-snapshot collapse.

Logs often hold a conversation many times, each snapshot a turn longer. A
rolling digest of role and text gives each prefix of a conversation a key; a
conversation whose whole key is the key of a proper prefix of another one is a
snapshot and goes (anti-join), and of equal conversations the least conv_id
stays. What is left is rendered as marked-up turns.

Defined cases: rows with a null conv_id belong to no conversation and are left
out; a null role is "unknown", a null text empty; rows that repeat turn, role
and text count once; turns that share a number are ordered by role and text, a
null number comes first; marks within a text are broken up ("<|" becomes
"< |"); extra columns are ignored; an empty table gives an empty result. A
conversation is one row, so its text must fit a task (Spark's limit is 2 GB);
the references to its prefixes' digests are copied at each turn, which of 10,000
turns comes to some 0.4 GB of copying and is felt beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns (sorted array of turn, role, text) and keys (digest of each prefix) of each conversation."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    whole = rows.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_set(turn)).alias("turns"))
    start = F.struct(F.lit("").alias("last"), F.array().cast("array<string>").alias("keys"))

    def roll(acc: F.Column, t: F.Column) -> F.Column:
        key = F.md5(F.concat(acc["last"], F.md5(t["role"]), F.md5(t["text"])))
        return F.struct(key.alias("last"), F.array_append(acc["keys"], key).alias("keys"))

    return whole.withColumn("keys", F.aggregate("turns", start, roll, lambda acc: acc["keys"]))


def maximal(whole: DataFrame) -> DataFrame:
    """The conversations that are no prefix of another; of equal ones the least conv_id."""
    snapshots = whole.select(F.explode(F.slice("keys", 1, F.size("keys") - 1)).alias("key")).distinct()
    firsts = whole.select("conv_id", F.element_at("keys", -1).alias("key")).groupBy("key").agg(F.min("conv_id").alias("conv_id"))
    kept = firsts.join(snapshots, "key", "left_anti").select("conv_id")
    return whole.join(kept, "conv_id", "left_semi")


def render(whole: DataFrame) -> DataFrame:
    """conv_id, n_turns, rendered."""
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    lines = F.transform("turns", lambda t: F.concat(F.lit("<|im_start|>"), safe(t["role"]), F.lit("\n"), safe(t["text"]), F.lit("<|im_end|>\n")))
    return whole.select("conv_id", F.size("turns").alias("n_turns"), F.array_join(lines, "").alias("rendered"))


def format_chats(rows: DataFrame) -> DataFrame:
    return render(maximal(conversations(rows)))


ORACLE = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT conv_id, string_agg(md5(role) || md5(text), '') OVER w AS prefix, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
kept AS (SELECT min(conv_id) AS conv_id FROM p WHERE k = n AND prefix NOT IN (SELECT prefix FROM p WHERE k < n) GROUP BY prefix)
SELECT conv_id, count(*)::INTEGER AS n_turns, string_agg('<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS rendered
FROM t JOIN kept USING (conv_id) GROUP BY conv_id"""
