"""URL filters by a bit-parallel wildcard automaton.

All glob rules (* any bytes, ? one byte) are packed into one multiword
Shift-And automaton: a bit for each state, a rule's states in a row. One step
reads one byte of a URL and advances every rule at once: the state words are
shifted (with carry between words), masked by the byte's mask, and states that
stand before a star stay. Steps are vectorised over all URLs of a batch.

URLs are matched whole, in canonical form: trimmed, without fragment, scheme
and host in lower case, the scheme's default port, tracking parameters (utm_*,
ref, gclid, fbclid) and slashes at the end of a URL without query removed; after a
host stands at least the root's slash. Of the rules that match, the first in
the list decides; a URL that none matches is allowed.

Defined cases: a null URL counts as empty; an empty URL matches only globs of
stars; bytes beyond ASCII match themselves, ? matches one of them; repeated
rows are each decided; without rules everything is allowed; extra columns pass
through url_filter; however many rules there are, states are held for a slice
of the URLs at a time; a URL takes a step a byte, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm import kernel as K

#: (glob, allow); a rule's number is its place, from 1.
RULES = [
    ("https://*.example.org/*", True),
    ("*://m.*", False),
    ("*://blog.*/*", False),
    ("*.example.net/de/*", False),
    ("*/??/1??", False),
    ("*?page=*", False),
    ("*/es/*9*", False),
    ("http://*", True),
    ("*.example.com/fr/???", False),
    ("*th*in*.example.com/*", False),
]
U = np.uint64
#: Words of automaton state that are held at once.
STATE_WORDS = 1 << 20


class Automaton:
    def __init__(self, globs: list[str]) -> None:
        states: list[tuple[int | None, bool]] = []  # byte that leads here (None: the start, -1: any), whether it loops
        self.accept = []
        for glob in globs:
            states.append((None, False))
            for c in glob.encode():
                if c == ord("*"):
                    states[-1] = (states[-1][0], True)
                else:
                    states.append((-1 if c == ord("?") else c, False))
            self.accept.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.byte = np.zeros((256, self.words), np.uint64)
        self.loop, self.start = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        for i, (c, loops) in enumerate(states):
            bit, w = U(1) << U(i % 64), i // 64
            if c is None:
                self.start[w] |= bit
            elif c < 0:
                self.byte[:, w] |= bit
            else:
                self.byte[c, w] |= bit
            if loops:
                self.loop[w] |= bit

    def match(self, buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first text, which globs match: texts by globs) of slices of the texts, so small that states and results stay within STATE_WORDS."""
        most = max(1, STATE_WORDS // max(self.words, len(self.accept) // 8 + 1))
        accept = np.array(self.accept, np.int64)
        for lo in range(0, offs.size - 1, most):
            at = offs[lo : lo + most + 1]
            size = np.diff(at)
            order = np.argsort(-size, kind="stable")
            begin, size = at[:-1][order], size[order]
            d = np.tile(self.start, (order.size, 1))
            for step in range(int(size[0])):
                n = int(np.searchsorted(-size, -step))
                now = d[:n]
                shifted = now << U(1)
                shifted[:, 1:] |= now[:, :-1] >> U(63)
                shifted &= self.byte[buf[begin[:n] + step]]
                d[:n] = shifted | (now & self.loop)
            out = np.empty((order.size, accept.size), bool)
            out[order] = (d[:, accept // 64] >> (accept % 64).astype(U)) & U(1) != 0
            yield lo, out


def parse_rules(lines: Iterable[str]) -> list[tuple[str, bool]]:
    """Rules from lines: "+ glob" allows, "- glob" blocks; blank lines and those that begin with # don't count."""
    rules = []
    for number, line in enumerate(lines, 1):
        line = line.strip()
        if line and not line.startswith("#"):
            sign, _, glob = line.partition(" ")
            if sign not in ("+", "-") or not glob.strip():
                raise ValueError(f"line {number} is no rule: {line}")
            rules.append((glob.strip(), sign == "+"))
    return rules


def read_rules(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """The rules of a file on any of Spark's file systems. They are held by the driver and each Python worker: about 2 KB a rule of 30 bytes."""
    return parse_rules("".join(r[0] for r in spark.read.text(path, wholetext=True).collect()).splitlines())


def canonical(url: F.Column) -> F.Column:
    whole = F.regexp_replace(F.ltrim(F.coalesce(url, F.lit("")), F.lit(" \t\r\n")), r"(?s)#.*$", "")
    whole = F.rtrim(whole, F.lit(" \t\r\n"))
    head = F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    return F.transform(F.array(F.struct(whole.alias("u"), head.alias("h"))), lambda x: F.concat(_host(x["h"]), _rest(x)))[0]


def _host(head: F.Column) -> F.Column:
    """Scheme and host without the scheme's default port."""
    return F.regexp_replace(F.regexp_replace(F.lower(head), "^(http://.*):80$", "$1"), "^(https://.*):443$", "$1")


def _rest(x: F.Column) -> F.Column:
    """What follows the host: without tracking parameters, without slashes at the end of a path that no query follows; at least the root's slash after a host."""
    rest = F.substring(x["u"], F.length(x["h"]) + 1, F.length(x["u"]))
    rest = F.regexp_replace(rest, r"([?&])(utm_[^=&]*|ref|gclid|fbclid)=[^&]*", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, r"([?&])&+", "$1"), r"[?&]+$", "")
    rest = F.regexp_replace(rest, r"^([^?]*[^?/])?/+$", "$1")
    return F.when((x["h"] != "") & ~F.startswith(rest, F.lit("/")), F.concat(F.lit("/"), rest)).otherwise(rest)


def matched(spark: SparkSession, rules: list[tuple[str, bool]]):
    """Column of canonical URLs to a struct: the numbers, from 1, of the globs that match, the first of them, and whether it allows the URL."""
    shipped = spark.sparkContext.broadcast((Automaton([g for g, _ in rules]), np.array([True, *(a for _, a in rules)])))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton, allow = shipped.value
        for col in batches:
            sizes, values, first = [np.zeros(1, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            for _, _, buf, offs in K.chunks(col):
                for _, hit in automaton.match(buf, offs):
                    sizes.append(hit.sum(axis=1))
                    values.append(np.nonzero(hit)[1] + 1)
                    first.append(np.where(hit.any(axis=1), hit.argmax(axis=1) + 1, 0) if len(rules) else np.zeros(len(hit), np.int64))
            rule = np.concatenate(first).astype(np.int32)
            hits = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)), pa.int32()), pa.array(np.concatenate(values), pa.int32()))
            yield pa.StructArray.from_arrays([hits, pa.array(rule, mask=rule == 0), pa.array(allow[rule])], ["matched", "rule", "allowed"])

    return F.arrow_udf(run, "matched array<int>, rule int, allowed boolean")


def judge(pages: DataFrame, rules: list[tuple[str, bool]] = RULES) -> DataFrame:
    """page_id, canonical_url, matched (numbers of the matching rules, comma-separated), rule (the deciding one, or null), allowed, for every row."""
    at = pages.select("page_id", canonical(F.col("url").cast("string")).alias("canonical_url"))
    hits = at.withColumn("m", matched(pages.sparkSession, rules)(F.col("canonical_url")))
    return hits.select("page_id", "canonical_url", F.array_join(F.col("m.matched").cast("array<string>"), ",").alias("matched"), "m.rule", "m.allowed")


def url_filter(pages: DataFrame, rules: list[tuple[str, bool]] = RULES) -> DataFrame:
    """The rows of pages, with all their columns, that the rules allow."""
    return pages.where(matched(pages.sparkSession, rules)(canonical(F.col("url").cast("string")))["allowed"]) if rules else pages


def oracle_sql(rules: list[tuple[str, bool]] = RULES) -> str:
    """judge() in DuckDB, a regular expression for each rule; ? there is a character, so URLs are to be ASCII."""

    def regex(glob: str) -> str:
        return "^" + "".join(".*" if c == "*" else "." if c == "?" else c if c.isalnum() or c in "/:&=_-" else "\\" + c for c in glob) + "$"

    hits = ", ".join(f"CASE WHEN regexp_matches(canonical_url, '{regex(g)}', 's') THEN {i} END" for i, (g, _) in enumerate(rules, 1))
    allow = " ".join(f"WHEN {i} THEN {str(a).lower()}" for i, (_, a) in enumerate(rules, 1))
    return rf"""
    WITH a AS (SELECT page_id, rtrim(regexp_replace(ltrim(coalesce(url, ''), chr(32) || chr(9) || chr(13) || chr(10)), '#.*$', '', 's'), chr(32) || chr(9) || chr(13) || chr(10)) AS u FROM pages),
    b AS (SELECT *, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*') AS h FROM a),
    r AS (SELECT page_id, regexp_replace(regexp_replace(lower(h), '^(http://.*):80$', '\1'), '^(https://.*):443$', '\1') AS h, regexp_replace(regexp_replace(regexp_replace(regexp_replace(substr(u, length(h) + 1),
        '([?&])(utm_[^=&]*|ref|gclid|fbclid)=[^&]*', '\1', 'g'), '([?&])&+', '\1', 'g'), '[?&]+$', ''), '^([^?]*[^?/])?/+$', '\1') AS rest FROM b),
    c AS (SELECT page_id, h || CASE WHEN h <> '' AND rest NOT LIKE '/%' THEN '/' ELSE '' END || rest AS canonical_url FROM r),
    m AS (SELECT page_id, canonical_url, list_filter([{hits}], lambda x: x IS NOT NULL) AS m FROM c)
    SELECT page_id, canonical_url, array_to_string(m, ',') AS matched, m[1]::INTEGER AS rule, coalesce(CASE m[1] {allow} END, true) AS allowed FROM m"""
