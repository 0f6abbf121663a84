import re

import numpy as np
import pytest

from tests.llm.conftest import CLASHING, WORDS, prose
from inkspan.llm import decontam as D


def words(t):
    return re.findall(r"[0-9a-z]+", (t or "").lower())


def distance(item, window):
    row = list(range(len(window) + 1))
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(window, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row


def brute(docs, items):
    """Least distance of each item in each document over all starts, where it is allowed."""
    out = {}
    for d, text in docs:
        w = words(text)
        for i, it in items:
            n = len(words(it))
            if not n:
                continue
            e = D.edits_allowed(n)
            best = n + 1
            for s in range(len(w)):
                row = distance(words(it), w[s : s + n + e])
                best = min([best, *row[max(0, n - e) : n + e + 1]])
            if best <= e:
                out[d, i] = best
    return out


def edited(rng, text, k):
    w = text.split()
    for _ in range(k):
        p = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[p] = "zz" + str(rng.randrange(99))
        elif kind == 1:
            w.insert(p, "yy" + str(rng.randrange(99)))
        else:
            del w[p]
    return " ".join(w)


def test_recall_and_precision_against_all_windows(spark, rng):
    items = [(i, prose(rng, n)) for i, n in enumerate([1, 2, 3, 5, 8, 12, 20, 33, 10, 10, 15, 25])]
    items = [(i, t if len(words(t)) > 1 else "uniqueword") for i, t in items]
    docs = []
    for d in range(90):
        i, it = items[d % len(items)]
        n = len(words(it))
        k = rng.randrange(D.edits_allowed(n) + 2)
        docs.append((d, prose(rng, rng.randrange(40)) + " " + edited(rng, it, min(k, n - 1)).upper() + "; " + prose(rng, rng.randrange(40))))
    docs += [(100 + d, prose(rng, 60)) for d in range(20)]
    want = brute(docs, items)
    got = {(r.doc_id, r.item_id): r.distance for r in D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) <= set(want) and all(got[k] >= want[k] for k in got)
    assert len(got) >= 0.95 * len(want) > 50
    kept = {r.doc_id for r in D.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


def test_embedding_ends_alike_for_windows_of_any_length():
    w = np.arange(1, 21, dtype=np.uint64).reshape(1, -1)
    a, b = D.walk(w, 3, 30), D.walk(w[:, :12].copy(), 3, 30)
    inside = b < 11
    assert (a[inside] == b[inside]).all()


def test_odd_cases(spark, make_docs, odd_rows, rng):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, odd_rows[3][1]), (4, odd_rows[3][1]), (None, "never there at all"), (5, "!!")], "item_id long, text string")
    docs = make_docs(odd_rows, CLASHING)
    got = {(r.doc_id, r.item_id, r.distance) for r in D.contaminated(docs, bench).collect()}
    assert got == {(d, i, 0) for d in (4, 5, None) for i in (3, 4)}
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(x for x in (0, 1, 2, 3, 6, 7, 8, 9, 10))


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = make_docs([(1, "a b c d e")])
    assert D.contaminated(docs, none).count() == 0
    assert D.decontaminate(docs, none).count() == 1
    assert D.decontaminate(make_docs([]), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        D.edits_allowed(10, 0.5)


def test_slices_give_what_one_index_gives(spark, rng, monkeypatch):
    items = [(i, prose(rng, 12)) for i in range(30)]
    docs = spark.createDataFrame([(i, prose(rng, 20) + " " + t + " " + prose(rng, 5)) for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(D.contaminated(docs, bench).collect())
    monkeypatch.setattr(D, "SLICE_BYTES", 400)
    assert sorted(D.contaminated(docs, bench).collect()) == whole and len(whole) >= 30
    assert len(WORDS) > 100
