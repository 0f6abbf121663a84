import math
import re
from collections import Counter

import pytest

from inkspan.llm import word_lm as M
from inkspan.llm.queries import op7_lm_score
from tests.llm.conftest import CLASHING, prose

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, good):
    """Losses by dictionaries."""
    bags = []
    for _, t in docs:
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
        bags.append(list(zip(["", *w], [*w, ""])) if w else [])
    pairs = {"background": Counter(p for b in bags for p in b), "target": Counter(p for b, d in zip(bags, docs) if d[0] in good for p in b)}
    size = sum(pairs["target"].values())
    vocabulary = {w for _, w in pairs["background"]}
    out, models = [], {}
    for name, c in pairs.items():
        scale = size / sum(c.values())
        singles = Counter()
        for (_, w), n in c.items():
            singles[w] += n * scale
        models[name] = {p: n * scale for p, n in c.items()}, singles
    for (d, _), b in zip(docs, bags):
        row = [d, len(b)]
        for name in ("target", "background"):
            c, singles = models[name]
            loss = 0.0
            for v, w in b:
                p = (singles[w] + M.PRIOR / len(vocabulary)) / (size + M.PRIOR)
                loss -= math.log2((c.get((v, w), 0) + M.PRIOR * p) / (singles[v] + M.PRIOR))
            row.append(loss / len(b) if b else None)
        out.append(tuple(row))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in df.collect()), key=key)


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2] or 0)


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        assert g[2:] == (None, None) if w[2] is None else g[2:] == pytest.approx(w[2:], abs=1e-6)


@pytest.mark.parametrize("block_bytes", [100, 5000, 1 << 23])
def test_losses_against_dictionaries(spark, rng, make_docs, block_bytes):
    docs = [(i, prose(rng, rng.randrange(1, 40)) + (" é, 12." if i % 3 else "")) for i in range(40)] + [(50, ""), (51, None), (52, "!! --"), (3, "again"), (None, "none of them"), (None, None)]
    good = set(range(0, 20))
    labels = spark.createDataFrame([(i, int(i in good), 0) for i in range(30)] + [(3, 0, 0), (3, 1, 0)], LABELS)
    same(rows_of(M.score(make_docs(docs, CLASHING), labels, block_bytes=block_bytes)), sorted(brute(docs, good), key=key))


def test_query_tells_words_and_phrases_apart(spark, make_docs, tmp_path):
    """Letters that byte classes merge, and the order of the same words."""
    kinds = ["ж ц ч ж ц ч", "Ж Ц Ч Ж Ц Ч", "red cat sits near", "near sits cat red"]
    docs = [(i, kinds[i % 4]) for i in range(40)]
    labels = [(i, 1 if i % 4 in (0, 2) else 0, 0) for i in range(40)]
    make_docs(docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = op7_lm_score(spark, str(tmp_path))
    score = {r.doc_id: r.score for r in got.collect()}
    assert score[0] < score[1] - 1 and score[2] < score[3] - 1


def test_what_is_gathered_grows_with_the_words(spark, make_docs):
    one = [(i, f"w{i} x{i} y{i}") for i in range(300)]
    labels = spark.createDataFrame([(0, 1, 0)], LABELS)
    same(rows_of(M.score(make_docs(one), labels, block_bytes=500)), sorted(brute(one, {0}), key=key))


def test_no_target_and_empty_tables(spark, make_docs):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (99, 1, 0)], LABELS)
    assert [r.score for r in M.score(make_docs([(1, "abc"), (None, "x")]), labels).collect()] == [None, None]
    assert M.score(make_docs([]), labels).count() == 0
