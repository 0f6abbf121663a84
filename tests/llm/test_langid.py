import numpy as np
import pyarrow as pa

from inkspan.llm import kernel as K
from inkspan.llm import langid as L
from tests.llm.conftest import CLASHING

SYLLABLES = {"aa": "ba be bi bo bu", "bb": "ka ke ki ko ku", "cc": "za ze zi zo zu é è", "dd": "ñu ña pli plo"}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(3)) for _ in range(n))


def naive(t):
    raw = K.folded(np.frombuffer((t or "").encode(), np.uint8), L.Grams().fold).tobytes()
    y = b" " + b" ".join(raw.split()) + b" " if raw.split() else b""
    return [y[i : i + L.N] for i in range(len(y) - L.N + 1)]


def test_grams_equal_naive_ones_whatever_stands_beside_them():
    texts = ["Hello, World!", "", "a", "  Ünï çode -- x  ", "12 34 five", "tail. ", "tail.", "ab"]
    for order in (texts, texts[::-1], *([t] for t in texts)):
        raw = [t.encode() for t in order]
        code, at = L.Grams()(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64))
        assert [[int(c).to_bytes(4, "big") for c in code[i:j]] for i, j in zip(at, at[1:])] == [naive(t) for t in order]


def test_all_languages_that_hold_a_gram_are_returned(rng):
    rows = [(x, text(rng, x, 200)) for x in ("aa", "bb")] + [("cc", text(rng, "aa", 200))]
    m = L.fit(rows)
    buf = rows[0][1].encode()
    n, found = L.counts(L.Grams(), m, np.frombuffer(buf, np.uint8), np.array([0, len(buf)]))
    assert found[0][0] == n[0]
    assert 0 < found[0][2] and found[0][1] < n[0] * 0.1
    assert all(0 < r < 0.05 for r in m["rate"])


def test_identify_against_brute_force_on_two_partitionings(spark, rng, make_docs):
    """Sets of n-grams instead of filters: the predictions are the same, and shares differ by what false positives leave."""
    rows = [(i, text(rng, x, rng.randrange(1, 60)), x) for i in range(300) for x in [rng.choice(list(SYLLABLES))]] + [(400, None, None), (401, "", None), (402, "12 !?", None), (403, "qqqq wwww", None), (404, text(rng, "aa", 20_000), "aa")]
    docs = make_docs(rows)
    known = {}
    for lang, t in L.training_rows(docs):
        known.setdefault(lang, set()).update(naive(t))
    languages = sorted(known)
    got = {r.doc_id: r for r in L.identify(docs.repartition(1)).collect()}
    assert got == {r.doc_id: r for r in L.identify(docs.repartition(7, "doc_id")).collect()} and len(got) == len(rows)
    for i, t, _ in rows:
        grams, r = naive(t), got[i]
        assert r.n_grams == len(grams)
        if not grams:
            assert r.share is None and r.predicted == "und"
            continue
        shares = [sum(g in known[x] for g in grams) / len(grams) for x in languages]
        assert abs(r.share - max(shares)) < 0.12 + 1 / len(grams)
        if sorted(shares)[-1] - sorted(shares)[-2] > 0.12 and abs(max(shares) - L.MIN_SHARE) > 0.12:
            assert r.predicted == (languages[shares.index(max(shares))] if max(shares) >= L.MIN_SHARE else "und")


def test_training_rows_stay_within_bytes(spark, rng, make_docs):
    docs = make_docs([(i, "x" * 100, "aa") for i in range(50)] + [(50, None, "aa"), (51, "y", None)])
    assert sum(len(t) for _, t in L.training_rows(docs, 40, 1050)) == 1000 and len(L.training_rows(docs, 7, 10**9)) == 7 and L.training_rows(docs, 7, 50) == []


def test_held_out_accuracy(spark, rng, make_docs):
    rows = [(i, text(rng, x, rng.randrange(3, 80)), x) for i in range(400) for x in [rng.choice(list(SYLLABLES))]]
    got = {r.doc_id: r.predicted for r in L.identify(make_docs(rows), train_rows=150).collect()}
    assert sum(got[i] == x for i, _, x in rows) >= 0.97 * len(rows)


def test_more_than_64_languages(rng):
    rows = [(f"l{i:03d}", " ".join(chr(97 + i % 26) + chr(97 + i // 26) * 3 for _ in range(3))) for i in range(100)]
    m = L.fit(rows)
    assert m["masks"].shape[0] == 2
    raw = [t.encode() for _, t in rows]
    n, found = L.counts(L.Grams(), m, np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64))
    assert L.decide(m, n, found, 0.2)[0] == [x for x, _ in rows]


def test_odd_cases(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, CLASHING)
    got = sorted(((r.doc_id or 0), r.predicted, r.share is None) for r in L.identify(docs).collect())
    assert len(got) == len(odd_rows)
    none = {i for i, p, empty in got if empty}
    assert none == {0, 1, 2, 3, 7, 8} and all(p == "und" for i, p, e in got if e)
    kept = L.identify_filter(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {4, 5, 6, 9, 10}


def test_empty_tables_and_no_labels(spark, make_docs):
    assert L.identify(make_docs([])).count() == 0
    docs = make_docs([(1, "some words here", None)])
    assert [r.predicted for r in L.identify(docs).collect()] == ["und"]
    assert L.identify_filter(docs).count() == 0


def test_batches_with_offsets(rng):
    col = pa.array(["xx", "abc def", None, "ghi"]).slice(1)
    assert [bytes(b) for _, _, b, _ in K.chunks(col)] == [b"abc defghi"]


def test_signs_beyond_ascii_separate_words_and_unspaced_scripts_are_characters():
    def words(t):
        raw = np.frombuffer(t.encode(), np.uint8)
        return K.Words()(raw, np.array([0, raw.size]))[0].tolist()

    assert words("“Été” — «là»…") == words("été là") and len(words("été là")) == 2
    assert len(words("漢字かな交じり文。次")) == 9 and words("a漢b") == [*words("a"), *words("漢"), *words("b")]
    assert len(words("한국어 문장")) == 2 and len(words("ภาษาไทย")) == 7 and words("1º") != words("1")
    assert words("漢") == words("漢漢")[:1] == words("漢漢")[1:]
