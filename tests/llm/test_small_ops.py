"""Mixing, exact dedup, chats, URL rules, sharding."""

import fnmatch
import hashlib
import re
from collections import Counter

import pytest

from inkspan.llm import chat, exact_dedup, mixing, shards, url_filter
from tests.llm.conftest import CLASHING, prose


def water(sizes, weights, budget, epochs):
    """By iteration: give everyone their share, clamp who is over, share out the rest again."""
    got, live, rest = {}, {s for s in sizes if sizes[s] > 0 and weights[s] > 0}, budget
    while live:
        level = rest / sum(weights[s] for s in live)
        over = {s for s in live if level * weights[s] > epochs * sizes[s] * (1 + 1e-12)}
        if not over:
            return got | {s: level * weights[s] for s in live} | {s: 0.0 for s in sizes if s not in got and s not in live}
        for s in over:
            got[s] = epochs * sizes[s]
            rest -= got[s]
        live -= over
    return got | {s: 0.0 for s in sizes if s not in got}


def test_allotments_against_iteration(spark, make_docs, rng):
    for trial in range(4):
        docs = [(i, "x" * rng.randrange(1, 200), "en", f"s{rng.randrange(6)}") for i in range(60)]
        weights = {f"s{k}": rng.choice([0.0, 0.1, 1.0, 5.0]) for k in range(6)}
        sizes = Counter()
        for d in docs:
            sizes[d[3]] += len(d[1])
        budget = rng.choice([0.5, 1, 3, 50]) * sum(sizes.values())
        w = spark.createDataFrame(list(weights.items()), "source string, weight double")
        got = {r.source: r.allotted for r in mixing.allotments(make_docs(docs), w, budget, 4.0).collect()}
        want = water(sizes, {s: weights[s] for s in sizes}, budget, 4.0)
        assert got == pytest.approx({s: want[s] for s in sizes}, rel=1e-9), trial


def test_mix_repeats_whole_and_fractional(spark, make_docs):
    docs = [(i, "x" * 10, "en", "a" if i < 400 else "b") for i in range(800)]
    w = spark.createDataFrame([("a", 5.0), ("b", 1.0)], "source string, weight double")
    rows = mixing.mix(make_docs(docs), weights=w, budget=8000.0, copy_column="copy").collect()
    n = Counter((r.source, r.doc_id) for r in rows)
    per = {s: [n[x] for x in n if x[0] == s] for s in "ab"}
    assert set(per["a"]) <= {1, 2} and set(per["b"]) == {1}
    assert sum(per["a"]) == pytest.approx(8000 * 5 / 6 / 10, rel=0.06) and sum(per["b"]) == pytest.approx(8000 / 6 / 10, rel=0.25)
    assert rows and sorted(rows) == sorted(mixing.mix(make_docs(docs), weights=w, budget=8000.0, copy_column="copy").collect())


def test_mix_odd_cases(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, CLASHING)
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() > 0
    w = spark.createDataFrame([("src0", None), ("src1", -1.0), (None, 2.0)], "source string, weight double")
    assert {r.source for r in mixing.mix(docs, weights=w).collect()} == {None}
    assert mixing.mix(make_docs([])).count() == 0
    assert mixing.mix(make_docs([(1, None), (2, "")])).count() == 0


def test_index_over_sessions_and_batches(spark, make_docs, tmp_path):
    path = f"file://{tmp_path}/index"
    first = exact_dedup.DigestIndex(spark, path, 4)
    assert first.fresh(make_docs([])).count() == 0
    first.absorb(make_docs([(5, "a"), (3, "a"), (9, "b"), (None, "c"), (7, None), (8, "")], CLASHING))
    assert {r.doc_id for r in first.table().collect()} == {3, 9, None, 7}
    spark.sql(f"DROP TABLE {first.name}")
    again = exact_dedup.DigestIndex(spark, path, 64)
    assert again.buckets == 4
    fresh = again.fresh(make_docs([(1, "a"), (20, "d"), (21, "d"), (22, "b"), (23, "x" * 3_000_000)]))
    assert {r.doc_id for r in fresh.collect()} == {20, 23}
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    again.absorb(make_docs([(1, "a"), (20, "d")]))
    assert again.table().count() == 5
    assert [bytes(r.digest) for r in again.table().where("doc_id = 20").collect()] == [hashlib.sha256(b"d").digest()]


def test_index_compacts_and_locks(spark, make_docs, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index", 4)
    for k in range(3):
        index.absorb(make_docs([(10 * k + i, f"t{k + i}") for i in range(5)]))
    before = sorted(map(tuple, index.table().collect()))
    index.compact(8)
    assert sorted(map(tuple, index.table().collect())) == before and len(before) == 7
    again = exact_dedup.DigestIndex(spark, f"file://{tmp_path}/index")
    assert (again.generation, again.buckets) == (1, 8) and len([p for p in tmp_path.glob("index/generation-*")]) == 1
    again.absorb(make_docs([(99, "t0"), (98, "new")]))
    assert again.table().count() == 8
    with again._writing(), pytest.raises(RuntimeError, match="another writer"):
        index.absorb(make_docs([(1, "z")]))
    open(f"{tmp_path}/index/_lock", "w").close()
    with pytest.raises(RuntimeError):
        again.absorb(make_docs([(1, "z")]))
    again.unlock()
    again.absorb(make_docs([(1, "z")]))


def test_mix_clamps_at_skewed_targets(spark, make_docs):
    docs = make_docs([(i, "x" * (1 + i % 50), "en", f"s{i % 13}") for i in range(1300)])
    weights = {r.source: r.weight for r in mixing.target_weights(docs).collect()}
    plan = {r.source: r for r in mixing.allotments(docs, mixing.target_weights(docs), budget_share=mixing.BUDGET_SHARE).collect()}
    sizes = {s: r.size for s, r in plan.items()}
    want = water(sizes, weights, mixing.BUDGET_SHARE * sum(sizes.values()), mixing.MAX_EPOCHS)
    assert {s: r.allotted for s, r in plan.items()} == pytest.approx(want, rel=1e-9)
    assert sum(r.repetitions == mixing.MAX_EPOCHS for r in plan.values()) >= 2 and sum(r.repetitions < 1 for r in plan.values()) >= 2
    n = Counter(r.source for r in mixing.mix(docs, weights=mixing.target_weights(docs), budget_share=mixing.BUDGET_SHARE).collect())
    assert all(n[s] == 400 for s, r in plan.items() if r.repetitions == 4.0)


CHATS = "conv_id long, turn long, role string, text string"


def test_snapshots_collapse(spark):
    rows = []
    full = [("user", "hi"), ("assistant", "hello <|im_end|>"), ("user", "more"), ("assistant", "ok")]
    for conv, n in ((1, 2), (2, 4), (3, 3), (4, 4)):
        rows += [(conv, t, *full[t]) for t in range(n)]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "other")]
    got = {r.conv_id: (r.n_turns, r.rendered) for r in chat.format_chats(spark.createDataFrame(rows, CHATS)).collect()}
    assert set(got) == {2, 5} and got[2][0] == 4
    assert got[2][1].startswith("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello < |im_end|><|im_end|>\n")


def test_chats_against_brute_force(spark, rng):
    rows = [(c, t, rng.choice(["user", "bot"]), rng.choice("xy")) for c in range(120) for t in range(rng.randrange(1, 5))]
    convs = {}
    for c, _, r, x in rows:
        convs.setdefault(c, []).append((r, x))
    want = {c for c, v in convs.items() if not any(len(u) > len(v) and u[: len(v)] == v for u in convs.values()) and c == min(k for k, u in convs.items() if u == v)}
    assert {r.conv_id for r in chat.format_chats(spark.createDataFrame(rows, CHATS)).collect()} == want


def test_chat_odd_cases(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (None, 0, "user", "x"), (2, None, "user", "first"), (2, 1, "user", ""), (3, 5, "b", "2"), (3, 5, "a", "1"), (4, 0, "user", prose(__import__("random").Random(1), 30_000))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], CHATS + ", keys string, turns string")
    got = {r.conv_id: r.rendered for r in chat.format_chats(df).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[1] == "<|im_start|>unknown\n<|im_end|>\n" and got[2].startswith("<|im_start|>user\nfirst") and got[3].index("1") < got[3].index("2")
    assert chat.format_chats(spark.createDataFrame([], CHATS)).count() == 0


def glob_regex(glob):
    return re.compile(b"".join(b".*" if c == 42 else b"." if c == 63 else re.escape(bytes([c])) for c in glob.encode()), re.S)


def test_automaton_against_regular_expressions(rng, monkeypatch):
    import numpy as np

    globs = ["".join(rng.choice("ab*?/") for _ in range(rng.randrange(0, 30))) for _ in range(40)] + ["*" * 70, "a" * 130 + "*", "", "é?"]
    texts = ["".join(rng.choice("ab/é") for _ in range(rng.randrange(0, 12))) for _ in range(200)] + ["a" * 131, "", "éa"]
    raw = [t.encode() for t in texts]
    monkeypatch.setattr(url_filter, "STATE_WORDS", 500)
    parts = list(url_filter.Automaton(globs).match(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)))
    assert len(parts) > 3 and [lo for lo, _ in parts] == np.cumsum([0, *(len(h) for _, h in parts)])[:-1].tolist()
    hits = np.concatenate([h for _, h in parts])
    for j, g in enumerate(globs):
        r = glob_regex(g)
        assert [bool(x) for x in hits[:, j]] == [bool(r.fullmatch(t)) for t in raw], g
    assert fnmatch.fnmatchcase("ab", "a?")


def test_url_odd_cases(spark):
    rows = [(1, None), (2, ""), (3, "HTTPS://WWW.A.com:443/Path//?utm_x=1&q=2#f"), (3, "HTTPS://WWW.A.com:443/Path//?utm_x=1&q=2#f"), (None, "https://m.x.com/"), (5, "https://a.com/" + "x" * 50_000), (6, " http://b.org/?ref=1 ")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, matched string")
    got = {(r.page_id, r.canonical_url): (r.rule, r.allowed) for r in url_filter.judge(df).collect()}
    assert got[1, ""] == got[2, ""] == (None, True)
    assert (3, "https://www.a.com/Path//?q=2") in got or (3, "https://www.a.com/Path/?q=2") in got
    assert got[None, "https://m.x.com/"][1] is False
    assert (6, "http://b.org/") in got
    kept = url_filter.url_filter(df)
    assert kept.columns == df.columns and kept.count() == 6
    assert url_filter.url_filter(df, []).count() == 7 and {r.allowed for r in url_filter.judge(df, []).collect()} == {True}
    assert url_filter.judge(df.limit(0)).count() == 0


def test_canonical_urls(spark):
    want = {"https://blog.foo.com/": "https://blog.foo.com/", "https://blog.foo.com": "https://blog.foo.com/", "HTTP://A.b:80": "http://a.b/", "http://a.b:443/x/": "http://a.b:443/x", "https://a.b:443/x//": "https://a.b/x", "https://a.b:80": "https://a.b:80/",
        "https://a.b?ref=1": "https://a.b/", "https://a.b?x=1/": "https://a.b/?x=1/", "https://a.b/c/?x=1": "https://a.b/c/?x=1", "https://a.b//": "https://a.b/", "a/b/": "a/b", "\t https://a.b/#x ": "https://a.b/", "https://a.b/?utm_x=1&y=/2/&ref=3": "https://a.b/?y=/2/"}
    df = spark.createDataFrame([(i, u) for i, u in enumerate(want)], "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    assert {u: got[i].canonical_url for i, u in enumerate(want)} == want
    # root URLs fall under host/* rules
    assert all(got[i].rule == 3 and not got[i].allowed for i in (0, 1))


def test_many_rules_and_rule_files(spark, tmp_path, rng):
    (tmp_path / "rules.txt").write_text("# rules\n+ https://ok.com/*\n\n- *://*.bad.com/*\n")
    rules = url_filter.read_rules(spark, f"file://{tmp_path}/rules.txt")
    assert rules == [("https://ok.com/*", True), ("*://*.bad.com/*", False)]
    for bad in ("* x", "-"):
        with pytest.raises(ValueError):
            url_filter.parse_rules([bad])
    many = [(f"https://h{k}.com/*", k % 2 == 0) for k in range(3000)] + [("https://h7.com/a*", True)]
    df = spark.createDataFrame([(i, f"https://h{i}.com/a") for i in range(200)], "page_id long, url string")
    got = {r.page_id: (r.matched, r.rule, r.allowed) for r in url_filter.judge(df, many).collect()}
    assert all(got[i] == (f"{i + 1},3001" if i == 7 else str(i + 1), i + 1, i % 2 == 0) for i in range(200))
    assert url_filter.url_filter(df, many).count() == 100


def test_table_is_even_stable_and_minimal():
    a, b = shards.fill(shards.names(10), 1009), shards.fill(shards.names(10)[:9], 1009)
    n = Counter(a.tolist())
    assert set(n.values()) <= {100, 101}
    moved = sum(1 for x, y in zip(a, b) if x != y and x != 9)
    assert moved < 0.12 * 1009
    for bad in (([], 7), (["a", "a"], 7), (["a", "b"], 8), (["a", "b", "c"], 3)):
        with pytest.raises(ValueError):
            shards.fill(*bad)


def test_fill_against_turns_by_hand():
    def by_hand(names, size):
        lists = []
        for s in names:
            d = hashlib.md5(s.encode()).digest()
            o, k = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:], "big") % (size - 1) + 1
            lists.append([(o + i * k) % size for i in range(size)])
        owner = {}
        while len(owner) < size:
            for i, prefs in enumerate(lists):
                free = next((p for p in prefs if p not in owner), None)
                if free is not None:
                    owner[free] = i
        return [owner[i] for i in range(size)]

    assert shards.fill(shards.names(5), 53).tolist() == by_hand(shards.names(5), 53)


def test_sharding_odd_cases(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, CLASHING)
    out = shards.place(docs, 8)
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == len(odd_rows)
    rows = out.collect()
    assert len({r.shard for r in rows if r.doc_id == 4}) == 1 and all(0 <= r.shard < 8 for r in rows)
    assert shards.place(make_docs([])).count() == 0
