import itertools
from collections import Counter

import numpy as np

from inkspan.llm import near_dedup as N
from tests.llm.conftest import CLASHING, prose


def shingle_words(t):
    return "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()


def brute(docs):
    """Groups of exact weighted Jaccard at the threshold, with exact document frequencies."""
    bags = {}
    for d, t in docs:
        w = shingle_words(t)
        bags[d] = Counter(tuple(w[i : i + N.SHINGLE]) for i in range(max(1, len(w) - N.SHINGLE + 1))) if w else Counter()
    df = Counter(s for b in bags.values() for s in b)
    n = sum(1 for b in bags.values() if b)
    weight = {d: {s: c * np.log1p(n / (df[s] + N.SMOOTH * n)) for s, c in b.items()} for d, b in bags.items()}
    up = {d: d for d in bags}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    near = []
    for a, b in itertools.combinations(bags, 2):
        x, y = weight[a], weight[b]
        low = sum(min(x[s], y[s]) for s in x if s in y)
        if low and low / (sum(x.values()) + sum(y.values()) - low) >= N.THRESHOLD:
            near.append((a, b))
            ra, rb = sorted((root(a), root(b)))
            up[rb] = ra
    return {d: root(d) for d in bags}, near


def spoiled(rng, t, share):
    return " ".join(prose(rng, 1) if rng.random() < share else w for w in t.split())


def corpus(rng):
    docs = []
    for g in range(25):
        base = prose(rng, rng.randrange(20, 200))
        docs += [spoiled(rng, base, rng.choice([0, 0.02, 0.05, 0.1, 0.2, 0.3])) for _ in range(rng.randrange(1, 6))]
    docs += ["  ".join(docs[0].upper().split()), docs[1] + "!"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_groups_against_all_pairs(spark, rng, make_docs):
    docs = corpus(rng)
    want, near = brute(docs)
    gone = {r.doc_id: r.keep_id for r in N.near_groups(make_docs(docs)).collect()}
    got = {d: gone.get(d, d) for d, _ in docs}
    together = sum(got[a] == got[b] for a, b in near)
    assert together >= 0.97 * len(near) > 30
    assert all(want[d] == want[k] for d, k in gone.items())
    kept = {r.doc_id for r in N.survivors(spark, make_docs(docs)).collect()}
    assert kept == {d for d in got if got[d] == d}


def test_samples_agree_as_often_as_weighted_jaccard_says():
    rng = np.random.default_rng(1)
    sampler = N.Sampler(2000)
    ids = np.sort(rng.choice(1 << 40, 60, replace=False).astype(np.uint64))
    w = rng.random(60) * 3 + 0.1
    v = w * rng.choice([1, 1, 0.4, 2.5], 60)
    a, b = sampler(np.array([0]), ids, w), sampler(np.array([0]), ids[:50], v[:50])
    exact = np.minimum(w[:50], v[:50]).sum() / (np.maximum(w[:50], v[:50]).sum() + w[50:].sum())
    assert abs(float((a == b).mean()) - exact) < 0.05


def test_samples_are_those_of_all_shingles_but_few_are_computed():
    """Half the near-dedup's time went into computing a for each sample of each shingle."""
    import time

    def plain(s, doc_at, ids, weight):
        ln_w, spread, columns = np.log(weight).astype(np.float32), N.K.mix(ids), []
        for odd in s.odd:
            i = ((spread * odd) >> np.uint64(48)).astype(np.int64)
            t = np.floor(ln_w * s.inv_r[i] + s.beta[i])
            a = np.maximum(s.ln_c[i] - s.r[i] * (t - s.beta[i] + 1) + np.float32(512), np.float32(1e-3))
            order = (a.view(np.uint32).astype(np.uint64) << np.uint64(32)) | np.arange(ids.size, dtype=np.uint64)
            least = (np.minimum.reduceat(order, doc_at) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            columns.append(N.K.mix(spread[least] * np.uint64(0x9E3779B97F4A7C15) + t[least].astype(np.int64).astype(np.uint64)))
        return np.stack(columns, axis=1)

    rng, took = np.random.default_rng(4), {plain: [], N.Sampler.__call__: []}
    n = np.concatenate((np.ones(50, int), rng.lognormal(6, 1, 300).astype(int) + 1))
    at, ids = np.cumsum(n) - n, rng.integers(0, 1 << 44, n.sum(), dtype=np.uint64)
    for weight in (rng.integers(1, 4, ids.size) * (rng.random(ids.size) * 4 + 0.02), np.full(ids.size, 0.016), rng.random(ids.size) * 1e4):
        got = {}
        for how in took:
            began = time.thread_time()
            got[how] = how(N.Sampler(48), at, ids, weight)
            took[how].append(time.thread_time() - began)
        assert (got[plain] == got[N.Sampler.__call__]).all()
    assert sum(took[N.Sampler.__call__]) < 0.8 * sum(took[plain])


def test_payloads_of_large_groups_are_made_once(spark):
    """Each round, and the comparison across blocks, read all texts again; across blocks they were shuffled too."""
    from inkspan.llm.blocks import links
    from inkspan.llm.components import components

    asked = []
    values = spark.range(60).selectExpr("id", "cast(cast(id % 7 as string) as binary) as v")

    def payload(some):
        asked.append(some.columns)
        return some.join(values, "id")

    def alike(payloads):
        digits = np.array([int(bytes(v)) for v in payloads])
        return lambda x, open_: np.flatnonzero(open_ & (np.abs(digits - digits[x]) % 5 == 0))

    members = spark.range(60).selectExpr("cast(0 as bigint) as key", "id", "100 as size").unionByName(spark.range(4).selectExpr("cast(1 as bigint) as key", "id", "100 as size"))
    got = {r.id: r.component for r in components(links(members, payload, alike, 1000, "once")).collect()}
    assert got == {i: {5: 0, 6: 1}.get(i % 7, i % 7) for i in range(60)}
    assert len(asked) == 2


def test_a_large_group_leaves_one(spark, rng, make_docs):
    base = prose(rng, 60)
    docs = [(i, spoiled(rng, base, 0.03)) for i in range(200)] + [(1000 + i, prose(rng, 40)) for i in range(2000)]
    kept = {r.doc_id for r in N.near_dedup(make_docs(docs)).collect()}
    assert kept >= {0, *range(1000, 3000)}
    assert len(kept) <= 2001 + 4  # 2 % of the group may lie under the threshold


def test_odd_cases(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, CLASHING)
    kept = N.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 6, 7, 8, 9, 10]


def test_empty_tables(spark, make_docs):
    assert N.near_dedup(make_docs([])).count() == 0
    assert N.survivors(spark, make_docs([])).count() == 0
    assert N.near_dedup(make_docs([(1, None), (2, "")])).count() == 2


def test_blocks_of_any_size_find_the_same_groups(spark, rng, make_docs, monkeypatch):
    """Groups that take many blocks: near copies that join at once, and a chain whose members agree with few others."""
    base = prose(rng, 80)
    docs = [(i, spoiled(rng, base, 0.05)) for i in range(120)]
    words = prose(rng, 500).split()
    docs += [(1000 + i, " ".join(words[4 * i : 4 * i + 40])) for i in range(100)] + [(5000 + i, prose(rng, 30)) for i in range(50)]
    frame = make_docs(docs)
    n, df = N.document_frequencies(frame)
    want, near = brute(docs)
    one = frame.selectExpr("doc_id as id", "cast(0 as bigint) as component")
    for most in (1 << 20, 3000):
        from inkspan.llm.components import components

        got = {r.id: r.component for r in components(N.exact_links(frame, one, n, df, N.SHINGLE, N.THRESHOLD, most)).collect()}
        assert {d: got.get(d, d) for d, _ in docs} == want, most
    assert len({want[1000 + i] for i in range(100)}) < 60
    monkeypatch.setattr(N, "SIGNATURE_BLOCK", 400)
    monkeypatch.setattr(N.coarse_links, "__defaults__", (400,))
    monkeypatch.setattr(N.exact_links, "__defaults__", (3000,))
    small = {r.doc_id: r.keep_id for r in N.near_groups(frame).collect()}
    monkeypatch.undo()
    assert small == {r.doc_id: r.keep_id for r in N.near_groups(frame).collect()}
    assert all(want[d] == want[k] for d, k in small.items()) and len(small) >= 0.95 * sum(want[d] != d for d, _ in docs)


def test_intermediate_tables_go(spark, make_docs, rng, tmp_path):
    import os

    from inkspan.llm.shared import shared_dir

    at = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(at)) if os.path.exists(at) else set()
    base = prose(rng, 50)
    assert N.near_groups(make_docs([(1, base), (2, base + " x"), (3, prose(rng, 50))])).count() == 1
    assert [x.split("-")[1] for x in set(os.listdir(at)) - before] == ["groups"]


def test_short_texts_that_share_a_line_are_not_compared_pair_by_pair(spark, rng, make_docs):
    """One coarse component of 6,000: comparing all its pairs took minutes."""
    import time

    line = prose(rng, 8)
    docs = [(i, line + "\n" + " ".join(f"w{rng.randrange(10**6)}" for _ in range(12))) for i in range(6000)]
    docs += [(10_000 + i, docs[i][1] + " end") for i in range(40)]
    frame = make_docs(docs)
    n, df = N.document_frequencies(frame)
    began = time.time()
    found = {(r.a, r.b) for r in N.exact_links(frame, frame.selectExpr("doc_id as id", "cast(0 as bigint) as component"), n, df, N.SHINGLE, N.THRESHOLD).collect()}
    assert found == {(10_000 + i, i) for i in range(40)}
    assert time.time() - began < 60


def test_overlaps_are_those_of_all_pairs():
    rng = np.random.default_rng(3)
    pack = lambda ids, w: ids.astype(np.uint64).tobytes() + w.astype(np.float32).tobytes()
    blocks, found = [], 0
    for _ in range(20):
        block = [pack(np.zeros(0), np.zeros(0))] * 2
        for _ in range(30):
            base = rng.choice(300, rng.integers(1, 60), replace=False)
            for _ in range(rng.integers(1, 6)):
                ids = np.unique(np.where(rng.random(base.size) < rng.random() * 0.4, rng.integers(0, 300, base.size), base))
                block.append(pack(ids, rng.random(ids.size) * 0.2 + rng.choice([1, 4], ids.size)))
        blocks.append(block)
    for block, share in zip([*blocks, *(b[:5] for b in blocks)], [0.05, 0.5, 1] * 20):
        near, open_ = N.overlapping(N.THRESHOLD)(block), rng.random(len(block)) < share
        vectors = [N.unpacked(v) for v in block]
        for x in range(len(block)):
            want = [y for y in np.flatnonzero(open_) if N.weighted_jaccard(vectors[x], vectors[y]) >= N.THRESHOLD]
            assert near(x, open_).tolist() == want
            found += len(want)
    assert found > 500
