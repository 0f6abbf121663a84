import corpus_pipeline as P
from inkspan.llm import decontam, langid, mixing, near_dedup, queries, shards
from tests.llm.conftest import CLASHING, prose
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_near_dedup import brute as groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, folder, docs, items):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")


def test_stages_against_brute_force(spark, rng, make_docs, tmp_path):
    items = [(i, prose(rng, 15)) for i in range(6)]
    base = [prose(rng, rng.randrange(30, 70)) for _ in range(50)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)] + [(100 + i, t + " end", "en", "s0") for i, t in enumerate(base[:20])]
    rows += [(200 + i, prose(rng, 20) + " " + t + " " + prose(rng, 9), "en", "s1") for i, (_, t) in enumerate(items)] + [(300 + i, "12345 -- 67", "en", "s2") for i in range(3)]
    write(spark, tmp_path, make_docs(rows), items)
    kept = [(r[0], r[1]) for r in rows if r[0] < 300]
    leader, _ = groups(kept)
    kept = [(d, t) for d, t in kept if leader[d] == d]
    leaked = {d for d, _ in leaks(kept, items)}
    want = {d for d, _ in kept} - leaked
    assert leaked == {200 + i for i in range(6)} and len(want) == 50
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in P.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS, name
    assert {r.doc_id for r in docs.collect()} == want
    mixed = mixing.mix(docs, weights=mixing.target_weights(docs), budget_share=mixing.BUDGET_SHARE)
    final = P.run(spark, str(tmp_path))
    assert final.columns == [*COLUMNS, "shard"]
    owner, slot = shards.fill(shards.names(shards.SHARDS)), None
    import hashlib

    for r in final.collect():
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % shards.SIZE
        assert r.shard == owner[slot]
    assert sorted(r.doc_id for r in final.collect()) == sorted(r.doc_id for r in mixed.collect())


def test_stages_on_odd_rows_and_empty_tables(spark, make_docs, odd_rows, tmp_path):
    items = [(None, None), (1, "")]
    for docs in (make_docs(odd_rows, CLASHING), make_docs([], CLASHING), make_docs([(1, None), (2, None)])):
        write(spark, tmp_path, docs, items)
        for name, stage in P.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert set(docs.columns) <= set(out.columns), name
            rows = out.collect()
            ids = {r.doc_id for r in docs.collect()}
            assert {r.doc_id for r in rows} <= ids
            if name in ("near duplicates", "decontamination", "sharding"):
                # nothing but copies goes: of these, documents 4 and 5 and their repeats
                assert ids - {r.doc_id for r in rows} == ({5} if name == "near duplicates" and 5 in ids else set()), name
        final = P.run(spark, str(tmp_path)).collect()
        assert {r.doc_id for r in final} <= ids and all(0 <= r.shard < shards.SHARDS for r in final)


def test_pipeline_and_queries_are_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(queries.ORACLE) <= set(names)
    assert [s for s, _ in P.STAGES] == ["language ID", "near duplicates", "decontamination", "mixing", "sharding"]
    assert all((langid, near_dedup, decontam))


def test_near_duplicates_among_short_texts_that_chain_through_a_line(spark, rng, make_docs, tmp_path):
    """The stage's coarse links join these into one component, whose pairs took minutes each by itself."""
    import time

    line = prose(rng, 30)
    words = lambda k: " ".join(f"w{rng.randrange(10**6)}" for _ in range(k))
    rows = [(i, line + "\n" + words(7)) for i in range(6000)] + [(10_000 + i, words(20)) for i in range(12_000)]
    rows += [(30_000 + i, rows[i][1] + " end") for i in range(40)]
    began = time.time()
    kept = {r.doc_id for r in P.near_duplicates(spark, make_docs(rows), str(tmp_path)).select("doc_id").collect()}
    assert kept >= {r[0] for r in rows[:18_000]}
    assert len(kept) <= 18_000 + 1  # one of 40 may share no band
    assert time.time() - began < 120
