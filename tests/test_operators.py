import random

import pytest
from pyspark.sql import functions as F

from inkspan.operators import audits, gazetteer, items, layout, queues, recovery, reports


def test_dictionary_aliases_and_levels(spark):
    legal = spark.createDataFrame([("1100000000", "서울특별시", "s", True), ("1114000000", "서울특별시 중구", "s", True), ("5111000000", "강원특별자치도 춘천시", "s", True), ("4113510300", "경기도 성남시 분당구 정자동", "s", False)], "code string, name string, status string, active boolean")
    matches = spark.createDataFrame([("서울특별시", "중구", "11140"), ("x", None, "1")], "sido_name string, sigungu_name string, admin_code string")
    coords = gazetteer.coordinates(spark.createDataFrame([("1100000000", 127.0, 37.5, "a")], "admin_code string, lon double, lat double, crs string"))
    d = gazetteer.dictionary(legal, matches, coords)
    rows = {(r.key, r.admin_code, r.match_source): r for r in d.collect()}
    base = lambda k, c, s="legal_dong_code": round(rows[k, c, s].base_confidence, 4)
    assert base("서울특별시", "1100000000") == 0.82 and base("서울", "1100000000") == 0.77 and base("서울시", "1100000000") == 0.77
    assert ("중구", "1114000000", "legal_dong_code") not in rows
    assert base("춘천시", "5111000000") == 0.68 and base("강원도춘천시", "5111000000") == 0.77
    assert base("서울특별시중구", "1114000000", "admin_code_match") == 0.76
    assert rows["정자동", "4113510300", "legal_dong_code"].match_level == "eupmyeondong" and rows["서울", "1100000000", "legal_dong_code"].lon == 127.0
    found = gazetteer.spans(spark.createDataFrame([("서울특별시 중구 공고", "서울특별시중구공고")], "text string, folded string"), d).collect()
    assert [(r.start, r.end, r.key) for r in found] == [(0, 7, "서울특별시중구")]


def test_renamed_provinces_score_by_date(spark):
    legal = spark.createDataFrame([("4200000000", "강원도", "", False), ("5100000000", "강원특별자치도", "", True)], "code string, name string, status string, active boolean")
    none = spark.createDataFrame([], "sido_name string, sigungu_name string, admin_code string")
    d = gazetteer.dictionary(legal, none, spark.createDataFrame([], "admin_code string, lon double, lat double, crs string"))
    its = spark.createDataFrame([("a", "2022-01-01", "강원도 고시", None), ("b", "2024-01-01", "강원도 고시", None), ("c", None, "없음", "강원특별자치도")], "item_key string, publication_date string, title string, agency string").withColumn("publication_date", F.to_date("publication_date"))
    got = {(r.item_key, r.field): (r.admin_code, r.temporal_relation) for r in gazetteer.mentions(its, d).collect()}
    assert got["a", "title"] == ("4200000000", "in_validity") and got["b", "title"] == ("5100000000", "in_validity") and got["c", "agency"][1] == "unknown"
    geo = gazetteer.item_geocodes(its, gazetteer.mentions(its, d)).collect()
    assert all(r.geocode_status == "matched" and '"rank":1' in r.geocode_json for r in geo)
    off = gazetteer.match_offline(spark.createDataFrame([("강원도",), ("어딘가",)], "address string"), d).collect()
    assert {r.address: r.needs_service for r in off} == {"강원도": False, "어딘가": True}


def test_spans_against_a_trie_walk(spark):
    rng = random.Random(3)
    keys = {"".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) for _ in range(8)}
    texts = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 20))) for _ in range(60)]

    def walk(t):
        best = [(s, s + max(len(k) for k in keys if t.startswith(k, s))) for s in range(len(t)) if any(t.startswith(k, s) for k in keys)]
        return [(s, e) for s, e in best if not any((a, b) != (s, e) and a <= s and e <= b for a, b in best)]

    df = spark.createDataFrame([(t, t) for t in set(texts)], "text string, folded string")
    got = {}
    for r in gazetteer.spans(df, spark.createDataFrame([(k,) for k in keys], "key string")).collect():
        got.setdefault(r.text, []).append((r.start, r.end))
    assert all(sorted(got.get(t, [])) == walk(t) for t in texts)


def test_weighted_turns_and_their_period():
    assert {n: queues.turns("qwen:4,codex:1,agy:1", 12).count(n) for n in ("qwen", "codex", "agy")} == {"qwen": 8, "codex": 2, "agy": 2}
    for spec in ("a:4,b:1,c:1", "a:2,b:3,c:5,d:1", "x:1", "a:1.5,b:1"):
        c = queues.cycle(spec)
        long = queues.turns(",".join(f"{n}:{c.count(n)}" for n, _ in queues.partition_spec(spec)), 4 * len(c))
        assert long == c * 4
    for bad in ("a", "a:0", "a:1,a:2", ":1"):
        with pytest.raises(ValueError):
            queues.partition_spec(bad)


def test_ordinals_over_many_partitions(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k")).repartition(7)
    assert {(r.k, r.ordinal) for r in queues.ordinal(df, "k").collect()} == {(k, k + 1) for k in range(1000)}
    assert queues.ordinal(df.limit(0), "k").count() == 0


def test_logs_and_claims(spark):
    log = spark.createDataFrame([("a", 1, "updated"), ("a", 2, "error"), ("b", 1, "error"), ("c", 3, "updated_empty")], "k string, n int, status string")
    assert {r.k: r.status for r in queues.replay(log, "k", "n").collect()} == {"a": "error", "b": "error", "c": "updated_empty"}
    assert {r.k: r.status for r in queues.replay(log, "k", "n", True).collect()} == {"a": "updated"}
    checkpoint = spark.createDataFrame([("a", "x"), ("z", "updated"), ("q", "error")], "k string, status string")
    assert {r.k: r.status for r in queues.overlaid(checkpoint, log, "k", "n").collect()} == {"a": "error", "b": "error", "c": "updated_empty", "z": "updated", "q": "error"}
    assert {r.k: r.status for r in queues.overlaid(checkpoint, log, "k", "n", True).collect()} == {"a": "updated", "z": "updated"}
    tasks = spark.createDataFrame([("j", 1, "t1", "claimed", 0.0, "c1"), ("j", 2, "t2", "pending", None, None), ("k", 1, "u1", "claimed", 95.0, "c2"), ("k", 2, "u2", None, None, None)], "job string, ordinal int, task_key string, status string, claimed_at double, claim_id string")
    assert {r.job: r.task_key for r in queues.next_claims(tasks, F.lit(100.0), 50.0).collect()} == {"j": "t1", "k": "u2"}
    w = spark.createDataFrame([("a", None, 0), ("b", "x", 0), ("c", None, 2)], "k string, error string, failed_downloads int")
    assert [r.k for r in queues.completed_windows(w).collect()] == ["a"]
    old = spark.createDataFrame([(None, ["p1", "p2"])], "tasks array<struct<task_key string, item_path string, page_number int>>, items array<string>")
    assert [tuple(t) for t in old.select(queues.legacy_tasks(F.col("tasks"), F.col("items")).alias("t")).first().t] == [("p1", "p1", 1), ("p2", "p2", 1)]
    sel = spark.createDataFrame([("b", 3), ("a", 2), ("c", 9)], "item_path string, pages_total int")
    assert [(r.item_path, r.page) for r in queues.benchmark_pages(sel, 2, 4).orderBy("item_path", "page").collect()] == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def greedy(tables):
    chosen = []
    for t in tables:
        if t["row_count"] < 2 or t["column_count"] < 2 or t["nonempty"] < 2 or (t["strategy"] == "text" and t["density"] < 0.35):
            continue

        def area(b):
            return max(0, b[2] - b[0]) * max(0, b[3] - b[1])

        def same(c):
            a, b = c["bbox"], t["bbox"]
            inter = max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
            whole = area(a) + area(b) - inter
            return (inter / whole if whole else 0) >= 0.9 or (c["raw_rows"] and c["raw_rows"][:3] == t["raw_rows"][:3])

        at = next((i for i, c in enumerate(chosen) if same(c)), None)
        if at is None:
            chosen.append(dict(t))
            continue
        old = chosen[at]
        names = sorted({old["strategy"], t["strategy"], *old["alternate"], *t["alternate"]} - {""})
        score = lambda x: x["text_chars"] + 10 * x["row_count"] + 5 * x["column_count"]
        chosen[at] = dict(t if score(t) > score(old) else old, alternate=names)
    return chosen


def test_distinct_tables_against_a_greedy_loop(spark):
    rng = random.Random(4)
    pages = []
    for p in range(40):
        tables = []
        for _ in range(rng.randrange(8)):
            x, y = rng.choice([0.0, 50.0, 52.0]), rng.choice([0.0, 1.0, 70.0])
            tables.append({"table_id": "", "strategy": rng.choice(["text", "lines", "lines_strict"]), "bbox": [x, y, x + 100, y + 60], "row_count": rng.randrange(1, 4), "column_count": rng.randrange(1, 4), "nonempty": rng.randrange(1, 5), "density": rng.random(), "raw_rows": [[rng.choice("abcdef")]], "text_chars": rng.randrange(30), "alternate": []})
        pages.append((p, tables))
    df = spark.createDataFrame(pages, f"p int, t array<{layout.TABLE}>")
    rows = df.select("p", layout.renumbered(layout.distinct_tables(F.col("t")), F.lit(2)).alias("t")).collect()
    for r in rows:
        want = greedy(pages[r.p][1])
        assert [(x.strategy, x.bbox, x.text_chars, x.alternate) for x in r.t] == [(w["strategy"], w["bbox"], w["text_chars"], w["alternate"]) for w in want]
        assert [x.table_id for x in r.t] == [f"p003-t{i + 1:03d}" for i in range(len(want))]
    assert [s for s, _ in layout.strategies("auto")] == ["lines", "lines_strict", "text"] and layout.strategies("text")[0][1]["min_words_vertical"] == 3
    assert layout.strategies("auto", {"a": 1}) == [("custom", {"a": 1})]
    with pytest.raises(ValueError):
        layout.strategies("best")


def test_table_shape_of_odd_rows(spark):
    df = spark.createDataFrame([([[" a ", None], ["", None], ["1", "2", "3"]],), ([],), (None,)], "r array<array<string>>")
    a, b, c = [x.t for x in df.select(layout.table_shape(F.col("r")).alias("t")).collect()]
    assert (a.row_count, a.column_count, a.nonempty, a.density, a.raw_rows) == (2, 3, 4, 0.6667, [["a", "", ""], ["1", "2", "3"]])
    assert a.records == [{"col_1": "1", "col_2": "2", "col_3": "3"}] and [x.label for x in a.columns] == ["a", "", ""]
    assert (b.row_count, b.column_count, b.density, b.records) == (0, 0, 0.0, [])


def test_recovery_helpers(spark):
    r = spark.createDataFrame([(("s", [("b", "s2", 1)]),)], "r struct<sample_text string, attempts array<struct<backend string, sample_text string, n int>>>")
    out = r.select(recovery.without_samples(F.col("r")).alias("r")).first().r
    assert out.asDict(True) == {"attempts": [{"backend": "b", "n": 1}]}
    assert spark.range(1).select(recovery.scope_signature(F.lit(2), {"dpi": 250, "seed": 17.0, "temp": 0.10})).first()[0] == "first_2_pages:dpi=250:seed=17:temp=0.1"
    its = spark.createDataFrame([(1, True, False), (2, False, False), (3, None, True), (4, None, False)], "i int, needs_ocr boolean, json_error boolean")
    assert [x.i for x in recovery.needs_ocr(its).collect()] == [1, 3]
    e = recovery.eligible(spark.range(6), F.when(F.col("id") % 2 == 0, "even"), "id", 2).orderBy("id").collect()
    assert [(x.reason, x.rank, x.picked) for x in e] == [("even", None, False), (None, 1, True), ("even", None, False), (None, 2, True), ("even", None, False), (None, 3, False)]
    d = spark.createDataFrame([(1,)], "x int")
    assert [d.select(recovery.ask_peers(p, F.array(F.lit("r")))).first()[0] for p in ("off", "uncertain", "always")] == [False, True, True]
    with pytest.raises(ValueError):
        recovery.ask_peers("maybe", F.lit(None))


def test_items_and_audits(spark):
    its = spark.createDataFrame([("a", "x", ("pending", None, None, None, "t0")), ("b", "y", ("failed", "p", 1, "h", None))], "id string, status string, pdf struct<status string, path string, size_bytes long, sha256 string, downloaded_at string>")
    got = {r.id: r for r in items.with_pdf(its, spark.createDataFrame([("a", "q", 9, "s")], "id string, path string, size_bytes long, sha256 string")).collect()}
    assert (got["a"].status, got["a"].pdf.path, got["a"].pdf.downloaded_at) == ("completed", "q", "t0") and got["b"].status == "y"
    only = {r.id: r for r in items.metadata_only(its).collect()}
    assert (only["a"].status, only["a"].pdf.status, only["a"].pdf.path, only["a"].pdf.size_bytes) == ("metadata_only", "skipped", "", 0)
    old, new = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "k int, x string, y string"), spark.createDataFrame([(2, None, "z"), (3, "n", None)], "k int, x string, y string")
    assert {tuple(r) for r in items.upsert(old, new, "k", True).collect()} == {(1, "a", "b"), (2, "c", "z"), (3, "n", None)}
    assert {tuple(r) for r in items.upsert(old, new, "k", False).collect()} == {(1, "a", "b"), (2, None, "z"), (3, "n", None)}
    html = '<a href="/user/common/ofcttCntntDownload.do;jsessionid=1"><a href="/user/common/ofcttDownload.do">'
    ends = spark.createDataFrame([(html, "T", ""), (html, "", "C"), (html, "", ""), ("", "T", "C")], "h string, t string, c string")
    assert [r.e for r in ends.select(items.endpoint(F.col("h"), F.col("t"), F.col("c")).alias("e")).collect()] == ["/user/common/ofcttCntntDownload.do;jsessionid=1", "/user/common/ofcttDownload.do", "error", "error"]
    found = audits.candidates(spark.createDataFrame([("a", "2024-01-02", "artifacts/pdfs/z.pdf")], "id string, date string, path string"), spark.createDataFrame([("artifacts/list/pdfs/z.pdf",), ("root/pdfs/2024/20240102/a.pdf",), ("other/a.pdf",), ("other/q.pdf",)], "path string"), "root")
    assert {(r.path, r.prio) for r in found.collect()} == {("artifacts/list/pdfs/z.pdf", 1), ("root/pdfs/2024/20240102/a.pdf", 2), ("other/a.pdf", 3)}
    st = spark.createDataFrame([("p", "p", "completed", "completed", 1, 1, "h", "h", True), ("artifacts/pdfs/p", "n", "x", "x", 1, 1, "h", "h", True), ("q", "n", "completed", "x", 1, 1, None, "h", True), ("q", None, "x", "x", 1, None, None, None, True), ("q", None, "x", "x", 1, None, None, None, False)], "path string, valid_path string, status string, pdf_status string, size_bytes int, valid_size int, sha256 string, valid_sha string, present boolean")
    assert [r.repair for r in audits.repair_status(st).collect()] == ["already_ok", "repaired_legacy_path", "repaired_existing_pdf", "invalid_pdf", "missing_pdf"]
    m = audits.download_manifest(spark.createDataFrame([("a", "d", "search", "T", ""), ("b", "d", "list", "T", ""), ("c", "d", "search", "", "/v"), ("e", "d", "search", "", "")], "id string, date string, source_detail string, toc_id string, viewer_path string"), F.lit("r"))
    assert {r.id for r in m.collect()} == {"a", "c"}
    y = spark.createDataFrame([("2023-01-01",), ("2024-01-01",), (None,)], "d string")
    assert y.where(audits.year_allowed(F.col("d"), ["2023", "2024"], ["2024"])).count() == 1 and y.where(audits.year_allowed(F.col("d"))).count() == 3
    log = audits.failure_log(spark.createDataFrame([("a", "failed", "e", "t"), ("b", "downloaded", None, "t")], "id string, outcome string, error string, failed_at string"))
    assert [(r.item_id, r.error) for r in log.collect()] == [("a", "e")]
    place = spark.createDataFrame([(("11", "n", ["시", "구", "동"], "p"),)], "c struct<admin_code string, name string, parent_chain array<string>, parent_name string>")
    assert tuple(place.select(items.place_record(F.col("c")).alias("p")).first().p) == ("1100000000", "시", "구", "동", "n")
    k = spark.createDataFrame([("a", None)], "a string, b string")
    assert k.select(items.identity(F.col("a"), F.col("b"))).first()[0] == "a|"
    rep = reports.report({"n": spark.range(2).agg(F.count("*").alias("n"))}, {"s": spark.range(1)}, {"x": 1})
    assert rep == {"counts": {"n": [{"n": 2}]}, "samples": {"s": [{"id": 0}]}, "settings": {"x": 1}}
