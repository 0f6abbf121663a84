import hashlib
import json
import zlib

import pytest
from pyspark.sql import functions as F

from inkspan.operators import audits as A
from inkspan.sources import feeds, files, records, sinks


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    (path.write_bytes if isinstance(text, bytes) else path.write_text)(text)


def test_items_and_error_rows(spark, tmp_path):
    put(tmp_path / "items/2024/20240101/a.json", '{"id": "a",\n "date": "2024-01-01", "n": 1}')
    put(tmp_path / "items/2024/20240102/b.json", "{broken")
    put(tmp_path / "items/x/c.json", "[1]")
    rows = records.typed_items(spark, f"{tmp_path}/items", "id string, n int").collect()
    assert sorted((r.id or "", r.json_error) for r in rows) == [("", True), ("", True), ("a", False)]


def test_store_overlays_single_files(spark, tmp_path):
    put(tmp_path / "all.json", json.dumps({"a": {"id": "a", "v": 1}, "b": {"id": "b", "v": 1}, "": {"v": 0}}))
    put(tmp_path / "s/1.json", '{"id": "b", "v": 2}')
    put(tmp_path / "s/2.json", '{"id": "b", "v": 3}')
    put(tmp_path / "s/3.json", '{"id": ""}')
    rows = {r.id: json.loads(r.raw)["v"] for r in records.store(spark, f"{tmp_path}/all.json", f"{tmp_path}/s").collect()}
    assert rows == {"a": 1, "b": 3}


def test_manifests(spark, tmp_path):
    put(tmp_path / "m.jsonl", '{"id": "a"}\n\nnot json\n{"id": "b"}\n[2]\n')
    rows = records.manifest(spark, f"{tmp_path}/m.jsonl", "id string").orderBy("line_number").collect()
    assert [(r.line_number, r.id, r.manifest_error is not None) for r in rows] == [(0, "a", False), (2, None, True), (3, "b", False), (4, None, True)]
    assert records.tolerant_lines(spark, f"{tmp_path}/m.jsonl", "id string").where("id is not null").count() == 2
    with pytest.raises(Exception):
        records.strict_lines(spark, f"{tmp_path}/m.jsonl", "id string").collect()
    put(tmp_path / "ok.jsonl", '{"id": "a"}\n{"id": "b"}\n')
    assert [tuple(r) for r in records.strict_lines(spark, f"{tmp_path}/ok.jsonl", "id string").orderBy("id").collect()] == [(1, "a"), (2, "b")]
    put(tmp_path / "list.txt", "# files\n\na/b.pdf\n/c.pdf\n")
    assert {r.path for r in records.listed(spark, f"{tmp_path}/list.txt", "/root/x").collect()} == {"/root/x/a/b.pdf", "/c.pdf"}


def test_point_lookup_reads_one_partition(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-02", "k"), ("b", "2023-05-06", "k"), ("c", "soon", "k")], "id string, date string, category string")
    sinks.items(df, f"{tmp_path}/items")
    assert (tmp_path / "items/year=2024/date_key=20240102").exists() and (tmp_path / "items/year=unknown/date_key=unknown").exists()
    back = spark.read.option("basePath", f"{tmp_path}/items").schema("id string, date string, category string, year string, date_key string").json(f"{tmp_path}/items")
    one = records.lookup(back, "2024", "20240102", "a")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().toString()


def made_pdf(objects, packed=()):
    """A PDF of numbered objects (dictionary, stream or None), some in an object stream."""
    out = b"%PDF-1.5\n"
    if packed:
        heads, bodies = "", b""
        for n, body in packed:
            heads += f"{n} {len(bodies)} "
            bodies += body + b" "
        objects = [*objects, (90, b"/Type /ObjStm /Filter /FlateDecode /N %d /First %d" % (len(packed), len(heads)), heads.encode() + bodies)]
    for n, head, data in objects:
        raw = zlib.compress(data) if data is not None and b"FlateDecode" in head else data
        out += b"%d 0 obj\n<<%s%s>>\n" % (n, head, b"" if raw is None else b" /Length %d" % len(raw))
        out += (b"" if raw is None else b"stream\n" + raw + b"\nendstream\n") + b"endobj\n"
    return out + b" " * 80 + b"\n%%EOF"


PDF = made_pdf([(1, b"/Type /Catalog /Pages 2 0 R", None), (2, b"/Kids [3 0 R]", None), (3, b"/Type /Page /Contents 4 0 R /Resources <</Font <</F 5 0 R>>>>", None), (4, b"/Filter /FlateDecode", b"BT /F 10 Tf 50 700 Td (Hello \\(x\\)) Tj 60 0 Td [(wo) -5 (rld)] TJ ET"), (5, b"/Type /Font /Subtype /Type1 /BaseFont /Batang", None)])
CMAP = b"1 begincodespacerange <0000> <FFFF> endcodespacerange 2 beginbfchar <0001> <AC00> <0002> <B098> endbfchar 2 beginbfrange <0010> <0012> <B2E4> <0020> <0021> [<0041> <D55C AE00>] endbfrange"
GRID = b" ".join(b"100 %d 200 50 re S" % y for y in (600, 550)) + b" 200 550 m 200 650 l S "
KOREAN = made_pdf(
    [(4, b"/Filter /FlateDecode", GRID + b"BT /F 10 Tf 105 630 Td <0001> Tj 100 0 Td <0002> Tj -100 -50 Td <00100012> Tj 100 0 Td <0021> Tj ET q 1 0 0 1 0 -100 cm /X Do Q /I Do"), (6, b"/Filter /ASCIIHexDecode", CMAP.hex().encode() + b">"), (7, b"/Subtype /Form /Resources <</Font <</F 5 0 R>>>>", b"BT /F 10 Tf 1 0 0 1 50 300 Tm <00200099> Tj T* ET"), (8, b"/Subtype /Image /Filter /DCTDecode", b"x")],
    [(1, b"<</Type /Catalog /Pages 2 0 R>>"), (2, b"<</Kids [3 0 R 9 0 R] /Resources <</Font <</F 5 0 R>> /XObject <</X 7 0 R /I 8 0 R>>>>>>"), (3, b"<</Type /Page /Contents [4 0 R]>>"), (5, b"<</Subtype /Type0 /BaseFont /ABC+Batang#20X /ToUnicode 6 0 R>>"), (9, b"<</Type /Page>>")],
)


def test_pdf_objects_maps_and_tables(spark, tmp_path):
    from inkspan.sources import pdf

    first, second = pdf.pages(KOREAN)
    assert first.text() == "가 나\n다닦 한글\nA(cid:153)" and first.images == 1 and second.text() == ""
    assert [w[:2] for w in first.words][:2] == [(105, 630), (205, 630)] and first.words[-1][1] == 200
    assert [(t["bbox"], t["rows"]) for t in first.tables()] == [([100, 550, 300, 650], [["가", "나"], ["다닦", "한글"]])]
    assert pdf.Document(KOREAN).origin() == (["ABC+Batang X"], 1)
    assert pdf.pages(PDF)[0].text() == "Hello (x) world" and pdf.pages(PDF)[0].tables() == []
    with pytest.raises(PermissionError):
        pdf.pages(PDF.replace(b"%%EOF", b"trailer <</Encrypt 9 0 R>> %%EOF"))
    # cut short, without a tree, a stream of unknown length
    assert pdf.pages(PDF[: PDF.index(b"endstream") - 1].replace(b"/Catalog", b"/Nothing"))[0].text() == "Hello (x) world"
    assert pdf.pages(b"%PDF-1.4 nothing") == [] and pdf.Document(b"1 0 obj [ << ( \\ ").origin() == ([], 0)
    put(tmp_path / "k.pdf", KOREAN)
    put(tmp_path / "x.pdf", PDF.replace(b"/FlateDecode", b"/LZWDecode"))
    rows = {r.path[-5]: r for r in files.read_layout(files.pdfs(spark, str(tmp_path))).where("page < 2").collect()}
    assert rows["k"].tables[0].rows == [["가", "나"], ["다닦", "한글"]] and rows["k"].images == 1 and rows["k"].words[0].text == "가"
    assert rows["x"].status == "error" and "LZWDecode" in rows["x"].error


def test_pdf_checks(spark, tmp_path):
    cases = {"good.pdf": PDF, "cut.pdf": PDF[:-5], "late.pdf": b"%PDF-1.4" + b"%%EOF" + b" " * 5000, "not.pdf": b"<html>" + b"%%EOF" * 40, "empty.pdf": b"", "tiny.pdf": b"%PDF-1.4\n%%EOF"}
    for name, body in cases.items():
        put(tmp_path / "p/sub" / name, body)
    put(tmp_path / "p/good.pdf.tmp", PDF)
    found = files.pdfs(spark, f"{tmp_path}/p")
    rows = {r.path.rsplit("/", 1)[1]: r for r in files.checks(found).collect()}
    assert set(rows) == set(cases) - {"empty.pdf"}
    assert {n for n, r in rows.items() if r.ok} == {"good.pdf"} and {n for n, r in rows.items() if r.complete} == {"good.pdf", "tiny.pdf"} and {n for n, r in rows.items() if r.header} == {"good.pdf", "cut.pdf", "late.pdf", "tiny.pdf"}
    assert rows["good.pdf"].digest == hashlib.sha256(PDF).hexdigest()
    assert "content" not in found.select("path", "size")._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    assert {r.x for r in found.select(files.inside(F.col("path"), f"{tmp_path}/p").alias("x")).collect()} == {True}
    b = found.where("path like '%good.pdf'").select(files.body_summary(F.col("content")).alias("b"), files.digital_origin(F.col("content")).alias("o")).first()
    assert b.b.starts_pdf and b.b.pdf_complete and b.b.bytes == len(PDF) and b.o.fonts == ["Batang"] and b.o.has_digital_evidence


def test_pdf_text_readers(spark, tmp_path):
    put(tmp_path / "a.pdf", PDF)
    put(tmp_path / "b.pdf", b"%PDF-1.4\nnothing\n%%EOF")
    found = files.pdfs(spark, str(tmp_path))
    m = {r.path[-5]: r for r in files.text_metadata(files.read_pages(found)).collect()}
    assert m["a"].sample_text == "Hello (x) world" and m["a"].text_extractable and not m["b"].text_extractable and m["b"].status == "ok"
    missing = files.text_metadata(files.read_pages(found, "absent")).collect()
    assert {r.status for r in missing} == {"error"} and "absent" in missing[0].error

    def broken(_):
        raise OSError("page tree")

    assert {r.error for r in files.read_pages(found, "x", {"x": broken}).collect()} == {"OSError: page tree"}


def test_objects_and_plans(spark, tmp_path):
    put(tmp_path / "d/a.txt", "123")
    put(tmp_path / "d/e/b.txt", "1")
    local = records.objects(spark, f"{tmp_path}/d", "pre/")
    assert {tuple(r) for r in local.collect()} == {("pre/a.txt", 3), ("pre/e/b.txt", 1)}
    remote = spark.createDataFrame([("pre/a.txt", 3), ("pre/e/b.txt", 2), ("pre/z", 1)], "key string, size long")
    assert {r.key for r in records.download_plan(remote, local).collect()} == {"pre/e/b.txt", "pre/z"} and records.download_plan(remote, local, True).count() == 3
    assert {r.key: r.action for r in A.sync_plan(local, remote).collect()} == {"pre/a.txt": "keep", "pre/e/b.txt": "upload", "pre/z": "delete"}


def test_config(tmp_path):
    put(tmp_path / "c.yaml", "crawl:\n  delay: 0.2  # seconds\n  retry: true\n  modes:\n    - pdf\n    - metadata\n  name: 'x: y'\npaths:\n  root: /data\nempty:\n")
    c = records.Config.read(f"{tmp_path}/c.yaml")
    assert (c.get("crawl.delay"), c.get("crawl.retry"), c.get("crawl.modes"), c.get("crawl.name"), c.get("paths.root")) == (0.2, True, ["pdf", "metadata"], "x: y", "/data")
    assert c.get("crawl.none", 5) == 5 and c.get("paths.root.deeper") is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", ("ok", 3), {"k": "v"}, "k1", "t"), ("b", ("no", None), None, None, "")], "id string, pdf struct<status string, size int>, tags map<string,string>, category string, title string")
    sinks.csv(df, f"{tmp_path}/csv", "pdf")
    text = b"".join(p.read_bytes() for p in (tmp_path / "csv").glob("*.csv"))
    assert text.startswith("\ufeffid".encode()) and b"pdf_status,pdf_size" in text and b'{\\"k\\":\\"v\\"}' in text
    for _ in range(2):
        sinks.by_category(df, f"{tmp_path}/cat")
        sinks.append_lines(df.select("title", "id"), f"{tmp_path}/log")
    assert sorted(p.name for p in (tmp_path / "cat").iterdir() if p.is_dir()) == ["category=k1", "category=unknown"]
    assert spark.read.json(f"{tmp_path}/log").count() == 4 and all(line.startswith('{"id"') for p in (tmp_path / "log").glob("*.json") for line in p.read_text().splitlines())
    sinks.single({"b": 1, "a": "가"}, f"{tmp_path}/r/report.json")
    assert json.loads((tmp_path / "r/report.json").read_text())["a"] == "가" and not list((tmp_path / "r").glob("*.tmp"))
    sinks.analytics(df.select("id", "title"), "flat_test", "id", 4)
    t = spark.table("flat_test")
    plan = t.join(t.withColumnRenamed("title", "other").hint("merge"), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    sinks.export(df.withColumn("source", F.lit("s")), f"{tmp_path}/hub")
    assert spark.read.parquet(f"{tmp_path}/hub").count() == 2
    raw = spark.createDataFrame([("9", "05"), ("", "x")], "stored_toc_seq string, stored_field_month string")
    assert [(r.id, r.date) for r in sinks.flat_rows(raw).collect()] == [("9", "05")]


def test_search_answers(spark):
    hit = {"stored_toc_seq": "T1", "stored_field_subject": "s", "stored_field_year": "", "keyword_field_regdate": "20240508", "stored_field_url": ""}
    payload = json.dumps({"data": [{"category_name": "c", "count": 2, "list": [hit, hit | {"stored_toc_seq": "T2", "stored_field_url": "/v?a=1&amp;b=2"}]}, {"category_name": "d", "count": "0", "list": None}]})
    df = spark.createDataFrame([(1, payload), (2, "bad")], "page int, payload string")
    rows = feeds.search_items(df).collect()
    assert [(r.id, r.date, r.category, r.viewer_path) for r in rows] == [("T1", "2024-05-08", "c", ""), ("T2", "2024-05-08", "c", "/v?a=1&b=2")]
    assert [tuple(r) for r in feeds.search_groups(df).where("page = 1").select("category_name", "count").collect()] == [("c", 2), ("d", 0)]
    assert df.select(feeds.first_hit(F.col("payload")).alias("h")).first().h.stored_toc_seq == "T2"


def test_list_pages(spark):
    good = "fnDetail('TOC1','제목','2024.1.2','호','공고','기관','법령','/viewer?contentId=C1&amp;tocId=TOC9','N','')"
    row = lambda call, n=5: f"<tr>{'<td>x</td>' * (n - 1)}<td><a href='#' onclick=\"{call}\">t</a></td></tr>"
    html = f"<div id='countArea'>총 1,234건</div><table id='tableArea'><tbody>{row(good)}{row(good, 4)}{row('fnDetail(1)')}</tbody></table><a onclick=\"fnGoPage('7')\">"
    assert feeds.list_rows(html)[:2] == (1234, 7) and feeds.list_rows(None) == (0, 0, [])
    r = feeds.list_items(spark.createDataFrame([(html, "u"), (None, "v")], "html string, url string")).collect()
    assert [(x.id, x.title, x.date, x.agency, x.content_id, x.toc_id, x.source_url) for x in r] == [("TOC9", "제목", "2024-01-02", "기관", "C1", "TOC9", "u")]


def test_paged_data_source(spark):
    spark.dataSource.register(feeds.Paged)
    options = {"feed": "tests.feed_stub:fetch", "fields": "id,page", "combinations": json.dumps([{"year": 2023, "n": 3}, {"year": 2024, "n": 0}])}
    df = spark.read.format("paged_feed").options(**options).load()
    assert sorted(r.id for r in df.collect()) == ["2023-1-0", "2023-1-1", "2023-2-0"]
    assert spark.read.format("paged_feed").options(**options, limit="2").load().count() == 2
    bad = options | {"combinations": json.dumps([{"bad": 1}]), "fallback": "tests.feed_stub:other"}
    assert [r.id for r in spark.read.format("paged_feed").options(**bad).load().collect()] == ["from the list"]


def test_copies_and_fallbacks(spark, tmp_path):
    from inkspan.sources import copies

    put(tmp_path / "s/a/x.bin", b"x" * 100_000)
    put(tmp_path / "s/y.bin", b"")
    put(tmp_path / "t/old.bin", b"1")
    put(tmp_path / "blocked", b"")
    plan = spark.createDataFrame([("a/x.bin", "upload"), ("y.bin", "upload"), ("none.bin", "upload"), ("old.bin", "delete"), ("k", "keep")], "key string, action string")
    rows = {r.key: (r.status, r.bytes, (r.target or "").rsplit("/", 1)[-1]) for r in copies.copied(plan, f"file://{tmp_path}/s", f"file://{tmp_path}/t").collect()}
    assert rows == {"a/x.bin": ("copied", 100_000, "t"), "y.bin": ("copied", 0, "t"), "none.bin": ("error", 0, ""), "old.bin": ("deleted", 0, "t"), "k": ("kept", 0, "")}
    assert (tmp_path / "t/a/x.bin").read_bytes() == b"x" * 100_000 and not (tmp_path / "t/old.bin").exists() and not list(tmp_path.glob("t/**/*.tmp"))
    r = copies.copied(plan.select("key").where("key = 'y.bin'"), f"file://{tmp_path}/s", f"file://{tmp_path}/blocked", f"file://{tmp_path}/u").first()
    assert r.status == "copied" and r.target.endswith("/u")


def test_images(spark, rng=None):
    import numpy as np

    from inkspan.sources import images as im

    g = np.random.default_rng(3)
    colour, gray = g.integers(20, 200, (7, 9, 3), dtype=np.uint8), g.integers(0, 256, (6, 5, 1), dtype=np.uint8)
    for x in (colour, gray):
        assert (im.decoded(im.encoded(x)) == x).all()
    median = im.applied(gray, "median")
    p = np.pad(gray[:, :, 0], 1, mode="edge")
    assert all(median[i, j, 0] == sorted(p[i : i + 3, j : j + 3].ravel())[4] for i in range(6) for j in range(5))
    stretched = im.applied(im.applied(colour, "gray"), "contrast")
    assert stretched.min() == 0 and stretched.max() == 255 and set(np.unique(im.applied(stretched, "threshold"))) <= {0, 255}
    assert im.shrunk(colour, 4).shape == (3, 3, 3) and im.shrunk(colour, 9) is colour
    # every PNG filter
    rows = np.vstack([np.concatenate(([k], r)) for k, r in zip(range(5), g.integers(0, 256, (5, 6), dtype=np.uint8))]).astype(np.uint8)
    assert len(im._predicted(rows.tobytes(), {"Columns": 6})) == 30
    df = spark.createDataFrame([("a", im.encoded(colour)), ("b", b"x"), ("c", None)], "path string, content binary")
    out = {r.path: r for r in im.prepared(df, "binary", 5).collect()}
    assert (out["a"].width, out["a"].height, out["a"].operations) == (5, 4, ["gray", "contrast", "median", "threshold", "max_side_5"]) and out["b"].status == out["c"].status == "error"
    with pytest.raises(ValueError):
        im.prepared(df, "odd")
