"""Faults that show on large tables only, on small ones made for them."""

import random

import duckdb
from pyspark.sql import functions as F

from inkspan import registry
from inkspan.operators import audits, gazetteer
from inkspan.plans import geocode
from inkspan.sources import feeds, files


def test_durations_add_in_order(spark, tmp_path):
    rng, rows = random.Random(7), []
    for user in range(300):
        cents = [rng.randrange(1, 20000) for _ in range(40)]
        cents[-1] += (50 - sum(cents)) % 100  # each sum ends at a half
        rows += [(user, c / 100) for c in cents]
    rows = [(i, user, value) for i, (user, value) in enumerate(sorted(rows, key=lambda _: rng.random()))]
    spark.createDataFrame(rows, "event_id long, user_id long, value double").repartition(7).write.parquet(f"{tmp_path}/events.parquet")
    got = {r["user_id"]: r["duration"] for r in registry.queries()["durations"](spark, str(tmp_path)).collect()}
    c = duckdb.connect(config={"threads": 1})
    c.sql(f"CREATE TABLE events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet' ORDER BY event_id")
    assert got == dict(c.sql(registry.oracle_sql()["durations"]).fetchall())


def test_reference_check_spreads_what_has_not_moved(spark):
    refs = spark.range(4000).select(F.col("id").alias("ref_id"), F.concat(F.when(F.col("id") % 10 == 0, "artifacts/pdfs/").otherwise("artifacts/list/pdfs/"), "id").alias("path"), F.lit(1).cast("long").alias("size_bytes"), F.lit("ok").alias("sha256"))
    files = spark.range(4000).select(F.concat(F.lit("artifacts/list/pdfs/"), "id").alias("path"), F.lit(1).cast("long").alias("size"), F.lit("ok").alias("digest"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = audits.reference_check(refs, files)
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["finding"]: r["count"] for r in found.groupBy("finding").count().collect()} == {"ok": 3600, "migrated": 400}
    assert sum(sizes) == 4000 and max(sizes) < 2000


def planned(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_answers_are_parsed_once(spark, sf_dir):
    assert planned(registry.queries()["address_answers"](spark, sf_dir)).count("from_json") <= 2  # the other one is a literal


def test_tables_places_are_found_once(spark, sf_dir):
    assert planned(registry.queries()["distinct_tables"](spark, sf_dir)).count("array_position") == 1


def test_verdicts_try_objects_only(spark, sf_dir):
    assert planned(registry.queries()["verdicts"](spark, sf_dir)).count("get_json_object") <= 4


def test_items_look_up_ranked_mentions(spark, sf_dir):
    plan = registry.queries()["geocode_place_year_summary"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "distinct" not in plan and "log10" not in plan.lower()
    items = [(str(i), t, a, d) for i, (t, a, d) in enumerate((t, a, d) for t in ("red widget bolt", "", None) for a in ("gizmo bolt", None) for d in ("1996-05-31", "1996-06-01", "1998-12-31", "1999-01-01", "2000-05-31", "2000-06-01", None))]
    df = spark.createDataFrame(items, "item_key string, title string, agency string, publication_date string").withColumn("publication_date", F.to_date("publication_date"))
    got = {(r["item_key"], r["key"], r["field"]): r["admin_name"] for r in gazetteer.mentions(df, geocode.places(spark)).collect()}
    assert [got[k, "redwidget", "title"] for k in ("2", "3")] == ["Red Widget County", "Red Widget City"]
    assert [got[k, "bolt", "title"] for k in ("1", "4", "5")] == ["Bolt Town", "Bolt Town", "Bolt"]
    assert {k for k, _, _ in got} == {i for i, t, a, _ in items if t or a}


def test_plain_list_pages_need_no_parser(monkeypatch):
    fed, rng = [], random.Random(3)
    parser = feeds._Rows.feed
    monkeypatch.setattr(feeds._Rows, "feed", lambda self, text: (fed.append(text), parser(self, text))[1])
    call = lambda i: f"fnDetail('T{i}','A &quot;b&amp;amp; {i}','2024.1.2','b', 'c','d','l','/v?contentId=C{i}&amp;tocId=T{i}','N','')"
    row = lambda i, x: f'<tr><td>1</td><td><a href="#" onclick="{call(i)}">{x}</a></td><td>a &lt; b</td><td>l</td><td>d</td></tr>'
    page = lambda x: '<div id="countArea">3건</div><table id="tableArea"><tbody>' + "".join(row(i, x) for i in range(3)) + "</tbody></table>"
    total, _, rows = feeds.list_rows(page("x"))
    assert total == 3 and [r["id"] for r in rows] == ["T0", "T1", "T2"] and not fed
    bits = ["x", " y\n", "&amp;", "&", "&nbsp", "<", ">", "<b>", "</b>", "<br/>", "<!-- <td> -->", "</td>", "<td>", "<a onclick='fnDetail(1)'>", "<TD>", "<script>", "</script>", "<tr>", "<td class=x>"]
    for _ in range(400):
        html = page("".join(rng.choices(bits, k=rng.randrange(4)))) + "".join(rng.choices(bits, k=rng.randrange(3)))
        slow = feeds._Rows()
        parser(slow, html)
        fast = feeds._fed(html)
        assert (fast.rows, fast.total) == (slow.rows, slow.total), html


def test_pages_of_files_pass_in_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        df = spark.range(5).select(F.col("id").cast("string").alias("path"), F.encode(F.repeat(F.lit("x"), 400_000), "UTF-8").alias("content")).coalesce(1)
        found = files.read_pages(df, "size", {"size": lambda b: [str(len(b))]})
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
        assert sorted((r["path"], r["text"]) for r in found.collect()) == [(str(i), "400000") for i in range(5)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
