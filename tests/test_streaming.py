import datetime as dt

from pyspark.sql import functions as F

from inkspan.streaming import events as E

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def claim_rows():
    at = lambda s: T0 + dt.timedelta(seconds=s)
    return [
        (1, 1, "a", "claim", "c1", at(0)), (2, 1, "a", "complete", "c1", at(5)),
        (3, 1, "b", "claim", "c2", at(0)), (4, 1, "b", "claim", "c3", at(10)), (5, 1, "b", "complete", "c3", at(20)),
        (6, 2, "d", "claim", "c4", at(0)), (7, 2, "d", "claim", "c5", at(4000)), (8, 2, "d", "fail", "c4", at(4001)), (9, 2, "d", "fail", "c5", at(4002)),
    ]


SCHEMA = "event_id long, job long, task_key string, kind string, claim_id string, ts timestamp"


def test_claims_hold_until_their_time_runs_out(spark, tmp_path):
    for k, part in enumerate((claim_rows()[:4], claim_rows()[4:])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = E.read(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema)
    q = E.claims(stream).writeStream.format("memory").queryName("claims").outputMode("update").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    last = {}
    for r in spark.table("claims").collect():
        last.setdefault((r.job, r.task_key), set()).add((r.status, r.claim_id))
    assert ("updated", "c1") in last[1, "a"] and ("claimed", "c2") in last[1, "b"] and not any(s == "updated" for s, _ in last[1, "b"]) and ("error", "c5") in last[2, "d"]


def test_a_stream_resumes_from_its_checkpoint_and_skips_what_is_done(spark, tmp_path):
    df = lambda a, b: spark.range(a, b).withColumn("x", F.lit(1))
    work = lambda rows: rows.select("id", F.when(F.col("id") % 5 == 0, "error").otherwise("updated").alias("status"))
    df(0, 10).write.parquet(f"{tmp_path}/in")
    src = lambda: spark.readStream.schema("id long, x int").parquet(f"{tmp_path}/in")
    E.resumed(src(), f"{tmp_path}/done", f"{tmp_path}/c", "id", work)
    df(5, 20).write.mode("append").parquet(f"{tmp_path}/in")
    E.resumed(src(), f"{tmp_path}/done", f"{tmp_path}/c", "id", work)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/done").collect()) == [i for i in range(20) if i % 5]


def test_repeats_are_dropped(spark, tmp_path):
    rows = [(i % 7, T0 + dt.timedelta(seconds=i)) for i in range(50)]
    spark.createDataFrame(rows, "event_id long, ts timestamp").write.parquet(f"{tmp_path}/in")
    stream = E.read(spark, f"{tmp_path}/in", spark.createDataFrame([], "event_id long, ts timestamp").schema)
    assert E.drained(E.first_of_each(stream, "event_id"), f"{tmp_path}/out", f"{tmp_path}/c").count() == 7
