"""Sources / sinks (S3, S9-S12) and scalar helpers."""

import json
import os

from pyspark.sql import functions as F

from millrace.functions import scalar as S
from millrace.operators import select as P
from millrace.sources import io


def test_ingest_json_schema_persisted_and_merged(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write(json.dumps({"a": 1, "b": "x"}) + "\n")
    loc = os.path.join(scratch, "schema")
    s1 = io.ingest_json_files(spark, src, loc, max_files=16)
    assert set(s1.schema.fieldNames()) == {"a", "b"}
    with open(os.path.join(src, "b.json"), "w") as fh:
        fh.write(json.dumps({"a": 2, "b": "y", "c": 1.5}) + "\n")
    s2 = io.ingest_json_files(spark, src, loc)
    assert s2.schema.fieldNames()[:2] == s1.schema.fieldNames() and "c" in s2.schema.fieldNames()
    q = io.append_stream(s2, None, os.path.join(scratch, "ck"), {"availableNow": True},
                         path=os.path.join(scratch, "out"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(scratch, "out")).count() == 2


def test_tables_and_databases(spark):
    io.reset_database(spark, "mr_test")
    assert io.database_exists(spark, "mr_test")
    io.write_table(spark.createDataFrame([(1, "a")], "k int, v string"), "mr_test.t")
    io.merge_schema_write(spark.createDataFrame([(2, "b", 3.0)], "k int, v string, w double"), "mr_test.t")
    t = io.read_table(spark, "mr_test.t")
    assert sorted(t.columns) == ["k", "v", "w"] and t.count() == 2
    assert t.filter("k = 1").first()["w"] is None
    io.drop_table(spark, "mr_test.t")
    assert not spark.catalog.tableExists("mr_test.t")
    spark.sql("DROP DATABASE mr_test CASCADE")


def test_stop_all_streams(spark, scratch):
    q = (spark.readStream.format("rate").option("rowsPerSecond", 1).load()
              .writeStream.format("noop").option("checkpointLocation", os.path.join(scratch, "ck"))
              .queryName("rate_probe").start())
    assert any(s.name == "rate_probe" for s in spark.streams.active)
    assert io.stop_all_streams(spark) >= 1
    assert not spark.streams.active
    assert not q.isActive


def test_batches_are_committed_once(spark, scratch):
    src, gold = os.path.join(scratch, "src"), os.path.join(scratch, "gold")

    def run(checkpoint):
        stream = spark.readStream.schema("x int").parquet(src)
        io.run_available_now(io.foreach_batch(stream, io.committed_append(gold), os.path.join(scratch, checkpoint), {"availableNow": True}))

    def seen():
        return sorted(r.x for r in io.read_committed(spark, gold, "x int").collect())

    assert seen() == []
    spark.createDataFrame([(1,), (2,)], "x int").write.parquet(src)
    run("ck1")
    spark.createDataFrame([(3,)], "x int").write.mode("append").parquet(src)
    run("ck1")
    assert seen() == [1, 2, 3] and io.committed_batches(spark, gold).count() == 2
    # a batch replayed after its commit is written once: drop the stream's own record of it
    commits = os.path.join(scratch, "ck1", "commits")
    os.remove(os.path.join(commits, "1"))
    crc = os.path.join(commits, ".1.crc")
    if os.path.exists(crc):
        os.remove(crc)
    run("ck1")
    assert seen() == [1, 2, 3]
    # rows without a commit record are not seen; a new checkpoint adds, never replaces
    spark.createDataFrame([(99,)], "x int").write.parquet(os.path.join(gold, "data-lost"))
    run("ck2")
    assert seen() == [1, 1, 2, 2, 3, 3]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("2024-01-07 13:05:09", 1700000000, '{"k": 12}', "d1")],
                               "s string, e bigint, j string, d string")
    r = df.select(
        S.to_ts("s").alias("ts"), S.epoch_to_ts("e").alias("e"),
        S.hour_of_day(S.to_ts("s")).alias("h"), S.day_of_week(S.to_ts("s")).alias("dow"),
        S.iso_utc(S.to_ts("s")).alias("iso"), S.day_label(S.to_ts("s")).alias("lbl"),
        S.month_start(S.to_ts("s")).alias("m"), S.json_int("j", "k").alias("k"),
        S.to_ts(F.lit("garbage")).alias("bad"),
        S.array_lookup(["A", "B", "C"], "d").alias("pick"),
        S.clip(F.lit(150.0), 0, 100).alias("c"), S.safe_div(F.lit(1), F.lit(0)).alias("z"),
        S.null_flag(F.lit(None)).alias("nf"), S.md5_coin("d").alias("coin")).first()
    assert r.h == 13.0 and r.dow == 1.0          # 2024-01-07 is a Sunday
    assert r.iso == "2024-01-07T13:05:09.000Z" and r.lbl == "7 Jan 2024"
    assert str(r.m) == "2024-01-01 00:00:00" and r.k == 12 and r.bad is None
    assert str(r.e) == "2023-11-14 22:13:20"
    assert r.pick in ("A", "B", "C") and r.c == 100.0 and r.z is None and r.nf == 1
    assert r.coin in (0.0, 1.0)


def test_select_helpers(spark):
    df = spark.createDataFrame([(1, 2.5, "x", 7), (2, None, "y", 8)], "a int, b double, c string, d int")
    t = P.typed_select(df.withColumn("a", F.col("a").cast("string")), "a int, b float")
    assert t.dtypes == [("a", "int"), ("b", "float")]
    assert P.cast_by_type(df, "double", "float").dtypes[1] == ("b", "float")
    assert P.drop_null_rows(df, ["b"]).count() == 1
    # predicate on a column that is not projected
    assert df.select("a").filter(F.col("d") > 7).count() == 1
    assert P.slice_entities(df, "a", [2], ["a", "c"]).collect()[0].c == "y"
    assert P.with_literal(df, "z", 3).first().z == 3
    n = P.hash_sample(spark.range(1000).withColumnRenamed("id", "k"), "k", 30).count()
    assert 200 < n < 400
    assert P.preview(df, 1).count() == 1


def test_load_dir_and_stream_dir(spark, scratch):
    wf = spark.createDataFrame([(1, 10), (2, 12), (3, 9)], "shiftNumber int, employee_count int")
    wf.write.mode("overwrite").option("header", "true").csv(os.path.join(scratch, "wf_csv"))
    got = io.load_dir(spark, os.path.join(scratch, "wf_csv"), fmt="csv", inferSchema="true")
    assert sorted(r.shiftNumber for r in got.collect()) == [1, 2, 3]
    wf.write.mode("overwrite").parquet(os.path.join(scratch, "wf_pq"))
    s = io.read_stream_dir(spark, os.path.join(scratch, "wf_pq"), wf.schema, max_files=1)
    q = io.append_stream(s, None, os.path.join(scratch, "ck2"), {"availableNow": True},
                         path=os.path.join(scratch, "wf_out"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(scratch, "wf_out")).count() == 3
