"""Streaming OEE: late data handling and stream = batch on closed windows."""

import json
import os

from pyspark.sql import functions as F

from millrace.plans import oee
from millrace.streaming.oee import run_oee


def _doc(ts, plant="P", line="L1", shift=1, parts=10, bad=1, health="Healthy"):
    body = {"applicationId": "a", "deviceId": "d",
            "messageProperties": {"iothub-connection-device-id": "d",
                                  "iothub-creation-time-utc": ts, "iothub-interface-id": ""},
            "telemetry": {"batchNumber": 1, "cpuLoad": 1.0, "defectivePartsMade": bad,
                          "machineHealth": health, "messageTimestamp": ts, "oilLevel": 90.0,
                          "plantName": plant, "productionLine": line, "shiftNumber": shift,
                          "systemDiskFreePercent": 50, "systemDiskUsedPercent": 50,
                          "temperature": 80.0, "totalPartsMade": parts}}
    return json.dumps({"body": json.dumps(body)})


def _write(d, name, docs):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write("\n".join(docs) + "\n")


def test_late_rows_dropped_after_watermark(spark, scratch):
    src = os.path.join(scratch, "in")
    wf = spark.createDataFrame([(1, 5)], "shiftNumber bigint, employee_count bigint")
    # batch 1: events up to 10:30 -> watermark 10:20 afterwards
    _write(src, "f1.json", [_doc("2024-01-01T10:01:00.000000Z"), _doc("2024-01-01T10:30:00.000000Z")])
    paths = run_oee(spark, src, os.path.join(scratch, "work"), wf, max_files=1)
    # batch 2: one row far behind the watermark (10:02, window 10:00 already
    # closed -> dropped) and one inside the lateness (10:26, counted)
    _write(src, "f2.json", [_doc("2024-01-01T10:02:00.000000Z", parts=1000),
                            _doc("2024-01-01T10:26:00.000000Z", parts=7),
                            _doc("2024-01-01T10:50:00.000000Z")])
    paths = run_oee(spark, src, os.path.join(scratch, "work"), wf, max_files=1)
    gold = spark.read.parquet(paths["gold"])
    got = {str(r["start"])[11:16]: r["totalPartsMade"] for r in
           gold.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "totalPartsMade").collect()}
    assert got["10:00"] == 10          # the late 1000 parts were not added
    assert got["10:25"] == 7           # late but within 10 minutes: counted
    assert "10:30" in got              # closed by the 10:50 event (watermark 10:40)
    assert "10:50" not in got          # still open


def test_malformed_and_rule_failures_dropped(spark):
    bronze = spark.createDataFrame([
        (json.loads(_doc("2024-01-01T10:01:00.000000Z"))["body"],),
        ("{not json",),
        (json.loads(_doc("2024-01-01T10:02:00.000000Z", parts=-1))["body"],),
        (json.loads(_doc("2024-01-01T10:03:00.000000Z", shift=4))["body"],),
    ], "body string")
    silver = oee.oee_silver(bronze)
    assert silver.count() == 1


def test_zero_parts_quality_null(spark):
    bronze = spark.createDataFrame([
        (json.loads(_doc("2024-01-01T10:01:00.000000Z", parts=0, bad=0))["body"],)], "body string")
    wf = spark.createDataFrame([(1, 5)], "shiftNumber bigint, employee_count bigint")
    g = oee.oee_gold(oee.oee_silver(bronze), wf).collect()[0]
    assert g["Quality"] is None and g["OEE"] is None
    assert g["Availability"] == 100.0 and g["Performance"] == 100.0


def test_sliding_windows_in_stream(spark, scratch):
    src = os.path.join(scratch, "in")
    wf = spark.createDataFrame([(1, 5)], "shiftNumber bigint, employee_count bigint")
    _write(src, "f1.json", [_doc("2024-01-01T10:01:30.000000Z", parts=3),
                            _doc("2024-01-01T10:40:00.000000Z", parts=1)])
    paths = run_oee(spark, src, os.path.join(scratch, "work"), wf, max_files=None, slide="1 minute")
    gold = spark.read.parquet(paths["gold"])
    starts = sorted(str(r.s)[11:16] for r in gold.select(
        F.col("window.start").cast("timestamp_ntz").alias("s"), "totalPartsMade")
        .filter("totalPartsMade = 3").collect())
    # the 10:01:30 reading lies in the five 5-minute windows starting 09:57 .. 10:01
    assert starts == ["09:57", "09:58", "09:59", "10:00", "10:01"]
