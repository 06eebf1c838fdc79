"""OEE as a chain of Structured Streaming queries:

    JSON files --(bronze)--> parquet --(silver: parse + rules)--> parquet
        --(gold: watermark + 5-minute windows + KPIs + workforce)--> parquet

Each layer is its own query with its own checkpoint, so every layer resumes
after a failure from its last committed offsets.  The transformation code is
the batch code (``millrace.plans.oee``); only the sources and sinks differ.
Gold runs in append mode: a window is written once, when the watermark
(latest event time minus the allowed lateness) has passed its end; rows
later than the watermark are dropped by the state store.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.plans import oee
from millrace.sources.io import append_stream, run_available_now

BRONZE_FILE_SCHEMA = StructType([StructField("body", StringType())])


def bronze_query(spark: SparkSession, src_dir: str, out_dir: str, ckpt: str,
                 max_files: int | None = 16, trigger: dict | None = None,
                 schema_location: str | None = None):
    """Bronze: raw documents, ``body`` kept as a string.  With
    ``schema_location`` the file schema is inferred once and kept there
    (merged with new fields on later starts, S3); otherwise it is fixed."""
    if schema_location:
        from millrace.sources.io import ingest_json_files
        src = ingest_json_files(spark, src_dir, schema_location, max_files=max_files)
    else:
        r = spark.readStream.schema(BRONZE_FILE_SCHEMA)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        src = r.json(src_dir)
    src = src.select(F.col("body").cast("string").alias("body"))
    return append_stream(src, None, ckpt, trigger or {"availableNow": True},
                         query_name="oee_bronze", path=out_dir)


def silver_query(spark: SparkSession, bronze_dir: str, out_dir: str, ckpt: str,
                 trigger: dict | None = None, max_files: int | None = None):
    """Silver: JSON parse, flatten, event-time parse, quality rules."""
    r = spark.readStream.schema(BRONZE_FILE_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    silver = oee.oee_silver(r.parquet(bronze_dir))
    return append_stream(silver, None, ckpt, trigger or {"availableNow": True},
                         query_name="oee_silver", path=out_dir)


def gold_query(spark: SparkSession, silver_dir: str, silver_schema: StructType, workforce: DataFrame,
               out_dir: str, ckpt: str, window: str = "5 minutes", slide: str | None = None,
               lateness: str = "10 minutes", trigger: dict | None = None, max_files: int | None = None):
    """Gold: watermark, windowed KPIs (stateful), stream-static join with
    the workforce, append."""
    r = spark.readStream.schema(silver_schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    gold = oee.oee_gold(r.parquet(silver_dir), workforce, window=window, slide=slide,
                        watermark=lateness)
    return append_stream(gold, None, ckpt, trigger or {"availableNow": True},
                         query_name="oee_gold", path=out_dir)


def run_oee(spark: SparkSession, src_dir: str, work_dir: str, workforce: DataFrame,
            max_files: int | None = 16, timeout: float | None = None,
            window: str = "5 minutes", slide: str | None = None,
            lateness: str = "10 minutes", infer_schema: bool = False) -> dict:
    """Run the three layers in order, each to completion (``availableNow``;
    a layer still running after ``timeout`` seconds is stopped and raises),
    and return the folders of the layer tables.  Calling it again processes
    only files that arrived since the last run."""
    p = {k: os.path.join(work_dir, k) for k in ("bronze", "silver", "gold")}
    ck = {k: os.path.join(work_dir, "_checkpoints", k) for k in p}
    run_available_now(bronze_query(spark, src_dir, p["bronze"], ck["bronze"], max_files,
                                   schema_location=os.path.join(work_dir, "_schema") if infer_schema else None), timeout)
    run_available_now(silver_query(spark, p["bronze"], p["silver"], ck["silver"]), timeout)
    silver_schema = spark.read.parquet(p["silver"]).schema
    run_available_now(gold_query(spark, p["silver"], silver_schema, workforce, p["gold"], ck["gold"], window=window,
                                 slide=slide, lateness=lateness), timeout)
    return p
