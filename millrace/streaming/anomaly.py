"""Anomaly detection as streams:

    readings table --(bronze: append)--> --(silver: typed select)-->
    features table (batch, E1/E2) --(micro-batch scoring)--> gold

Scoring runs in ``foreachBatch``: each micro-batch is scored with a fitted
``PipelineModel`` (JVM-side transform) and appended to the gold folder with a
commit record for each batch (``sources.io.committed_append``): a replayed batch
is written once, and readers follow the records.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.plans.anomaly import anomaly_silver
from millrace.sources.io import append_stream, committed_append, foreach_batch, read_committed

GOLD_COLS = ["event_id", "device_id", "device_model", "timestamp", "sensor_1", "sensor_2",
             "sensor_3", "site_name", "anomaly"]


def bronze_to_silver(spark: SparkSession, bronze_dir: str, schema: StructType, silver_dir: str,
                     ckpt: str, trigger: dict | None = None):
    """X6 (silver step): typed projection of the readings, append."""
    src = spark.readStream.schema(schema).parquet(bronze_dir)
    return append_stream(anomaly_silver(src), None, ckpt, trigger or {"availableNow": True},
                         query_name="anomaly_silver", path=silver_dir)


def score_stream(spark: SparkSession, features_dir: str, schema: StructType, model: PipelineModel,
                 gold_dir: str, ckpt: str, trigger: dict | None = None, keep=None):
    """Stream over the feature table, score each micro-batch, append to
    gold exactly once.  ``read_gold`` reads it."""
    keep = keep or [c for c in GOLD_COLS if c in schema.fieldNames()]
    src = spark.readStream.schema(schema).parquet(features_dir)
    sink = committed_append(gold_dir, lambda batch: model.transform(batch).select(*keep, F.col("prediction").cast("double")))
    return foreach_batch(src, sink, ckpt, trigger or {"availableNow": True}, query_name="anomaly_scoring")


def read_gold(spark: SparkSession, gold_dir: str, schema: StructType, keep=None) -> DataFrame:
    """The committed rows of the gold folder; ``schema`` is the feature table's."""
    keep = keep or [c for c in GOLD_COLS if c in schema.fieldNames()]
    return read_committed(spark, gold_dir, StructType([*[schema[c] for c in keep], StructField("prediction", DoubleType())]))
