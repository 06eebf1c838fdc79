"""Streaming queries registered as named queries: the stream runs to
completion (``availableNow``) over files derived from the test tables, and
the query returns the gold table it wrote."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from millrace.operators import models as M
from millrace.plans import anomaly as A
from millrace.plans.common import round_doubles, window_cols
from millrace.plans.q_anomaly import _WITH as _ANOM_WITH
from millrace.plans.q_models import ANOMALY_CATEGORICAL, ANOMALY_NUMERIC
from millrace.plans.q_oee import _GOLD_COLS, _GOLD_WITH
from millrace.plans.registry import register
from millrace.session import scratch_path
from millrace.sources.fixtures import view
from millrace.sources.io import run_available_now
from millrace.streaming.anomaly import bronze_to_silver, read_gold, score_stream
from millrace.streaming.oee import run_oee


@register("oee_gold_stream", _GOLD_WITH + f"""
SELECT {_GOLD_COLS} FROM gold
WHERE window_end <= (SELECT max(messageTimestamp) FROM silver) - INTERVAL '10 minutes'""")
def q_oee_gold_stream(spark, sf_dir):
    """Bronze -> silver -> gold streams with a 10-minute watermark;
    append mode emits exactly the windows closed by the watermark, which
    equal the batch KPIs of those windows."""
    work = scratch_path(spark, f"oee-stream-{uuid.uuid4().hex[:12]}")
    src = f"{work}/incoming"
    view(spark, sf_dir, "plant_json").write.mode("overwrite").json(src)
    # S3: the bronze stream infers the file schema once and keeps it
    paths = run_oee(spark, src, work, view(spark, sf_dir, "workforce"), max_files=None,
                    infer_schema=True)
    return round_doubles(window_cols(spark.read.parquet(paths["gold"])))


_GOLD_ROWS = _ANOM_WITH + """
SELECT event_id, device_id, site_name, round(CAST(anomaly AS DOUBLE), 6) AS anomaly, {prediction} FROM feat"""


def _features_by_stream(spark, sf_dir, work):
    """Readings streamed bronze -> silver, then the feature table, written."""
    bronze = view(spark, sf_dir, "telemetry")
    bronze.write.mode("overwrite").parquet(f"{work}/bronze")
    run_available_now(bronze_to_silver(spark, f"{work}/bronze", bronze.schema, f"{work}/silver", f"{work}/_ck/silver"))
    silver = spark.read.parquet(f"{work}/silver")
    feats = A.anomaly_features(A.label_anomaly(silver), segment=A.day_segment())
    feats.write.mode("overwrite").parquet(f"{work}/features")
    return spark.read.parquet(f"{work}/features")


@register("anomaly_stream_scored", _GOLD_ROWS.format(prediction="true AS scored"))
def q_anomaly_stream_scored(spark, sf_dir):
    """X6 + X7 + S8: a tree trained on the hash-split training rows scores the
    feature table micro-batch by micro-batch into gold: every reading once, with
    a class."""
    work = scratch_path(spark, f"anomaly-stream-{uuid.uuid4().hex[:12]}")
    feats = _features_by_stream(spark, sf_dir, work)
    train, _ = M.hash_split(feats, "event_id", 70)
    model = M.fit(M.make_pipeline("tree_classifier", "anomaly", ANOMALY_NUMERIC, ANOMALY_CATEGORICAL,
                                  maxDepth=4, seed=42), train, "anomaly")
    run_available_now(score_stream(spark, f"{work}/features", feats.schema, model, f"{work}/gold", f"{work}/_ck/gold"))
    gold = read_gold(spark, f"{work}/gold", feats.schema)
    return round_doubles(gold.select("event_id", "device_id", "site_name", "anomaly", F.col("prediction").isin(0.0, 1.0).alias("scored")))


# Fixed coefficients of a linear score of the readings.
_SCORE = "0.04 * abs(CAST({q}sensor_1 AS DOUBLE) - 45.0) + 0.01 * abs(CAST({q}sensor_1_diff AS DOUBLE)) + 0.002 * CAST({q}sensor_2 AS DOUBLE)"


@register("anomaly_stream_fixed_model", _GOLD_ROWS.format(prediction=f"CASE WHEN {_SCORE.format(q='')} >= 1.0 THEN 1.0 ELSE 0.0 END AS prediction"))
def q_anomaly_stream_fixed_model(spark, sf_dir):
    """X7 + S8 + V5: the scored stream with a linear model of fixed coefficients.
    Half of the readings arrive before a second run with the same checkpoint;
    the gold table that readers see has every reading once."""
    work = scratch_path(spark, f"fixed-stream-{uuid.uuid4().hex[:12]}")
    feats = _features_by_stream(spark, sf_dir, work)
    model = PipelineModel([SQLTransformer(statement=f"SELECT *, CASE WHEN {_SCORE.format(q='')} >= 1.0 THEN 1.0 ELSE 0.0 END AS prediction FROM __THIS__")])
    for part in (0, 1):
        feats.where(f"event_id % 2 = {part}").write.mode("append").parquet(f"{work}/arriving")
        run_available_now(score_stream(spark, f"{work}/arriving", feats.schema, model, f"{work}/gold", f"{work}/_ck/gold"))
    return round_doubles(read_gold(spark, f"{work}/gold", feats.schema).select("event_id", "device_id", "site_name", "anomaly", "prediction"))
