"""Anomaly detection: sensor readings -> silver (typed) -> labelled features
-> model -> scored gold -> dashboard queries (SURVEY P1, E1, E2, D6-D13,
G6, G15-G17, G19, J3, U1).

Dashboard functions take any scored table with the gold columns
(``device_id, device_model, timestamp, sensor_1.., site_name, anomaly,
prediction``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import day_label
from millrace.operators.features import anomaly_features, label_anomaly
from millrace.operators.select import in_range, typed_select

# The silver schema of the sensor stream.
SILVER_SCHEMA = ("timestamp timestamp, device_id int, device_model string, sensor_1 float, "
                 "sensor_2 float, sensor_3 float, site_name string")


def anomaly_silver(bronze: DataFrame, keep=("event_id",)) -> DataFrame:
    """Typed projection of the bronze readings (bad values become
    null).  An epoch-seconds ``timestamp`` is converted with
    ``timestamp_seconds``."""
    b = bronze
    if dict(b.dtypes).get("timestamp") in ("bigint", "int"):
        b = b.withColumn("timestamp", F.timestamp_seconds("timestamp"))
    extra = [c for c in keep if c in b.columns]
    ddl = SILVER_SCHEMA + "".join(f", {c} {t}" for c, t in b.select(*extra).dtypes)
    return typed_select(b, ddl)


def day_segment(ts: str = "timestamp") -> Column:
    """Coarse, order-compatible segment for skew-safe per-device windows."""
    return F.to_date(F.col(ts))


def anomaly_feature_table(silver: DataFrame, skew_safe: bool = True) -> DataFrame:
    """E1 + E2: labelled features, one row per reading, by day-segmented
    windows (``skew_safe=False``: one plain window a device)."""
    return anomaly_features(label_anomaly(silver), segment=day_segment() if skew_safe else None)


# ------------------------------------------------------------------ dashboard
def dash_reading_split(gold: DataFrame, lo: float = 20.0, hi: float = 80.0) -> DataFrame:
    """Per reading, its date and the sensor value in the anomaly column
    (outside (lo, hi)) or the normal column (inside, both bounds exclusive);
    values equal to a bound are in neither."""
    s = F.col("sensor_1")
    return gold.select(F.to_date("timestamp").alias("date"),
                       F.when((s < lo) | (s > hi), s).alias("anomaly_reading"),
                       F.when((s > lo) & (s < hi), s).alias("non_anomaly_reading"))


def dash_devices_per_model(gold: DataFrame) -> DataFrame:
    """Distinct devices per model."""
    return gold.groupBy("device_model").agg(F.count_distinct("device_id").alias("devices"))


def dash_sensor_by_date(gold: DataFrame, sensor: str = "sensor_1") -> DataFrame:
    """Daily sum of a sensor."""
    return gold.groupBy(F.to_date("timestamp").alias("date")).agg(F.sum(sensor).alias(f"sum_{sensor}"))


def dash_predictions_in_range(gold: DataFrame, after: str, before: str, sites: list) -> DataFrame:
    """Scored rows strictly between two instants, for an exact list
    of sites."""
    return in_range(gold, "timestamp", after, before, list(sites), "site_name")


def dash_monthly(gold: DataFrame) -> DataFrame:
    """Predicted anomalies and active devices per month."""
    return (gold.groupBy(F.date_trunc("MONTH", "timestamp").alias("month"))
                .agg(F.sum("prediction").alias("predicted_anomalies"),
                     F.count_distinct("device_id").alias("devices")))


def dash_by_site(gold: DataFrame) -> DataFrame:
    """Predicted anomalies per site (map layer)."""
    return gold.groupBy("site_name").agg(F.sum("prediction").alias("predicted_anomalies"))


def dash_anomalies_by_hour(scored: DataFrame, readings: DataFrame,
                           keys=("device_id", "site_name")) -> DataFrame:
    """The dashboard joins predictions with readings on
    (device, site) -- a many-to-many join -- and sums the prediction per
    hour of the reading.  Each reading r in hour h contributes the sum of
    the predictions of its key, so

        qty(h) = sum over keys of  pred_sum(key) * readings(key, h)

    which is computed from two aggregates joined on the key: the same
    numbers without ever forming the row pairs."""
    keys = list(keys)
    p = scored.groupBy(*keys).agg(F.sum("prediction").alias("__pred"))
    r = (readings.groupBy(*keys, F.hour("timestamp").alias("anomaly_hour"))
                 .agg(F.count(F.lit(1)).alias("__n")))
    return (r.join(p, keys, "inner")
             .groupBy("anomaly_hour")
             .agg(F.sum(F.col("__pred") * F.col("__n")).alias("qty_anomalies")))


def dash_anomalies_by_hour_unique(gold: DataFrame) -> DataFrame:
    """D12, unique-key form: predicted anomalies by the hour of their own
    reading."""
    return (gold.groupBy(F.hour("timestamp").alias("anomaly_hour"))
                .agg(F.sum("prediction").alias("qty_anomalies")))


def dash_sites(gold: DataFrame) -> DataFrame:
    """List of sites."""
    return gold.select("site_name").distinct()


def dash_device_count(gold: DataFrame) -> DataFrame:
    """Number of distinct devices."""
    return gold.agg(F.count_distinct("device_id").alias("devices"))


def dash_latest_day(gold: DataFrame) -> DataFrame:
    """Predicted anomalies of the latest day (the dashboard's
    "day" tile), with its ``d MMM yyyy`` label.  Top-1 by date: a
    TakeOrderedAndProject over the small daily table."""
    daily = (gold.groupBy(F.to_date("timestamp").alias("date"))
                 .agg(F.sum("prediction").alias("predicted_anomalies")))
    return (daily.orderBy(F.col("date").desc()).limit(1)
                 .select("predicted_anomalies", day_label(F.col("date")).alias("day")))


def dash_peak_day(gold: DataFrame) -> DataFrame:
    """D13, corrected: the day with the most predicted anomalies (ties: the
    latest day)."""
    daily = (gold.groupBy(F.to_date("timestamp").alias("date"))
                 .agg(F.sum("prediction").alias("predicted_anomalies")))
    return (daily.orderBy(F.col("predicted_anomalies").desc(), F.col("date").desc()).limit(1)
                 .select("predicted_anomalies", day_label(F.col("date")).alias("day")))


def dash_totals(gold: DataFrame) -> DataFrame:
    """Labelled anomalies versus all readings."""
    return gold.agg(F.sum("anomaly").alias("anomalies"), F.count(F.lit(1)).alias("readings"))
