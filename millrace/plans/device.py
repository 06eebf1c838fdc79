"""CNC device pipeline: readings -> trips -> features -> defect labels
(SURVEY W3-W9, E3-E6, J2, T2, E10) and the milling failure modes (E12).

Per-device windows use the skew-safe segmented form by default (segment =
calendar day), so one device holding a large share of the rows is spread
over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.features import device_features, failure_mode_flags, label_defects
from millrace.operators.scan import Smooth, series_scan
from millrace.operators.windows import dense_rank_by, deviation, ewm_alpha, fill_series, lag_by

ORDER = ["timestamp", "event_id"]


def day_segment():
    return F.to_date("timestamp")


def hour_segment():
    return F.date_trunc("hour", "timestamp")


def _segment_for(key, skew_safe):
    """Per-device series go by day segments, (device, trip) series (one
    device-day each, of any size) by hour segments."""
    if not skew_safe:
        return None
    return hour_segment() if "trip_id" in list(key) else day_segment()


def add_trips(readings: DataFrame, key: str = "device_id", ts: str = "timestamp") -> DataFrame:
    """``trip_id`` = dense rank of the calendar day per device."""
    return dense_rank_by(readings, key, F.to_date(F.col(ts)), out="trip_id")


def add_airflow(readings: DataFrame, key=("device_id", "trip_id"), skew_safe: bool = True) -> DataFrame:
    """W5 + W7: ``airflow_rate`` = rotation speed 5 readings earlier / air
    pressure, inside each (device, trip); gaps back-filled, then
    forward-filled, then 0."""
    seg = _segment_for(key, skew_safe)
    d = lag_by(readings, list(key), ORDER, ["rotation_speed"], n=5, segment=seg,
               names={"rotation_speed": "__rot5"})
    d = d.withColumn("airflow_rate", F.try_divide(F.col("__rot5"), F.col("air_pressure"))).drop("__rot5")
    return fill_series(d, ["airflow_rate"], list(key), ORDER, value=0.0, segment=seg,
                       backward_first=True)


def temperature_ewma(readings: DataFrame, com: float = 5.0) -> DataFrame:
    """W3 + W6 + W8 in one scan: trips, the EWMA of temperature per trip with
    both deviations, and that of the previous temperatures per device."""
    a = ewm_alpha(com=com)
    d = series_scan(readings, "device_id", ORDER, day_segment(), rank="trip_id", smooth=[
        Smooth("temperature", "rolling_mean_temp", a, restart=True), Smooth("temperature", "prev_temp_ewma", a, 1)])
    d = deviation(d, "temperature", "rolling_mean_temp", "temp_difference", sign=1)
    return deviation(d, "temperature", "rolling_mean_temp", "temp_deviation", sign=-1)


def feature_table(readings: DataFrame, factories=None, models=None, skew_safe: bool = True) -> DataFrame:
    """E5 on trips."""
    return device_features(readings if skew_safe else add_trips(readings), factories=factories, models=models,
                           segment=day_segment() if skew_safe else None)


def defects(readings: DataFrame, skew_safe: bool = True, **rules) -> DataFrame:
    """E6."""
    return label_defects(readings, segment=_segment_for(["device_id"], skew_safe),
                         **rules)


def worst_device(labelled: DataFrame, key: str = "device_id", label: str = "defect") -> DataFrame:
    """Device with the most defects (ties: smallest id)."""
    return (labelled.groupBy(key).agg(F.sum(label).alias("defects"), F.count(F.lit(1)).alias("readings"))
                    .orderBy(F.col("defects").desc(), F.col(key).asc()).limit(1))


def time_split(readings: DataFrame, frac: float = 0.8) -> DataFrame:
    """First 80 % of readings in time order for training."""
    from millrace.operators.windows import ordered_split
    return ordered_split(readings, ORDER, frac=frac, segment=day_segment())  # global order: always split


def daily_context(readings: DataFrame) -> DataFrame:
    """A per-day lookup value (mean temperature of the day over all
    devices) left-joined onto each reading by its date.  The lookup has one
    row per day; AQE broadcasts it by its measured size."""
    d = readings.withColumn("date", F.to_date("timestamp"))
    lookup = d.groupBy("date").agg(F.avg("temperature").alias("day_mean_temp"))
    return d.join(lookup, "date", "left")


def milling_failures(milling: DataFrame) -> DataFrame:
    """E12."""
    return failure_mode_flags(milling)


def failure_counts(flags: DataFrame, by: str = "Type") -> DataFrame:
    """E12 root-cause counts per failure mode (and per product type)."""
    modes = ["TWF", "HDF", "PWF", "OSF", "machine_failure"]
    return flags.groupBy(by).agg(*[F.sum(m).cast("bigint").alias(m) for m in modes],
                                 F.count(F.lit(1)).alias("rows"))
