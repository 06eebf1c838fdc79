"""Named anomaly-detection queries and their DuckDB twins.

The dashboard queries run on a scored gold table.  So that the oracle can
recompute them, the registered gold scores each reading with its own label
(``prediction = anomaly``, i.e. a perfect model); the trained-model scoring
path is registered separately (``anomaly_scored``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import anomaly as A
from millrace.plans.common import ntz, round_doubles
from millrace.plans.registry import register
from millrace.sources.fixtures import duck_with, view

_COIN = "CAST(CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS BIGINT) % 2 AS DOUBLE)"

_FEAT = f"""lab AS (
  SELECT *, CAST(CASE WHEN sensor_1 > 80 THEN 1.0 WHEN sensor_1 < 10 THEN 1.0
                      WHEN sensor_1 > 65 THEN {_COIN} WHEN sensor_1 < 25 THEN {_COIN}
                      ELSE 0.0 END AS FLOAT) AS anomaly
  FROM telemetry),
feat AS (
  SELECT event_id, device_id, device_model, "timestamp", sensor_1, sensor_2, sensor_3, site_name, anomaly,
    coalesce(CAST(avg(sensor_1) OVER w2 AS FLOAT), 0.0) AS sensor_1_rolling_avg,
    coalesce(CAST(avg(sensor_2) OVER w2 AS FLOAT), 0.0) AS sensor_2_rolling_avg,
    coalesce(CAST(avg(sensor_3) OVER w2 AS FLOAT), 0.0) AS sensor_3_rolling_avg,
    coalesce(CAST(sensor_1 - lag(sensor_1) OVER w AS FLOAT), 0.0) AS sensor_1_diff,
    coalesce(CAST(sensor_2 - lag(sensor_2) OVER w AS FLOAT), 0.0) AS sensor_2_diff,
    coalesce(CAST(sensor_3 - lag(sensor_3) OVER w AS FLOAT), 0.0) AS sensor_3_diff,
    CAST(hour("timestamp") AS FLOAT) AS hour_of_day,
    CAST(dayofweek("timestamp") + 1 AS FLOAT) AS day_of_week
  FROM lab
  WINDOW w AS (PARTITION BY device_id ORDER BY "timestamp", event_id),
         w2 AS (PARTITION BY device_id ORDER BY "timestamp", event_id
                ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
gold AS (SELECT *, anomaly AS prediction FROM feat)"""

_WITH = duck_with("telemetry", extra=[_FEAT])


def _r(c):
    return f"round(CAST({c} AS DOUBLE), 6) AS {c}"


def _features(spark, sf_dir):
    return A.anomaly_feature_table(view(spark, sf_dir, "telemetry"))


def _gold(spark, sf_dir):
    return _features(spark, sf_dir).withColumn("prediction", F.col("anomaly"))


_FEAT_COLS = ", ".join(["event_id", "device_id", "device_model", '"timestamp"', "site_name"] + [
    _r(c) for c in ["sensor_1", "sensor_2", "sensor_3", "anomaly",
                    "sensor_1_rolling_avg", "sensor_2_rolling_avg", "sensor_3_rolling_avg",
                    "sensor_1_diff", "sensor_2_diff", "sensor_3_diff", "hour_of_day", "day_of_week"]])


@register("anomaly_features", _WITH + f"SELECT {_FEAT_COLS} FROM feat")
def q_anomaly_features(spark, sf_dir):
    """E1 + E2 (W1, W2, F1, F7, F13): labelled rolling / lag features."""
    return round_doubles(ntz(_features(spark, sf_dir), "timestamp"))


@register("anomaly_label_balance", _WITH + """
SELECT round(CAST(anomaly AS DOUBLE), 6) AS anomaly, count(*) AS count FROM feat GROUP BY anomaly""")
def q_anomaly_label_balance(spark, sf_dir):
    """Class balance of the label."""
    from millrace.operators.aggregates import count_by
    return round_doubles(count_by(_features(spark, sf_dir), "anomaly"))


@register("dash_reading_split", _WITH + """
SELECT CAST("timestamp" AS DATE) AS date,
       round(CAST(CASE WHEN sensor_1 < 20 OR sensor_1 > 80 THEN sensor_1 END AS DOUBLE), 6) AS anomaly_reading,
       round(CAST(CASE WHEN sensor_1 > 20 AND sensor_1 < 80 THEN sensor_1 END AS DOUBLE), 6) AS non_anomaly_reading
FROM gold""")
def q_dash_reading_split(spark, sf_dir):
    """D6."""
    return round_doubles(A.dash_reading_split(_gold(spark, sf_dir)))


@register("dash_devices_per_model", _WITH + """
SELECT device_model, count(DISTINCT device_id) AS devices FROM gold GROUP BY device_model""")
def q_dash_devices_per_model(spark, sf_dir):
    """D7 / G6."""
    return A.dash_devices_per_model(_gold(spark, sf_dir))


@register("dash_sensor_by_date", _WITH + """
SELECT CAST("timestamp" AS DATE) AS date, round(sum(sensor_1), 6) AS sum_sensor_1 FROM gold GROUP BY 1""")
def q_dash_sensor_by_date(spark, sf_dir):
    """D8 / G19."""
    return round_doubles(A.dash_sensor_by_date(_gold(spark, sf_dir)))


@register("dash_predictions_in_range", _WITH + """
SELECT event_id, device_id, "timestamp", site_name, round(CAST(prediction AS DOUBLE), 6) AS prediction
FROM gold WHERE "timestamp" > TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-20 00:00:00'
  AND site_name IN ('site_0', 'site_2')""")
def q_dash_predictions_in_range(spark, sf_dir):
    """D9 / P10."""
    g = A.dash_predictions_in_range(_gold(spark, sf_dir), "2024-01-05 00:00:00",
                                    "2024-01-20 00:00:00", ["site_0", "site_2"])
    return round_doubles(ntz(g.select("event_id", "device_id", "timestamp", "site_name", "prediction"),
                             "timestamp"))


@register("dash_monthly", _WITH + """
SELECT date_trunc('month', "timestamp") AS month, round(sum(prediction), 6) AS predicted_anomalies,
       count(DISTINCT device_id) AS devices FROM gold GROUP BY 1""")
def q_dash_monthly(spark, sf_dir):
    """D10 / G15 / F4."""
    return round_doubles(ntz(A.dash_monthly(_gold(spark, sf_dir)), "month"))


@register("dash_by_site", _WITH + """
SELECT site_name, round(sum(prediction), 6) AS predicted_anomalies FROM gold GROUP BY site_name""")
def q_dash_by_site(spark, sf_dir):
    """D11."""
    return round_doubles(A.dash_by_site(_gold(spark, sf_dir)))


@register("dash_anomalies_by_hour", _WITH + """
SELECT hour(g."timestamp") AS anomaly_hour, round(sum(p.prediction), 6) AS qty_anomalies
FROM gold p JOIN gold g ON g.device_id = p.device_id AND g.site_name = p.site_name
GROUP BY 1""")
def q_dash_anomalies_by_hour(spark, sf_dir):
    """Many-to-many join semantics, computed from aggregates."""
    g = _gold(spark, sf_dir)
    return round_doubles(A.dash_anomalies_by_hour(g, g))


@register("dash_anomalies_by_hour_unique", _WITH + """
SELECT hour("timestamp") AS anomaly_hour, round(sum(prediction), 6) AS qty_anomalies FROM gold GROUP BY 1""")
def q_dash_anomalies_by_hour_unique(spark, sf_dir):
    """D12, unique-key form."""
    return round_doubles(A.dash_anomalies_by_hour_unique(_gold(spark, sf_dir)))


@register("dash_sites", _WITH + "SELECT DISTINCT site_name FROM gold")
def q_dash_sites(spark, sf_dir):
    """D13 / U1."""
    return A.dash_sites(_gold(spark, sf_dir))


@register("dash_device_count", _WITH + "SELECT count(DISTINCT device_id) AS devices FROM gold")
def q_dash_device_count(spark, sf_dir):
    """D13 / G6."""
    return A.dash_device_count(_gold(spark, sf_dir))


@register("dash_latest_day", _WITH + """
SELECT round(sum(prediction), 6) AS predicted_anomalies,
       strftime(CAST("timestamp" AS DATE), '%-d %b %Y') AS day
FROM gold GROUP BY CAST("timestamp" AS DATE) ORDER BY CAST("timestamp" AS DATE) DESC LIMIT 1""")
def q_dash_latest_day(spark, sf_dir):
    """D13 / G17 / F5 / T4."""
    return round_doubles(A.dash_latest_day(_gold(spark, sf_dir)))


@register("dash_peak_day", _WITH + """
SELECT round(sum(prediction), 6) AS predicted_anomalies,
       strftime(CAST("timestamp" AS DATE), '%-d %b %Y') AS day
FROM gold GROUP BY CAST("timestamp" AS DATE)
ORDER BY sum(prediction) DESC, CAST("timestamp" AS DATE) DESC LIMIT 1""")
def q_dash_peak_day(spark, sf_dir):
    """D13 corrected arg-max day / T2."""
    return round_doubles(A.dash_peak_day(_gold(spark, sf_dir)))


@register("dash_totals", _WITH + """
SELECT round(sum(anomaly), 6) AS anomalies, count(*) AS readings FROM gold""")
def q_dash_totals(spark, sf_dir):
    """D13 / G5."""
    return round_doubles(A.dash_totals(_gold(spark, sf_dir)))
