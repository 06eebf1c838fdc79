"""Named CNC device / milling queries and their DuckDB twins.

The DuckDB twin of the EWMA is the closed form
``sum(x * b^-rn) / sum(b^-rn)`` over the rows so far (fine for the short
series of the test tables); the Spark side is the blocked form that keeps
every power of b in range for series of any length."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.windows import ewm_alpha, row_number_by
from millrace.plans import device as D
from millrace.plans.common import ntz, round_doubles
from millrace.plans.registry import register
from millrace.sources.fixtures import duck_with, view

B5 = repr(1.0 - ewm_alpha(com=5.0))
B600 = repr(1.0 - ewm_alpha(span=600.0))
ORD = '"timestamp", event_id'

_TRIPS = """trips AS (
  SELECT d.*, CAST(dense_rank() OVER (PARTITION BY device_id ORDER BY CAST("timestamp" AS DATE)) AS INTEGER) AS trip_id
  FROM device d)"""


def _readings(spark, sf_dir):
    return view(spark, sf_dir, "device")


@register("device_trips", duck_with("device", extra=[_TRIPS]) + f"""
SELECT event_id, device_id, trip_id,
       CAST(row_number() OVER (PARTITION BY device_id ORDER BY {ORD}) AS INTEGER) AS row_num FROM trips""")
def q_device_trips(spark, sf_dir):
    """W3 trip id + W4 row number per device (both skew-safe)."""
    t = D.add_trips(_readings(spark, sf_dir))
    t = row_number_by(t, "device_id", D.ORDER, out="row_num", segment=D.day_segment())
    return t.select("event_id", "device_id", F.col("trip_id").cast("int").alias("trip_id"),
                    F.col("row_num").cast("int").alias("row_num"))


@register("device_airflow", duck_with("device", extra=[_TRIPS]) + f""",
a AS (SELECT event_id, device_id, trip_id, "timestamp",
        lag(rotation_speed, 5) OVER (PARTITION BY device_id, trip_id ORDER BY {ORD}) / nullif(air_pressure, 0) AS a0
      FROM trips),
b AS (SELECT *, coalesce(a0, first_value(a0 IGNORE NULLS) OVER (PARTITION BY device_id, trip_id ORDER BY {ORD}
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS a1 FROM a),
c AS (SELECT *, coalesce(a1, last_value(a1 IGNORE NULLS) OVER (PARTITION BY device_id, trip_id ORDER BY {ORD}
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS a2 FROM b)
SELECT event_id, round(coalesce(a2, 0.0), 6) AS airflow_rate FROM c""")
def q_device_airflow(spark, sf_dir):
    """W5 shift(5) + W7 bfill / ffill / 0 inside (device, trip)."""
    t = D.add_airflow(D.add_trips(_readings(spark, sf_dir)))
    return round_doubles(t.select("event_id", "airflow_rate"))


def _ewma_ctes():
    # each CTE keeps its partition columns so the running sums stay per series
    parts = {"et": ("temperature", "device_id, trip_id", B5, 0),
             "ep": ("temperature", "device_id", B5, 1),
             "ed": ("density", "device_id", B600, 1)}
    out = []
    for n, (x, part, b, shift) in parts.items():
        xv = f"lag({x}) OVER (PARTITION BY {part} ORDER BY {ORD})" if shift else x
        out.append(f"""{n} AS (SELECT event_id, {part}, {xv} AS xv,
        row_number() OVER (PARTITION BY {part} ORDER BY {ORD}) AS rn FROM trips)""")
        out.append(f"""{n}_r AS (SELECT event_id,
        sum(CASE WHEN xv IS NOT NULL THEN xv * pow({b}, -rn) END) OVER w
          / sum(CASE WHEN xv IS NOT NULL THEN pow({b}, -rn) END) OVER w AS v
        FROM {n} WINDOW w AS (PARTITION BY {part} ORDER BY rn
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
    return out


_EWMA_WITH = duck_with("device", extra=[_TRIPS] + _ewma_ctes())


@register("device_temp_ewma", _EWMA_WITH + """
SELECT t.event_id, round(et_r.v, 6) AS rolling_mean_temp, round(et_r.v - t.temperature, 6) AS temp_difference,
       round(t.temperature - et_r.v, 6) AS temp_deviation, round(ep_r.v, 6) AS prev_temp_ewma
FROM trips t JOIN et_r USING (event_id) JOIN ep_r USING (event_id)""")
def q_device_temp_ewma(spark, sf_dir):
    """W6 + W8: EWMA (com=5) of temperature per (device, trip), both
    deviations, and the shifted per-device form used for defect labels."""
    t = D.temperature_ewma(_readings(spark, sf_dir))
    return round_doubles(t.select("event_id", "rolling_mean_temp", "temp_difference",
                                  "temp_deviation", "prev_temp_ewma"))


# Category values of the fixture (factory_id = 'F' || user_id % 5, model_id =
# event_type): fixed lists keep the feature layout stable between training
# and serving and avoid a discovery job per call.
FACTORIES = ["F0", "F1", "F2", "F3", "F4"]
MODELS = ["click", "error", "purchase", "signup", "view"]


_FEATURES_WITH = _EWMA_WITH.replace(
    "et AS (SELECT event_id, device_id, trip_id, temperature AS xv",
    "et AS (SELECT event_id, device_id, trip_id, lag(temperature) OVER (PARTITION BY device_id, trip_id ORDER BY \"timestamp\", event_id) AS xv")
_FEATURE_COLS = """t.event_id, t.device_id, t.trip_id,
       round(coalesce(et_r.v, 0.0), 6) AS rolling_mean_temp,
       round(coalesce(et_r.v - t.temperature, 0.0), 6) AS temp_difference,
       round(coalesce(ed_r.v, 0.0), 6) AS rolling_mean_density, """ + ", ".join(
    [f"CAST(t.factory_id = '{v}' AS DOUBLE) AS ohe_{v}" for v in FACTORIES] +
    [f"CAST(t.model_id = '{v}' AS DOUBLE) AS ohe_{v}" for v in MODELS])


@register("device_features", _FEATURES_WITH + f"""
SELECT {_FEATURE_COLS}
FROM trips t JOIN et_r USING (event_id) JOIN ed_r USING (event_id)""")
def q_device_features(spark, sf_dir):
    """E3 + E5: one-hot, EWMA temperature of the previous readings per
    (device, trip), its difference, EWMA (span=600) of the previous density
    per device, forward fill then 0."""
    f = D.feature_table(_readings(spark, sf_dir), factories=FACTORIES, models=MODELS)
    keep = ["event_id", "device_id", F.col("trip_id").cast("int").alias("trip_id"),
            "rolling_mean_temp", "temp_difference", "rolling_mean_density"] + \
        [f"ohe_{v}" for v in FACTORIES + MODELS]
    return round_doubles(f.select(*keep))


# Rules of the defect label, rescaled to the fixture's factories, models and
# air-pressure range (FIXTURES.md); thresholds stay those of the reference.
FIXTURE_TEMP_RULES = [(1.8, "factory_id", "F0", 0.89), (1.8, "model_id", "click", 0.89),
                      (1.9, "model_id", "view", 0.93)]
FIXTURE_PRESSURE_MAX = 1093.0


def _coin_sql(i, off):
    return (f"CASE WHEN CAST(CAST(('0x' || substr(md5(device_id || '|rule{i}'), 1, 8)) AS BIGINT) AS DOUBLE)"
            f" / 4294967296.0::DOUBLE + {off}::DOUBLE >= 0.5 THEN 1.0 ELSE 0.0 END")


_DEFECT_SQL = _EWMA_WITH + """,
q AS (SELECT device_id, quantile_cont(temperature, 0.89) AS q89, quantile_cont(temperature, 0.93) AS q93
      FROM device GROUP BY device_id),
x AS (SELECT t.*, t.temperature - ep_r.v AS dev, q.q89, q.q93
      FROM trips t JOIN ep_r USING (event_id) JOIN q USING (device_id)),
lab AS (SELECT event_id, device_id, CAST(CASE
   WHEN coalesce(dev > 1.8 AND factory_id = 'F0' AND temperature > q89, false) THEN """ + _coin_sql(0, 0.2) + """
   WHEN coalesce(dev > 1.8 AND model_id = 'click' AND temperature > q89, false) THEN """ + _coin_sql(1, 0.2) + """
   WHEN coalesce(dev > 1.9 AND model_id = 'view' AND temperature > q93, false) THEN """ + _coin_sql(2, 0.2) + """
   WHEN coalesce(delay > 39 AND rotation_speed > 590, false) THEN """ + _coin_sql(3, 0.2) + """
   WHEN coalesce(density > 4.2 AND air_pressure < 1093, false) THEN """ + _coin_sql(4, 0.15) + """
   ELSE 0.0 END AS FLOAT) AS defect FROM x)"""


def _defects(spark, sf_dir):
    return D.defects(_readings(spark, sf_dir), temp_rules=FIXTURE_TEMP_RULES,
                     pressure_max=FIXTURE_PRESSURE_MAX)


@register("device_defects", _DEFECT_SQL + """
SELECT event_id, device_id, round(CAST(defect AS DOUBLE), 6) AS defect FROM lab""")
def q_device_defects(spark, sf_dir):
    """E6 + G11: five ordered defect rules with per-device quantiles."""
    return round_doubles(_defects(spark, sf_dir).select("event_id", "device_id", "defect"))


@register("device_worst", _DEFECT_SQL + """
SELECT device_id, round(sum(defect), 6) AS defects, count(*) AS readings FROM lab
GROUP BY device_id ORDER BY sum(defect) DESC, device_id ASC LIMIT 1""")
def q_device_worst(spark, sf_dir):
    """The device with most defects."""
    return round_doubles(D.worst_device(_defects(spark, sf_dir)))


@register("device_time_split", duck_with("device") + f""",
r AS (SELECT *, row_number() OVER (ORDER BY {ORD}) AS rn, count(*) OVER () AS n FROM device)
SELECT CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split, count(*) AS rows,
       min("timestamp") AS first_ts, max("timestamp") AS last_ts FROM r GROUP BY 1""")
def q_device_time_split(spark, sf_dir):
    """Time-ordered 80/20 split (global numbering per day + offsets)."""
    s = D.time_split(_readings(spark, sf_dir))
    out = s.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_ts"),
                                 F.max("timestamp").alias("last_ts"))
    return ntz(out, "first_ts", "last_ts")


@register("device_daily_context", duck_with("device") + """,
l AS (SELECT CAST("timestamp" AS DATE) AS date, avg(temperature) AS m FROM device GROUP BY 1)
SELECT d.event_id, l.date, round(l.m, 6) AS day_mean_temp FROM device d LEFT JOIN l
  ON CAST(d."timestamp" AS DATE) = l.date""")
def q_device_daily_context(spark, sf_dir):
    """Per-day lookup left-joined by date."""
    return round_doubles(D.daily_context(_readings(spark, sf_dir)).select("event_id", "date", "day_mean_temp"))


@register("milling_failure_counts", duck_with("milling") + """,
f AS (SELECT Type,
   CAST(tool_wear BETWEEN 200 AND 240 AS INTEGER) AS TWF,
   CAST(coalesce(process_temp - air_temp < 8.6 AND rpm < 1380, false) AS INTEGER) AS HDF,
   CAST(coalesce(torque * rpm * 0.10471975511965977::DOUBLE < 3500
        OR torque * rpm * 0.10471975511965977::DOUBLE > 9000, false) AS INTEGER) AS PWF,
   CAST(coalesce(tool_wear * torque > CASE Type WHEN 'L' THEN 11000 WHEN 'M' THEN 12000 WHEN 'H' THEN 13000 END, false) AS INTEGER) AS OSF
   FROM milling)
SELECT Type, CAST(sum(TWF) AS BIGINT) AS TWF, CAST(sum(HDF) AS BIGINT) AS HDF, CAST(sum(PWF) AS BIGINT) AS PWF,
       CAST(sum(OSF) AS BIGINT) AS OSF, CAST(sum(greatest(TWF, HDF, PWF, OSF)) AS BIGINT) AS machine_failure,
       count(*) AS rows FROM f GROUP BY Type""")
def q_milling_failure_counts(spark, sf_dir):
    """Failure-mode flags, counted per product type."""
    return D.failure_counts(D.milling_failures(view(spark, sf_dir, "milling")))
