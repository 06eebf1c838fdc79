"""Named OEE queries (flagship + dashboard) and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans import oee
from millrace.plans.common import round_doubles, window_cols
from millrace.plans.registry import register
from millrace.sources.fixtures import duck_with, spread, view
from millrace.operators.quality import quality_report
from millrace.sources.io import materialize


_BRONZE: dict = {}


def _bronze(spark, sf_dir):
    """Bronze layer: the raw JSON documents, written once per application as
    a table in the shared checkpoint folder (the ingest step of the
    pipeline); silver and gold queries read it like the reference's layers
    read the bronze table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BRONZE:
        # the ingest writes one file per core, as a streaming ingest would
        _BRONZE[key] = materialize(spread(view(spark, sf_dir, "plant_json")), "oee_bronze")
    return _BRONZE[key]


def _gold(spark, sf_dir, slide=None):
    silver = oee.oee_silver(_bronze(spark, sf_dir))
    return oee.oee_gold(silver, view(spark, sf_dir, "workforce"), slide=slide)


_SILVER = """silver AS (
  SELECT * FROM plant
  WHERE coalesce(defectivePartsMade >= 0, false) AND coalesce(totalPartsMade >= 0, false)
    AND coalesce(oilLevel >= 0, false) AND coalesce(shiftNumber >= 1 AND shiftNumber <= 3, false))"""

_MEASURES = """avg(systemDiskFreePercent) AS avg_systemDiskFreePercent,
    avg(oilLevel) AS avg_oilLevel, min(oilLevel) AS min_oilLevel, max(oilLevel) AS max_oilLevel,
    min(temperature) AS min_temperature, max(temperature) AS max_temperature,
    avg(temperature) AS avg_temperature,
    CAST(sum(totalPartsMade) AS BIGINT) AS totalPartsMade,
    CAST(sum(defectivePartsMade) AS BIGINT) AS defectivePartsMade,
    CAST(count(*) FILTER (WHERE machineHealth = 'Healthy') AS BIGINT) AS healthy_count,
    CAST(count(*) FILTER (WHERE machineHealth = 'Error') AS BIGINT) AS error_count,
    CAST(count(*) FILTER (WHERE machineHealth = 'Warning') AS BIGINT) AS warning_count,
    count(*) AS total_count"""

_KPIS = """(healthy_count - error_count) * 100 / nullif(total_count, 0) AS Availability,
    (totalPartsMade - defectivePartsMade) * 100 / nullif(totalPartsMade, 0) AS Quality,
    healthy_count * 100 / nullif(healthy_count + error_count + warning_count, 0) AS Performance"""

_GOLD = f"""agg AS (
  SELECT time_bucket(INTERVAL '5 minutes', messageTimestamp) AS window_start,
         time_bucket(INTERVAL '5 minutes', messageTimestamp) + INTERVAL '5 minutes' AS window_end,
         plantName, productionLine, shiftNumber, {_MEASURES}
  FROM silver GROUP BY ALL),
kpi AS (
  SELECT *, {_KPIS} FROM agg),
gold AS (
  SELECT k.*, (Availability + Quality + Performance) / 3 AS OEE, w.employee_count
  FROM kpi k JOIN workforce w ON k.shiftNumber = w.shiftNumber
  WHERE w.shiftNumber BETWEEN 1 AND 3)"""

_GOLD_WITH = duck_with("plant", "workforce", extra=[_SILVER, _GOLD])

_GOLD_COLS = """window_start, window_end, shiftNumber, plantName, productionLine,
  round(avg_systemDiskFreePercent, 6) AS avg_systemDiskFreePercent,
  round(avg_oilLevel, 6) AS avg_oilLevel, round(min_oilLevel, 6) AS min_oilLevel,
  round(max_oilLevel, 6) AS max_oilLevel, round(min_temperature, 6) AS min_temperature,
  round(max_temperature, 6) AS max_temperature, round(avg_temperature, 6) AS avg_temperature,
  totalPartsMade, defectivePartsMade, healthy_count, error_count, warning_count, total_count,
  round(Availability, 6) AS Availability, round(Quality, 6) AS Quality,
  round(Performance, 6) AS Performance, round(OEE, 6) AS OEE, employee_count"""


@register("oee_gold", _GOLD_WITH + f"SELECT {_GOLD_COLS} FROM gold")
def q_oee_gold(spark, sf_dir):
    """Flagship: JSON telemetry -> silver rules -> 5-minute KPIs -> workforce."""
    return round_doubles(window_cols(_gold(spark, sf_dir)))


_SLIDE_GOLD = f"""buckets AS (
  SELECT s.*, time_bucket(INTERVAL '1 minute', messageTimestamp) - INTERVAL '1 minute' * o.i AS window_start
  FROM silver s, (SELECT unnest(range(0, 5)) AS i) o),
sagg AS (
  SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end,
         plantName, productionLine, shiftNumber, {_MEASURES}
  FROM buckets GROUP BY ALL),
skpi AS (SELECT *, {_KPIS} FROM sagg)"""


@register("oee_gold_sliding",
          duck_with("plant", "workforce", extra=[_SILVER, _SLIDE_GOLD]) +
          f"""SELECT {_GOLD_COLS} FROM (
                SELECT k.*, (Availability + Quality + Performance) / 3 AS OEE, w.employee_count
                FROM skpi k JOIN workforce w ON k.shiftNumber = w.shiftNumber) g""")
def q_oee_gold_sliding(spark, sf_dir):
    """5-minute windows sliding every minute."""
    return round_doubles(window_cols(_gold(spark, sf_dir, slide="1 minute")))


@register("oee_quality_report",
          duck_with("plant") + """, flags AS (
  SELECT coalesce(defectivePartsMade >= 0, false) AS r1, coalesce(totalPartsMade >= 0, false) AS r2,
         coalesce(oilLevel >= 0, false) AS r3,
         coalesce(shiftNumber >= 1 AND shiftNumber <= 3, false) AS r4 FROM plant),
t AS (SELECT count(*) AS total_rows,
             CAST(count(*) FILTER (WHERE r1 AND r2 AND r3 AND r4) AS BIGINT) AS kept_rows,
             CAST(count(*) FILTER (WHERE NOT r1) AS BIGINT) AS f1,
             CAST(count(*) FILTER (WHERE NOT r2) AS BIGINT) AS f2,
             CAST(count(*) FILTER (WHERE NOT r3) AS BIGINT) AS f3,
             CAST(count(*) FILTER (WHERE NOT r4) AS BIGINT) AS f4 FROM flags)
SELECT 'positive_defective_parts' AS rule, f1 AS failed_rows, total_rows, kept_rows FROM t
UNION ALL SELECT 'positive_parts_made', f2, total_rows, kept_rows FROM t
UNION ALL SELECT 'positive_oil_level', f3, total_rows, kept_rows FROM t
UNION ALL SELECT 'expected_shifts', f4, total_rows, kept_rows FROM t""")
def q_oee_quality_report(spark, sf_dir):
    """P8 report: rows failing each silver rule (on the parsed JSON)."""
    from millrace.operators.select import flatten
    bronze = _bronze(spark, sf_dir)
    parsed = bronze.select(F.from_json("body", oee.infer_json_schema()).alias("j"))
    flat = flatten(parsed, "j.telemetry")
    return quality_report(flat)


@register("oee_warnings", _GOLD_WITH + """, w AS (
  SELECT unnest([
    CASE WHEN NOT coalesce(defectivePartsMade < 35, false) THEN 'warn_defective_parts' END,
    CASE WHEN NOT coalesce(min_temperature > 70, false) THEN 'warn_low_temperature' END,
    CASE WHEN NOT coalesce(min_oilLevel > 60, false) THEN 'warn_low_oilLevel' END,
    CASE WHEN NOT coalesce(Quality > 99, false) THEN 'warn_decrease_Quality' END,
    CASE WHEN NOT coalesce(OEE > 99.3, false) THEN 'warn_decrease_OEE' END]) AS warning
  FROM gold)
SELECT warning, count(*) AS windows FROM w WHERE warning IS NOT NULL GROUP BY warning""")
def q_oee_warnings(spark, sf_dir):
    """Gold windows violating each warning rule."""
    return oee.oee_warnings(_gold(spark, sf_dir))


@register("dash_oee_formatted", _GOLD_WITH + """
SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS window_start,
       strftime(window_end, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS window_end,
       plantName, productionLine, shiftNumber, round(OEE, 6) AS OEE, employee_count FROM gold""")
def q_dash_oee_formatted(spark, sf_dir):
    """Gold with ISO window bounds."""
    d = oee.dash_gold_formatted(_gold(spark, sf_dir))
    return round_doubles(d.select("window_start", "window_end", "plantName", "productionLine",
                                  "shiftNumber", "OEE", "employee_count"))


@register("dash_oee_counters", _GOLD_WITH + """
SELECT round(avg(OEE), 6) AS avg_oee, round(avg(Availability), 6) AS avg_availability,
       round(avg(Performance), 6) AS avg_performance, round(avg(Quality), 6) AS avg_quality,
       round(avg(avg_oilLevel), 6) AS avg_oil_level, round(max(max_oilLevel), 6) AS max_oil_level,
       CAST(sum(totalPartsMade) AS BIGINT) AS total_parts,
       CAST(sum(defectivePartsMade) AS BIGINT) AS total_defective FROM gold""")
def q_dash_oee_counters(spark, sf_dir):
    """Counters."""
    return round_doubles(oee.dash_counters(_gold(spark, sf_dir)))


@register("dash_oee_trend", _GOLD_WITH + """
SELECT window_start AS start, round(avg(totalPartsMade), 6) AS avg_parts,
       round(avg(defectivePartsMade), 6) AS avg_defects, round(avg(OEE), 6) AS avg_oee
FROM gold GROUP BY window_start""")
def q_dash_oee_trend(spark, sf_dir):
    """D3: parts/defects/OEE per window start."""
    d = oee.dash_trend(_gold(spark, sf_dir))
    return round_doubles(d.withColumn("start", F.col("start").cast("timestamp_ntz")))


@register("dash_oee_table", _GOLD_WITH + """
SELECT shiftNumber, plantName, productionLine, round(avg(OEE), 6) AS avg_oee,
       round(avg(Availability), 6) AS avg_availability, round(avg(Quality), 6) AS avg_quality,
       round(avg(Performance), 6) AS avg_performance, count(*) AS windows
FROM gold GROUP BY ALL""")
def q_dash_oee_table(spark, sf_dir):
    """OEE by shift / plant / line."""
    return round_doubles(oee.dash_oee_table(_gold(spark, sf_dir)))


@register("dash_oee_variance", _GOLD_WITH + """
SELECT plantName, round(var_samp(OEE), 6) AS oee_variance FROM gold GROUP BY plantName""")
def q_dash_oee_variance(spark, sf_dir):
    """Variance of OEE per plant."""
    return round_doubles(oee.dash_oee_variance(_gold(spark, sf_dir)))


@register("oee_plant_shift_rollup", _GOLD_WITH + """
SELECT plantName, shiftNumber, CAST(sum(totalPartsMade) AS BIGINT) AS parts,
       CAST(sum(defectivePartsMade) AS BIGINT) AS defective, max(employee_count) AS employee_count,
       round(sum(defectivePartsMade) * 1.0 / nullif(sum(totalPartsMade), 0), 6) AS defect_rate,
       round(sum(totalPartsMade) * 1.0 / nullif(max(employee_count), 0), 6) AS parts_per_employee
FROM gold GROUP BY plantName, shiftNumber""")
def q_oee_plant_shift_rollup(spark, sf_dir):
    """Plant / shift roll-up."""
    return round_doubles(oee.plant_shift_rollup(_gold(spark, sf_dir)))


@register("oee_silver_readings", duck_with("plant", extra=[_SILVER]) + """
SELECT batchNumber, deviceId, memoryFree, memoryUsed, systemDiskFreePercent, round(oilLevel, 6) AS oilLevel FROM silver""")
def q_oee_silver_readings(spark, sf_dir):
    """S4 + F8 + P3 + P8: readings parsed by the example document's schema, with its memory fields."""
    silver = oee.oee_silver(_bronze(spark, sf_dir))
    return round_doubles(silver.select("batchNumber", "deviceId", "memoryFree", "memoryUsed", "systemDiskFreePercent", "oilLevel"))
