"""Named engine (remaining-useful-life) profiling queries and DuckDB twins
(SURVEY G1, G7-G13, E7, E8, P6, W1, W2 over the ``engine`` view)."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import profile as P
from millrace.operators.aggregates import count_by
from millrace.operators.quality import duplicate_rows, null_profile
from millrace.operators.select import slice_entities
from millrace.operators.windows import rolling_avg_and_diff
from millrace.plans.common import round_doubles
from millrace.plans.registry import register
from millrace.sources.fixtures import duck_with, stored, view

ENGINE_COLS = ["id", "Cycle", "OpSet1", "OpSet2", "SensorMeasure1", "SensorMeasure2",
               "RemainingUsefulLife"]
_W = duck_with("engine")


def _engine(spark, sf_dir):
    """The engine-cycles table (stored once per application)."""
    return stored(spark, sf_dir, "engine")


@register("engine_rows_per_id", _W + "SELECT id, count(*) AS count FROM engine GROUP BY id")
def q_engine_rows_per_id(spark, sf_dir):
    """G1: cycles per engine, ordered by id."""
    return count_by(_engine(spark, sf_dir), "id")


@register("engine_null_profile", _W + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM engine"
    for c in ENGINE_COLS) + ")")
def q_engine_null_profile(spark, sf_dir):
    """G7 / F15."""
    return null_profile(_engine(spark, sf_dir))


_READING = ["id", "OpSet1", "OpSet2", "SensorMeasure1", "SensorMeasure2"]


@register("engine_duplicate_readings", _W + f"""
SELECT {', '.join(_READING)}, count(*) AS count FROM engine GROUP BY ALL HAVING count(*) > 1""")
def q_engine_duplicate_readings(spark, sf_dir):
    """Identical readings (all measured columns) occurring more than once."""
    return duplicate_rows(_engine(spark, sf_dir).select(*_READING))


def _pairs():
    return [(a, b) for i, a in enumerate(ENGINE_COLS) for b in ENGINE_COLS[i:]]


@register("engine_correlation", _W + " UNION ALL ".join(
    f"SELECT '{a}' AS column1, '{b}' AS column2, "
    f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation FROM engine"
    for a, b in _pairs()))
def q_engine_correlation(spark, sf_dir):
    """Pearson matrix in one aggregate."""
    return round_doubles(P.correlation_matrix(_engine(spark, sf_dir), ENGINE_COLS))


_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT id AS rid, '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM engine" for c in ENGINE_COLS) + ")"
_FZ = """fz AS (
  SELECT col, q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT col, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY col))"""


@register("engine_quartiles", duck_with("engine", extra=[_LONG, _FZ]) + """
SELECT col AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3 FROM fz""")
def q_engine_quartiles(spark, sf_dir):
    """G10 (exact form): quartiles of every column in one aggregate."""
    return round_doubles(P.quartiles(_engine(spark, sf_dir), ENGINE_COLS))


@register("engine_outliers", duck_with("engine", extra=[_LONG, _FZ]) + """,
t AS (SELECT l.col, l.rid, CASE WHEN v < lo THEN 'lower' WHEN v > hi THEN 'upper' END AS side
      FROM long l JOIN fz USING (col)),
s AS (SELECT col, side, count(*) AS n,
             array_to_string(list_slice(list(rid ORDER BY rid), 1, 10), ',') AS ids
      FROM t WHERE side IS NOT NULL GROUP BY col, side)
SELECT fz.col AS variable_name, round(lo, 6) AS lower_fence, round(hi, 6) AS upper_fence,
       CAST(coalesce(sl.n, 0) AS BIGINT) AS n_below_lower, CAST(coalesce(su.n, 0) AS BIGINT) AS n_above_upper,
       sl.ids AS lower_ids, su.ids AS upper_ids,
       CASE WHEN coalesce(sl.n, 0) + coalesce(su.n, 0) = 0 THEN 'No outliers present' END AS message
FROM fz LEFT JOIN s sl ON sl.col = fz.col AND sl.side = 'lower'
        LEFT JOIN s su ON su.col = fz.col AND su.side = 'upper'""")
def q_engine_outliers(spark, sf_dir):
    """E7 + G12: IQR outlier report with the first 10 ids per side."""
    return round_doubles(P.outlier_report(_engine(spark, sf_dir), ENGINE_COLS, id_col="id"))


def _winsor_sql():
    sel = []
    for c in ENGINE_COLS:
        sel.append(f"round(CASE WHEN {c} < (SELECT lo FROM fz WHERE col = '{c}') THEN (SELECT lo FROM fz WHERE col = '{c}') "
                   f"WHEN {c} > (SELECT hi FROM fz WHERE col = '{c}') THEN (SELECT hi FROM fz WHERE col = '{c}') "
                   f"ELSE CAST({c} AS DOUBLE) END, 6) AS {c}")
    return duck_with("engine", extra=[_LONG, _FZ]) + "SELECT " + ", ".join(sel) + " FROM engine"


@register("engine_winsorized", _winsor_sql())
def q_engine_winsorized(spark, sf_dir):
    """Every numeric column clamped to its IQR fences."""
    return round_doubles(P.winsorize(_engine(spark, sf_dir), ENGINE_COLS))


def _exact_mean(c: str) -> str:
    """Mean of an exact integer sum in millionths, rounded half away from zero to 6 digits."""
    s, n = f"sum(CAST(round(CAST({c} AS DOUBLE) * 1000000) AS HUGEINT))", f"count({c})"
    return f"CAST(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) AS DOUBLE) / 1000000"


@register("engine_describe", _W + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {_exact_mean(c)} AS mean,
        round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75,
        round(CAST(max({c}) AS DOUBLE), 6) AS max FROM engine""" for c in ENGINE_COLS))
def q_engine_describe(spark, sf_dir):
    """Count / mean / std / min / quartiles / max per column."""
    return round_doubles(P.describe(_engine(spark, sf_dir), ENGINE_COLS))


@register("engine_slice", _W + """
SELECT id, Cycle, round(SensorMeasure1, 6) AS SensorMeasure1 FROM engine WHERE id IN (1, 2, 3, 4)""")
def q_engine_slice(spark, sf_dir):
    """A few engines, three columns (filter and projection reach the scan)."""
    return round_doubles(slice_entities(_engine(spark, sf_dir), "id", [1, 2, 3, 4],
                                        ["id", "Cycle", "SensorMeasure1"]))


@register("engine_cycle_features", _W + """
SELECT id, Cycle,
  round(CAST(CAST(avg(SensorMeasure1) OVER w2 AS FLOAT) AS DOUBLE), 6) AS SensorMeasure1_rolling_avg,
  round(CAST(CAST(avg(SensorMeasure2) OVER w2 AS FLOAT) AS DOUBLE), 6) AS SensorMeasure2_rolling_avg,
  round(CAST(CAST(SensorMeasure1 - lag(SensorMeasure1) OVER w AS FLOAT) AS DOUBLE), 6) AS SensorMeasure1_diff,
  round(CAST(CAST(SensorMeasure2 - lag(SensorMeasure2) OVER w AS FLOAT) AS DOUBLE), 6) AS SensorMeasure2_diff
FROM engine WINDOW w AS (PARTITION BY id ORDER BY Cycle),
  w2 AS (PARTITION BY id ORDER BY Cycle ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)""")
def q_engine_cycle_features(spark, sf_dir):
    """W1 + W2 over cycles: rolling mean of the current and previous cycle and
    the change from the previous cycle (FLOAT, null on the first cycle).
    Skew-safe form: cycles are segmented in blocks of 64."""
    e = _engine(spark, sf_dir)
    seg = F.floor(F.col("Cycle") / 64)
    d = rolling_avg_and_diff(e, ["SensorMeasure1", "SensorMeasure2"], "id", ["Cycle"], segment=seg)
    return round_doubles(d.select("id", "Cycle", *[f"SensorMeasure{i}_{k}" for k in ("rolling_avg", "diff") for i in (1, 2)]))


@register("engine_shape", _W + """
SELECT count(*) AS rows, 7 AS columns, 'id bigint,Cycle int,OpSet1 double,OpSet2 double,SensorMeasure1 double,SensorMeasure2 double,RemainingUsefulLife int' AS types
FROM engine""")
def q_engine_shape(spark, sf_dir):
    """Number of rows and columns, and the columns' types."""
    e = _engine(spark, sf_dir)
    types = ",".join(f"{c} {t}" for c, t in P.dtypes_table(e))
    return P.shape(e).withColumn("types", F.lit(types))


@register("engine_cycles", _W + """
SELECT id, Cycle, round(OpSet1, 6) AS OpSet1, round(OpSet2, 6) AS OpSet2,
       round(SensorMeasure1, 6) AS SensorMeasure1, round(SensorMeasure2, 6) AS SensorMeasure2,
       RemainingUsefulLife FROM engine""")
def q_engine_cycles(spark, sf_dir):
    """W4 (skew-safe, global per engine): cycle number of every reading
    (numbered inside (engine, month) plus month offsets) and the remaining
    useful life = cycles of the engine - cycle."""
    return round_doubles(view(spark, sf_dir, "engine"))
