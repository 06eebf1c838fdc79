"""Fixture views: the reference's input schemas derived from the driver's
test tables (see FIXTURES.md part B).

Each ``*_view(spark, sf_dir)`` returns a lazy DataFrame over the parquet
files, so scans keep column pruning and filter push-down.  Each view also has
a DuckDB twin (``DUCK_CTES``) used by ``oracle_sql``; both sides state the same
derivation so results can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalar import json_int
from millrace.session import ensure_session_defaults

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S1 over the driver's parquet layout: ``{sf_dir}/{name}.parquet``."""
    ensure_session_defaults(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that plans fewer splits than the cluster has cores (a
    small file written as one row group reads in ONE task) round-robin over
    ``defaultParallelism`` partitions.  Used before CPU-heavy row work (JSON
    documents); a large table plans thousands of splits and is returned
    untouched, without a shuffle."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def _k():
    return json_int("props", "k")


def telemetry_view(spark, sf_dir) -> DataFrame:
    """A1 silver sensor readings, from ``events``."""
    e = table(spark, sf_dir, "events")
    k = _k()
    return e.select(
        F.col("event_id"),
        F.col("user_id").cast("int").alias("device_id"),
        F.col("event_type").alias("device_model"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").cast("float").alias("sensor_1"),
        (k % 11).cast("float").alias("sensor_2"),
        ((k + 1) / F.lit(100.0)).cast("float").alias("sensor_3"),
        F.concat(F.lit("site_"), (F.col("user_id") % 4).cast("string")).alias("site_name"),
    )


def plant_view(spark, sf_dir) -> DataFrame:
    """A4 flattened plant telemetry, from ``events``."""
    e = table(spark, sf_dir, "events")
    k = _k()
    return e.select(
        F.concat(F.lit("app-"), (F.col("user_id") % 7).cast("string")).alias("applicationId"),
        F.concat(F.lit("machine-"), F.col("user_id").cast("string")).alias("deviceId"),
        F.col("event_id").alias("batchNumber"),
        F.col("ts").cast("timestamp").alias("messageTimestamp"),
        F.concat(F.lit("Plant_"), (F.col("user_id") % 3).cast("string")).alias("plantName"),
        F.concat(F.lit("ProductionLine "), (F.col("user_id") % 2 + 1).cast("string")).alias("productionLine"),
        (F.floor(F.hour("ts") / 8) + 1).cast("bigint").alias("shiftNumber"),
        F.when(k < 80, "Healthy").when(k < 92, "Warning").otherwise("Error").alias("machineHealth"),
        F.when(k == 99, F.lit(-1)).otherwise(k).cast("bigint").alias("totalPartsMade"),
        F.when(k >= 97, F.lit(40)).otherwise(k % 7).cast("bigint").alias("defectivePartsMade"),
        (F.lit(100.0) - F.lit(0.4) * k.cast("double")).alias("oilLevel"),
        (F.lit(60.0) + F.col("value") / F.lit(10.0)).alias("temperature"),
        (F.lit(200000000) + 1000 * k).cast("bigint").alias("memoryFree"),
        (F.lit(50000000) - 1000 * k).cast("bigint").alias("memoryUsed"),
        (F.lit(100) - k).cast("bigint").alias("systemDiskFreePercent"),
        k.cast("bigint").alias("systemDiskUsedPercent"),
        (F.col("value") / F.lit(5.0)).alias("cpuLoad"),
    )


def plant_json_view(spark, sf_dir) -> DataFrame:
    """A4 as raw JSON documents in a ``body`` column (bronze input)."""
    p = plant_view(spark, sf_dir)
    tel = F.struct(
        "batchNumber", "cpuLoad", "defectivePartsMade", "machineHealth", "memoryFree", "memoryUsed",
        F.date_format("messageTimestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("messageTimestamp"),
        "oilLevel", "plantName", "productionLine", "shiftNumber",
        "systemDiskFreePercent", "systemDiskUsedPercent", "temperature", "totalPartsMade")
    props = F.struct(
        F.col("deviceId").alias("iothub-connection-device-id"),
        F.date_format("messageTimestamp", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("iothub-creation-time-utc"),
        F.lit("").alias("iothub-interface-id"))
    return p.select(F.to_json(F.struct("applicationId", "deviceId",
                                       props.alias("messageProperties"),
                                       tel.alias("telemetry"))).alias("body"))


def workforce_view(spark, sf_dir) -> DataFrame:
    """A5 workforce per shift, from ``customer``."""
    c = table(spark, sf_dir, "customer")
    return (c.select(((F.col("c_custkey") % 3) + 1).cast("bigint").alias("shiftNumber"))
             .groupBy("shiftNumber").agg(F.count("*").alias("employee_count")))


def device_view(spark, sf_dir) -> DataFrame:
    """A7 CNC device readings, from ``events``."""
    e = table(spark, sf_dir, "events")
    k = _k()
    return e.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("device_id"),
        F.concat(F.lit("F"), (F.col("user_id") % 5).cast("string")).alias("factory_id"),
        F.col("event_type").alias("model_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("temperature"),
        (F.lit(900) + 2 * k).cast("double").alias("air_pressure"),
        (7 * k).cast("double").alias("rotation_speed"),
        (F.col("value") / F.lit(5.0)).cast("float").alias("delay"),
        (k / F.lit(20.0)).cast("float").alias("density"),
    )


ENGINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                "l_extendedprice", "l_quantity", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus"]


def engine_raw_view(spark, sf_dir) -> DataFrame:
    """A10 before cycle numbering: one row per engine reading, with the
    columns that order readings inside an engine."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("id"),
        *[F.col(c) for c in ENGINE_ORDER],
    )


def engine_view(spark, sf_dir) -> DataFrame:
    """A10 engine cycles.  ``Cycle`` numbers readings per engine in time
    order; the numbering is skew-safe (see operators.windows.row_number_by)."""
    from millrace.operators.windows import row_number_by
    raw = engine_raw_view(spark, sf_dir)
    # month segments: coarse enough that the per-(engine, month) count table
    # stays far smaller than the data, fine enough to split a hot engine
    numbered = row_number_by(raw, "id", ENGINE_ORDER, out="Cycle",
                             segment=F.date_trunc("MONTH", "l_shipdate"), with_count="n_cycles")
    return numbered.select(
        "id",
        F.col("Cycle").cast("int").alias("Cycle"),
        F.col("l_tax").alias("OpSet1"),
        F.col("l_discount").alias("OpSet2"),
        F.col("l_quantity").alias("SensorMeasure1"),
        F.col("l_extendedprice").alias("SensorMeasure2"),
        (F.col("n_cycles") - F.col("Cycle")).cast("int").alias("RemainingUsefulLife"),
    )


def milling_view(spark, sf_dir) -> DataFrame:
    """A11 milling-machine readings, from ``lineitem``."""
    li = table(spark, sf_dir, "lineitem")
    air = F.lit(300.0) + F.lit(20.0) * F.col("l_tax")
    m = F.col("l_partkey") % 10
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
        F.when(m < 5, "L").when(m < 8, "M").otherwise("H").alias("Type"),
        air.alias("air_temp"),
        (air + F.lit(8.0) + F.lit(20.0) * F.col("l_discount")).alias("process_temp"),
        (F.lit(1200.0) + F.lit(8.0) * (F.col("l_suppkey") % 100).cast("double")).alias("rpm"),
        (F.col("l_quantity") + F.lit(15.0)).alias("torque"),
        (F.col("l_partkey") % 250).cast("double").alias("tool_wear"),
    )


VIEWS = {
    "telemetry": telemetry_view,
    "plant": plant_view,
    "plant_json": plant_json_view,
    "workforce": workforce_view,
    "device": device_view,
    "engine": engine_view,
    "milling": milling_view,
}


def view(spark, sf_dir, name) -> DataFrame:
    return VIEWS[name](spark, sf_dir)


_STORED: dict = {}


def stored(spark, sf_dir, name) -> DataFrame:
    """A fixture view written once per application as a parquet table
    under the shared checkpoint folder, then read like the stored table the
    pipeline expects (e.g. engine cycles arrive with ``Cycle`` and the
    remaining useful life already given).  Later calls read the table."""
    from millrace.sources.io import materialize
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = materialize(view(spark, sf_dir, name), f"fixture_{name}")
    return _STORED[key]


# ---------------------------------------------------------------------------
# DuckDB twins of the views above (oracle side only).
# ---------------------------------------------------------------------------
_K = "CAST(props::json->>'k' AS INTEGER)"

DUCK_CTES = {
    "telemetry": f"""telemetry AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS device_id, event_type AS device_model,
         ts AS "timestamp", CAST(value AS FLOAT) AS sensor_1,
         CAST({_K} % 11 AS FLOAT) AS sensor_2,
         CAST(({_K} + 1) / 100.0::DOUBLE AS FLOAT) AS sensor_3,
         'site_' || CAST(user_id % 4 AS VARCHAR) AS site_name
  FROM events)""",
    "plant": f"""plant AS (
  SELECT 'app-' || CAST(user_id % 7 AS VARCHAR) AS applicationId,
         'machine-' || CAST(user_id AS VARCHAR) AS deviceId,
         event_id AS batchNumber, ts AS messageTimestamp,
         'Plant_' || CAST(user_id % 3 AS VARCHAR) AS plantName,
         'ProductionLine ' || CAST(user_id % 2 + 1 AS VARCHAR) AS productionLine,
         CAST(floor(hour(ts) / 8) + 1 AS BIGINT) AS shiftNumber,
         CASE WHEN {_K} < 80 THEN 'Healthy' WHEN {_K} < 92 THEN 'Warning' ELSE 'Error' END AS machineHealth,
         CAST(CASE WHEN {_K} = 99 THEN -1 ELSE {_K} END AS BIGINT) AS totalPartsMade,
         CAST(CASE WHEN {_K} >= 97 THEN 40 ELSE {_K} % 7 END AS BIGINT) AS defectivePartsMade,
         100.0::DOUBLE - 0.4::DOUBLE * CAST({_K} AS DOUBLE) AS oilLevel,
         60.0::DOUBLE + value / 10.0::DOUBLE AS temperature,
         CAST(200000000 + 1000 * {_K} AS BIGINT) AS memoryFree, CAST(50000000 - 1000 * {_K} AS BIGINT) AS memoryUsed,
         CAST(100 - {_K} AS BIGINT) AS systemDiskFreePercent,
         CAST({_K} AS BIGINT) AS systemDiskUsedPercent,
         value / 5.0::DOUBLE AS cpuLoad
  FROM events)""",
    "workforce": """workforce AS (
  SELECT CAST(c_custkey % 3 + 1 AS BIGINT) AS shiftNumber, count(*) AS employee_count
  FROM customer GROUP BY 1)""",
    "device": f"""device AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS device_id,
         'F' || CAST(user_id % 5 AS VARCHAR) AS factory_id, event_type AS model_id,
         ts AS "timestamp", value AS temperature,
         CAST(900 + 2 * {_K} AS DOUBLE) AS air_pressure,
         CAST(7 * {_K} AS DOUBLE) AS rotation_speed,
         CAST(value / 5.0::DOUBLE AS FLOAT) AS delay,
         CAST({_K} / 20.0::DOUBLE AS FLOAT) AS density
  FROM events)""",
    "engine": """engine AS (
  SELECT l_suppkey AS id,
         CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey,
              l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax,
              l_returnflag, l_linestatus) AS INTEGER) AS Cycle,
         l_tax AS OpSet1, l_discount AS OpSet2, l_quantity AS SensorMeasure1,
         l_extendedprice AS SensorMeasure2,
         CAST(count(*) OVER (PARTITION BY l_suppkey) - row_number() OVER (PARTITION BY l_suppkey
              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
              l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS INTEGER)
           AS RemainingUsefulLife
  FROM lineitem)""",
    "milling": """milling AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_partkey % 10 < 5 THEN 'L' WHEN l_partkey % 10 < 8 THEN 'M' ELSE 'H' END AS Type,
         300.0::DOUBLE + 20.0::DOUBLE * l_tax AS air_temp,
         300.0::DOUBLE + 20.0::DOUBLE * l_tax + 8.0::DOUBLE + 20.0::DOUBLE * l_discount AS process_temp,
         1200.0::DOUBLE + 8.0::DOUBLE * CAST(l_suppkey % 100 AS DOUBLE) AS rpm,
         l_quantity + 15.0::DOUBLE AS torque,
         CAST(l_partkey % 250 AS DOUBLE) AS tool_wear
  FROM lineitem)""",
}


def duck_with(*names: str, extra: list[str] | None = None) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for an oracle query."""
    parts = [DUCK_CTES[n] for n in names] + list(extra or [])
    return "WITH " + ",\n".join(parts) + "\n"
