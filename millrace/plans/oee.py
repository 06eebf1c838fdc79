"""OEE monitoring: JSON telemetry -> typed silver with quality rules ->
5-minute KPIs per plant / line / shift joined with the workforce -> dashboard
queries (SURVEY S4, F8, P3, P8, P9, G2-G5, G14, G18, J1, X2, X3, D1-D5, E13).

The same ``oee_silver`` / ``oee_gold`` functions serve the batch table and the
streaming query (see ``millrace.streaming.oee``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import iso_utc
from millrace.operators.aggregates import oee_kpis, oee_measures
from millrace.operators.quality import SILVER_RULES, apply_quality_rules, flag_quality_warnings
from millrace.operators.select import flatten

# Fixed value: an example telemetry document; its shape (field names and JSON
# types) defines the silver schema.  Values are illustrative only.
EXAMPLE_BODY = """{"applicationId":"app-0","deviceId":"machine-1",
 "messageProperties":{"iothub-connection-device-id":"machine-1",
   "iothub-creation-time-utc":"2024-01-01T00:00:00+00:00","iothub-interface-id":""},
 "telemetry":{"batchNumber":1,"cpuLoad":1.5,"defectivePartsMade":2,"machineHealth":"Healthy",
   "memoryFree":200000000,"memoryUsed":50000000,"messageTimestamp":"2024-01-01T00:00:00.000000Z","oilLevel":97.5,"plantName":"Plant_0",
   "productionLine":"ProductionLine 1","shiftNumber":1,"systemDiskFreePercent":75,
   "systemDiskUsedPercent":25,"temperature":89.5,"totalPartsMade":99}}"""

GROUP_KEYS = ["plantName", "productionLine", "shiftNumber"]


def infer_json_schema(example: str = EXAMPLE_BODY):
    """Schema of an example document, as a foldable Column (no job)."""
    return F.schema_of_json(F.lit(example))


def oee_silver(bronze: DataFrame, schema=None, rules: dict = SILVER_RULES,
               body: str = "body") -> DataFrame:
    """F8 + P3 + F2 + P8: parse ``body`` JSON, flatten the nested structs,
    parse the event time, keep rows passing every silver rule.  Malformed
    documents give null fields and fail the rules."""
    schema = schema if schema is not None else infer_json_schema()
    parsed = bronze.select(F.from_json(F.col(body), schema).alias("j"))
    flat = flatten(parsed, "j.messageProperties", "j.telemetry",
                   keep=[F.col("j.applicationId").alias("applicationId"),
                         F.col("j.deviceId").alias("deviceId")])
    flat = flat.withColumn("messageTimestamp", F.try_to_timestamp(F.col("messageTimestamp")))
    return apply_quality_rules(flat, rules)


def oee_gold(silver: DataFrame, workforce: DataFrame, window: str = "5 minutes",
             slide: str | None = None, watermark: str | None = None,
             ts: str = "messageTimestamp") -> DataFrame:
    """KPIs per (time window, plant, line, shift), joined
    with the workforce of the shift.

    The workforce may hold any number of rows per shift (each KPI row meets all
    of them); the planner, and AQE at run time, broadcast it by its measured size.
    The KPI aggregate shuffles on (window, plant, line, shift) after a
    map-side partial aggregate; ``slide`` gives the sliding form (X3)."""
    src = silver.withWatermark(ts, watermark) if watermark else silver
    win = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    agg = src.groupBy(win.alias("window"), *GROUP_KEYS).agg(*oee_measures())
    kpis = oee_kpis(agg)
    wf = workforce.filter(F.col("shiftNumber").between(1, 3))
    return kpis.join(wf, ["shiftNumber"], "inner")


def oee_warnings(gold: DataFrame) -> DataFrame:
    """P9 on gold: one row per warning rule with the number of windows that
    violate it."""
    flagged = flag_quality_warnings(gold)
    return (flagged.select(F.explode("warnings").alias("warning"))
                   .groupBy("warning").agg(F.count(F.lit(1)).alias("windows")))


# ----------------------------------------------------------------- dashboard
def dash_gold_formatted(gold: DataFrame) -> DataFrame:
    """Gold rows with ISO-8601 window bounds."""
    rest = [c for c in gold.columns if c != "window"]
    return gold.select(iso_utc("window.start").alias("window_start"),
                       iso_utc("window.end").alias("window_end"), *rest)


def dash_counters(gold: DataFrame) -> DataFrame:
    """Whole-table averages and totals."""
    return gold.agg(
        F.avg("OEE").alias("avg_oee"), F.avg("Availability").alias("avg_availability"),
        F.avg("Performance").alias("avg_performance"), F.avg("Quality").alias("avg_quality"),
        F.avg("avg_oilLevel").alias("avg_oil_level"), F.max("max_oilLevel").alias("max_oil_level"),
        F.sum("totalPartsMade").cast("bigint").alias("total_parts"),
        F.sum("defectivePartsMade").cast("bigint").alias("total_defective"))


def dash_trend(gold: DataFrame) -> DataFrame:
    """Averages per window start."""
    return (gold.groupBy(F.col("window.start").alias("start"))
                .agg(F.avg("totalPartsMade").alias("avg_parts"),
                     F.avg("defectivePartsMade").alias("avg_defects"),
                     F.avg("OEE").alias("avg_oee")))


def dash_oee_table(gold: DataFrame) -> DataFrame:
    """OEE by shift / plant / line."""
    return (gold.groupBy("shiftNumber", "plantName", "productionLine")
                .agg(F.avg("OEE").alias("avg_oee"), F.avg("Availability").alias("avg_availability"),
                     F.avg("Quality").alias("avg_quality"),
                     F.avg("Performance").alias("avg_performance"),
                     F.count(F.lit(1)).alias("windows")))


def dash_oee_variance(gold: DataFrame) -> DataFrame:
    """Sample variance of OEE per plant."""
    return gold.groupBy("plantName").agg(F.var_samp("OEE").alias("oee_variance"))


def plant_shift_rollup(gold: DataFrame) -> DataFrame:
    """Parts per shift and defect rate per plant and shift, with the
    workforce size (parts per employee)."""
    return (gold.groupBy("plantName", "shiftNumber")
                .agg(F.sum("totalPartsMade").cast("bigint").alias("parts"),
                     F.sum("defectivePartsMade").cast("bigint").alias("defective"),
                     F.max("employee_count").alias("employee_count"))
                .withColumn("defect_rate", F.try_divide(F.col("defective") * 1.0, F.col("parts")))
                .withColumn("parts_per_employee",
                            F.try_divide(F.col("parts") * 1.0, F.col("employee_count"))))
