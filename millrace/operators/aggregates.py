"""Aggregations and the OEE KPI expressions.

All are hash aggregates with a partial (map-side) step, so a hot group key is
pre-aggregated on every partition before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, key, out: str = "count") -> DataFrame:
    """Rows per key, ordered by key."""
    keys = key if isinstance(key, (list, tuple)) else [key]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).orderBy(*keys)


def count_if(cond: Column) -> Column:
    """Conditional count as BIGINT."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


OEE_MEASURES = {
    "avg_systemDiskFreePercent": lambda: F.avg("systemDiskFreePercent"),
    "avg_oilLevel": lambda: F.avg("oilLevel"),
    "min_oilLevel": lambda: F.min("oilLevel"),
    "max_oilLevel": lambda: F.max("oilLevel"),
    "min_temperature": lambda: F.min("temperature"),
    "max_temperature": lambda: F.max("temperature"),
    "avg_temperature": lambda: F.avg("temperature"),
    "totalPartsMade": lambda: F.sum("totalPartsMade").cast("bigint"),
    "defectivePartsMade": lambda: F.sum("defectivePartsMade").cast("bigint"),
    "healthy_count": lambda: count_if(F.col("machineHealth") == "Healthy"),
    "error_count": lambda: count_if(F.col("machineHealth") == "Error"),
    "warning_count": lambda: count_if(F.col("machineHealth") == "Warning"),
    "total_count": lambda: F.count(F.lit(1)),
}


def oee_measures() -> list[Column]:
    """G2 + G3: the per-window measures of the OEE gold table."""
    return [f().alias(n) for n, f in OEE_MEASURES.items()]


def oee_kpis(df: DataFrame) -> DataFrame:
    """Availability, Quality, Performance and OEE in percent.

    Availability = (healthy - error) / all readings
    Quality      = (parts - defective parts) / parts
    Performance  = healthy / (healthy + error + warning)
    OEE          = mean of the three
    A zero denominator gives null (``try_divide``), never an error."""
    h, e, w = F.col("healthy_count"), F.col("error_count"), F.col("warning_count")
    avail = F.try_divide((h - e) * 100, F.col("total_count"))
    qual = F.try_divide((F.col("totalPartsMade") - F.col("defectivePartsMade")) * 100,
                        F.col("totalPartsMade"))
    perf = F.try_divide(h * 100, h + e + w)
    return (df.withColumn("Availability", avail.cast("double"))
              .withColumn("Quality", qual.cast("double"))
              .withColumn("Performance", perf.cast("double"))
              .withColumn("OEE", (F.col("Availability") + F.col("Quality") + F.col("Performance")) / 3))


def global_kpis(df: DataFrame, spec: dict) -> DataFrame:
    """Whole-table aggregates, ``spec`` = {alias: Column}."""
    return df.agg(*[c.alias(n) for n, c in spec.items()])


def distinct_count(df: DataFrame, col: str, by=None, out: str = "n_distinct",
                   approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Exact (or HyperLogLog++ with ``approx``) distinct count, global or
    per group.  The exact form is a two-level aggregate (distinct pairs, then
    count), which Spark plans with partial aggregation at both levels."""
    agg = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    if by:
        keys = by if isinstance(by, (list, tuple)) else [by]
        return df.groupBy(*keys).agg(agg.alias(out))
    return df.agg(agg.alias(out))


def distinct_sketches(df: DataFrame, col: str, by, lg_k: int = 12) -> DataFrame:
    """A mergeable distinct-count sketch per group (``sketch``, at most 2^lg_k
    registers); its relative standard error is about 0.83 / sqrt(2^lg_k).  Keep
    the table per fine group (model and day) and roll it up later."""
    keys = by if isinstance(by, (list, tuple)) else [by]
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col, lg_k).alias("sketch"))


def rolled_up_distinct(sketches: DataFrame, by=None, out: str = "n_distinct") -> DataFrame:
    """Distinct counts of coarser groups from the sketches of finer ones, without reading the rows again."""
    keys = (by if isinstance(by, (list, tuple)) else [by]) if by else []
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))


def variance_by(df: DataFrame, key, col: str, out: str = "variance") -> DataFrame:
    """Sample variance per group."""
    return df.groupBy(key).agg(F.var_samp(col).alias(out))


def totals_by_time(df: DataFrame, ts: str, unit: str, measures: dict) -> DataFrame:
    """Totals per truncated time (``unit`` = MONTH, DAY,
    HOUR...)."""
    return df.groupBy(F.date_trunc(unit, F.col(ts)).alias("period")).agg(
        *[c.alias(n) for n, c in measures.items()])
