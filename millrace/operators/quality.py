"""Row quality rules and table checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The silver-layer rules of the OEE pipeline (name -> SQL).
SILVER_RULES = {
    "positive_defective_parts": "defectivePartsMade >= 0",
    "positive_parts_made": "totalPartsMade >= 0",
    "positive_oil_level": "oilLevel >= 0",
    "expected_shifts": "shiftNumber >= 1 and shiftNumber <= 3",
}

# The gold-layer warning rules of the OEE pipeline.
GOLD_WARNINGS = {
    "warn_defective_parts": "defectivePartsMade < 35",
    "warn_low_temperature": "min_temperature > 70",
    "warn_low_oilLevel": "min_oilLevel > 60",
    "warn_decrease_Quality": "Quality > 99",
    "warn_decrease_OEE": "OEE > 99.3",
}


def apply_quality_rules(df: DataFrame, rules: dict = SILVER_RULES) -> DataFrame:
    """Keep rows that pass every rule; a rule evaluating to null drops the
    row.  One filter: Catalyst pushes it into the scan / JSON parse."""
    cond = reduce(lambda a, b: a & b,
                  [F.coalesce(F.expr(r), F.lit(False)) for r in rules.values()])
    return df.filter(cond)


def quality_report(df: DataFrame, rules: dict = SILVER_RULES) -> DataFrame:
    """Rows failing each rule, plus total and kept rows: one aggregate pass,
    unpivoted to (rule, failed)."""
    fails = [F.sum(F.when(F.coalesce(F.expr(r), F.lit(False)), 0).otherwise(1)).cast("bigint").alias(n)
             for n, r in rules.items()]
    allok = reduce(lambda a, b: a & b, [F.coalesce(F.expr(r), F.lit(False)) for r in rules.values()])
    agg = df.agg(*fails,
                 F.count(F.lit(1)).alias("__total"),
                 F.sum(F.when(allok, 1).otherwise(0)).cast("bigint").alias("__kept"))
    names = list(rules)
    return agg.select(
        F.col("__total").alias("total_rows"), F.col("__kept").alias("kept_rows"),
        F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failed_rows"))
                            for n in names])).alias("r")
    ).select("r.rule", "r.failed_rows", "total_rows", "kept_rows")


def flag_quality_warnings(df: DataFrame, rules: dict = GOLD_WARNINGS,
                          out: str = "warnings") -> DataFrame:
    """Array of the names of the warning rules a row violates (null rule
    result counts as a violation); rows are kept."""
    flags = [F.when(~F.coalesce(F.expr(r), F.lit(False)), F.lit(n)) for n, r in rules.items()]
    return df.withColumn(out, F.array_compact(F.array(*flags)))


def null_profile(df: DataFrame, cols=None) -> DataFrame:
    """Null count per column in one aggregate, unpivoted, sorted by count
    then name."""
    cols = cols or df.columns
    agg = df.agg(*[F.sum(F.col(c).isNull().cast("int")).cast("bigint").alias(c) for c in cols])
    long = agg.unpivot([], cols, "column", "null_count")
    return long.orderBy("null_count", "column")


def duplicate_rows(df: DataFrame, cols=None) -> DataFrame:
    """Groups of identical rows occurring more than once, with the count.
    The aggregate is partial per partition first, so duplicates of one hot row
    collapse before the shuffle."""
    cols = cols or df.columns
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)
