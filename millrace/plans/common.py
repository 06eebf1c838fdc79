"""Output conventions shared by the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column to ``digits`` (as DOUBLE), so results
    compare across engines regardless of summation order."""
    out = []
    for c, t in df.dtypes:
        if t in ("double", "float"):
            out.append((F.round(F.col(c).cast("double"), digits) + F.lit(0.0)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def window_cols(df: DataFrame, col: str = "window", prefix: str = "window") -> DataFrame:
    """Replace a ``window`` struct by wall-clock (UTC) start/end columns."""
    rest = [c for c in df.columns if c != col]
    return df.select(F.col(f"{col}.start").cast("timestamp_ntz").alias(f"{prefix}_start"),
                     F.col(f"{col}.end").cast("timestamp_ntz").alias(f"{prefix}_end"),
                     *rest)


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Cast TIMESTAMP columns to wall-clock TIMESTAMP_NTZ (UTC session)."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c)
                       for c in df.columns])
