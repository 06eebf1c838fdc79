"""Scalar functions.  Every helper returns a Column built from
JVM-side built-ins, so it stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "hour_of_day", "day_of_week", "to_ts", "epoch_to_ts", "to_day",
    "month_start", "iso_utc", "day_label", "md5_coin", "md5_bucket",
    "array_lookup", "null_flag", "clip", "safe_div", "json_int",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_day(ts, as_float: bool = True) -> Column:
    """hour of day (0-23)."""
    h = F.hour(_c(ts))
    return h.cast("float") if as_float else h


def day_of_week(ts, as_float: bool = True) -> Column:
    """day of week, 1 = Sunday ... 7 = Saturday."""
    d = F.dayofweek(_c(ts))
    return d.cast("float") if as_float else d


def to_ts(s, fmt: str | None = None) -> Column:
    """string -> TIMESTAMP; unparsable strings give null (ANSI-safe)."""
    if fmt is None:
        return F.try_to_timestamp(_c(s))
    return F.try_to_timestamp(_c(s), F.lit(fmt))


def epoch_to_ts(secs) -> Column:
    """epoch seconds -> TIMESTAMP."""
    return F.timestamp_seconds(_c(secs))


def to_day(ts) -> Column:
    """timestamp -> DATE."""
    return F.to_date(_c(ts))


def month_start(ts) -> Column:
    """truncate to the first instant of the month."""
    return F.date_trunc("MONTH", _c(ts))


def iso_utc(ts) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'`` (session time zone is UTC)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def day_label(ts) -> Column:
    """``d MMM yyyy`` label, e.g. ``3 Jan 2024``."""
    return F.date_format(_c(ts), "d MMM yyyy")


def md5_bucket(*keys, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from the md5 of the key(s).

    First 8 hex digits of md5 as an unsigned 32-bit integer, modulo
    ``buckets``.  The same value is computable in DuckDB, so seeded
    randomness becomes testable."""
    k = F.concat_ws("|", *[_c(x).cast("string") for x in keys]) if len(keys) > 1 \
        else _c(keys[0]).cast("string")
    return F.pmod(F.conv(F.substring(F.md5(k), 1, 8), 16, 10).cast("bigint"),
                  F.lit(buckets))


def md5_coin(*keys) -> Column:
    """reproducible 0.0/1.0 coin flip keyed by the row key (replaces a
    seeded ``round(rand(seed))``)."""
    return md5_bucket(*keys, buckets=2).cast("double")


def array_lookup(values: list, key) -> Column:
    """pick ``values[pmod(hash(key), n)]`` from a literal array."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(F.hash(_c(key)), F.lit(len(values))) + 1).cast("int"))


def null_flag(c) -> Column:
    """1 when null else 0."""
    return _c(c).isNull().cast("int")


def clip(c, lo=None, hi=None) -> Column:
    """clamp to [lo, hi] (either bound optional)."""
    out = _c(c)
    if lo is not None:
        out = F.when(out < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > F.lit(hi), F.lit(hi)).otherwise(out)
    return out


def safe_div(a, b) -> Column:
    """x / 0 -> null instead of an ANSI error."""
    return F.try_divide(_c(a), _c(b))


def json_int(json_col, field: str) -> Column:
    """Integer field of a JSON string column (null when absent)."""
    return F.get_json_object(_c(json_col), f"$.{field}").try_cast("int")
