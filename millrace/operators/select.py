"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from millrace.functions.scalar import md5_bucket


def typed_select(df: DataFrame, schema, safe: bool = True) -> DataFrame:
    """Project exactly the columns of ``schema`` (StructType or DDL),
    each cast to its declared type; ``safe`` uses ``try_cast`` so dirty input
    becomes null instead of failing under ANSI."""
    st = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    cols = []
    for f in st.fields:
        c = F.col(f.name)
        cols.append((c.try_cast(f.dataType) if safe else c.cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def cast_by_type(df: DataFrame, from_type: str = "double", to_type: str = "float") -> DataFrame:
    """Cast every column whose simple type name is ``from_type``."""
    return df.select(*[F.col(c).cast(to_type).alias(c) if t == from_type else F.col(c)
                       for c, t in df.dtypes])


def flatten(df: DataFrame, *structs: str, keep: list[str] | None = None) -> DataFrame:
    """Star-expand nested struct columns (``s.*``)."""
    return df.select(*(keep or []), *[F.col(f"{s}.*") for s in structs])


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """P4."""
    return df.drop(*cols)


def where(df: DataFrame, cond) -> DataFrame:
    """P5: Column or SQL string predicate."""
    return df.filter(F.expr(cond) if isinstance(cond, str) else cond)


def slice_entities(df: DataFrame, key: str, ids, cols=None) -> DataFrame:
    """``isin`` filter plus projection (pushed to the scan)."""
    out = df.filter(F.col(key).isin(list(ids)))
    return out.select(*cols) if cols else out


def in_range(df: DataFrame, ts: str, lo=None, hi=None, members: list | None = None,
             member_col: str | None = None) -> DataFrame:
    """P10: exclusive time range and exact membership in a value list."""
    out = df
    if lo is not None:
        out = out.filter(F.col(ts) > F.lit(lo).cast("timestamp"))
    if hi is not None:
        out = out.filter(F.col(ts) < F.lit(hi).cast("timestamp"))
    if members is not None and member_col:
        out = out.filter(F.col(member_col).isin(list(members)))
    return out


def containing(df: DataFrame, col: str, text: str) -> DataFrame:
    """rows whose column contains a substring (literal, case-sensitive)."""
    return df.filter(F.contains(F.col(col), F.lit(text)))


def drop_null_rows(df: DataFrame, subset=None) -> DataFrame:
    """P11."""
    return df.na.drop(subset=subset)


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """P12."""
    return df.withColumn(name, F.lit(value))


def hash_sample(df: DataFrame, key, percent: int, seed: str = "") -> DataFrame:
    """Reproducible sample of about ``percent`` % of rows, chosen by the
    md5 bucket of the key (a sampling operator: the cap is the feature)."""
    keys = key if isinstance(key, (list, tuple)) else [key]
    b = md5_bucket(*(keys + ([F.lit(seed)] if seed else [])), buckets=100)
    return df.filter(b < percent)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Bounded look at a table (never the whole table on the driver)."""
    return df.limit(n)
