"""Joins.

No side is broadcast by hint: the planner, and AQE at run time, decide by
measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_on_keys(left: DataFrame, right: DataFrame, keys, how: str = "inner",
                 right_cols=None) -> DataFrame:
    """Equi-join on several keys, with an explicit column pick on the
    right side (no ambiguous duplicate columns)."""
    keys = list(keys)
    r = right.select(*keys, *(right_cols or [c for c in right.columns if c not in keys]))
    return left.join(r, keys, how)
