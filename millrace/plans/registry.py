"""Named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and the
DuckDB twin ``ORACLE[name]`` of each (where SQL can express it).

Every query reads whole driver tables (through the fixture views) and returns
a lazily planned DataFrame; doubles are rounded to 6 digits, timestamps are
wall-clock UTC, so both engines produce comparable values."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all():
    # importing the modules fills the registry
    from millrace.plans import q_oee, q_anomaly, q_engine, q_device, q_models, q_learning, q_stream, q_gate  # noqa: F401
    return QUERIES, ORACLE
