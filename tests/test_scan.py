"""The series scan against pandas, over batch and segment boundaries."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.scan import Lag, Smooth, series_scan

SCHEMA = "k string, day int, t long, x double, z string, u long"


def series(seed=2, n=400):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(n):
        k = ["hot", "hot", "a", "b", None][rng.integers(5)]
        day = [None, 1, 2, 3, 9][rng.integers(5)] if k != "b" else 4
        x = None if rng.random() < 0.4 else float(rng.normal(50, 9))
        rows.append((k, day, int(rng.integers(50)), x, None if rng.random() < 0.3 else f"z{u}", u))
    rows += [("gap", d, 0, 7.0 if d in (0, 60) else None, "g", 1000 + d) for d in range(80)]
    rows += [("none", d, 0, None, None, 2000 + d) for d in range(3)]
    return rows


def expected(rows):
    p = pd.DataFrame(rows, columns=["k", "day", "t", "x", "z", "u"]).astype({"x": float})
    p["dd"] = p.day.fillna(1e9)
    p = p.sort_values(["dd", "t", "u"], kind="stable")
    parts = []
    for _, g in p.groupby(p.k.fillna("~"), sort=False):
        g = g.copy()
        g["slow"] = g.x.shift(1).ewm(span=600).mean()
        g["now"] = g.x.ewm(com=5).mean()
        by = g.groupby("dd", sort=False).x
        g["prev"] = by.transform(lambda v: v.shift(1).ewm(com=5).mean())
        g["dev"] = (g.prev - g.x).groupby(g.dd, sort=False).ffill()
        g["lag1"], g["lag4"], g["zlag"] = g.x.shift(1), g.x.shift(4), g.z.shift(2)
        g["trip"] = g.dd.rank(method="dense").astype(int)
        parts.append(g)
    return pd.concat(parts).set_index("u")


@pytest.mark.parametrize("batch", [3, 10_000])
def test_scan_equals_pandas(spark, batch):
    rows = series()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = series_scan(df, "k", ["t", "u"], F.col("day"),
                          smooth=[Smooth("x", "slow", 2 / 601, shift=1), Smooth("x", "now", 1 / 6),
                                  Smooth("x", "prev", 1 / 6, shift=1, restart=True, deviation="dev")],
                          lags=[Lag("x", 1, "lag1"), Lag("x", 4, "lag4"), Lag("z", 2, "zlag")], rank="trip").toPandas().set_index("u")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = expected(rows).loc[got.index]
    assert len(got) == len(rows)
    for c in ("slow", "now", "prev", "dev", "lag1", "lag4"):
        assert np.allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, equal_nan=True), c
    assert (got.trip == want.trip).all()
    assert (got.zlag.fillna("-") == want.zlag.fillna("-")).all()


def test_segments_finer_than_the_restarting_series(spark):
    rows = [("d", h // 6, h, None if h % 5 == 2 else float(h * h % 17), None, h) for h in range(48)]
    df = spark.createDataFrame(rows, SCHEMA)
    s = [Smooth("x", "prev", 1 / 6, shift=1, restart=True, deviation="dev"), Smooth("x", "all", 1 / 6, shift=1, deviation="all_dev")]
    fine = series_scan(df, "k", "t", F.col("t").cast("int") / 2, smooth=s, within=F.col("day"), rank="trip").toPandas().set_index("u")
    plain = series_scan(df, "k", "t", F.col("day"), smooth=s, rank="trip").toPandas().set_index("u").loc[fine.index]
    assert np.allclose(fine.prev, plain.prev, equal_nan=True) and np.allclose(fine.dev, plain.dev, equal_nan=True)
    assert np.allclose(fine["all"], plain["all"], equal_nan=True) and np.allclose(fine.all_dev, plain.all_dev, equal_nan=True)
    assert (fine.trip == plain.trip).all() and fine.trip.max() == 8


def test_scan_of_an_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert series_scan(df, "k", "t", F.col("day"), smooth=[Smooth("x", "s", 0.5, deviation="d")], lags=[Lag("x", 2, "l")]).count() == 0
