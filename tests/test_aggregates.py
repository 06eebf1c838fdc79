"""Aggregate helpers and the approximate variants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as AG
from millrace.operators.profile import describe, quartiles


def _df(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i % 40), float(v), f"2024-0{1 + i % 3}-0{1 + i % 9} 10:00:00")
            for i, v in enumerate(rng.normal(size=4000))]
    return (spark.createDataFrame(rows, "k int, v double, ts string")
                 .withColumn("ts", F.col("ts").cast("timestamp")), rows)


def test_distinct_exact_and_approx(spark):
    df, _ = _df(spark)
    assert AG.distinct_count(df, "k").first().n_distinct == 40
    approx = AG.distinct_count(df, "k", approx=True, rsd=0.02).first().n_distinct
    assert abs(approx - 40) <= 2
    per = {r.k: r.n_distinct for r in AG.distinct_count(df, "v", by="k").collect()}
    assert sum(per.values()) == 4000


def test_variance_totals_global(spark):
    df, rows = _df(spark)
    var = {r.k: r.variance for r in AG.variance_by(df, "k", "v").collect()}
    vals0 = [v for k, v, _ in rows if k == 0]
    assert var[0] == pytest.approx(np.var(vals0, ddof=1), rel=1e-9)
    monthly = {str(r.period)[:7]: r.n for r in
               AG.totals_by_time(df, "ts", "MONTH", {"n": F.count(F.lit(1))}).collect()}
    assert sorted(monthly) == ["2024-01", "2024-02", "2024-03"] and sum(monthly.values()) == 4000
    g = AG.global_kpis(df, {"mean_v": F.avg("v"), "max_v": F.max("v")}).first()
    assert g.mean_v == pytest.approx(np.mean([v for _, v, _ in rows]), rel=1e-9)
    c = AG.count_by(df, "k").collect()
    assert [r.k for r in c] == sorted(r.k for r in c) and sum(r["count"] for r in c) == 4000


def test_approx_quartiles_close_to_exact(spark):
    df, _ = _df(spark)
    ex = {r.column: (r.q1, r.q3) for r in quartiles(df, ["v"]).collect()}
    ap = {r.column: (r.q1, r.q3) for r in quartiles(df, ["v"], method="approx").collect()}
    assert ap["v"][0] == pytest.approx(ex["v"][0], abs=0.05)
    assert ap["v"][1] == pytest.approx(ex["v"][1], abs=0.05)
    d_ex = describe(df, ["v"]).first()
    d_ap = describe(df, ["v"], method="approx").first()
    assert d_ex["count"] == d_ap["count"] == 4000 and d_ap.p50 == pytest.approx(d_ex.p50, abs=0.05)
