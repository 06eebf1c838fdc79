"""Feature, label and model operators on small fixtures and test tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from millrace.operators import grouped as G
from millrace.operators import models as M
from millrace.operators.features import align_columns, label_anomaly, one_hot
from millrace.plans import anomaly as A
from millrace.sources.fixtures import view


def test_anomaly_label_bounds(spark):
    df = spark.createDataFrame([(1, 81.0), (2, 9.0), (3, 50.0), (4, 80.0), (5, 10.0)],
                               "event_id bigint, sensor_1 double")
    lab = {r.event_id: r.anomaly for r in label_anomaly(df).collect()}
    assert lab[1] == 1.0 and lab[2] == 1.0 and lab[3] == 0.0
    assert lab[4] in (0.0, 1.0) and lab[5] in (0.0, 1.0)   # coin zone (65, 80] / [10, 25)


def test_reading_split_bounds_exclusive(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 20.0), ("2024-01-01 00:00:00", 80.0),
                                ("2024-01-01 00:00:00", 50.0)], "timestamp string, sensor_1 double")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows = A.dash_reading_split(df).collect()
    assert sum(r.anomaly_reading is None and r.non_anomaly_reading is None for r in rows) == 2


def test_single_row_series_diff_zero(spark):
    df = spark.createDataFrame([(7, "2024-01-01 00:00:00", 1.0, 2.0, 3.0, 1)],
                               "device_id int, timestamp string, sensor_1 float, sensor_2 float, "
                               "sensor_3 float, event_id bigint")
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    r = A.anomaly_features(df).collect()[0]
    assert r.sensor_1_diff == 0.0 and r.sensor_1_rolling_avg == 1.0


def test_one_hot_align(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    oh = one_hot(df, "c", prefix="ohe")
    assert sorted(oh.columns) == ["ohe_a", "ohe_b"]
    al = align_columns(oh, ["ohe_a", "ohe_b", "ohe_z"])
    assert al.columns == ["ohe_a", "ohe_b", "ohe_z"] and al.agg(F.sum("ohe_z")).first()[0] == 0.0


def test_grouped_least_squares_matches_numpy(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g in range(3):
        for _ in range(200):
            x1, x2 = rng.normal(), rng.normal()
            rows.append((g, x1, x2, 1.0 + g + 2.0 * x1 - 0.5 * x2 + rng.normal() * 0.1))
    df = spark.createDataFrame(rows, "g int, x1 double, x2 double, y double")
    fit = {r.g: r for r in G.grouped_least_squares(df, "g", ["x1", "x2"], "y").collect()}
    arr = np.array(rows)
    for g in range(3):
        a = arr[arr[:, 0] == g]
        X = np.column_stack([np.ones(len(a)), a[:, 1], a[:, 2]])
        beta = np.linalg.lstsq(X, a[:, 3], rcond=None)[0]
        assert fit[g].intercept == pytest.approx(beta[0], rel=1e-9)
        assert fit[g].coef_x1 == pytest.approx(beta[1], rel=1e-9)
        assert fit[g].coef_x2 == pytest.approx(beta[2], rel=1e-9)
        assert fit[g].n_used == 200


def test_order_search_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    x = np.cumsum(rng.normal(size=120)) + 50
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "k int, t int, v double")
    got = {(r.p, r.d): r.rmse for r in G.order_search(df, "k", ["t"], "v", ps=(0, 1, 2), ds=(0, 1)).collect()}
    seg = {(r.p, r.d): r.rmse for r in G.order_search(df, "k", ["t"], "v", ps=(0, 1, 2), ds=(0, 1),
                                                       segment=F.floor(F.col("t") / 7)).collect()}
    assert seg == pytest.approx(got, rel=1e-9)
    for p in (0, 1, 2):
        for d in (0, 1):
            # all orders on the same rows: those that have the three lags of the largest one
            z = np.r_[np.full(d, np.nan), np.diff(x, n=d)]
            rows = np.arange(3, len(x))
            Y = z[rows]
            X = np.column_stack([np.ones(len(Y))] + [z[rows - j] for j in range(1, p + 1)])
            beta = np.linalg.lstsq(X, Y, rcond=None)[0]
            rmse = np.sqrt(np.mean((Y - X @ beta) ** 2))
            assert got[(p, d)] == pytest.approx(rmse, rel=1e-8)


def test_forecast_fit_from_moments(spark):
    rng = np.random.default_rng(7)
    rows = [(g, t, float(v)) for g in (1, 2) for t, v in enumerate(np.cumsum(rng.normal(size=90)) + 1e4 * g)]
    rows += [(3, t, 5.0) for t in range(9)] + [(4, 0, 1.0), (None, 0, 2.0), (None, 1, 3.0), (None, 2, 5.0), (None, 3, 4.0)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    for p, d in ((1, 0), (2, 1)):
        got = {r.k: r for r in G.forecast_fit(df, "k", ["t"], "v", p, d, segment=F.floor(F.col("t") / 7)).collect()}
        for g in (1, 2):
            x = np.array([v for k, _, v in rows if k == g])
            z = np.r_[np.full(d, np.nan), np.diff(x, n=d)]
            at = np.arange(p + d, len(x))
            X = np.column_stack([np.ones(len(at))] + [z[at - j] for j in range(1, p + 1)])
            beta = np.linalg.lstsq(X, z[at], rcond=None)[0]
            assert [got[g].intercept, *[got[g][f"a{j}"] for j in range(1, p + 1)]] == pytest.approx(list(beta), rel=1e-6)
            assert got[g].rmse == pytest.approx(np.sqrt(np.mean((z[at] - X @ beta) ** 2)), rel=1e-7)
            assert got[g].n_used == got[g].n_scored == len(at)
        assert got[3].rmse is None and got[3].n_scored == 0 and 4 not in got  # constant: collinear; one row: no lag
        assert None in got if (p, d) == (1, 0) else True


def test_tree_classifier_seed_stable(spark):
    f = A.anomaly_feature_table(view(spark, SF_SMALL, "telemetry"))
    train, test = M.hash_split(f, "event_id", 70)
    from millrace.plans.q_models import ANOMALY_CATEGORICAL, ANOMALY_NUMERIC
    pipe = M.make_pipeline("tree_classifier", "anomaly", ANOMALY_NUMERIC, ANOMALY_CATEGORICAL,
                           maxDepth=4, seed=42)
    model = M.fit(pipe, train, "anomaly")
    s1 = M.score(model, test, ["event_id", "anomaly"]).orderBy("event_id").collect()
    s2 = M.score(M.fit(pipe, train, "anomaly"), test, ["event_id", "anomaly"]).orderBy("event_id").collect()
    assert s1 == s2 and len(s1) == test.count()
    assert "anomaly" not in model.stages[-2].getInputCols()
    met = M.classification_metrics(M.score(model, test, [F.col("anomaly").alias("label")])).first()
    assert met.f1 is not None and 0.0 <= met.f1 <= 1.0


def test_runs_and_best(spark):
    runs = M.new_run(spark, "m", {"d": 2}, {"f1": 0.5, "mse": 3.0}, {"root": "x"}, run_id="a") \
        .unionByName(M.new_run(spark, "m", {"d": 4}, {"f1": 0.7, "mse": 4.0}, {"root": "x"}, run_id="b")) \
        .unionByName(M.new_run(spark, "m", {"d": 6}, {"f1": 0.9, "mse": 1.0}, {"root": "y"}, run_id="c"))
    assert M.best_run(runs, "f1", "root", "x").first().run_id == "b"
    assert M.best_run(runs, "mse", ascending=True).first().run_id == "c"


def test_correlation_matrix_both_paths(spark):
    import pandas as pd
    from millrace.operators.profile import correlation_matrix
    rng = np.random.default_rng(4)
    a = rng.normal(size=300)
    pdf = pd.DataFrame({"a": a, "b": 3 * a + rng.normal(size=300), "c": rng.normal(size=300)})
    for with_nulls in (False, True):
        p = pdf.copy()
        if with_nulls:
            p.loc[::7, "b"] = np.nan
        rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in p.itertuples(index=False)]
        df = spark.createDataFrame(rows, "a double, b double, c double")
        got = {(r.column1, r.column2): r.correlation for r in correlation_matrix(df).collect()}
        want = p.corr()
        for (c1, c2), v in got.items():
            assert v == pytest.approx(want.loc[c1, c2], rel=1e-9)


def test_exact_quantiles_by_counting(spark):
    from millrace.operators.profile import exact_quantiles
    rng = np.random.default_rng(5)
    a = rng.normal(size=20000)
    b = rng.integers(0, 3, size=20000).astype(float)     # heavy duplicates
    c = rng.exponential(size=20000)
    c[::11] = np.nan                                     # NaN / null are skipped
    rows = [(float(x), float(y), None if np.isnan(z) else float(z)) for x, y, z in zip(a, b, c)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probs = [0.0, 0.25, 0.5, 0.89, 0.93, 1.0]
    got = exact_quantiles(df, ["a", "b", "c"], probs, accuracy=1000)
    for col, arr in (("a", a), ("b", b), ("c", c[~np.isnan(c)])):
        for p in probs:
            assert got[(col, p)] == pytest.approx(np.quantile(arr, p), rel=1e-12, abs=1e-12)
    # a coarse sketch takes several rounds: same numbers
    got2 = exact_quantiles(df, ["a", "c"], [0.25, 0.75], accuracy=100)
    assert got2[("a", 0.25)] == pytest.approx(np.quantile(a, 0.25), rel=1e-12)
    assert got2[("c", 0.75)] == pytest.approx(np.quantile(c[~np.isnan(c)], 0.75), rel=1e-12)


def test_group_quantiles_exact_with_hot_group(spark):
    from millrace.operators.profile import group_quantiles
    rng = np.random.default_rng(6)
    rows = [(0, float(v)) for v in rng.normal(size=6000)]            # hot group
    rows += [(g, float(v)) for g in range(1, 30) for v in rng.gamma(2.0, size=40)]
    rows += [(99, 5.0)]                                               # single value
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r for r in group_quantiles(df, "g", "v", (0.89, 0.93, 0.5)).collect()}
    arr = np.array(rows)
    assert set(got) == {0, 99, *range(1, 30)}
    for g in got:
        vals = arr[arr[:, 0] == g][:, 1]
        for p, nm in ((0.89, "q89"), (0.93, "q93"), (0.5, "q50")):
            assert getattr(got[g], nm) == pytest.approx(np.quantile(vals, p), rel=1e-12, abs=1e-12)


def test_outlier_report_first_ids_across_ranges(spark):
    from millrace.operators.profile import outlier_report
    # 2,000 ids spread over a wide range; ids 5000+ hold extreme values
    rows = []
    for i in range(2000):
        rid = i * 997
        rows.append((rid, 1000.0 if i % 50 == 0 else float(i % 7)))
        if i % 50 == 0:
            rows.append((rid, 1000.0))           # a repeated outlying id
    df = spark.createDataFrame(rows, "id bigint, v double")
    r = outlier_report(df, ["v"], id_col="id").first()
    expect = sorted([rid for rid, v in rows if v == 1000.0])[:10]
    assert r.upper_ids == ",".join(str(x) for x in expect)
    assert r.n_above_upper == sum(1 for _, v in rows if v == 1000.0)


def test_outlier_report_with_text_ids_null_ids_and_empty_columns(spark):
    from millrace.operators.profile import outlier_report
    rows = [(f"d{i:03d}", float(i % 7), None) for i in range(200)] + [(None, 900.0, None), ("a", 900.0, None), ("a", 901.0, None), ("b", -900.0, None)]
    df = spark.createDataFrame(rows, "id string, v double, w double")
    got = {r.variable_name: r for r in outlier_report(df, ["v", "w"]).collect()}
    assert (got["v"].n_above_upper, got["v"].upper_ids, got["v"].lower_ids) == (3, "a,a", "b")
    assert got["w"].message == "No outliers present" and got["w"].lower_fence is None
    assert outlier_report(df, ["w"]).first().n_above_upper == 0


def test_boosted_trees_from_cells_equal_those_from_rows(spark, monkeypatch):
    from pyspark.sql import functions as F

    from millrace.operators import models as M

    rows = [(float(i % 7), float(i * i % 5), float((i % 7) ** 2 + 3 * (i * i % 5) + i % 3)) for i in range(600)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    seen, write = [], M.materialize
    monkeypatch.setattr(M, "materialize", lambda d, name: seen.append(write(d, name)) or seen[-1])
    cells = M.fit_cells("gbt_regressor", df, "y", ["a", "b"], maxIter=5, maxDepth=3, seed=1)
    by_row = M.fit(M.make_pipeline("gbt_regressor", "y", ["a", "b"], maxIter=5, maxDepth=3, seed=1), df, "y")
    assert seen[0].count() <= 35 and seen[0].agg(F.sum("__weight")).first()[0] == 600
    both = [sorted(r["prediction"] for r in m.transform(df).select("prediction").collect()) for m in (cells, by_row)]
    assert max(abs(x - y) for x, y in zip(*both)) < 1e-9
