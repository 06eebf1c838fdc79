"""Nearest neighbours, oversampling and per-id trees against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import neighbours as N
from millrace.operators import trees as T


def brute_neighbours(rows, k):
    first = {}
    for i, v in sorted(rows):
        first.setdefault(v, i)
    out = {}
    for v, pid in first.items():
        near = sorted((sum((a - b) * (a - b) for a, b in zip(v, w)), first[w], j) for j, w in rows if j != pid)[:k]
        out[pid] = [(other, d2) for d2, other, _ in near]
    return out


@pytest.mark.parametrize("leaf,spread", [(4, 1.0), (4, 1e-3), (64, 1.0), (6, 0.0)])
def test_neighbours_are_exact(spark, leaf, spread):
    rng = np.random.default_rng(leaf)
    rows = [(i, tuple(float(x) for x in v)) for i, v in enumerate(rng.normal(size=(120, 3)) * spread)]
    rows += [(1000 + i, (0.5, 0.5, 0.5)) for i in range(60)]                    # a third are copies
    rows += [(2000 + i, (float(2 ** i), 0.0, 0.0)) for i in range(20)]          # far apart, one-sided cells
    rows += [(3000, (0.0, -0.0, 0.0)), (3001, (-0.0, 0.0, 0.0))]
    df = spark.createDataFrame([(i, *v) for i, v in rows] + [(None, 1.0, 1.0, 1.0), (9, None, 1.0, 1.0), (10, float("nan"), 1.0, 1.0)],
                               "id long, a double, b double, c double").repartition(3)
    got = {}
    for r in N.nearest_neighbours(N.points_of(df, "id", ["a", "b", "c"]), 3, 5, leaf).collect():
        got.setdefault(r.pid, {})[r["rank"]] = (r.other, r.d2)
    want = brute_neighbours(rows, 5)
    assert got.keys() == want.keys()
    for p, near in want.items():
        assert [got[p][i][0] for i in range(1, 6)] == [o for o, _ in near]
        assert [got[p][i][1] for i in range(1, 6)] == pytest.approx([d for _, d in near], rel=1e-12)


def test_fewer_rows_than_neighbours(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 1.0)], "id long, a double")
    got = sorted((r.pid, r["rank"], r.other, r.d2) for r in N.nearest_neighbours(N.points_of(df, "id", ["a"]), 1, 5).collect())
    assert got == [(1, 1, 2, 1.0), (1, 2, 2, 1.0), (2, 1, 2, 0.0), (2, 2, 1, 1.0)]


def test_oversampling_balances_and_stays_between_neighbours(spark):
    rng = np.random.default_rng(1)
    few = {i: rng.normal(size=2) for i in range(23)}
    rows = [(i, float(v[0]), float(v[1]), 1.0, "x") for i, v in few.items()] + [(100 + i, 9.0, 9.0, 0.0, "y") for i in range(90)]
    rows += [(500, None, 1.0, 1.0, "z"), (501, 1.0, 1.0, None, "z")]
    df = spark.createDataFrame(rows, "id long, a double, b double, label double, copy string").drop("copy")
    got = N.oversample_minority(df, "id", ["a", "b"], "label").collect()
    assert len(got) == 90 - 23 and {r.label for r in got} == {1.0}
    counts = [sum(r.id == i for r in got) for i in few]
    assert max(counts) - min(counts) <= 1 and len({(r.id, r.copy) for r in got}) == len(got)
    near = brute_neighbours([(i, tuple(map(float, v))) for i, v in few.items()], 5)
    for r in got:
        p, ok = np.array([r.a, r.b]), False
        for other, _ in near[r.id]:
            d = few[other] - few[r.id]
            t = (p - few[r.id]) @ d / (d @ d)
            ok |= -1e-9 <= t <= 1 and np.allclose(few[r.id] + t * d, p)
        assert ok
    assert sorted(map(tuple, got)) == sorted(map(tuple, N.oversample_minority(df.repartition(7), "id", ["a", "b"], "label").collect()))
    assert N.oversample_minority(df, "id", ["a", "b"], "label", minority=0).count() == 0
    assert N.oversample_minority(df.where("id = 3 or id > 90"), "id", ["a", "b"], "label").count() == 0


def brute_tree(x, y, cuts, depth):
    """(positives, rows) of each row's leaf, by trying every cut."""
    def gini(v):
        return v.sum() * (len(v) - v.sum()) / len(v)

    out = np.zeros((len(y), 2))

    def grow(rows, level):
        best = None
        if level < depth:
            for f in range(x.shape[1]):
                for c in cuts[f]:
                    right = x[rows, f] > c
                    if right.any() and not right.all():
                        gain = round(gini(y[rows]) - gini(y[rows[~right]]) - gini(y[rows[right]]), 6)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, f, c)
        if best is None:
            out[rows] = [y[rows].sum(), len(rows)]
            return
        right = x[rows, best[1]] > best[2]
        grow(rows[~right], level + 1)
        grow(rows[right], level + 1)

    grow(np.arange(len(y)), 0)
    return out


@pytest.mark.parametrize("depth", [1, 4])
def test_trees_of_all_ids_equal_brute_force(spark, depth):
    rng = np.random.default_rng(depth)
    rows = []
    for k, n in (("big", 300), ("b", 80), (None, 40), ("one", 1), ("same", 9)):
        for i in range(n):
            a, b = float(rng.normal()), float(rng.integers(5))
            label = 1.0 if k == "same" else float(rng.random() < (0.8 if (a > 0.3) != (b > 2) else 0.1))
            rows.append((len(rows), k, a, b, label))
    df = spark.createDataFrame(rows, "u long, k string, a double, b double, label double")
    edges = T.bin_edges(df, ["a", "b"], 16)
    trees = T.fit_trees(df, "k", ["a", "b"], "label", depth=depth, bins=16)
    got = {r.u: r.p for r in T.route_trees(df, trees, "k", ["a", "b"], out="p").collect()}
    assert trees.count() == 5
    for k in {r[1] for r in rows}:
        part = [r for r in rows if r[1] == k]
        x, y = np.array([[r[2], r[3]] for r in part]), np.array([r[4] for r in part])
        leaf = brute_tree(x, y, [edges["a"], edges["b"]], depth)
        assert [got[r[0]] for r in part] == pytest.approx(list(leaf[:, 0] / leaf[:, 1]))


def test_tree_routing_without_model_and_with_missing_features(spark):
    df = spark.createDataFrame([("a", float(i), float(i > 5)) for i in range(12)] + [("a", 3.0, None)], "k string, x double, label double")
    trees = T.fit_trees(df, "k", ["x"], "label", depth=2)
    ask = spark.createDataFrame([("a", None), ("a", float("nan")), ("a", 99.0), ("other", 1.0), (None, 1.0)], "k string, x double")
    got = [(r.k, r.probability, r.probability_class) for r in T.route_trees(ask, trees, "k", ["x"]).collect()]
    assert sorted(got, key=str) == sorted([("a", 0.0, 0.0), ("a", 0.0, 0.0), ("a", 1.0, 1.0), ("other", None, None), (None, None, None)], key=str)
    assert trees.first().n_used == 12
    assert T.fit_trees(df.limit(0), "k", ["x"], "label").count() == 0


def test_no_plan_of_the_neighbour_search_grows_with_the_depth(spark, monkeypatch):
    from millrace.operators import neighbours as N

    joins, write = [], N.materialize

    def spied(df, name):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return write(df, name)

    monkeypatch.setattr(N, "materialize", spied)
    points = spark.createDataFrame([(i, [float(i * 37 % 101), float(i * 53 % 97)], 1) for i in range(60)], "pid long, v array<double>, copies long")
    near = N.nearest_neighbours(points, 2, k=2, leaf=4)
    assert len(joins) > 10 and max(joins) <= 2  # a tree of more than four levels
    got = {(r["pid"], r["rank"]): (r.d2, r.other) for r in near.collect()}
    rows = [(r.pid, r.v) for r in points.collect()]
    for a, v in rows:
        best = sorted(((v[0] - w[0]) ** 2 + (v[1] - w[1]) ** 2, b) for b, w in rows if b != a)[:2]
        assert [got[(a, 1)], got[(a, 2)]] == best
