"""Whitening against a plain eigen-decomposition; hard negatives against all pairs."""

import numpy as np
import pytest

from millrace.llm import hardneg, whitening

VECTOR = "vec_id long, embedding array<double>, n string, component string"


def frame(spark, vectors, schema=VECTOR):
    return spark.createDataFrame([(i, v, "n", "c") for i, v in vectors], schema).repartition(3)


def expected(vectors):
    x = np.floor(np.array(vectors) * 1024).astype(np.int64) + 100_000
    n = len(x)
    d = x * n - x.sum(0)
    e, v = np.linalg.eigh((d / n).T @ (d / n) / n)
    return d, e[::-1], v[:, ::-1]


def check(spark, vectors, least=1e-12):
    got = whitening.whiten(frame(spark, list(enumerate(vectors)))).toPandas()
    d, e, v = expected(vectors)
    k = min(8, int((e > least * e[0]).sum()))
    assert sorted(got.component.unique()) == list(range(1, k + 1)) and len(got) == k * len(vectors)
    assert (got.n == len(vectors)).all() and (got.identity_error <= 1e-4).all()
    for c in range(k):
        part = got[got.component == c + 1].sort_values("vec_id")
        assert (part.deviation.to_numpy() == (d * d).sum(1)).all()
        assert np.allclose(part.explained, e[c] / e.sum(), rtol=1e-9)
        mine, plain = part.whitened.to_numpy(), (d / len(d)) @ v[:, c] / np.sqrt(e[c])
        assert min(np.abs(mine - plain).max(), np.abs(mine + plain).max()) < 1e-7


def test_whitening_equals_the_eigen_decomposition(spark):
    rng = np.random.default_rng(3)
    check(spark, (rng.standard_normal((200, 12)) * np.linspace(1, 3, 12)).tolist())


def test_whitening_of_badly_scaled_and_singular_data(spark):
    rng = np.random.default_rng(4)
    check(spark, (rng.standard_normal((150, 6)) * [3000, 300, 50, 10, 1, 0.1]).tolist())
    low = rng.integers(-9, 9, (90, 3)) @ rng.integers(-9, 9, (3, 7))  # three directions in seven dimensions, exactly
    check(spark, low.astype(float).tolist())
    constant = rng.standard_normal((60, 4))
    constant[:, 2] = 0.5
    check(spark, constant.tolist())


def test_whitening_defined_cases(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(20)] + [(None, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0])]
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [float("nan"), 1.0, 1.0]), (54, [float("inf"), 1.0, 1.0]), (55, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, good + odd)).toPandas()
    assert len(got) == 3 * len(good) and (got.n == len(good)).all() and got.vec_id.isna().sum() == 3
    assert whitening.whiten(frame(spark, odd[:4])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, []).limit(0)).count() == 0


def brute(rows, positives=5, negatives=3):
    out = []
    for i, (a, al, ax, anchor) in enumerate(rows):
        if not anchor:
            continue
        scored = [(-int(np.dot(ax, x)), v is None, v or 0, j, l) for j, (v, l, x, _) in enumerate(rows) if j != i]
        for s, _, p, *_ in sorted(t for t in scored if t[4] == al)[:positives]:
            fit = sorted(t for t in scored if t[4] != al and 50 * -s <= 100 * -t[0] <= 95 * -s)[:negatives]
            out += [(a, p, r + 1, None if t[1] else t[2], -s, -t[0]) for r, t in enumerate(fit)]
    return sorted(out, key=str)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, "r", "b") for r in rows], "vec_id long, label string, x array<bigint>, mark boolean, rid string, block string").repartition(3)
    from pyspark.sql import functions as F
    return sorted([tuple(r) for r in hardneg.mine(df, F.col("mark")).collect()], key=str)


def clustered(rng, n, dims, labels):
    centres = rng.integers(-60, 60, (9, dims))
    return [(i, str(rng.integers(labels)), (centres[rng.integers(9)] + rng.integers(-6, 7, dims)).tolist(), bool(i % 10 == 0)) for i in range(n)]


@pytest.mark.parametrize("labels", [3, 40])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, labels):
    rng = np.random.default_rng(labels)
    rows = clustered(rng, 500, 6, labels)
    want = brute(rows)
    assert want and mined(spark, rows) == want
    monkeypatch.setattr(hardneg, "BLOCK", 30)  # several cells, two visits, split groups
    monkeypatch.setattr(hardneg, "QUERIES", 10)
    monkeypatch.setattr(hardneg, "LEAF", 4)
    assert mined(spark, rows) == want


def test_hard_negative_ties_repeats_and_null_ids(spark):
    rows = [(10, "a", [4, 0], True), (10, "a", [4, 0], True), (3, "a", [4, 0], False), (2, "a", [3, 0], False), (9, "b", [3, 0], False), (8, "b", [3, 0], False),
            (None, "b", [3, 0], False), (7, "b", [3, 1], False), (7, "b", [3, 1], False), (5, "c", [2], False), (6, "c", [], False), (1, "d", [-1, 0], True), (4, "d", [9, 9], False)]
    padded = [(v, l, (x + [0, 0])[:2], m) for v, l, x, m in rows]
    assert mined(spark, rows) == brute(padded)


def test_hard_negatives_without_rows_or_partners(spark):
    assert mined(spark, [(1, "a", [1], False)]) == []
    assert mined(spark, [(1, "a", [1], True), (2, "b", [1], False)]) == []
    from pyspark.sql import functions as F
    odd = spark.createDataFrame([(1, None, [1.0]), (2, 3, None), (3, 3, [None]), (4, 3, [float("nan")])], "vec_id long, label int, embedding array<float>")
    assert hardneg.mine(hardneg.valid_rows(odd, 256), F.lit(True)).count() == 0


def test_cover_tree_covers_and_halves():
    rng = np.random.default_rng(8)
    points = np.vstack([c + rng.standard_normal((60, 4)) for c in rng.standard_normal((6, 4)) * 50])
    root, centre, radius = hardneg.cover_tree(points)
    assert np.sqrt(((points - points[centre]) ** 2).sum(1)).max() == radius
    seen, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.children:
            seen += node.rows.tolist()
            continue
        for child, c, r in zip(node.children, node.centres, node.radii):
            assert np.sqrt(((points[child.rows] - points[c]) ** 2).sum(1)).max() <= r + 1e-9
        stack += node.children
    assert root.children and sorted(seen) == list(range(len(points)))


def test_queries_of_a_group_descend_together(monkeypatch):
    rng = np.random.default_rng(9)
    centres = rng.integers(-60, 60, (9, 6))
    x = centres[rng.integers(9, size=900)] + rng.integers(-6, 7, (900, 6))
    points = hardneg._augmented(x, float((x * x).sum(1).max()))
    root, centre, radius = hardneg.cover_tree(points)
    leaves = [n for n in hardneg._flat(root) if not n.children]
    asked = x[:200].astype(float)
    best = hardneg.Best(np.full((200, 1), -np.inf), np.full((200, 1), np.inf), np.full((200, 1), -np.inf), 3)
    calls = []
    add = hardneg.Best.add
    monkeypatch.setattr(hardneg.Best, "add", lambda *a: (calls.append(len(a[2]) * len(a[1])), add(*a)))
    hardneg.descend(root, centre, radius, points, x.astype(float), asked, asked, lambda own, rows: np.ones((len(own), len(rows)), bool), best)
    assert len(leaves) > 3 and len(calls) <= 4 * len(leaves) and sum(calls) < asked.shape[0] * len(x) / 2
    score = asked @ x.T
    for i in range(200):
        assert best.row[best.query == i].tolist() == sorted(range(900), key=lambda j: (-score[i, j], j))[:3]


def test_a_level_that_compresses_nothing_is_left_early(monkeypatch):
    points = np.random.default_rng(10).standard_normal((6000, 64))
    made = []
    count = np.count_nonzero
    monkeypatch.setattr(hardneg.np, "count_nonzero", lambda v: made.append(len(v)) or count(v))
    root, _, _ = hardneg.cover_tree(points)
    assert made == [6000] and not root.children and len(root.rows) == 6000
