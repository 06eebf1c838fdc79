"""Window operators against pandas twins (small hand-made series)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.windows import (dense_rank_by, ewma, fill_forward, fill_series, lag_by,
                                        ordered_split, row_number_by)


def _series(spark, n_keys=3, n=700, nulls=False, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n_keys):
        m = n + 37 * k
        for t in range(m):
            x = float(rng.normal(50, 10))
            if nulls and rng.random() < 0.1:
                x = None
            rows.append((k, t, t // 50, x))
    pdf = pd.DataFrame(rows, columns=["k", "t", "seg", "x"])
    return pdf, spark.createDataFrame(rows, "k int, t int, seg int, x double")


def _pandas_ewm(pdf, shift=0, **kw):
    out = []
    for _, g in pdf.sort_values(["k", "t"]).groupby("k"):
        s = g["x"].astype(float).shift(shift) if shift else g["x"].astype(float)
        out.append(pd.Series(s.ewm(**kw).mean().to_numpy(), index=g["t"].to_numpy(), name=g["k"].iloc[0]))
    return {(s.name, t): v for s in out for t, v in s.items()}


@pytest.mark.parametrize("kw,shift,seg,nulls", [
    ({"com": 5}, 0, False, False),
    ({"com": 5}, 1, True, False),
    ({"span": 600}, 1, False, True),
    ({"span": 600}, 0, True, True),
    ({"alpha": 0.02}, 1, True, False),
])
def test_ewma_matches_pandas(spark, kw, shift, seg, nulls):
    pdf, df = _series(spark, nulls=nulls)
    res = ewma(df, "x", "k", ["t"], out="y", shift=shift,
               segment=F.col("seg") if seg else None, **kw).select("k", "t", "y").collect()
    want = _pandas_ewm(pdf, shift=shift, **kw)
    for r in res:
        w = want[(r["k"], r["t"])]
        if np.isnan(w):
            assert r["y"] is None
        else:
            assert r["y"] == pytest.approx(w, rel=1e-9, abs=1e-9)


def test_ewma_long_series_many_blocks(spark):
    # 5,000 rows, com=5: block size 256 -> 20 blocks, carry across blocks
    pdf, df = _series(spark, n_keys=1, n=5000, seed=3)
    res = {r["t"]: r["y"] for r in ewma(df, "x", "k", ["t"], out="y", com=5).collect()}
    want = _pandas_ewm(pdf, com=5)
    for t in (0, 1, 255, 256, 257, 2047, 4999):
        assert res[t] == pytest.approx(want[(0, t)], rel=1e-10)


def test_row_number_segmented_equals_plain(spark):
    _, df = _series(spark)
    a = {(r.k, r.t): r.rn for r in row_number_by(df, "k", ["t"], out="rn").collect()}
    b = {(r.k, r.t): r.rn for r in row_number_by(df, "k", ["t"], out="rn", segment=F.col("seg")).collect()}
    assert a == b
    g = {r.t: r.rn for r in row_number_by(df.filter("k = 0"), None, ["t"], out="rn",
                                           segment=F.col("seg")).collect()}
    assert g[0] == 1 and g[699] == 700


@pytest.mark.parametrize("seg_kind", ["fifty", "two"])
def test_lag_segmented_equals_plain(spark, seg_kind):
    # segments of 50 rows, and of 2 rows (a lag of 5 reaches 3 segments back)
    seg = F.col("seg") if seg_kind == "fifty" else F.floor(F.col("t") / 2)
    _, df = _series(spark, nulls=True, n=120)
    for n in (1, 5):
        a = {(r.k, r.t): r.p for r in lag_by(df, "k", ["t"], ["x"], n, names={"x": "p"}).collect()}
        b = {(r.k, r.t): r.p for r in lag_by(df, "k", ["t"], ["x"], n, segment=seg,
                                             names={"x": "p"}).collect()}
        assert a == b and len(b) == df.count()
    many = lag_by(df, "k", ["t"], ["x"], [1, 3, 5], segment=seg).collect()
    plain = lag_by(df, "k", ["t"], ["x"], [1, 3, 5]).collect()
    assert sorted(map(tuple, many), key=lambda r: (r[0], r[1])) == \
        sorted(map(tuple, plain), key=lambda r: (r[0], r[1]))


def test_fill_matches_pandas(spark):
    pdf, df = _series(spark, nulls=True)
    for seg in (None, F.col("seg")):
        got = {(r.k, r.t): r.x for r in fill_series(df, ["x"], "k", ["t"], value=0.0,
                                                     segment=seg).collect()}
        for k, g in pdf.sort_values(["k", "t"]).groupby("k"):
            want = g["x"].ffill().bfill().fillna(0.0).to_numpy()
            assert [got[(k, t)] for t in g["t"]] == pytest.approx(list(want))
        bf = {(r.k, r.t): r.x for r in fill_forward(df, ["x"], "k", ["t"], segment=seg,
                                                     backward=True).collect()}
        for k, g in pdf.sort_values(["k", "t"]).groupby("k"):
            want = g["x"].bfill().to_numpy()
            got_k = [bf[(k, t)] for t in g["t"]]
            for a, b in zip(got_k, want):
                assert (a is None and np.isnan(b)) or a == pytest.approx(b)


def test_dense_rank_and_split(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (1, "2024-01-01 12:00:00"),
                                (1, "2024-01-03 09:00:00"), (2, "2024-01-02 00:00:00")],
                               "d int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    r = {(x.d, str(x.ts)): x.trip for x in dense_rank_by(df, "d", F.to_date("ts"), out="trip").collect()}
    assert sorted(r.values()) == [1, 1, 1, 2]
    s = ordered_split(df.withColumn("i", F.monotonically_increasing_id()), ["ts"], frac=0.5,
                      segment=F.to_date("ts"))
    got = {str(x.ts): x.split for x in s.collect()}
    assert got["2024-01-01 10:00:00"] == "train" and got["2024-01-03 09:00:00"] == "test"
    assert list(got.values()).count("train") == 2


def test_ewma_small_blocks_long_carry(spark):
    # block=16 with span=600: ~780 blocks of look-back in the carry
    pdf, df = _series(spark, n_keys=2, n=900, nulls=True, seed=9)
    res = {(r["k"], r["t"]): r["y"] for r in
           ewma(df, "x", "k", ["t"], out="y", span=600, shift=1, block=16).collect()}
    want = _pandas_ewm(pdf, shift=1, span=600)
    for key, w in want.items():
        if np.isnan(w):
            assert res[key] is None
        else:
            assert res[key] == pytest.approx(w, rel=1e-9, abs=1e-9)


def _odd_rows(spark):
    """Null keys, null times, null values, ties and a gap longer than many blocks."""
    rows = [(k, None if i % 17 == 3 else i, float(i % 7) if i < 10 or i > 390 else None, i)
            for k in ("a", None) for i in range(400)]
    return spark.createDataFrame(rows, "k string, t int, x double, id int")


def test_segmented_forms_equal_plain_forms_on_nulls(spark):
    from pyspark.sql import functions as F

    from millrace.operators import windows as W
    df, seg, order = _odd_rows(spark), F.floor(F.col("t") / 25), ["t", "id"]

    def same(f):
        plain, cut = ([tuple(r) for r in f(s).collect()] for s in (None, seg))
        assert len(plain) == 800
        key = lambda r: (r[0] or "", r[3])
        for a, b in zip(sorted(plain, key=key), sorted(cut, key=key)):
            assert a == pytest.approx(b, nan_ok=True) if all(isinstance(v, (int, float)) for v in a) else \
                all(u == v or (isinstance(u, float) and u == pytest.approx(v)) for u, v in zip(a, b))

    same(lambda s: W.row_number_by(df, "k", order, segment=s, with_count="n"))
    same(lambda s: W.lag_by(df, "k", order, ["x"], n=1, segment=s))
    same(lambda s: W.lag_by(df, "k", order, ["x"], n=[1, 3], segment=s))
    same(lambda s: W.fill_forward(df, ["x"], "k", order, segment=s))
    same(lambda s: W.fill_forward(df, ["x"], "k", order, segment=s, backward=True))
    same(lambda s: W.ewma(df, "x", "k", order, com=5, segment=s))
    same(lambda s: W.ordered_split(df, order, 0.7, segment=s))
    assert W.dense_rank_by(df, "k", F.col("t")).count() == 800


def test_ewma_carries_over_a_long_gap(spark):
    import pandas as pd

    from millrace.operators.windows import ewma
    xs = [float(i) if i < 10 else None for i in range(3000)] + [5.0, None, 7.0]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(xs)], "k int, t int, x double")
    for block in (None, 3):
        got = [r["e"] for r in ewma(df, "x", "k", "t", out="e", com=5, block=block).orderBy("t").collect()]
        assert got == pytest.approx(pd.Series(xs, dtype=float).ewm(com=5).mean().tolist(), rel=1e-9)


def test_group_quantiles_keep_the_null_group(spark):
    import numpy as np

    from millrace.operators.profile import group_quantiles
    df = _odd_rows(spark)
    got = {r["k"]: r["q89"] for r in group_quantiles(df, "k", "x", [0.89]).collect()}
    xs = [float(i % 7) for i in range(400) if i < 10 or i > 390]
    assert got == {k: pytest.approx(float(np.quantile(xs, 0.89))) for k in ("a", None)}


def test_a_limit_that_runs_out_raises(spark, scratch):
    from millrace.sources.io import append_stream, run_available_now
    rate = spark.readStream.format("rate").load()
    q = append_stream(rate, None, f"{scratch}/ck", {"processingTime": "1 second"}, path=f"{scratch}/out")
    with pytest.raises(TimeoutError):
        run_available_now(q, timeout=2)
    assert not q.isActive


def test_time_split_by_counting(spark):
    """The filter equals the numbered form on any table with a unique order; rows tied in the whole order stay together."""
    import datetime

    from millrace.operators import windows as W

    rng = np.random.default_rng(9)
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(None if rng.random() < 0.1 else t0 + datetime.timedelta(seconds=int(rng.integers(40))), int(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "t timestamp, i long")
    for frac in (0.0, 0.003, 0.5, 0.8, 0.95, 1.0):
        got = {r.i: r.split for r in W.ordered_split(df, ["t", "i"], frac).collect()}
        order = sorted(rows, key=lambda r: (r[0] is None, r[0] or t0, r[1]))
        train = {i for _, i in order[:int(np.floor(300 * frac))]}
        assert {i for i, s in got.items() if s == "train"} == train
    tied = spark.createDataFrame([(1,)] * 5 + [(2,)] * 5, "i long")
    assert W.ordered_split(tied, ["i"], 0.3).where("split = 'train'").count() == 5
    assert W.ordered_split(tied, ["i"], 0.5).where("split = 'train'").count() == 5
    assert W.ordered_split(df.limit(0), ["t", "i"], 0.5).count() == 0

