"""Per-group models.

The heavy part of every fit is one distributed aggregate: per group, the
row count, the means and the population covariances of features and label
(numerically stable accumulators, partial per partition, merged after the
shuffle).  Only that small table -- one row per group -- reaches Python,
where ``mapInPandas`` solves all the small normal-equation systems of a batch
of groups at once with numpy.  No group's rows are ever collected.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scan import Lag, series_scan
from millrace.operators.windows import _list, lag_by


def _moments(df: DataFrame, keys: list, feats: list[str], label: str) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_used"), F.avg(label).alias("__my")]
    aggs += [F.avg(f).alias(f"__m_{i}") for i, f in enumerate(feats)]
    for i, a in enumerate(feats):
        for j in range(i, len(feats)):
            aggs.append(F.covar_pop(a, feats[j]).alias(f"__s_{i}_{j}"))
        aggs.append(F.covar_pop(a, label).alias(f"__c_{i}"))
    return df.groupBy(*keys).agg(*aggs)


def _solver(keys: list, p_max: int, p_col: str | None, coef_names: list[str]):
    def solve(batches):
        for pdf in batches:
            g = len(pdf)
            out = pdf[keys].copy()
            out["n_used"] = pdf["n_used"].astype("int64")
            coefs = np.full((g, p_max), np.nan)
            icpt = np.full(g, np.nan)
            ps = pdf[p_col].to_numpy().astype(int) if p_col else np.full(g, p_max)
            for p in np.unique(ps):
                rows = np.where(ps == p)[0]
                my = pdf["__my"].to_numpy(dtype=float)[rows]
                if p == 0:
                    icpt[rows] = my
                    continue
                S = np.zeros((len(rows), p, p))
                c = np.zeros((len(rows), p))
                m = np.zeros((len(rows), p))
                for i in range(p):
                    m[:, i] = pdf[f"__m_{i}"].to_numpy(dtype=float)[rows]
                    c[:, i] = pdf[f"__c_{i}"].to_numpy(dtype=float)[rows]
                    for j in range(i, p):
                        v = pdf[f"__s_{i}_{j}"].to_numpy(dtype=float)[rows]
                        S[:, i, j] = v
                        S[:, j, i] = v
                ok = np.isfinite(S).all(axis=(1, 2)) & np.isfinite(c).all(axis=1)
                beta = np.full((len(rows), p), np.nan)
                if ok.any():
                    Sk = S[ok]
                    det_ok = np.abs(np.linalg.det(Sk)) > 1e-12 * np.maximum(
                        1.0, np.prod(np.abs(np.diagonal(Sk, axis1=1, axis2=2)), axis=1))
                    idx = np.where(ok)[0][det_ok]
                    if len(idx):
                        beta[idx] = np.linalg.solve(S[idx], c[idx][..., None])[..., 0]
                coefs[rows, :p] = beta
                icpt[rows] = my - np.einsum("ij,ij->i", np.nan_to_num(beta), m)
                icpt[rows[~np.isfinite(beta).all(axis=1)]] = np.nan
            out["intercept"] = icpt
            for i, nm in enumerate(coef_names):
                out[nm] = coefs[:, i]
            if p_col:
                out[p_col] = ps
            yield out
    return solve


def grouped_least_squares(df: DataFrame, key, features: list[str], label: str,
                          coef_prefix: str = "coef_") -> DataFrame:
    """Ordinary least squares ``label ~ 1 + features`` per group.

    Returns one row per group: keys, ``n_used``, ``intercept``,
    ``coef_<feature>`` and a deterministic ``run_id`` (md5 of group and
    features).  Rows with a null feature or label are left out.  A group
    whose feature covariance is singular gets null coefficients."""
    keys = _list(key)
    d = df.select(*keys, *[F.col(f).cast("double").alias(f) for f in features],
                  F.col(label).cast("double").alias(label)).na.drop(subset=list(features) + [label])
    mom = _moments(d, keys, list(features), label)
    names = [f"{coef_prefix}{f}" for f in features]
    key_ddl = ", ".join(f"`{k}` {t}" for k, t in mom.select(*keys).dtypes)
    schema = key_ddl + ", n_used bigint, intercept double, " + ", ".join(f"`{n}` double" for n in names)
    fitted = mom.mapInPandas(_solver(keys, len(features), None, names), schema)
    # singular groups: NaN from numpy -> SQL null
    fitted = fitted.select(*keys, "n_used", *[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c)
                                              for c in ["intercept"] + names])
    rid = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys],
                            F.lit(",".join(features) + "~" + label)))
    return fitted.withColumn("run_id", rid)


def route_and_score(df: DataFrame, models: DataFrame, key, features: list[str],
                    out: str = "prediction", coef_prefix: str = "coef_",
                    threshold: float | None = None) -> DataFrame:
    """Send each row to the model of its group and score it.  The model
    table has one row per group; AQE broadcasts it where its measured size
    allows, so the plan that makes it runs once."""
    keys = _list(key)
    m = models.select(*keys, "intercept", *[f"{coef_prefix}{f}" for f in features])
    j = df.join(m, keys, "left")
    pred = F.col("intercept")
    for f in features:
        pred = pred + F.col(f"{coef_prefix}{f}") * F.col(f).cast("double")
    j = j.withColumn(out, pred)
    if threshold is not None:
        j = j.withColumn(f"{out}_class", (F.col(out) >= threshold).cast("double"))
    return j.drop("intercept", *[f"{coef_prefix}{f}" for f in features])


# ------------------------------------------------------------------ M13 / M14
def _diff_expr(lags: dict, d: int, shift: int = 0):
    """Delta^d x at t - shift, as a linear combination of lags (lags[k] is
    x_{t-k}, lags[0] is x_t)."""
    e = None
    for k in range(d + 1):
        term = lags[k + shift] * F.lit(float((-1) ** k * math.comb(d, k)))
        e = term if e is None else e + term
    return e


def _lags(df: DataFrame, keys, order, col: str, L: int, segment, keep) -> DataFrame:
    """x and its lags 1..L as ``__x0..__xL`` (doubles)."""
    base = df.select(*keep, F.col(col).cast("double").alias("__x0"))
    if L == 0:
        return base
    if segment is not None:
        return series_scan(base, keys, order, segment, lags=[Lag("__x0", k, f"__x{k}") for k in range(1, L + 1)])
    return lag_by(base, keys, order, ["__x0"], n=list(range(1, L + 1)), segment=segment,
                  names={("__x0", k): f"__x{k}" for k in range(1, L + 1)})


def ar_forecast(df: DataFrame, key, order, col: str, p: int = 1, d: int = 0,
                out: str = "predicted", segment=None) -> tuple[DataFrame, DataFrame]:
    """One-step-ahead in-sample forecast per series with an AR(p) model
    on the d-times differenced values, fitted by least squares per series.

    Returns (rows with the forecast, per-series fit).  The forecast of x_t
    is  x_t - Delta^d x_t  +  (intercept + sum_j a_j Delta^d x_{t-j})."""
    keys = _list(key)
    L = d + p
    base = _lags(df, keys, order, col, L, segment, keep=df.columns)
    lags = {k: F.col(f"__x{k}") for k in range(L + 1)}
    feats = [f"__z{j}" for j in range(1, p + 1)]
    z = base.select("*", _diff_expr(lags, d).alias("__z"),
                    *[_diff_expr(lags, d, j).alias(f"__z{j}") for j in range(1, p + 1)])
    if p == 0:
        fit = (z.filter(F.col("__z").isNotNull()).groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("n_used"), F.avg("__z").alias("intercept")))
    else:
        fit = grouped_least_squares(z, keys, feats, "__z")
    zhat = F.col("intercept")
    for j in range(1, p + 1):
        zhat = zhat + F.col(f"coef___z{j}") * F.col(f"__z{j}")
    pred = (F.col(col).cast("double") - F.col("__z")) + zhat
    rows = z.join(fit.drop("n_used", "run_id") if p else fit.drop("n_used"), keys, "left") \
            .withColumn(out, pred)
    drop = [c for c in rows.columns if c.startswith("__") or c.startswith("coef___z") or c == "intercept"]
    return rows.drop(*drop), fit


def _fit_orders(keys, p: int, d: int):
    """Solves every series' AR(p) on d-th differences from its moments, with the error that the fit leaves."""
    mix = np.zeros((p + 1, p + d + 1))
    for j in range(p + 1):
        for k in range(d + 1):
            mix[j, j + k] = (-1) ** k * math.comb(d, k)

    def run(batches):
        for pdf in batches:
            n = pdf["n"].to_numpy(float)
            mean, cov = _mean_and_covariance(pdf, p + d)
            level = pdf["level"].to_numpy(float)
            z_mean = mean @ mix.T + level[:, None] * mix.sum(1)
            s = mix @ cov @ mix.T
            out = pdf[list(keys)].copy()
            beta = np.full((len(n), p), np.nan)
            if p:
                scale = np.prod(np.maximum(np.einsum("gii->gi", s)[:, 1:], 0), axis=1)
                ok = np.abs(np.linalg.det(s[:, 1:, 1:])) > 1e-12 * np.maximum(scale, 1e-300)
                beta[ok] = np.linalg.solve(s[ok, 1:, 1:], s[ok, 1:, :1])[..., 0]
            left = s[:, 0, 0] - (beta * s[:, 1:, 0]).sum(1)
            out["n_used"] = n.astype("int64")
            out["intercept"] = z_mean[:, 0] - (beta * z_mean[:, 1:]).sum(1)
            for j in range(p):
                out[f"a{j + 1}"] = beta[:, j]
            out["rmse"] = np.sqrt(np.maximum(left, 0.0))
            out["n_scored"] = np.where(np.isfinite(out["rmse"]), n, 0).astype("int64")
            yield out

    return run


def forecast_fit(df: DataFrame, key, order, col: str, p: int = 1, d: int = 0, segment=None) -> DataFrame:
    """M13 + M7: per series the AR(p) fit on d-times differenced values
    (``n_used``, ``intercept``, ``a1`` ..) and the RMSE of its one-step forecast,
    all from one set of moments; the rows are read once.  A series whose lags
    are collinear has no fit and no error (null)."""
    keys = _list(key)
    moments = _lag_moments(df, keys, order, col, p + d, segment)
    numbers = ["intercept", *[f"a{j + 1}" for j in range(p)], "rmse"]
    schema = ", ".join(f"`{k}` {t}" for k, t in moments.select(*keys).dtypes) + ", n_used long, " + ", ".join(f"{c} double" for c in numbers) + ", n_scored long"
    fit = moments.mapInPandas(_fit_orders(keys, p, d), schema)
    return fit.select(*keys, "n_used", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in numbers], "n_scored")


def forecast_rmse(df: DataFrame, key, order, col: str, p: int = 1, d: int = 0,
                  segment=None) -> DataFrame:
    """M13 + M7: RMSE of the one-step forecast per series."""
    return forecast_fit(df, key, order, col, p, d, segment).select(*_list(key), "rmse", "n_scored")


def _lag_moments(df: DataFrame, keys, order, col: str, lags: int, segment) -> DataFrame:
    """Per series: ``n`` and, of x_t .. x_(t-lags) less the series' mean, the sums
    ``s_i`` and products ``q_i_j``; over the rows that have all lags."""
    base = _lags(df, keys, order, col, lags, segment, keep=keys + [o for o in _list(order) if isinstance(o, str) and o not in keys])
    whose = F.struct(*keys)
    level = df.groupBy(whose.alias("__k")).agg(F.avg(F.col(col).cast("double")).alias("__level"))
    x = base.withColumn("__k", whose).join(level, "__k")
    for i in range(lags + 1):
        x = x.where(F.col(f"__x{i}").isNotNull())
    x = x.select("__k", "__level", *[(F.col(f"__x{i}") - F.col("__level")).alias(f"__x{i}") for i in range(lags + 1)])
    sums = [F.sum(f"__x{i}").alias(f"s_{i}") for i in range(lags + 1)]
    sums += [F.sum(F.col(f"__x{i}") * F.col(f"__x{j}")).alias(f"q_{i}_{j}") for i in range(lags + 1) for j in range(i, lags + 1)]
    return x.groupBy("__k").agg(F.count(F.lit(1)).alias("n"), F.first("__level").alias("level"), *sums).select("__k.*", "n", "level", *[f"s_{i}" for i in range(lags + 1)],
                                                                           *[f"q_{i}_{j}" for i in range(lags + 1) for j in range(i, lags + 1)])


# a lag whose variance is below this share of its own, given the lags before it, adds nothing to a fit
COLLINEAR = 1e-9


def _mean_and_covariance(pdf, lags: int):
    """Of x and its lags, by series: means (from the level) and covariances."""
    n = pdf["n"].to_numpy(float)
    mean = np.stack([pdf[f"s_{i}"].to_numpy(float) for i in range(lags + 1)], 1) / n[:, None]
    cov = np.empty((len(n), lags + 1, lags + 1))
    for i in range(lags + 1):
        for j in range(i, lags + 1):
            cov[:, i, j] = cov[:, j, i] = pdf[f"q_{i}_{j}"].to_numpy(float) / n - mean[:, i] * mean[:, j]
    return mean, cov


def _order_errors(ps, ds, lags: int):
    """Adds up the squared errors of every order (p, d) over a batch of series."""
    combos = [(p, d) for p in ps for d in ds]

    def run(batches):
        for pdf in batches:
            n = pdf["n"].to_numpy(float)
            _, cov = _mean_and_covariance(pdf, lags)
            out = []
            for p, d in combos:
                mix = np.zeros((p + 1, lags + 1))  # row j: the d-th difference j steps back, from x and its lags
                for j in range(p + 1):
                    for k in range(d + 1):
                        mix[j, j + k] = (-1) ** k * math.comb(d, k)
                s = mix @ cov @ mix.T
                own = np.einsum("gii->gi", s).copy()
                for j in range(1, p + 1):  # sweep out one lag after the other
                    rest = s[:, j, j].copy()
                    use = rest > COLLINEAR * own[:, j]
                    step = np.where(use[:, None], s[:, j, :] / np.where(use, rest, 1.0)[:, None], 0.0)
                    s = s - step[:, :, None] * s[:, j, None, :]
                out.append((p, d, float((n * np.maximum(s[:, 0, 0], 0.0)).sum()), int(n.sum())))
            yield pd.DataFrame(out, columns=["p", "d", "sse", "n_scored"])

    return run


def order_search(df: DataFrame, key, order, col: str, ps=(0, 1, 2), ds=(0, 1, 2, 3),
                 segment=None) -> DataFrame:
    """RMSE of every (p, d) forecast order over all series.

    One pass over the lagged rows gives each series' moments of x and its lags;
    all fits and their errors follow from those: a difference is a linear
    combination of lags, and what its least-squares fit on its own lags leaves
    is the swept covariance.  All orders are compared on the same rows, those
    that have every lag of the largest order.  A lag that is collinear with the
    lags before it (short or constant series) is left out of that series' fit.
    """
    keys = _list(key)
    lags = max(ds) + max(ps)
    moments = _lag_moments(df, keys, order, col, lags, segment)
    errors = moments.drop(*keys).mapInPandas(_order_errors(tuple(ps), tuple(ds), lags), "p int, d int, sse double, n_scored long")
    return errors.groupBy("p", "d").agg(F.sqrt(F.sum("sse") / F.sum("n_scored")).alias("rmse"), F.sum("n_scored").alias("n_scored"))
