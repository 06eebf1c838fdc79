"""Column profiles.

Each profile is a fixed number of aggregate jobs over the whole table,
whatever the number of columns (the naive form runs a job per column or per
column pair).

Quantiles: ``method="exact"`` gives the exact linear-interpolation quantile
(as ``percentile`` / pandas / DuckDB ``quantile_cont``).  Whole-table
quantiles come from counting below sketched pivots (:func:`exact_quantiles`);
per-group quantiles come from a skew-safe ranking when a group is hot
(:func:`group_quantiles`).  Neither holds a column's distinct values in one
task.  ``method="approx"`` uses ``percentile_approx`` (a bounded sketch, one
aggregate); ``accuracy`` sets its relative rank error (1/accuracy).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [c for c, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and c not in exclude]


def _quantile(c: str, probs: list[float], method: str, accuracy: int) -> Column:
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if method == "exact":
        return F.percentile(F.col(c).cast("double"), arr)
    return F.percentile_approx(F.col(c).cast("double"), arr, accuracy)


# ------------------------------------------------------------------ G9
def correlation_matrix(df: DataFrame, cols=None) -> DataFrame:
    """Pearson correlation for every pair i <= j of numeric columns,
    long form (column1, column2, correlation).

    Two passes whatever the column count.  Pass 1: per-column mean and
    non-null count (2 numbers per column reach the driver).  Pass 2, when no
    column has nulls: one aggregate of n(n+1)/2 sums of centred products
    (the two-pass algorithm, numerically stable); correlation =
    S_ab / sqrt(S_aa S_bb).  Plain sums keep the aggregate inside whole-stage
    code generation, which the 6-field ``corr`` buffers leave beyond about 16
    pairs.  With nulls present, pairwise deletion is needed, and the
    ``corr`` aggregate is used instead (same single pass, interpreted)."""
    cols = cols or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    x = {c: F.col(c).cast("double") for c in cols}
    stats = df.agg(F.count(F.lit(1)).alias("__n"),
                   *[F.avg(x[c]).alias(f"m_{c}") for c in cols],
                   *[F.count(x[c]).alias(f"n_{c}") for c in cols]).first()
    complete = all(stats[f"n_{c}"] == stats["__n"] for c in cols)
    if complete:
        cen = {c: x[c] - F.lit(stats[f"m_{c}"]) for c in cols}
        wide = df.agg(*[F.sum(cen[a] * cen[b]).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
        idx = {pr: k for k, pr in enumerate(pairs)}

        def corr_of(a, b):
            saa, sbb = F.col(f"p{idx[(a, a)]}"), F.col(f"p{idx[(b, b)]}")
            return F.try_divide(F.col(f"p{idx[(a, b)]}"), F.sqrt(saa * sbb))
        vals = {k: corr_of(a, b) for k, (a, b) in enumerate(pairs)}
    else:
        wide = df.agg(*[F.corr(x[a], x[b]).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
        vals = {k: F.col(f"p{k}") for k in range(len(pairs))}
    rows = F.array(*[F.struct(F.lit(a).alias("column1"), F.lit(b).alias("column2"),
                              vals[k].alias("correlation"))
                     for k, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(rows))


# ------------------------------------------------------------------ exact quantiles
def _select_ranks(df: DataFrame, ranks: dict, counts: dict, known: dict, accuracy: int) -> dict:
    """Values at 0-based ranks (ascending, non-null and non-NaN) by counting.

    ``ranks``: {column: [rank, ...]}; ``counts``: {column: number of values};
    ``known``: {column: pivots to start with}.  Every round counts the rows below and at some pivots, values of the
    column itself.  A pivot that covers a rank is its value; otherwise the
    nearest pivots on either side enclose it, and the next pivots are taken
    from the rows strictly between them, so every round narrows.  A sketch of
    fewer than ``accuracy`` / 2 rows keeps all of them: its answer is the value
    itself.  Only counts and pivots reach the driver, a few for every rank.
    """
    x = {c: F.col(c).cast("double") for c in ranks}
    out: dict = {}
    # rank -> (value below, rows up to it, value above, rows below that)
    span = {(c, r): (None, 0, None, counts[c]) for c in ranks for r in ranks[c]}
    pivots = {c: sorted(set(v)) for c, v in known.items()}
    while span:
        counted = [(c, v) for c in pivots for v in pivots[c]]
        got = df.agg(F.lit(0), *[F.count(F.when(x[c] < v, 1)).alias(f"b{i}") for i, (c, v) in enumerate(counted)],
                     *[F.count(F.when(x[c] == v, 1)).alias(f"e{i}") for i, (c, v) in enumerate(counted)]).first()
        seen = {k: (got[f"b{i}"], got[f"e{i}"]) for i, k in enumerate(counted)}
        for (c, r), (lo, upto, hi, under) in list(span.items()):
            for v in pivots.get(c, []):
                below, at = seen[(c, v)]
                if below <= r < below + at:
                    out[(c, r)] = v
                    break
                if below + at <= r and (lo is None or v > lo):
                    lo, upto = v, below + at
                if below > r and (hi is None or v < hi):
                    hi, under = v, below
            if (c, r) in out:
                del span[(c, r)]
            else:
                span[(c, r)] = (lo, upto, hi, under)
        if not span:
            break
        places = list(dict.fromkeys((c, *span[(c, r)]) for c, r in span))
        aggs, asked = [F.lit(0)], {}
        for i, (c, lo, upto, hi, under) in enumerate(places):
            inside = x[c].isNotNull() & ~F.isnan(x[c])
            if lo is not None:
                inside &= x[c] > lo
            if hi is not None:
                inside &= x[c] < hi
            m = under - upto
            wanted = [(r, (r - upto + 0.5) / m) for k, r in span if (k, *span[(k, r)]) == (c, lo, upto, hi, under)]
            grid = sorted({min(1.0, max(0.0, p + e)) for _, p in wanted for e in (-3.0 / accuracy, 0.0, 3.0 / accuracy)})
            aggs.append(F.percentile_approx(F.when(inside, x[c]), F.array(*[F.lit(g) for g in grid]), accuracy).alias(f"s{i}"))
            asked[i] = (wanted, grid, m)
        row = df.agg(*aggs).first()
        pivots = {}
        for i, (c, *_) in enumerate(places):
            wanted, grid, m = asked[i]
            values = dict(zip(grid, row[f"s{i}"]))
            for r, p in wanted:
                if m < accuracy / 2:
                    out[(c, r)] = values[p]
                    del span[(c, r)]
                else:
                    pivots.setdefault(c, set()).update(values.values())
        pivots = {c: sorted(v) for c, v in pivots.items()}
    return out


def select_rank(df: DataFrame, col: str, rank: int, count: int, accuracy: int = 10000) -> float:
    """The value at a 0-based rank of a column of ``count`` values, by counting."""
    return _select_ranks(df, {col: [rank]}, {col: count}, {}, accuracy)[(col, rank)]


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10000) -> dict:
    """Exact quantiles (linear interpolation between order statistics, as
    ``percentile`` / pandas / DuckDB ``quantile_cont``) by counting
    (:func:`_select_ranks`): no list of values, no cap, at any size.

    The first pass counts the rows and takes pivots at p -/+ 3/A from a
    sketch; two more passes are enough for about A^2 / 12 rows.  Returns
    {(column, p): value}; only a few numbers per (column, p) reach the driver."""
    eps = 3.0 / accuracy
    grid = sorted({max(0.0, p - eps) for p in probs} | {min(1.0, p + eps) for p in probs})
    ok = {c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols}
    first = df.agg(*[F.count(F.when(ok[c], 1)).alias(f"n_{c}") for c in cols],
                   *[F.percentile_approx(F.when(ok[c], F.col(c).cast("double")),
                                         F.array(*[F.lit(q) for q in grid]), accuracy).alias(f"b_{c}")
                     for c in cols]).first()
    ranks, pos, known = {}, {}, {}
    for c in cols:
        n = first[f"n_{c}"]
        if not n:
            continue
        known[c] = first[f"b_{c}"]
        rs = set()
        for p in probs:
            h = p * (n - 1)
            lo, hi = math.floor(h), math.ceil(h)
            pos[(c, p)] = (lo, hi, h - lo)
            rs |= {lo, hi}
        ranks[c] = sorted(rs)
    stats = _select_ranks(df, ranks, {c: first[f"n_{c}"] for c in ranks}, known, accuracy) if ranks else {}
    out = {}
    for c in cols:
        for p in probs:
            if (c, p) not in pos:
                out[(c, p)] = None
                continue
            lo, hi, f = pos[(c, p)]
            vl, vh = stats[(c, lo)], stats[(c, hi)]
            out[(c, p)] = vl if f == 0 else float(hi - lo - f) * vl + f * vh   # (1 - f) * lo + f * hi, as percentile
    return out


def quantile_table(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10000) -> DataFrame:
    """(column, q1, q2, ...) from :func:`exact_quantiles` as a small DataFrame."""
    qs = exact_quantiles(df, cols, probs, accuracy)
    names = [f"q{i + 1}" for i in range(len(probs))]
    ddl = "column string, " + ", ".join(f"{n} double" for n in names)
    return df.sparkSession.createDataFrame([(c, *[qs.get((c, p)) for p in probs]) for c in cols], ddl)


# ------------------------------------------------------------------ G10 / G11
def quartiles(df: DataFrame, cols=None, method: str = "exact", accuracy: int = 10000,
              probs=(0.25, 0.75)) -> DataFrame:
    """Quantiles of every column, long form (column, q1, q3) for the
    default probabilities.  ``exact`` runs :func:`exact_quantiles` (three
    small aggregate jobs); ``approx`` is one ``percentile_approx`` aggregate
    (lazy)."""
    cols = cols or numeric_columns(df)
    if method == "exact":
        out = quantile_table(df, cols, list(probs), accuracy)
        return out.withColumnRenamed("q2", "q3") if tuple(probs) == (0.25, 0.75) else out
    wide = df.agg(*[_quantile(c, list(probs), method, accuracy).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"),
                              *[F.col(c)[i].alias(f"q{i + 1}") for i in range(len(probs))])
                     for c in cols])
    out = wide.select(F.inline(rows))
    if tuple(probs) == (0.25, 0.75):
        out = out.withColumnRenamed("q2", "q3")
    return out


def group_quantiles(df: DataFrame, key, col: str, probs=(0.89, 0.93),
                    method: str = "exact", accuracy: int = 10000, prefix: str = "q",
                    buckets: int = 64) -> DataFrame:
    """Quantiles of ``col`` per group (one row per group), linear
    interpolation between order statistics.

    ``exact`` (default): the distinct values of each group are counted (an
    aggregation with map-side combine), and their counts summed up in value
    order within value buckets (cut at global approximate quantiles) and
    shifted by the totals of the lower buckets, so a hot group's values
    spread over many tasks.  Then only the values that cover the needed ranks
    are kept and interpolated.  No group's values are held together anywhere.
    ``approx``: ``percentile_approx`` per group."""
    keys = key if isinstance(key, (list, tuple)) else [key]
    probs = list(probs)
    names = [f"{prefix}{int(round(p * 100))}" for p in probs]
    if method != "exact":
        agg = df.groupBy(*keys).agg(_quantile(col, probs, method, accuracy).alias("__q"))
        return agg.select(*keys, *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])
    x = F.col(col).cast("double")
    vals = df.select(*keys, x.alias("__v")).filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
    edges = vals.agg(F.percentile_approx("__v", F.array(*[F.lit(i / buckets) for i in range(1, buckets)]),
                                         accuracy).alias("e")).first()["e"] or []
    edges = sorted(set(float(e) for e in edges))
    seg = F.lit(0)
    for e in edges:       # bucket = number of edges <= value (monotone in value)
        seg = seg + (F.col("__v") >= F.lit(e)).cast("int")
    # a struct of group and bucket: never null itself, null keys match themselves
    counted = vals.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c")) \
        .withColumn("__ks", F.struct(*keys, seg.alias("__seg")))
    inside = Window.partitionBy("__ks").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("__upto", F.sum("__c").over(inside))
    of_key = [F.col(f"__ks.{k}") for k in keys]
    total = counted.groupBy("__ks").agg(F.sum("__c").alias("__t"))
    total = total.select("__ks", F.sum("__t").over(Window.partitionBy(*of_key)).alias("__n"), F.coalesce(
        F.sum("__t").over(Window.partitionBy(*of_key).orderBy("__ks.__seg").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__below"))
    ranked = counted.join(total, "__ks").withColumn("__last", F.col("__upto") + F.col("__below")) \
        .withColumn("__first", F.col("__last") - F.col("__c"))   # the value has the 0-based ranks first .. last - 1
    covers = lambda r: (F.col("__first") <= r) & (r < F.col("__last"))
    picks, outs, wanted = [], [], F.lit(False)
    for p, nm in zip(probs, names):
        h = F.lit(p) * (F.col("__n") - 1)
        wanted = wanted | covers(F.floor(h)) | covers(F.ceil(h))
        picks += [F.max(F.when(covers(F.floor(h)), F.col("__v"))).alias(f"{nm}__lo"),
                  F.max(F.when(covers(F.ceil(h)), F.col("__v"))).alias(f"{nm}__hi"),
                  F.max(h - F.floor(h)).alias(f"{nm}__f")]
        outs.append(F.when(F.col(f"{nm}__f") == 0, F.col(f"{nm}__lo"))
                     .otherwise((F.lit(1.0) - F.col(f"{nm}__f")) * F.col(f"{nm}__lo")
                                + F.col(f"{nm}__f") * F.col(f"{nm}__hi")).alias(nm))
    return ranked.filter(wanted).groupBy(*keys).agg(*picks).select(*keys, *outs)


def fences(df: DataFrame, cols=None, k: float = 1.5, method: str = "exact",
           accuracy: int = 10000) -> DataFrame:
    """IQR fences per column: (column, q1, q3, iqr, lower_fence, upper_fence)."""
    q = quartiles(df, cols, method, accuracy)
    return (q.withColumn("iqr", F.col("q3") - F.col("q1"))
             .withColumn("lower_fence", F.col("q1") - k * F.col("iqr"))
             .withColumn("upper_fence", F.col("q3") + k * F.col("iqr")))


# ------------------------------------------------------------------ E7 / G12
def outlier_report(df: DataFrame, cols=None, id_col: str = "id", k: float = 1.5,
                   n_ids: int = 10, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Per column, the IQR fences, the number of rows below / above them,
    the ``n_ids`` smallest ids of the rows below / above (ascending, repeated
    when an id has several outlying rows; comma separated), and a message
    when the column has no outliers.

    Two jobs whatever the column count: the fences (one aggregate), then one
    scan that unpivots each row to (column, side, id) for outlying values
    only.  The id lists are cut to ``n_ids`` from per-id counts, so no list
    ever holds more than ``n_ids`` entries."""
    cols = cols or numeric_columns(df)
    fz = fences(df, cols, k, method, accuracy)
    # 2 numbers per column: bounded by the column count, not the data
    fz_rows = fz.select("column", "lower_fence", "upper_fence").collect()
    bounds = {r["column"]: (r["lower_fence"], r["upper_fence"]) for r in fz_rows}
    # the collected fences become a small literal table (no second job)
    fz = df.sparkSession.createDataFrame(
        [(r["column"], r["lower_fence"], r["upper_fence"]) for r in fz_rows],
        "column string, lower_fence double, upper_fence double")
    sides = []
    for c in cols:
        lo, hi = bounds.get(c, (None, None))
        if lo is None:
            continue
        x = F.col(c).cast("double")
        sides.append(F.struct(F.lit(c).alias("column"),
                              F.when(x < F.lit(lo), F.lit("lower"))
                               .when(x > F.lit(hi), F.lit("upper")).alias("side")))
    # a column without values has no fences: where no column has any, nothing is tagged
    tagged = (df.select(F.col(id_col).alias("__id"), F.explode(F.array(*sides)).alias("r"))
                .select("__id", "r.column", "r.side")
                .filter(F.col("side").isNotNull())) if sides else \
        df.limit(0).select(F.col(id_col).alias("__id"), F.lit("").alias("column"), F.lit("").alias("side"))
    per_id = tagged.groupBy("column", "side", "__id").agg(F.count(F.lit(1)).alias("__n"))
    # the first ids of every (column, side): each task keeps n_ids of a group at most
    # before the exchange, so no group is sorted whole; ids of any type, null last
    w = Window.partitionBy("column", "side").orderBy(F.col("__id").asc_nulls_last())
    first = per_id.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= n_ids)
    cut = (first.withColumn("__before", F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .filter(F.col("__before") < n_ids)
                .withColumn("__take", F.least(F.col("__n"), F.lit(n_ids) - F.col("__before"))))
    ids = (cut.select("column", "side", "__id", "__k",
                      F.explode(F.sequence(F.lit(1), F.col("__take").cast("int"))).alias("__i"))
              .groupBy("column", "side")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__k", "__i", F.col("__id").cast("string").alias("id")))),
                                            lambda x: x["id"]), ",").alias("ids")))
    counts = per_id.groupBy("column", "side").agg(F.sum("__n").alias("n"))
    side = counts.join(ids, ["column", "side"], "left")
    piv = (side.groupBy("column")
               .agg(F.max(F.when(F.col("side") == "lower", F.col("n"))).alias("n_lower"),
                    F.max(F.when(F.col("side") == "upper", F.col("n"))).alias("n_upper"),
                    F.max(F.when(F.col("side") == "lower", F.col("ids"))).alias("lower_ids"),
                    F.max(F.when(F.col("side") == "upper", F.col("ids"))).alias("upper_ids")))
    out = fz.select(F.col("column").alias("variable_name"), "lower_fence", "upper_fence") \
            .join(piv.withColumnRenamed("column", "variable_name"), "variable_name", "left")
    return out.select(
        "variable_name", "lower_fence", "upper_fence",
        F.coalesce("n_lower", F.lit(0)).cast("bigint").alias("n_below_lower"),
        F.coalesce("n_upper", F.lit(0)).cast("bigint").alias("n_above_upper"),
        "lower_ids", "upper_ids",
        F.when(F.coalesce("n_lower", F.lit(0)) + F.coalesce("n_upper", F.lit(0)) == 0,
               F.lit("No outliers present")).alias("message"))


# ------------------------------------------------------------------ E8
def winsorize(df: DataFrame, cols=None, k: float = 1.5, method: str = "exact",
              accuracy: int = 10000, fence_table: DataFrame | None = None) -> DataFrame:
    """Clamp every column to its IQR fences (values below the lower fence
    become the lower fence, above the upper the upper; result DOUBLE).

    The fences are one aggregate job, collected as 2 numbers per column
    (bounded by the column count), then applied in a single projection."""
    cols = cols or numeric_columns(df)
    fz = (fence_table if fence_table is not None else fences(df, cols, k, method, accuracy))
    bounds = {r["column"]: (r["lower_fence"], r["upper_fence"])
              for r in fz.select("column", "lower_fence", "upper_fence").collect()}
    out = []
    for c in df.columns:
        if c in bounds and bounds[c][0] is not None:
            lo, hi = bounds[c]
            x = F.col(c)
            out.append(F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi))
                        .otherwise(x.cast("double")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ------------------------------------------------------------------ G13
def describe(df: DataFrame, cols=None, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per numeric column,
    long form (one row per column).  Moments come from one aggregate; the
    quartiles from :func:`exact_quantiles` (or the approximate sketch).  The
    mean is an exact decimal sum (12 digits) over the count, so it does not
    depend on the order of addition; columns with values that a
    DECIMAL(28,12) does not hold (NaN, infinite, 1e16 and more) get the plain
    average."""
    cols = cols or numeric_columns(df)
    probs = [0.25, 0.5, 0.75]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        d = F.expr(f"try_cast(cast(`{c}` as double) as decimal(28,12))")
        exact = F.try_divide(F.try_sum(d), F.count(x)).cast("double")
        mean = F.when(F.count(d) == F.count(x), F.coalesce(exact, F.avg(x))).otherwise(F.avg(x))
        aggs += [F.count(x).alias(f"{c}__count"), mean.alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
        if method != "exact":
            aggs.append(_quantile(c, probs, method, accuracy).alias(f"{c}__q"))
    wide = df.agg(*aggs)
    if method == "exact":
        qs = exact_quantiles(df, cols, probs, accuracy)
        quart = {c: [F.lit(qs.get((c, p))).cast("double") for p in probs] for c in cols}
    else:
        quart = {c: [F.col(f"{c}__q")[i] for i in range(3)] for c in cols}
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
        F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
        F.col(f"{c}__min").alias("min"), quart[c][0].alias("p25"),
        quart[c][1].alias("p50"), quart[c][2].alias("p75"),
        F.col(f"{c}__max").alias("max")) for c in cols])
    return wide.select(F.inline(rows))


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def dtypes_table(df: DataFrame) -> list[tuple[str, str]]:
    """Column types (schema only, no job)."""
    return list(df.dtypes)
