"""Per-series window operators.

Every operator works on a series identified by ``key`` (one or more columns)
and ordered by ``order`` (one or more columns, the last ones acting as
tie-breaks).

Two physical forms
------------------
``segment=None``
    One ``Window.partitionBy(key).orderBy(order)``: one hash exchange on the
    key and one sort.  Right when no single key is large.
``segment=<Column>``
    Skew-safe form.  ``segment`` is a coarse, order-compatible bucket of the
    ordering (e.g. the calendar day of the timestamp).  The heavy work is
    partitioned by ``(key, segment)`` so one hot key is spread over many
    tasks; only small per-(key, segment) summaries are ordered per key.  Rows
    with a null key or a null segment form a series or a last segment of their
    own, as in the plain form: joins go by a struct of key and segment, which
    is never null itself and compares null fields as equal, and which the
    windows are partitioned by too (no second exchange).

No operator collects a series to the driver or into one Python worker.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEG = "__seg"
_KS = "__ks"
_RN = "__rn"


def _segmented(df: DataFrame, keys: list, segment: Column) -> DataFrame:
    """``df`` with its segment and the struct (key, segment) that windows and joins go by."""
    d = df.withColumn(_SEG, segment)
    return d.withColumn(_KS, F.struct(*keys, _SEG))


def _order_key(order) -> Column:
    """A struct that orders rows as ``asc_nulls_last`` does."""
    cols = [F.col(o) if isinstance(o, str) else o for o in _list(order)]
    return F.struct(*[F.struct(c.isNull(), c) for c in cols])


def _list(x) -> list:
    if x is None:
        return []
    return list(x) if isinstance(x, (list, tuple)) else [x]


def _order_cols(order) -> list[Column]:
    out = []
    for o in _list(order):
        out.append(F.col(o).asc_nulls_last() if isinstance(o, str) else o)
    return out


def series_window(key, order) -> Window:
    return Window.partitionBy(*_list(key)).orderBy(*_order_cols(order))


# ---------------------------------------------------------------------------
# Row number (skew-safe numbering is the base of the segmented forms)
# ---------------------------------------------------------------------------
def row_number_by(df: DataFrame, key, order, out: str = "row_num",
                  segment: Column | None = None,
                  with_count: str | None = None) -> DataFrame:
    """1-based position of each row inside its series.

    ``key=None`` numbers the whole table (global order).  With ``segment``,
    rows are numbered inside ``(key, segment)`` and shifted by the number of
    rows of the earlier segments of the same key (a running sum over the small
    per-segment count table), so no task ever holds a whole series.
    ``with_count`` adds the series length.
    """
    keys = _list(key)
    if not keys:
        df = df.withColumn("__all", F.lit(0))
        keys = ["__all"]
    if segment is None:
        w = series_window(keys, order)
        res = df.withColumn(out, F.row_number().over(w))
        if with_count:
            res = res.withColumn(with_count, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        return res.drop("__all") if "__all" in res.columns else res

    # the key and the segment travel once, in the struct, unless the order names the key
    ordered = {o.lower() if isinstance(o, str) else None for o in _list(order)}
    inside = [k for k in keys if k.lower() not in ordered] if None not in ordered else []
    d = _segmented(df, keys, segment).drop(_SEG, *inside)
    local = d.withColumn(out, F.row_number().over(series_window(_KS, order)))
    counts = d.groupBy(_KS).agg(F.count(F.lit(1)).alias("__cnt"))
    of_key = [F.col(f"{_KS}.{k}") for k in keys]
    per_key = Window.partitionBy(*of_key).orderBy(F.col(f"{_KS}.{_SEG}").asc_nulls_last())
    offs = counts.withColumn(
        "__off", F.coalesce(F.sum("__cnt").over(per_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if with_count:
        offs = offs.withColumn(with_count, F.sum("__cnt").over(Window.partitionBy(*of_key)))
    res = (local.join(offs.drop("__cnt"), _KS, "inner")
                .withColumn(out, F.col(out) + F.col("__off"))
                .select(*[F.col(f"{_KS}.{c}").alias(c) if c in inside else F.col(c) for c in df.columns],
                        *[c for c in (out, with_count) if c and c not in df.columns]))
    return res.drop("__all") if "__all" in res.columns else res


# ---------------------------------------------------------------------------
# Dense rank of a derived value (trip id = dense rank of the day)
# ---------------------------------------------------------------------------
def dense_rank_by(df: DataFrame, key, value: Column, out: str = "trip_id") -> DataFrame:
    """Dense rank of ``value`` (e.g. ``to_date(timestamp)``) per key.

    Ranked on the distinct (key, value) table, which is as small as the
    number of (device, day) pairs, then joined back on (key, value): the big
    side is never sorted per key."""
    keys = _list(key)
    d = df.withColumn("__v", value)
    d = d.withColumn(_KS, F.struct(*keys, "__v"))   # null keys and values match themselves
    ranks = (d.select(_KS).distinct()
              .withColumn(out, F.dense_rank().over(
                  Window.partitionBy(*[F.col(f"{_KS}.{k}") for k in keys]).orderBy(F.col(f"{_KS}.__v").asc_nulls_last()))))
    return d.join(ranks, _KS, "inner").drop("__v", _KS)


# ---------------------------------------------------------------------------
# Shift / lag
# ---------------------------------------------------------------------------
def lag_by(df: DataFrame, key, order, cols, n=1, suffix: str = "_lag",
           segment: Column | None = None, names: dict | None = None) -> DataFrame:
    """Value ``n`` rows earlier in the series (pandas ``shift(n)``).

    ``n`` may be a list of distances; then ``names`` maps (column, n) to the
    output name (default ``{col}{suffix}{n}``)."""
    cols = _list(cols)
    ns = sorted(set(_list(n)))
    multi = isinstance(n, (list, tuple))
    if multi:
        names = names or {(c, k): f"{c}{suffix}{k}" for c in cols for k in ns}
    else:
        names = {(c, n): (names or {}).get(c, f"{c}{suffix}{n}" if suffix else c) for c in cols}
    keys = _list(key)
    if segment is None:
        w = series_window(keys, order)
        return df.select("*", *[F.lag(c, k).over(w).alias(names[(c, k)]) for c in cols for k in ns])
    # Skew-safe: one shuffle of the data, by (key, segment).  Inside a
    # segment the lag is a plain window lag.  Only the first m rows of a
    # segment look further back, and the row they need is always among the
    # last m rows of an earlier segment.  A small "fix" table holds, for each
    # segment, the values its head rows need: it comes from the per-segment
    # counts and tails (small tables).  The windowed data is consumed once,
    # in a left join with that table.
    m = max(ns)
    base = _segmented(df, keys, segment)
    ws = series_window(_KS, order)
    d = (base.withColumn("__lrn", F.row_number().over(ws))
             .select("*", *[F.lag(c, k).over(ws).alias(names[(c, k)]) for c in cols for k in ns]))
    of_key = [F.col(f"{_KS}.{k}") for k in keys]
    whose = F.struct(*of_key).alias("__key")
    counts = base.groupBy(_KS).agg(F.count(F.lit(1)).alias("__cnt"))
    offs = counts.withColumn("__off", F.coalesce(F.sum("__cnt").over(
        Window.partitionBy(*of_key).orderBy(F.col(f"{_KS}.{_SEG}").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if m == 1:
        # the last row of each segment, by an aggregate (no second window)
        last = base.groupBy(_KS).agg(
            F.max_by(F.struct(*[F.col(c) for c in cols]), _order_key(order)).alias("__last"))
        tails = (last.join(offs, _KS, "inner")
                     .select(whose, (F.col("__off") + F.col("__cnt")).alias("__src"),
                             *[F.col(f"__last.{c}").alias(f"__t_{c}") for c in cols]))
    else:
        tails = (d.join(counts, _KS, "inner")
                  .filter(F.col("__lrn") > F.col("__cnt") - m)
                  .join(offs.drop("__cnt"), _KS, "inner")
                  .select(whose, (F.col("__off") + F.col("__lrn")).alias("__src"),
                          *[F.col(c).alias(f"__t_{c}") for c in cols]))
    fix = offs.select(_KS, whose, "__off", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(m), F.col("__cnt")))).alias("__lrn"))
    fix = fix.withColumn("__grn", F.col("__off") + F.col("__lrn"))
    for k in ns:
        tk = tails.select("__key", (F.col("__src") + k).alias("__grn"),
                          *[F.col(f"__t_{c}").alias(f"__f{k}_{c}") for c in cols])
        fix = fix.join(tk, ["__key", "__grn"], "left")
    # one row per (key, segment): position -> values (at most m entries), so
    # the join below reuses the window's (key, segment) partitioning and
    # moves only this small side
    fcols = [f"__f{k}_{c}" for k in ns for c in cols]
    fix = (fix.groupBy(_KS)
              .agg(F.map_from_entries(F.collect_list(F.struct(
                  "__lrn", F.struct(*[F.col(x) for x in fcols])))).alias("__fix")))
    out = d.join(fix, _KS, "left")
    sel = [F.col(c) for c in df.columns]
    for c in cols:
        for k in ns:
            sel.append(F.when(F.col("__lrn") <= k, F.col("__fix")[F.col("__lrn")][f"__f{k}_{c}"])
                        .otherwise(F.col(names[(c, k)])).alias(names[(c, k)]))
    return out.select(*sel)


# ---------------------------------------------------------------------------
# Rolling average of the current and previous row, lag difference
# ---------------------------------------------------------------------------
def rolling_avg_and_diff(df: DataFrame, cols, key, order, cast: str = "float", segment: Column | None = None) -> DataFrame:
    """W1 + W2: for each column the mean of the present and previous row
    (``{col}_rolling_avg``; a missing one is left out) and the change from the
    previous row (``{col}_diff``; null where either is missing).  The previous
    values come from one window sort, or one series scan with ``segment``."""
    from millrace.operators.scan import Lag, series_scan

    cols = _list(cols)
    prev = {c: f"__prev_{c}" for c in cols}
    if segment is None:
        d = lag_by(df, key, order, cols, n=1, names=prev)
    else:
        d = series_scan(df, key, _list(order), segment, lags=[Lag(c, 1, p) for c, p in prev.items()])
    out = []
    for c in cols:
        x, p = F.col(c).cast("double"), F.col(prev[c]).cast("double")
        out.append(F.coalesce((x + p) / 2, x, p).cast(cast).alias(f"{c}_rolling_avg"))
    out += [(F.col(c) - F.col(prev[c])).cast(cast).alias(f"{c}_diff") for c in cols]
    return d.select(*df.columns, *out)


# ---------------------------------------------------------------------------
# Forward fill / backward fill
# ---------------------------------------------------------------------------
def fill_forward(df: DataFrame, cols, key, order, segment: Column | None = None,
                 backward: bool = False) -> DataFrame:
    """Replace nulls by the last (``backward=True``: next) non-null value
    of the same series.  Leading (trailing) nulls stay null."""
    cols = _list(cols)
    keys = _list(key)
    if not backward:
        w = series_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
        pick = lambda c, win: F.last(c, ignorenulls=True).over(win)
    else:
        w = series_window(keys, order).rowsBetween(0, Window.unboundedFollowing)
        pick = lambda c, win: F.first(c, ignorenulls=True).over(win)
    if segment is None:
        return df.select(*[pick(c, w).alias(c) if c in cols else F.col(c) for c in df.columns])
    # Skew-safe: fill inside (key, segment); carry the boundary value of the
    # neighbouring segments from the small per-segment table.
    d = _segmented(df, keys, segment)
    ws = series_window(_KS, order)
    ws = ws.rowsBetween(Window.unboundedPreceding, 0) if not backward else \
        ws.rowsBetween(0, Window.unboundedFollowing)
    inner = d.select(*[pick(c, ws).alias(c) if c in cols else F.col(c) for c in d.columns])
    # boundary value per segment: last (first) non-null in order
    ordkey = _order_key(order)
    agg = [(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordkey)) if not backward else
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ordkey))).alias(f"__b_{c}")
           for c in cols]
    bounds = d.groupBy(_KS).agg(*agg)
    wk = Window.partitionBy(*[F.col(f"{_KS}.{k}") for k in keys]).orderBy(F.col(f"{_KS}.{_SEG}").asc_nulls_last())
    wk = wk.rowsBetween(Window.unboundedPreceding, -1) if not backward else \
        wk.rowsBetween(1, Window.unboundedFollowing)
    carry = bounds.select(_KS, *[
        (F.last(f"__b_{c}", ignorenulls=True) if not backward else
         F.first(f"__b_{c}", ignorenulls=True)).over(wk).alias(f"__c_{c}") for c in cols])
    out = inner.join(carry, _KS, "left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"__c_{c}")).alias(c) if c in cols
                        else F.col(c) for c in df.columns])


def fill_series(df: DataFrame, cols, key, order, value=0.0,
                segment: Column | None = None, backward_first: bool = False) -> DataFrame:
    """W7 chain: forward fill, then backward fill, then a constant (the
    reference's ``ffill`` / ``bfill`` / ``fillna(0)`` sequence; set
    ``backward_first`` for bfill-then-ffill)."""
    steps = [True, False] if backward_first else [False, True]
    out = df
    for b in steps:
        out = fill_forward(out, cols, key, order, segment=segment, backward=b)
    return out.na.fill(value, subset=_list(cols)) if value is not None else out


# ---------------------------------------------------------------------------
# Adjusted exponentially weighted mean (pandas ``ewm(...).mean()``)
# ---------------------------------------------------------------------------
def ewm_alpha(com: float | None = None, span: float | None = None,
              alpha: float | None = None, halflife: float | None = None) -> float:
    if com is not None:
        return 1.0 / (1.0 + com)
    if span is not None:
        return 2.0 / (span + 1.0)
    if halflife is not None:
        return 1.0 - math.exp(-math.log(2.0) / halflife)
    if alpha is not None:
        return alpha
    raise ValueError("one of com, span, halflife, alpha is required")


def ewma(df: DataFrame, col: str, key, order, out: str | None = None,
         com: float | None = None, span: float | None = None,
         alpha: float | None = None, halflife: float | None = None,
         shift: int = 0, segment: Column | None = None,
         block: int | None = None) -> DataFrame:
    """``x.shift(shift).ewm(...).mean()`` per series, ``adjust=True``,
    ``ignore_na=False`` (weights follow row positions; null inputs are left
    out of both sums; no observation yet gives null).

    y_t = sum_{i<=t} b^(t-i) x_i / sum_{i<=t, x_i not null} b^(t-i),  b = 1-alpha

    Computed in blocks of ``B`` rows so every power of b stays in double
    range: running sums inside a block, plus what all earlier blocks carry in.
    A block with observations knows its sums at its end, S = its own total T
    plus those of the blocks before it (terms that weigh less than 2^-60 of T
    are below double precision).  The carry of a block is the S of the last
    block before it that has observations, however far back: the gap only
    scales both sums, so where a block has no observation yet the value is
    S_num / S_den, unscaled.  Only the table of blocks (one row for B rows) is
    ordered per key.
    """
    a = ewm_alpha(com, span, alpha, halflife)
    b = 1.0 - a
    out = out or f"{col}_ewma"
    keys = _list(key)
    lb = -math.log(b) if b > 0 else float("inf")
    if block is None:
        # as long as b^-B stays below e^69 (~1e30): slow decays (span=600:
        # B ~ 20,000) get few, long blocks, so the carry table (one row per
        # block) stays small enough to broadcast even for very long series
        block = 65536 if lb == 0 else max(1, min(65536, int(69.0 / lb)))
    B = block
    # T weighs at least b^(B-1) at the block's end, a total at most 1 / (1 - b)
    L = 1 if lb == float("inf") else 1 + math.ceil((60.0 * math.log(2.0) - math.log(a)) / (B * lb))

    if shift not in (0, 1):
        # general shift: move the values first, then smooth
        src = lag_by(df, keys, order, [col], n=shift, segment=segment, names={col: "__ewm_x"})
        return ewma(src, "__ewm_x", keys, order, out=out, alpha=a, shift=0,
                    segment=segment, block=block).drop("__ewm_x")
    # shift=1 needs no lag: the smoothed value of the previous rows is the
    # same block sums with the frame ending one row earlier and one power
    # of b less (y'(t) = N(t-1) / D(t-1)).
    x = col
    numbered = row_number_by(df, keys, order, out=_RN, segment=segment)
    d = (numbered.withColumn("__blk", F.floor((F.col(_RN) - 1) / B))
                 .withColumn("__j", ((F.col(_RN) - 1) % B).cast("int")))
    xv = F.col(x).cast("double")
    has = F.col(x).isNotNull() & ~F.isnan(xv)  # NaN counts as missing, as in pandas
    inv = F.pow(F.lit(b), -F.col("__j").cast("double"))
    end = -1 if shift else 0
    wblk = Window.partitionBy(*keys, "__blk").orderBy("__j").rowsBetween(Window.unboundedPreceding, end)
    d = (d.withColumn("__sn", F.sum(F.when(has, xv * inv)).over(wblk))
          .withColumn("__sd", F.sum(F.when(has, inv)).over(wblk)))
    # block totals, weighted to the last position of the block
    tail = F.pow(F.lit(b), F.lit(B - 1) - F.col("__j").cast("double"))
    d = d.withColumn(_KS, F.struct(*keys, "__blk"))
    totals = d.groupBy(_KS).agg(
        F.sum(F.when(has, xv * tail)).alias("__tn"),
        F.sum(F.when(has, tail)).alias("__td"))
    later = (totals.filter(F.col("__td").isNotNull())
             .select(_KS, "__tn", "__td", F.explode(F.sequence(F.lit(0), F.lit(L))).alias("__d"))
             .select(F.struct(*[F.col(f"{_KS}.{k}").alias(k) for k in keys],
                              (F.col(f"{_KS}.__blk") + F.col("__d")).alias("__blk")).alias(_KS),
                     (F.col("__tn") * F.pow(F.lit(b), F.col("__d") * B)).alias("__n"),
                     (F.col("__td") * F.pow(F.lit(b), F.col("__d") * B)).alias("__m"))
             .groupBy(_KS).agg(F.sum("__n").alias("__n"), F.sum("__m").alias("__m")))
    ends = totals.join(later, _KS, "left").withColumn(
        "__s", F.when(F.col("__td").isNotNull(), F.struct("__n", "__m", F.col(f"{_KS}.__blk").alias("at"))))
    before = Window.partitionBy(*[F.col(f"{_KS}.{k}") for k in keys]).orderBy(F.col(f"{_KS}.__blk")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(_KS, F.last("__s", ignorenulls=True).over(before).alias("__c"))
    j = F.col("__j").cast("double") - F.lit(float(shift))
    bj = F.pow(F.lit(b), j)
    gap = F.pow(F.lit(b), j + 1 + (F.col("__blk") - 1 - F.col("__c.at")) * B)
    num = F.coalesce(F.col("__sn") * bj, F.lit(0.0)) + F.coalesce(F.col("__c.__n") * gap, F.lit(0.0))
    den = F.coalesce(F.col("__sd") * bj, F.lit(0.0)) + F.coalesce(F.col("__c.__m") * gap, F.lit(0.0))
    res = (d.join(carry, _KS, "left")
            .withColumn(out, F.when(F.col("__sd").isNull(), F.col("__c.__n") / F.col("__c.__m"))
                              .otherwise(num / den)))
    return res.drop(_RN, "__blk", "__j", "__sn", "__sd", "__c", _KS)


# ---------------------------------------------------------------------------
# Deviation from a smoothed value
# ---------------------------------------------------------------------------
def deviation(df: DataFrame, col: str, smooth: str, out: str, sign: int = 1) -> DataFrame:
    """``sign=+1`` gives smooth - x (reference feature table);
    ``sign=-1`` gives x - smooth (defect labelling)."""
    e = (F.col(smooth) - F.col(col)) if sign > 0 else (F.col(col) - F.col(smooth))
    return df.withColumn(out, e)


# ---------------------------------------------------------------------------
# Time-ordered split
# ---------------------------------------------------------------------------
_COUNTABLE = ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz")


def _as_number(df: DataFrame, c: str) -> Column:
    """A whole number in the column's order (exact as a double up to 2^53)."""
    t = dict(df.dtypes)[c]
    if t == "date":
        return F.unix_date(c)
    if t.startswith("timestamp"):
        return F.unix_micros(F.col(c).cast("timestamp"))
    return F.col(c)


def _first_rows(df: DataFrame, order: list[str], rows: int) -> Column:
    """The condition that holds for the first ``rows`` rows in ``order`` (nulls last),
    found by counting, a column after the other; rows equal to the last one in
    all columns are among them."""
    from millrace.operators.profile import select_rank

    before, same, rank = F.lit(False), F.lit(True), rows - 1
    for c in order:
        tied = df.where(same).select(_as_number(df, c).cast("double").alias("x"))
        present = tied.agg(F.count("x")).first()[0]
        x = _as_number(df, c)
        if rank < present:
            value = select_rank(tied, "x", rank, present)
            below = tied.agg(F.count(F.when(F.col("x") < value, 1))).first()[0]
            before = before | (same & (x < F.lit(value)))
            same, rank = same & (x == F.lit(value)), rank - below
        else:
            before = before | (same & x.isNotNull())
            same, rank = same & x.isNull(), rank - present
    return F.coalesce(before | same, F.lit(False))


def ordered_split(df: DataFrame, order, frac: float = 0.8, key=None,
                  segment: Column | None = None, out: str = "split") -> DataFrame:
    """The first ``frac`` of rows in time order are ``train``, the rest
    ``test`` (pandas ``df[:int(n*frac)]``).

    A split of the whole table by times or whole numbers is a plain filter at
    the cut row's values, which are found by counting: nothing is sorted or
    exchanged.  Rows equal to the cut row in all order columns stay together, in
    ``train``.  A split within series (``key``), or by other types, numbers the
    rows per segment plus offsets."""
    names = [o for o in _list(order) if isinstance(o, str)]
    if not _list(key) and len(names) == len(_list(order)) and all(dict(df.dtypes)[o] in _COUNTABLE for o in names):
        rows = math.floor(df.count() * frac)
        train = _first_rows(df, names, rows) if rows else F.lit(False)
        return df.withColumn(out, F.when(train, "train").otherwise("test"))
    numbered = row_number_by(df, key, order, out=_RN, segment=segment, with_count="__n")
    return (numbered.withColumn(out, F.when(F.col(_RN) <= F.floor(F.col("__n") * frac), "train")
                                      .otherwise("test"))
                    .drop(_RN, "__n"))
