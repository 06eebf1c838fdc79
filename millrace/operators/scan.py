"""One scan over time-ordered series for many measures at once.

``series_scan`` computes smoothed values, their deviations, lags and the trip
number of a table of series together: the data is exchanged once, by (key,
segment), and sorted there.  A task streams through its sorted rows in Arrow
batches and gives each row what its own segment says.  The last row of every
segment is that segment's summary; summaries are ordered per key and combined
in a second, small scan, which is associative: sums decay by the rows they pass,
so segments of any length and gaps of any length are right.  What earlier
segments carry in is then joined to the rows by (key, segment).

A segment is a coarse, order-compatible bucket of the order, such as the day: a
key that holds a large share of the rows is spread over its segments, and no
task holds a series or a segment in memory.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import _list, _order_cols

_SEG, _IN, _END, _POS = "__seg", "__within", "__end", "__pos"


@dataclass(frozen=True)
class Smooth:
    """pandas' ``col.shift(shift).ewm(alpha=alpha).mean()`` (adjusted; missing values keep their place).

    ``restart``: a series of its own for every value of ``within``.
    ``deviation`` names the smoothed value less ``col``; where ``col`` is
    missing it is that of the last row before that has it.
    """

    col: str
    out: str
    alpha: float
    shift: int = 0
    restart: bool = False
    deviation: str | None = None


@dataclass(frozen=True)
class Lag:
    """``col`` ``n`` rows earlier in the series."""

    col: str
    n: int
    out: str


def _codes(column) -> np.ndarray:
    """Numbers that are equal where the column's values are (nulls equal each other)."""
    import pyarrow.compute as pc

    return pc.fill_null(column.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)


class _Run:
    """A smoothed column's state at the last row seen: decayed sums, and those at the last row with a value."""

    def __init__(self):
        self.n = self.d = 0.0
        self.ref = (np.nan, np.nan, -1)      # sums and place of the last row with a value
        self.dev = (np.nan, np.nan, -1, np.nan)  # what its own smoothed value is made of, and its value


def _smooth_batch(s: Smooth, x, begins, pos, run: _Run):
    """Sums and references of one column's rows; ``run`` is moved to the batch's end."""
    m, b = len(x), 1.0 - s.alpha
    has = ~np.isnan(x)
    rows = np.arange(m)
    first = np.maximum.accumulate(np.where(begins, rows, 0))  # a run's first row in the batch
    since = rows - first
    old = ~np.logical_or.accumulate(begins)  # rows of the run that the last batch left open
    n, d = np.where(has, x, 0.0), has.astype(float)
    step, weight = 1, b
    while step < m and weight > 2.0 ** -80:  # doubling: sums over the last 1, 2, 4, ... rows
        use = since[step:] >= step
        more_n, more_d = np.where(use, weight * n[:-step], 0.0), np.where(use, weight * d[:-step], 0.0)
        n[step:] += more_n
        d[step:] += more_d
        step, weight = step * 2, weight * weight
    if old.any():
        fade = b ** (since[old] + 1.0)
        n[old] += fade * run.n
        d[old] += fade * run.d
    last = np.maximum.accumulate(np.where(has, rows, -1))
    here = last >= first
    at = np.where(here, last, 0)

    def pick(values, kept, nothing):
        return np.where(here, values[at], np.where(old, kept, nothing))

    ref = [pick(n, run.ref[0], np.nan), pick(d, run.ref[1], np.nan), pick(pos, run.ref[2], -1)]
    if s.shift:  # the reference that the row before has
        prior = [np.where(begins, e, np.r_[k, r[:-1]]) for r, k, e in zip(ref, run.ref, (np.nan, np.nan, -1))]
    else:
        prior = ref
    dev = [pick(prior[0], run.dev[0], np.nan), pick(prior[1], run.dev[1], np.nan), pick(prior[2], run.dev[2], -1), pick(x, run.dev[3], np.nan)]
    run.n, run.d = n[-1], d[-1]
    run.ref, run.dev = tuple(r[-1] for r in ref), tuple(v[-1] for v in dev)
    return n, d, prior, dev


def _rows(keys, smooth, lags, depth):
    """The first scan: rows as they are, with what their segment says; ``__end`` marks a segment's last row."""

    def run(batches):
        import pyarrow as pa

        state = {s.out: _Run() for s in smooth}
        tails = {c: None for c in depth}
        held, last_key, length = None, None, 0
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            change = np.zeros(m, bool)
            for k in (*keys, _SEG):
                codes = _codes(batch.column(k))
                change[1:] |= codes[1:] != codes[:-1]
            first_key = [batch.column(k)[0].as_py() for k in (*keys, _SEG)]
            change[0] = last_key is None or first_key != last_key
            rows = np.arange(m)
            first = np.maximum.accumulate(np.where(change, rows, 0))
            old = ~np.logical_or.accumulate(change)
            pos = rows - first + np.where(old, length, 0)
            extra = {_POS: pa.array(pos)}
            for s in smooth:
                column = batch.column(s.col)
                x = column.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)
                n, d, prior, dev = _smooth_batch(s, x, change, pos, state[s.out])
                parts = {"n": n, "d": d, "rn": prior[0], "rd": prior[1], "ri": prior[2].astype(float)}
                if s.deviation:
                    parts |= {"vn": dev[0], "vd": dev[1], "vi": dev[2].astype(float), "vx": dev[3]}
                extra |= {f"__{s.out}_{p}": pa.array(v) for p, v in parts.items()}
            for c, most in depth.items():
                column = batch.column(c)
                tail = tails[c] if tails[c] is not None else column.slice(0, 0)
                joined = pa.concat_arrays([tail, column])
                for k in range(1, most + 1):
                    source = rows + len(tail) - k
                    extra[f"__{c}_lag{k}"] = joined.take(pa.array(np.where(pos >= k, np.maximum(source, 0), 0), mask=pos < k))
                tails[c] = joined.slice(max(0, len(joined) - most))
            length = int(pos[-1]) + 1
            last_key = [batch.column(k)[m - 1].as_py() for k in (*keys, _SEG)]
            table = pa.RecordBatch.from_arrays([*batch.columns, *extra.values()], names=[*batch.schema.names, *extra])
            if held is not None:
                yield held.append_column(_END, pa.array([bool(change[0])]))
            if m > 1:
                yield table.slice(0, m - 1).append_column(_END, pa.array(change[1:]))
            held = table.slice(m - 1)
        if held is not None:
            yield held.append_column(_END, pa.array([True]))

    return run


def _carry(keys, smooth, depth, out_names):
    """The second scan, over segments in order: what the segments before carry in."""

    def run(batches):
        import pyarrow as pa

        last = within = None
        rank, sums, devs, tails = 0, {}, {}, {}
        for batch in batches:
            rows = batch.to_pylist()
            out = {c: [] for c in out_names}
            for r in rows:
                key = tuple(r[k] for k in keys)
                if key != last:
                    last, within, rank = key, None, 0
                    sums, devs, tails = {}, {}, {c: [] for c in depth}
                    fresh = True
                else:
                    fresh = r[_IN] != within
                if fresh:
                    rank += 1
                    for s in smooth:
                        if s.restart:
                            sums.pop(s.out, None)
                            devs.pop(s.out, None)
                within = r[_IN]
                for k in (*keys, _SEG):
                    out[k].append(r[k])
                out["__rank"].append(rank)
                for c in depth:
                    out[f"__{c}_tail"].append(list(tails[c]))
                    tails[c] = (tails[c] + [r[f"__{c}_lag{i}"] for i in range(depth[c] - 1, 0, -1) if r[_POS] >= i] + [r[c]])[-depth[c]:]
                for s in smooth:
                    n, d, age = sums.get(s.out, (None, None, None))
                    dev = devs.get(s.out)
                    for p, v in (("cn", n), ("cd", d), ("ca", age)):
                        out[f"__{s.out}_{p}"].append(v)
                    b, count = 1.0 - s.alpha, r[_POS] + 1
                    if s.deviation:
                        out[f"__{s.out}_cv"].append(dev)
                        x = r[f"__{s.out}_vx"]
                        if x is not None and not math.isnan(x):  # the last row of the segment that has a value
                            i, vn, vd = r[f"__{s.out}_vi"], r[f"__{s.out}_vn"], r[f"__{s.out}_vd"]
                            if i >= 0:
                                fade = b ** (age + i + 1) if n is not None else 0.0
                                y = (vn + fade * (n or 0.0)) / (vd + fade * (d or 0.0))
                            else:
                                y = n / d if n is not None else None
                            devs[s.out] = None if y is None else y - x
                    if r[f"__{s.out}_d"] > 0:
                        fade = b ** (age + count) if n is not None else 0.0
                        sums[s.out] = (r[f"__{s.out}_n"] + fade * (n or 0.0), r[f"__{s.out}_d"] + fade * (d or 0.0), 0)
                    elif n is not None:  # no value here: both sums would only fade alike
                        sums[s.out] = (n, d, age + count)
            types = {"__rank": pa.int32()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[c], batch.schema.field(c).type) if c in batch.schema.names
                 else pa.array(out[c], types.get(c) or (pa.list_(batch.schema.field(c[2:-5]).type) if c.endswith("_tail") else pa.float64()))
                 for c in out_names], names=out_names)

    return run


def series_scan(df: DataFrame, key, order, segment: Column, smooth=(), lags=(), within: Column | None = None, rank: str | None = None) -> DataFrame:
    """``df`` with all ``smooth`` and ``lags`` columns, and ``rank``: the dense rank of ``within`` in the series.

    ``within`` (the segment if not given) is constant in a segment and grows
    with it.  Null keys are a series of their own; rows with a null segment
    come last.
    """
    keys = _list(key)
    depth: dict[str, int] = {}
    for g in lags:
        depth[g.col] = max(depth.get(g.col, 0), g.n)
    d = df.withColumn(_SEG, segment).withColumn(_IN, within if within is not None else segment)
    ordered = d.repartition(*keys, _SEG).sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in (*keys, _SEG)], *_order_cols(order))
    types = dict(d.dtypes)
    added = {_POS: "long"}
    for s in smooth:
        added |= {f"__{s.out}_{p}": "double" for p in ("n", "d", "rn", "rd", "ri", *(("vn", "vd", "vi", "vx") if s.deviation else ()))}
    for c, most in depth.items():
        added |= {f"__{c}_lag{k}": types[c] for k in range(1, most + 1)}
    schema = ", ".join(f"`{c}` {t}" for c, t in [*types.items(), *added.items(), (_END, "boolean")])
    scanned = ordered.mapInArrow(_rows(keys, tuple(smooth), tuple(lags), depth), schema)

    names = {k: types[k] for k in (*keys, _SEG)} | {"__rank": "int"}
    names |= {f"__{c}_tail": f"array<{types[c]}>" for c in depth}
    for s in smooth:
        names |= {f"__{s.out}_{p}": "double" for p in ("cn", "cd", "ca", *(("cv",) if s.deviation else ()))}
    needed = [*keys, _SEG, _IN, *depth, *added]
    units = scanned.where(_END).select(*dict.fromkeys(needed)).repartition(*keys) \
        .sortWithinPartitions(*[F.col(k).asc_nulls_last() for k in (*keys, _SEG)])
    carried = units.mapInArrow(_carry(keys, tuple(smooth), depth, list(names)), ", ".join(f"`{c}` {t}" for c, t in names.items()))
    # a struct is never null and its null fields equal each other
    ks = F.struct(*keys, _SEG)
    joined = scanned.withColumn("__ks", ks).join(carried.withColumn("__ks", ks).drop(*keys, _SEG), "__ks")

    out = []
    for s in smooth:
        b, p = F.lit(1.0 - s.alpha), f"__{s.out}_"

        def value(n, den, i, p=p, b=b):
            carry = F.col(p + "cn").isNotNull()
            fade = F.pow(b, F.col(p + "ca") + F.col(i) + 1)
            both = (F.col(n) + fade * F.col(p + "cn")) / (F.col(den) + fade * F.col(p + "cd"))
            return F.when(F.col(i) >= 0, F.when(carry, both).otherwise(F.col(n) / F.col(den))).when(carry, F.col(p + "cn") / F.col(p + "cd"))

        out.append(value(p + "rn", p + "rd", p + "ri").alias(s.out))
        if s.deviation:
            known = ~F.isnan(F.col(p + "vx"))
            out.append(F.when(known, value(p + "vn", p + "vd", p + "vi") - F.col(p + "vx")).otherwise(F.col(p + "cv")).alias(s.deviation))
    for g in lags:
        tail = F.col(f"__{g.col}_tail")
        # the carried values end with the row before the segment's first
        before = F.get(tail, (F.size(tail) - g.n + F.col(_POS)).cast("int"))
        out.append(F.when(F.col(_POS) >= g.n, F.col(f"__{g.col}_lag{g.n}")).when(F.size(tail) + F.col(_POS) >= g.n, before).alias(g.out))
    if rank:
        out.append(F.col("__rank").alias(rank))
    fresh = {s.out for s in smooth} | {s.deviation for s in smooth} | {g.out for g in lags} | {rank}
    return joined.select(*[c for c in df.columns if c not in fresh], *out)
