"""Embedding whitening (operator 12) by shifted Cholesky QR.

Rows are integers x = floor(``SCALE`` * c) + ``OFFSET``.  Counts and sums are
exact, and a centred entry is (n * x - S) / n from exact integers, so the large
offset costs no digits.  Each pass over the rows adds up the Gram matrix of
Q = X R^-1 (a sum for every task, then a sum of those by entry), and the driver
takes the Cholesky factor of that small matrix into R.  The first passes add a
shift, which keeps the factorisation possible however close to singular the
Gram matrix is; passes repeat until Q's Gram matrix is the identity on the
directions that the data has.  The singular value decomposition of the composed
R (weighted by the last Gram matrix) gives eigenvalues and components.

All that the driver holds is dimensions x dimensions; rows are read where they
are and never exchanged.

Defined cases: a row whose vector is null, empty, or holds null or non-finite
entries is dropped; so is one whose vector has another length than the most
frequent one (of equally frequent lengths the longest).  Components are those
with an eigenvalue above ``RANK`` of the largest (directions in which no row
differs have none), ``limit`` at most; a component's largest entry is positive,
the first one if several are.  Repeated rows count and are returned each; a null
id is returned; extra columns are ignored; a table with no rows, or whose rows
are all alike, gives an empty result.  A deviation that does not fit a long
raises an error.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

SCALE = 1024
OFFSET = 100_000
LIMIT = 8
PASSES = 8  # at most; three are enough where the directions' spreads are within 1e8
RANK = 1e-12  # least eigenvalue of a component, as a share of the largest
CLOSE = 1e-12  # greatest difference from the identity that ends the passes


def integers(vectors: DataFrame, vec_id: str, vector: str, scale: int, offset: int) -> DataFrame:
    """(vec_id, x) of the rows that take part, x as array of long."""
    c = F.col("_c")
    valid = c.isNotNull() & (F.size(c) > 0) & ~F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("_c")).where(F.coalesce(valid, F.lit(False)))
    rows = stored(rows.select("vec_id", F.transform(c, lambda v: F.floor(v * scale).cast("long") + offset).alias("x")), "whitening-rows")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (common["d"] if common else 0))


def _sums(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension (a sum for every task, then one of those)."""

    def run(batches):
        from decimal import Decimal

        import pyarrow as pa

        count, total = 0, [0] * dims
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, dims)
                safe = int(np.abs(x).max()) < 2 ** 62 // len(x)
                part = (x if safe else x.astype(object)).sum(0)
                count, total = count + len(x), [t + int(p) for t, p in zip(total, part)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1, dtype=np.int32)),
                                          pa.array([Decimal(v) for v in [count, *total]], pa.decimal128(38, 0))], names=["i", "v"])

    found = rows.select("x").mapInArrow(run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    n, *sums = [int(r["v"]) for r in sorted(found, key=lambda r: r["i"])]
    return n, sums


def _matrix(batch, dims: int) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S exactly: int64 where it fits, Python's integers elsewhere."""
    if len(x) and max(int(np.abs(x).max()) * n, int(max(map(abs, sums)))) >= 2 ** 62:
        x = x.astype(object)
    return x * n - (sums if x.dtype == object else sums.astype(np.int64))


def _gram(rows: DataFrame, n: int, sums: np.ndarray, r: np.ndarray | None = None, transform: np.ndarray | None = None, mean=0.0) -> np.ndarray:
    """Gram matrix, over all rows, of the centred rows solved against the triangle ``r``, or times ``transform`` less ``mean``."""
    dims = len(sums)
    k = dims if transform is None else transform.shape[1]
    upper = np.triu_indices(k)

    def run(batches):
        import pyarrow as pa

        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                q = (_centred(_matrix(batch, dims), n, sums) / n).astype(np.float64)
                q = np.linalg.solve(r.T, q.T).T if transform is None else q @ transform - mean
                total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])],
                                         names=["i", "j", "v"])

    parts = rows.select("x").mapInArrow(run, "i int, j int, v double")
    out = np.zeros((k, k))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _mean(rows: DataFrame, n: int, sums: np.ndarray, transform: np.ndarray) -> np.ndarray:
    """Mean of the transformed rows."""
    dims, k = transform.shape

    def run(batches):
        import pyarrow as pa

        total = np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                total += ((_centred(_matrix(batch, dims), n, sums) / n).astype(np.float64) @ transform).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    found = rows.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(found, key=lambda r: r["i"])]) / n


def _cholesky(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper factor of ``gram``, with the least shift that is safe if it is singular to rounding."""
    dims, eps = len(gram), np.finfo(float).eps
    shift = 11 * (n * dims + dims * (dims + 1)) * eps / 2 * np.linalg.norm(gram, 2) if shifted else 0.0
    shift = min(shift, np.linalg.norm(gram, 2) * 1e-3)  # the bound grows with the rows; a larger one would take passes
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(dims)).T
        except np.linalg.LinAlgError:
            shift = max(shift * 10, dims * eps * np.linalg.norm(gram, 2))


def qr(rows: DataFrame, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """R and the Gram matrix of the last Q = X R^-1, X being the centred rows."""
    dims = len(sums)
    r = np.eye(dims)
    last = None
    for step in range(PASSES):
        gram = _gram(rows, n, sums, r)
        if not np.any(gram):
            return r, gram
        away = np.abs(gram - np.eye(dims)).max()
        # directions without data stay at nought: what is left there no pass mends
        if step and (away <= CLOSE or (last is not None and away >= last / 2 and step >= 3)):
            return r, gram
        last = away
        # triangular solves compose: the new Q is X (factor r)^-1
        r = _cholesky(gram, n, shifted=step == 0) @ r
    return r, _gram(rows, n, sums, r)


def components(r: np.ndarray, gram: np.ndarray, n: int, limit: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Components (columns), eigenvalues and the trace of the covariance, from R and Q's Gram matrix."""
    values, vectors = np.linalg.eigh(gram)
    root = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T
    _, singular, right = np.linalg.svd(root @ r)
    e = singular ** 2 / n
    k = min(limit, int((e > RANK * e[0]).sum())) if len(e) and e[0] > 0 else 0
    v = right[:k].T
    for i in range(k):
        if v[np.abs(v[:, i]).argmax(), i] < 0:
            v[:, i] = -v[:, i]
    return v, e[:k], float(e.sum())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET, limit: int = LIMIT) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row a vector and component."""
    rows = integers(vectors, vec_id, vector, scale, offset)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    dims = rows.select(F.size("x")).first()
    if dims is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dims = dims[0]
    n, totals = _sums(rows, dims)
    sums = np.array(totals, dtype=object)
    r, gram = qr(rows, n, sums)
    axes, values, trace = components(r, gram, n, limit)
    k = len(values)
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    transform = axes / np.sqrt(values)
    covariance = _gram(rows, n, sums, transform=transform, mean=_mean(rows, n, sums, transform)) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = values / trace

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            d = _centred(_matrix(batch, dims), n, sums)
            if d.dtype != object and int(np.abs(d).max()) ** 2 * dims >= 2 ** 63:
                d = d.astype(object)
            deviation = (d * d).sum(1)
            if d.dtype == object and max(deviation) >= 2 ** 63:
                raise OverflowError("a deviation does not fit a long")
            w = (d / n).astype(np.float64) @ transform
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 pa.array(np.repeat(deviation.astype(np.int64), k)), pa.array(w.ravel()), pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, error))], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
