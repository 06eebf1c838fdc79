"""Embedding near-dedup (operator 6): product quantisation over coarse inverted lists.

The index is fitted on a bounded sample (``SAMPLE_VALUES`` numbers) of the
distinct unit vectors: coarse centroids, and for the residuals a codebook for
each subspace of ``SUB`` dimensions.  Every vector is put in the list of its
nearest centroid with its residual codes, and searches the ``probes`` nearest
lists; ``probes`` is what finds ``SUFFICIENT`` of partners placed exactly at
the threshold in random directions around sampled vectors.  Within a list the
asymmetric distance (query exact, list vector by its codes, from lookup tables)
discards a pair only when it exceeds the threshold's distance by more than the
list vector's own quantisation error, so codes lose no link; what is left gets
the exact cosine in double precision.

Lists are split by label, and equal vectors are one entry with a multiplicity.
Of two lists the one with the smaller number probes the other, so each pair is
met once.  Large lists are cut into blocks, so list x query blocks are bounded;
a block task returns sums of links and a spanning forest of its links, never
the pairs.

Defined cases: a null label, and a vector that is null, empty, zero or holds
null or non-finite components, links with nothing; vectors of different
lengths never link; equal rows link with each other; extra columns are ignored;
a table without valid vectors gives every vector alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import connected_components, stored

THRESHOLD = 0.93
SAMPLE_VALUES = 1_500_000  # numbers in the fitting sample (rows x dimensions)
SUB = 4  # dimensions a subspace
CODES = 256
SUFFICIENT = 0.995
BLOCK = 2048


@dataclass
class Index:
    centroids: np.ndarray  # lists x dimensions
    books: np.ndarray  # subspaces x codes x SUB
    probes: int
    threshold: float


def _k_means(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = ((c * c).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def _units(vectors: list, dims: int) -> np.ndarray:
    """Unit vectors, padded with zeros to ``dims``."""
    u = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        u[i, :len(v)] = v
    u /= np.abs(u).max(1, keepdims=True)
    return u / np.linalg.norm(u, axis=1, keepdims=True)


def _near(index: Index, u: np.ndarray) -> np.ndarray:
    """Lists by distance, nearest first (the ``probes`` first ones)."""
    d = (index.centroids ** 2).sum(1)[None, :] - 2 * u @ index.centroids.T
    p = min(index.probes, d.shape[1])
    first = np.argpartition(d, p - 1, axis=1)[:, :p]
    order = np.take_along_axis(d, first, 1).argsort(1, kind="stable")
    return np.take_along_axis(first, order, 1)


def fit(sample: np.ndarray, rows: int, threshold: float = THRESHOLD, seed: int = 11) -> Index:
    """Index of unit vectors; the number of lists grows with the root of ``rows``."""
    rng = np.random.default_rng(seed)
    lists = int(min(4096, len(sample), max(4, 2 ** round(math.log2(max(rows, 16) ** 0.5)))))
    centroids = _k_means(sample, lists, 8, rng)
    index = Index(centroids, np.empty(0), lists, threshold)
    own = _near(Index(centroids, index.books, 1, threshold), sample)[:, 0]
    residual = (sample - centroids[own]).reshape(len(sample), -1, SUB)
    part = residual[rng.choice(len(residual), min(len(residual), 8000), replace=False)]
    index.books = np.stack([_k_means(part[:, m], CODES, 5, rng) for m in range(part.shape[1])])
    # partners exactly at the threshold, in random directions
    x = sample[rng.choice(len(sample), min(len(sample), 2000), replace=False)]
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    y = threshold * x + math.sqrt(1 - threshold ** 2) * away
    home = _near(Index(centroids, index.books, 1, threshold), y)[:, 0]
    rank = (_near(index, x) == home[:, None]).argmax(1)
    index.probes = int(min(lists, np.quantile(rank, SUFFICIENT, method="higher") + 1))
    return index


def _encode(shared, dims: int):
    def run(batches):
        import pyarrow as pa

        index = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            u = _units([x.values.to_numpy(zero_copy_only=False) for x in batch.column("vector")], dims)
            near = _near(index, u)
            cell = near[:, 0]
            residual = (u - index.centroids[cell]).reshape(len(u), -1, SUB)
            codes = np.empty(residual.shape[:2], np.uint8)
            error = np.zeros(len(u))
            for m, book in enumerate(index.books):
                d = (book ** 2).sum(1)[None, :] - 2 * residual[:, m] @ book.T
                codes[:, m] = d.argmin(1)
                error += ((residual[:, m] - book[codes[:, m]]) ** 2).sum(1)
            asks = [sorted(int(c) for c in row if c >= own) for row, own in zip(near, cell)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes]),
                 pa.array(np.sqrt(error)), pa.array(asks, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "cell", "codes", "error", "asks"])

    return run


def _forest(hit: np.ndarray, q: np.ndarray, x: np.ndarray):
    """Edges of a spanning forest of the bipartite graph ``hit``."""
    new_q, new_x = hit.any(1), hit.any(0)
    edges = []
    for root in np.flatnonzero(new_q):
        if not new_q[root]:
            continue
        new_q[root] = False
        stack = [(True, root)]
        while stack:
            is_q, i = stack.pop()
            if is_q:
                found = np.flatnonzero(hit[i] & new_x)
                new_x[found] = False
                edges += [(q[i], x[j]) for j in found]
                stack += [(False, j) for j in found]
            else:
                found = np.flatnonzero(hit[:, i] & new_q)
                new_q[found] = False
                edges += [(x[i], q[j]) for j in found]
                stack += [(True, j) for j in found]
    return edges


def _search(shared, dims: int):
    def run(group):
        import pyarrow as pa

        index = shared.value
        asking = group.column("asking").to_numpy(zero_copy_only=False)
        rid = group.column("rid").to_numpy()
        copies = group.column("copies").to_numpy()
        cells = group.column("cell").to_numpy()
        out_rid, out_links, out_edge = [], [], []
        li, qi = np.flatnonzero(~asking), np.flatnonzero(asking)
        if len(li) and len(qi):
            rows = group.column("vector").combine_chunks()
            u = _units([rows[int(i)].values.to_numpy(zero_copy_only=False) for i in range(len(rows))], dims)
            cell = int(group.column("list")[0].as_py())
            all_codes = group.column("codes").to_pylist()
            codes = np.stack([np.frombuffer(all_codes[i], np.uint8) for i in li])
            error = group.column("error").to_numpy()[li]
            reach = math.sqrt(2 - 2 * index.threshold) + 1e-6
            hit = np.zeros((len(qi), len(li)), bool)
            for at in range(0, len(qi), 256):  # lookup tables of 256 queries at a time
                part = qi[at:at + 256]
                r = (u[part] - index.centroids[cell]).reshape(len(part), -1, SUB)
                d = np.zeros((len(part), len(li)))
                for m, book in enumerate(index.books):
                    lookup = ((r[:, m, None, :] - book[None]) ** 2).sum(2)
                    d += lookup[:, codes[:, m]]
                close = (d <= (reach + error)[None, :] ** 2)
                close &= ~((cells[part] == cell)[:, None] & (rid[part][:, None] >= rid[li][None, :]))
                a, b = np.nonzero(close)
                exact = (u[part[a]] * u[li[b]]).sum(1) >= index.threshold
                hit[at + a[exact], b[exact]] = True
            if hit.any():
                for ids, links in ((rid[qi], hit @ copies[li]), (rid[li], copies[qi] @ hit)):
                    some = links > 0
                    out_rid += ids[some].tolist()
                    out_links += links[some].tolist()
                    out_edge += [None] * int(some.sum())
                for a, b in _forest(hit, rid[qi], rid[li]):
                    out_rid.append(int(a))
                    out_links.append(0)
                    out_edge.append(int(b))
        return pa.table({"rid": pa.array(out_rid, pa.int64()), "links": pa.array(out_links, pa.int64()), "to": pa.array(out_edge, pa.int64())})

    return run


def embedding_near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row a vector."""
    spark = vectors.sparkSession
    rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                                 F.col("embedding").cast("array<double>").alias("vector"))
                  .withColumn("rid", F.monotonically_increasing_id()), "vectors")
    finite = ~F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("vector", lambda v: v != 0)
    valid = rows.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    entries = stored(valid.groupBy("label", "vector").agg(F.min("rid").alias("rid"), F.count("*").alias("copies")), "entries")
    n, dims = entries.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dims = -(-dims // SUB) * SUB
    take = max(64, SAMPLE_VALUES // dims)
    sample = entries.orderBy(F.xxhash64("rid"), "rid").limit(take).select("vector").toPandas()["vector"]
    shared = spark.sparkContext.broadcast(fit(_units(list(sample), dims), n, threshold))

    coded = stored(entries.select("rid", "label", "copies", F.size("vector").alias("dim"), "vector")
                   .mapInArrow(_encode(shared, dims), "rid long, label string, copies long, dim int, vector array<double>, "
                                                      "cell int, codes binary, error double, asks array<int>"), "codes")
    key = ["label", "dim", "list"]
    lists = coded.withColumn("list", F.col("cell")).drop("asks")
    asks = coded.withColumn("list", F.explode("asks")).drop("asks")
    sizes = lists.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("list_blocks")) \
        .join(asks.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("ask_blocks")), key)
    block = lambda total: F.pmod(F.xxhash64("rid"), F.col(total)).cast("int")
    every = lambda total: F.explode(F.sequence(F.lit(0), F.col(total) - 1))
    dealt = lists.join(sizes, key).withColumn("lb", block("list_blocks")).withColumn("ab", every("ask_blocks")).withColumn("asking", F.lit(False)) \
        .unionByName(asks.join(sizes, key).withColumn("ab", block("ask_blocks")).withColumn("lb", every("list_blocks")).withColumn("asking", F.lit(True)))
    found = stored(dealt.groupBy(*key, "lb", "ab").applyInArrow(_search(shared, dims), "rid long, links long, to long"), "found")

    links = found.where("to is null").groupBy("rid").agg(F.sum("links").alias("links"))
    comps = connected_components(found.where("to is not null").select(F.col("rid").alias("a"), F.col("to").alias("b")))
    state = entries.select("rid", "label", "vector", "copies").join(links, "rid", "left") \
        .join(comps.withColumnRenamed("node", "rid"), "rid", "left") \
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rid").alias("comp"))
    full = stored(rows.join(state, ["label", "vector"], "left")
                  .select("rid", "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                          F.coalesce("comp", "rid").alias("comp")), "state")
    least = full.groupBy("comp").agg(F.min("vec_id").alias("component_id"))
    return full.join(least, "comp").select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
