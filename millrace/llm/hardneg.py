"""Hard-negative mining (operator 13) with cover trees over norm-augmented candidates.

A candidate x is augmented by sqrt(M^2 - |x|^2), M being the largest norm, so
all candidates lie on one sphere and the order by inner product with a query is
the order by distance.  The first level of the tree is a farthest-first net of a
bounded sample (``SAMPLE_VALUES`` numbers); every candidate belongs to its
nearest net point's cell, and a cell's covering radius is measured over all its
candidates.  Cells are cut into blocks of bounded size, and each block is a tree
of its own: level by level the radius halves and a greedy net covers a node's
points.  With a node's centre c and covering radius r all inner products with q
below it lie within <q,c> -+ |q| r.

A query has windows [low, high] of wanted inner products and looks for the
highest k in each.  It first visits the cell of the highest bound, then those
other cells that meet a window above the k-th score found.  In a tree it
descends best-first, leaves out nodes outside all windows or below the k-th
score, and scores leaves exactly.  The queries of a group descend together: each
takes its best open nodes (one, then two, four, ...), and a node's centres or
leaf are multiplied once with all queries that took it.  Where a level compresses
nothing, as with random vectors, no net is finished: the points are one leaf.
Labels are kept apart by hash (``BUCKETS``),
so a search in one's own label reads its bucket only.  Queries and candidates
meet in groups of at most about ``QUERIES`` x ``BLOCK``; only the best k of a
group leave it.

Defined cases: rows with a null label, a null vector or null or non-finite
components take no part; an empty vector is a nought; shorter vectors count as
padded with noughts; ties go by smaller id, null ids last; repeated rows are
other rows with the same score; a null id is no anchor; an anchor without other
rows of its label, or a positive without rows in its window, gives nothing; an
empty table gives an empty result; extra columns are ignored.  Scores beyond a
long raise an error.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import stored

SAMPLE_VALUES = 1_500_000  # numbers in the sample that the net is made of
CELLS = 1024
BUCKETS = 64
BLOCK = 8192
QUERIES = 8192
LEAF = 48
TOGETHER = 256  # queries that descend together
PATIENCE = 256  # centres after which a net shows whether its level compresses
ROW = "vec_id long, label string, x array<bigint>, rid long"
EXACT = 2 ** 53  # scores below this are exact in double precision


class Node:
    __slots__ = ("rows", "children", "centres", "radii", "first")

    def __init__(self, rows):
        self.rows, self.children, self.centres, self.radii = rows, [], None, None


def cover_tree(points: np.ndarray) -> tuple[Node, int, float]:
    """Root, its centre's row and radius.  Every level's radius is half the one above."""

    def split(rows: np.ndarray, far: np.ndarray, level: float) -> Node:
        node = Node(rows)
        top = float(far.max()) if len(far) else 0.0
        while level > top and level > 0:  # levels that a single centre covers
            level /= 2
        if len(rows) <= LEAF or top <= 0:
            return node
        # greedy net: centres are more than ``level`` apart and cover the node's points
        own_points, squares = points[rows], square[rows]
        nearest = np.full(len(rows), np.inf)  # squared, by products: the radii are measured below
        own = np.zeros(len(rows), np.int64)
        centres: list[int] = []
        at = 0
        while True:
            d = np.maximum(squares + squares[at] - 2 * (own_points @ own_points[at]), 0)
            d[at] = 0
            closer = d < nearest
            own[closer] = len(centres)
            nearest[closer] = d[closer]
            centres.append(at)
            at = int(nearest.argmax())
            if nearest[at] <= level * level:
                break
            if nearest[at] <= 1e-12 * squares[at]:  # too close for products to tell the points apart
                if len(centres) == 1:
                    return node
                break
            # the level does not compress, four points a centre: score the points instead
            if len(centres) * 4 > len(rows) or len(centres) == PATIENCE and np.count_nonzero(nearest <= level * level) < 4 * PATIENCE:
                return node
        nearest = np.sqrt(((own_points - own_points[np.array(centres)[own]]) ** 2).sum(1))
        del own_points
        parts = [np.flatnonzero(own == i) for i in range(len(centres))]
        node.children = [split(rows[p], nearest[p], level / 2) for p in parts]
        node.centres = rows[np.array(centres)]
        node.radii = np.array([float(nearest[p].max()) for p in parts])
        return node

    square = (points * points).sum(1)
    rows = np.arange(len(points))
    far = np.sqrt(((points - points[0]) ** 2).sum(1))
    top = float(far.max())
    return split(rows, far, 2.0 ** math.floor(math.log2(top)) if top > 0 else 0.0), 0, top


class Best:
    """The highest k of every query's windows so far: ``query``, ``window``, ``score``, ``row`` of each find.

    ``low``, ``high`` and ``floor`` have a row for each query and a column for
    each window.  Rows stand in the order in which equal scores are taken.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, floor: np.ndarray, k: int):
        self.high, self.k, self.floor = high, k, np.maximum(low, floor)
        self.query, self.window, self.row = (np.empty(0, np.int64) for _ in range(3))
        self.score = np.empty(0, low.dtype)
        self.new: list[tuple] = []

    def add(self, queries: np.ndarray, rows: np.ndarray, scores: np.ndarray, wanted: np.ndarray) -> None:
        """``scores`` of ``queries`` with ``rows`` (ascending), of which ``wanted`` count."""
        for w in range(self.high.shape[1]):
            inside = wanted & (scores >= self.floor[queries, w][:, None]) & (scores <= self.high[queries, w][:, None])
            hit = np.flatnonzero(inside.any(1))
            if not len(hit):
                continue
            inside, own = inside[hit], scores[hit]
            if len(rows) > self.k:
                least = np.partition(np.where(inside, own, -np.inf), -self.k, axis=1)[:, -self.k][:, None]
                ties = inside & (own == least)
                inside = inside & (own > least) | ties & (np.cumsum(ties, axis=1) <= self.k)
            i, j = np.nonzero(inside)
            self.new.append((queries[hit[i]], np.full(len(i), w), own[i, j], rows[j]))

    def settle(self) -> None:
        """Keeps the highest k of all that was added, and raises the floors to the k-th score."""
        if not self.new:
            return
        query, window, score, row = (np.concatenate(c) for c in zip((self.query, self.window, self.score, self.row), *self.new))
        self.new = []
        order = np.lexsort((row, -score, window, query))
        query, window, score, row = (c[order] for c in (query, window, score, row))
        begins = np.flatnonzero(np.r_[True, (np.diff(query) != 0) | (np.diff(window) != 0)])
        place = np.arange(len(query)) - np.repeat(begins, np.diff(np.r_[begins, len(query)]))
        last = place == self.k - 1
        self.floor[query[last], window[last]] = np.maximum(self.floor[query[last], window[last]], score[last])
        self.query, self.window, self.score, self.row = (c[place < self.k] for c in (query, window, score, row))


def _flat(root: Node) -> list[Node]:
    """All nodes, the root first; a node's children get consecutive numbers, ``first`` being the lowest."""
    nodes = [root]
    for node in nodes:
        node.first = len(nodes)
        nodes += node.children
    return nodes


def descend(root: Node, centre: int, radius: float, points: np.ndarray, exact: np.ndarray, q: np.ndarray, q_exact: np.ndarray, wanted, best: Best) -> None:
    """Best-first search of the queries ``q``; ``wanted`` says which of some rows count for some queries."""
    nodes, d = _flat(root), points.shape[1] - 1
    length = np.sqrt((q * q).sum(1))
    slack = (1e-9 * (length * float(np.abs(points).max()) * q.shape[1] + 1) + 1e-6)[:, None]
    top, bottom = np.full((len(q), len(nodes)), -np.inf), np.full((len(q), len(nodes)), -np.inf)
    reached = np.zeros(top.shape, bool)
    mid = q @ points[centre, :d]
    top[:, 0], bottom[:, 0], reached[:, 0] = mid + length * radius, mid - length * radius, True
    ends, many = best.high.astype(np.float64), 1
    while True:
        floors, useful = best.floor.astype(np.float64), np.zeros(reached.shape, bool)
        for w in range(ends.shape[1]):
            useful |= (top + slack >= floors[:, w, None]) & (bottom - slack <= ends[:, w, None])
        reached &= useful
        if not reached.any():
            return
        take = reached.copy()
        if many < len(nodes):
            bounds = np.where(reached, top, -np.inf)
            take &= bounds >= np.partition(bounds, -many, axis=1)[:, -many][:, None]
        reached &= ~take
        for at in np.flatnonzero(take.any(0)):
            node, own = nodes[at], np.flatnonzero(take[:, at])
            if node.children:
                mid, reach = q[own] @ points[node.centres, :d].T, length[own, None] * node.radii
                below = slice(node.first, node.first + len(node.children))
                top[own, below], bottom[own, below], reached[own, below] = mid + reach, mid - reach, True
            else:
                best.add(own, node.rows, q_exact[own] @ exact[node.rows].T, wanted(own, node.rows))
        best.settle()
        many *= 2


def _vectors(column, dims: int) -> np.ndarray:
    """int64 rows, padded with noughts."""
    n = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(n) and (n == dims).all():
        return flat.reshape(len(n), dims).astype(np.int64)
    out = np.zeros((len(column), dims), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _windows(column: list, of: np.ndarray, dtype, empty: float) -> np.ndarray:
    """The windows' bounds of the rows ``of``, those that a query has fewer of being ``empty``."""
    out = np.full((len(of), max(len(column[i]) for i in of)), empty, dtype)
    for row, i in zip(out, of):
        row[:len(column[i])] = column[i]
    return out


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))[:, None]])


def _net(points: np.ndarray, k: int) -> np.ndarray:
    """Farthest-first net of k points."""
    chosen = [0]
    d = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(k, len(points)) and d.max() > 0:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _assign(shared, dims: int):
    def run(batches):
        import pyarrow as pa

        net, top = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _augmented(_vectors(batch.column("x"), dims), top)
            d = np.maximum((x * x).sum(1)[:, None] + (net * net).sum(1)[None, :] - 2 * x @ net.T, 0)
            cell = d.argmin(1)
            # the distance itself, not the rounded difference of squares
            away = np.sqrt(((x - net[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=[*batch.schema.names, "cell", "away"])

    return run


def _route(shared, dims: int, same: bool, step: int):
    """Adds ``blocks``: those of the best cell (step 0), or of all others that can hold a better one (step 1)."""

    def run(batches):
        import pyarrow as pa

        net, cells, buckets, radii, first, count = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch.column("x"), dims).astype(np.float64)
            length = np.sqrt((x * x).sum(1))
            own = batch.column("bucket").to_numpy()
            low, high, floor = (batch.column(n).to_pylist() for n in ("low", "high", "floor"))
            mids = x @ net[:, :dims].T
            out = []
            for i in range(len(x)):
                mid, reach = mids[i][cells], length[i] * radii
                slack = 1e-9 * (np.abs(mid) + reach + 1) + 1e-6
                meets = np.zeros(len(cells), bool)
                for a, b, f in zip(low[i], high[i], floor[i]):
                    meets |= (mid + reach + slack >= max(a, f)) & (mid - reach - slack <= b)
                if same:
                    meets &= buckets == own[i]
                if meets.any():  # the best cell: highest bound within the highest window
                    bound = np.where(meets, np.minimum(mid + reach, max(high[i])), -np.inf)
                    meets &= (cells == cells[bound.argmax()]) == (step == 0) if step < 2 else True
                out.append([int(b) for c in np.flatnonzero(meets) for b in range(first[c], first[c] + count[c])])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "blocks"])

    return run


def _search(dims: int, top: float, same: bool, k: int, exact_double: bool):
    def run(group):
        import pyarrow as pa

        out = {n: [] for n in ("rid", "window", "other", "other_id", "score")}
        asking = group.column("asking").to_numpy(zero_copy_only=False)
        qi, ci = np.flatnonzero(asking), np.flatnonzero(~asking)
        if len(qi) and len(ci):
            x = _vectors(group.column("x").combine_chunks(), dims)
            rid = group.column("rid").to_numpy()
            numbers = {}
            label = np.array([numbers.setdefault(v, len(numbers)) for v in group.column("label").to_pylist()])
            id_null = group.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            ids = np.where(id_null, np.iinfo(np.int64).max, group.column("vec_id").fill_null(0).to_numpy())
            exact = x.astype(np.float64) if exact_double else x.astype(object)
            ci = ci[np.lexsort((rid[ci], ids[ci], id_null[ci]))]  # the order of equal scores
            points, number, of, candidates = _augmented(x[ci], top), exact.dtype, label[ci], exact[ci]
            root, centre, radius = cover_tree(points)
            low, high, floor = (group.column(n).to_pylist() for n in ("low", "high", "floor"))
            for part in np.split(qi, range(TOGETHER, len(qi), TOGETHER)):
                def wanted(own, rows):
                    alike = label[part[own]][:, None] == of[rows]
                    return alike & (rid[part[own]][:, None] != rid[ci[rows]]) if same else ~alike

                best = Best(_windows(low, part, number, np.inf), _windows(high, part, number, -np.inf), _windows(floor, part, number, -np.inf), k)
                descend(root, centre, radius, points, candidates, x[part].astype(np.float64), exact[part], wanted, best)
                other = ci[best.row]
                out["rid"] += rid[part[best.query]].tolist()
                out["window"] += best.window.tolist()
                out["other"] += rid[other].tolist()
                out["other_id"] += [None if null else v for null, v in zip(id_null[other].tolist(), ids[other].tolist())]
                out["score"] += [int(v) for v in best.score.tolist()]
        return pa.table({"rid": pa.array(out["rid"], pa.int64()), "window": pa.array(out["window"], pa.int32()), "other": pa.array(out["other"], pa.int64()),
                         "other_id": pa.array(out["other_id"], pa.int64()), "score": pa.array(out["score"], pa.int64())})

    return run


class Index:
    """Candidates (rid, vec_id, label, x) in cells and blocks, ready to be searched."""

    def __init__(self, rows: DataFrame):
        spark = rows.sparkSession
        square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
        self.n, self.dims, self.top, largest = rows.agg(F.count("*"), F.max(F.size("x")), F.max(square), F.max(F.array_max(F.transform("x", F.abs)))).first()
        if not self.n:
            return
        self.dims = max(self.dims, 1)
        self.exact_double = self.dims * (largest or 0) ** 2 < EXACT
        take = max(64, SAMPLE_VALUES // self.dims)
        sample = rows.orderBy(F.xxhash64("rid"), "rid").limit(take).select("x").toArrow()
        sample = _augmented(_vectors(sample.column("x").combine_chunks(), self.dims), self.top)
        self.net = _net(sample, min(CELLS, max(1, self.n // (4 * BLOCK))))
        placed = rows.select("vec_id", "label", "x", "rid").withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int"))
        placed = stored(placed.mapInArrow(_assign(spark.sparkContext.broadcast((self.net, self.top)), self.dims), f"{ROW}, bucket int, cell int, away double"), "cells")
        # at most CELLS x BUCKETS rows
        sizes = placed.groupBy("cell", "bucket").agg(F.count("*").alias("n"), F.max("away").alias("radius")).orderBy("cell", "bucket").collect()
        count = np.array([-(-r["n"] // BLOCK) for r in sizes])
        first = np.cumsum(count) - count
        parts = spark.createDataFrame([(r["cell"], r["bucket"], int(f), int(c)) for r, f, c in zip(sizes, first, count)], "cell int, bucket int, first int, count int")
        self.blocks = placed.join(parts, ["cell", "bucket"]).select(
            "rid", "vec_id", "label", "x", (F.col("first") + F.pmod(F.xxhash64("rid"), F.col("count")).cast("int")).alias("block"))
        self.routes = spark.sparkContext.broadcast((self.net, np.array([r["cell"] for r in sizes]), np.array([r["bucket"] for r in sizes]),
                                                    np.array([r["radius"] for r in sizes]) * (1 + 1e-9), first, count))

    def search(self, asks: DataFrame, same: bool, k: int, tag: str) -> DataFrame:
        """rid, window, other, other_id, score, place: the best k of each window of ``asks`` (rid, label, x, low, high), written."""
        none = F.transform("low", lambda _: F.lit(-2 ** 63))
        asks = asks.withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int")).withColumn("floor", none)
        if len(self.net) == 1:
            return stored(self._best(self._visit(asks, same, k, 2), k), tag)
        near = stored(self._best(self._visit(asks, same, k, 0), k), tag + "-first")
        floors = near.where(F.col("place") == k).groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("known"))
        rest = asks.join(floors, "rid", "left").withColumn("floor", F.transform("low", lambda _, i: F.coalesce(F.try_element_at("known", i), F.lit(-2 ** 63)))).drop("known")
        return stored(self._best(near.drop("place").unionByName(self._visit(rest, same, k, 1)), k), tag)

    def _best(self, found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("rid", "window").orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)

    def _visit(self, asks: DataFrame, same: bool, k: int, step: int) -> DataFrame:
        routed = asks.select("rid", "label", "bucket", "x", "low", "high", "floor")
        routed = routed.mapInArrow(_route(self.routes, self.dims, same, step), "rid long, label string, bucket int, x array<bigint>, low array<bigint>, high array<bigint>, floor array<bigint>, blocks array<int>")
        routed = stored(routed.drop("bucket").where(F.size("blocks") > 0), "routes")
        sent = routed.withColumn("block", F.explode("blocks")).drop("blocks")
        shares = sent.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("shares"))
        deal = F.pmod(F.xxhash64("rid", F.lit(7)), F.col("shares")).cast("int")
        longs = F.lit(None).cast("array<bigint>")
        both = sent.join(shares, "block").withColumn("share", deal).withColumn("vec_id", F.lit(None).cast("long")).withColumn("asking", F.lit(True)) \
            .unionByName(self.blocks.join(shares, "block").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
                         .withColumn("low", longs).withColumn("high", longs).withColumn("floor", longs).withColumn("asking", F.lit(False)))
        return both.groupBy("block", "share").applyInArrow(_search(self.dims, self.top, same, k, self.exact_double),
                                                           "rid long, window int, other long, other_id long, score long")


def valid_rows(vectors: DataFrame, scale: int, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(vec_id, label, x) of the rows that take part; x = floor(scale * component)."""
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    finite = ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("x", F.transform("x", lambda v: F.floor(v * scale).cast("long")))


def mine(rows: DataFrame, anchors, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and x (array of long); ``anchors`` is a condition
    on them.  A negative's score is between ``low`` and ``high`` percent of its
    positive's.
    """
    rows = stored(rows.select("vec_id", F.col("label").cast("string").alias("label"), "x", F.coalesce(anchors, F.lit(False)).alias("anchor"))
                  .withColumn("rid", F.monotonically_increasing_id()), "candidates")
    index = Index(rows.drop("anchor"))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not index.n:
        return rows.sparkSession.createDataFrame([], schema)
    asking = rows.where("anchor").select("rid", "label", "x")
    longs = lambda v: F.array(F.lit(v)).cast("array<bigint>")
    near = index.search(asking.withColumn("low", longs(-2 ** 63)).withColumn("high", longs(2 ** 63 - 1)), True, positives, "positives")
    near = near.select("rid", F.col("place").alias("p"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # a window for each positive; a negative score's window is empty
    bounds = near.where("positive_score >= 0").groupBy("rid").agg(F.sort_array(F.collect_list(F.struct(
        "p", F.expr(f"(positive_score * {low} + 99) div 100").alias("low"), F.expr(f"positive_score * {high} div 100").alias("high")))).alias("w"))
    asks = asking.join(bounds, "rid").select("rid", "label", "x", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    hard = index.search(asks, False, negatives, "negatives").select("rid", (F.col("window") + 1).alias("p"), F.col("place").alias("rank"),
                                                                    F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    # positives come in falling order of score, so those with a window are the first ones
    return hard.join(near, ["rid", "p"]).join(rows.select("rid", F.col("vec_id").alias("anchor_id")), "rid") \
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
