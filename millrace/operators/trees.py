"""Decision trees for every id of a table, grown together.

All trees grow level by level.  A level is one aggregate of (id, node, feature,
bin) counts over the binned rows; the best cut of every open node of every id
follows from running sums of those counts.  There is no loop over ids, and no
id's rows are held together: an id with a third of the rows collapses in the
partial aggregate.  A model is one row for an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.windows import _list
from millrace.sources.io import materialize

BINS = 32


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Equal-width cuts between the least and greatest value of every feature (a few numbers a feature)."""
    x = {f: F.nanvl(F.col(f).cast("double"), F.lit(None)) for f in features}
    row = df.agg(*[F.min(x[f]).alias(f"lo_{f}") for f in features], *[F.max(x[f]).alias(f"hi_{f}") for f in features]).first()
    out = {}
    for f in features:
        lo, hi = row[f"lo_{f}"], row[f"hi_{f}"]
        out[f] = sorted({lo + (hi - lo) * i / bins for i in range(1, bins)} - {hi}) if lo is not None and lo < hi else []
    return out


def _bin(x: Column, edges: list[float]) -> Column:
    """Number of cuts below ``x`` (a missing value is below all)."""
    if not edges:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < x)), F.lit(0))


def _impurity(n: Column, p: Column) -> Column:
    return p * (n - p) / n


def fit_trees(df: DataFrame, key, features: list[str], label: str, depth: int = 3, bins: int = BINS, min_rows: int = 1,
              edges: dict[str, list[float]] | None = None) -> DataFrame:
    """One decision tree (Gini, binary label 0/1) per id: keys, ``n_used``, ``nodes``.

    ``nodes``: (node, n, positives, feature, cut, gain); the children of node i
    are 2 i and 2 i + 1, rows above the cut go to the second; leaves have no
    feature.  Equal gains (to six digits) go to the first feature and the lowest
    cut.  Rows without a label are left out; a missing feature is below every
    cut.  A null id is an id.
    """
    keys = _list(key)
    edges = edges or bin_edges(df, features, bins)
    y = F.col(label).cast("double")
    cuts = {i: edges[f] for i, f in enumerate(features)}
    rows = df.where(y.isNotNull()).select(
        F.struct(*keys).alias("k"), y.alias("y"),
        F.array(*[_bin(F.nanvl(F.col(f).cast("double"), F.lit(None)), edges[f]) for f in features]).alias("bins"))
    rows = materialize(rows.withColumn("node", F.lit(1)), "tree-rows")
    grown = None
    for level in range(depth + 1):
        if level == depth:
            stats = rows.groupBy("k", "node").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"))
            best = stats.select("k", "node", "n", "p", F.lit(None).cast("struct<feature:int,bin:int,gain:double>").alias("cut"))
        else:
            counts = rows.select("k", "node", "y", F.posexplode("bins").alias("feature", "bin")) \
                .groupBy("k", "node", "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p"))
            one = Window.partitionBy("k", "node", "feature")
            upto = one.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
            c = counts.select("k", "node", "feature", "bin", F.sum("n").over(one).alias("n"), F.sum("p").over(one).alias("p"),
                              F.sum("n").over(upto).alias("nl"), F.sum("p").over(upto).alias("pl"))
            right = F.col("n") - F.col("nl")
            gain = F.when((F.col("nl") >= min_rows) & (right >= min_rows) & (right > 0), F.round(
                _impurity(F.col("n"), F.col("p")) - _impurity(F.col("nl"), F.col("pl")) - _impurity(right, F.col("p") - F.col("pl")), 6))
            c = c.withColumn("gain", gain)
            best = c.groupBy("k", "node").agg(
                F.max("n").alias("n"), F.max("p").alias("p"),
                F.min_by(F.struct("feature", "bin", "gain"), F.when(F.col("gain") > 0, F.struct(-F.col("gain"), "feature", "bin"))).alias("cut"))
        best = materialize(best, "tree-level")
        grown = best if grown is None else grown.unionByName(best)
        split = best.where("cut is not null").select("k", "node", "cut")
        if level == depth or split.isEmpty():
            break
        rows = rows.join(split, ["k", "node"]).select(
            "k", "y", "bins", (F.col("node") * 2 + (F.col("bins")[F.col("cut.feature")] > F.col("cut.bin")).cast("int")).alias("node"))
        rows = materialize(rows, "tree-rows")
    name = F.when(F.col("cut").isNotNull(), F.get(F.array(*[F.lit(f) for f in features]), F.col("cut.feature")))
    at = F.lit(None).cast("double")
    for i in cuts:
        if cuts[i]:
            at = F.when(F.col("cut.feature") == i, F.get(F.array(*[F.lit(e) for e in cuts[i]]), F.col("cut.bin"))).otherwise(at)
    # 2^(depth + 1) nodes at most
    node = F.struct("node", "n", F.col("p").alias("positives"), name.alias("feature"), at.alias("cut"), F.col("cut.gain").alias("gain"))
    trees = grown.select("k", node.alias("node")).groupBy("k").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    return trees.select("k.*", F.element_at("nodes", 1)["n"].alias("n_used"), "nodes")


def route_trees(df: DataFrame, trees: DataFrame, key, features: list[str], out: str = "probability", threshold: float = 0.5) -> DataFrame:
    """Every row scored by the tree of its id: ``out``, and ``{out}_class``; null without a model."""
    keys = _list(key)
    models = trees.select(F.struct(*keys).alias("__k"), F.map_from_entries(F.transform("nodes", lambda n: F.struct(n["node"], n))).alias("__nodes"))
    joined = df.withColumn("__k", F.struct(*keys)).join(models, "__k", "left")
    x = F.create_map(*[e for f in features for e in (F.lit(f), F.nanvl(F.col(f).cast("double"), F.lit(None)))])
    depth = F.floor(F.log2(F.array_max(F.map_keys("__nodes")).cast("double"))).cast("int")   # of the deepest node

    def step(at, _):
        n = F.try_element_at(F.col("__nodes"), at)
        return F.when(n["feature"].isNull(), at).otherwise(at * 2 + F.coalesce(F.try_element_at(F.col("__x"), n["feature"]) > n["cut"], F.lit(False)).cast("int"))

    leaf = F.aggregate(F.sequence(F.lit(0), depth), F.lit(1), step)
    scored = joined.withColumn("__x", x).withColumn("__leaf", F.when(F.col("__nodes").isNotNull(), F.try_element_at(F.col("__nodes"), leaf)))
    p = F.col("__leaf.positives") / F.col("__leaf.n")
    return scored.withColumn(out, p).withColumn(f"{out}_class", (F.col(out) >= threshold).cast("double")).drop("__k", "__nodes", "__x", "__leaf")
