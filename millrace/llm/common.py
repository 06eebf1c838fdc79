"""Helpers shared by the operators: input tables, written steps, word classes, components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back.

    The written table cuts the lineage (a lost executor re-reads it instead of
    recomputing) and holds the step's rows still for every later reader.
    Afterwards the driver's garbage is collected, so that Spark's cleaner can
    drop the shuffle files of the steps that are over.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    release(spark)
    return out


def discard(df: DataFrame) -> None:
    """Delete the table behind ``stored``'s result, once nothing that is still to run reads it."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def release(spark: SparkSession) -> None:
    """Let Spark's context cleaner remove shuffle files nobody refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def with_columns_of(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns (extra columns of the input may clash with an operator's own)."""
    return docs.select(*[F.col(f"`{n}`") for n in names])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", tag: str = "cc") -> DataFrame:
    """(node, component) of the undirected graph of ``edges``; component = smallest node.

    Alternates the large-star and small-star steps: a round is two
    aggregations with map-side combine and two joins, so a hub's neighbours are
    never gathered in one place.  Ends when the edges form stars: every node
    has one edge at most to a smaller node, which has none itself.  The number
    of rounds grows with the logarithm of the longest path.  Self loops and
    repeated edges are allowed; only nodes that have an edge to another node
    are returned.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v")
    e = stored(e.distinct(), tag)
    while not _are_stars(e):
        last = e
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        e = stored(small.select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
                   .union(small.select("u", F.col("m").alias("v"))).where("u > v").distinct(), tag)
        discard(last)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)


def _are_stars(e: DataFrame) -> bool:
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .union(e.select(F.col("v"), F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty()


class WordHashes(dict):
    """64-bit hash of a word, remembered for words seen before (bounded; refilled when full)."""

    LIMIT = 400_000

    def __missing__(self, word):
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = WordHashes()


def word_hashes(words: list[bytes]):
    """uint64 array of the words' hashes."""
    import numpy as np

    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def window_hashes(h, width: int, base: int = 0x9E3779B97F4A7C15):
    """64-bit hash of every run of ``width`` consecutive word hashes.

    A polynomial in an odd ``base`` modulo 2^64, taken from prefix sums and
    mixed at the end; equal runs give equal hashes wherever they stand.
    """
    import numpy as np

    n = len(h)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = _powers(n + 1, base)
    q = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], dtype=np.uint64, out=q[1:])
    return mixed((q[width:] - q[:-width]) * down[:n - width + 1])


_POWERS: dict = {}


def _powers(n: int, base: int):
    import numpy as np

    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        def run(x):
            p = np.full(size, np.uint64(x))
            p[0] = 1
            return np.cumprod(p, dtype=np.uint64)
        have = _POWERS[base] = run(base), run(pow(base, -1, 1 << 64))
    return have


def mixed(x):
    """A bijective finishing mix of uint64 values."""
    import numpy as np

    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))
