"""Benchmark decontamination (operator 9): size-partitioned MinHash containment search.

Test items are sets of word shingles (five words, or all words of a shorter
item), grouped by size class (powers of two).  The sketch of an item is its
``k`` shingles of smallest hash, where ``k`` follows from the upper end of the
size class: a document that holds at least the share ``containment`` of an item
lacks at most (1 - containment) x size of its shingles, so one shingle more than
that in the sketch is bound to be found.  The sketch search therefore loses no
document, however long.  Candidates are verified by exact containment: the
share of the item's distinct shingles that the document holds.

Everything is DataFrame functions.  Documents are turned into shingle hashes
once for the search; the sketches are joined by hash (the planner broadcasts them
while their measured size allows), and only documents that met a sketch are
looked at again.  A passage that a third of all documents hold is counted by
(document, item), which spreads it.  A document is an id with a text: what
several texts under one id, or under none, hold is never added up.

Words are runs of letters and digits in lower case.  Defined cases: null and
empty documents and items match nothing; items of fewer than five words match as one
run of their words; items with equal shingles are each reported; repeated rows, and
several texts under one id, are reported once for each (doc_id, item_id), with the
highest containment of one text; null ids are kept as an id of their own; extra
columns are ignored, and kept by ``decontaminate`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh_name, stored

SHINGLE = 5
CONTAINMENT = 0.8


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def shingles(w: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words of an array (runs of different widths differ)."""
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - width),
                       lambda i: F.xxhash64(F.lit(width), *[F.get(w, i + k) for k in range(width)]))
    return F.when(F.size(w) >= width, runs).otherwise(F.array().cast("array<bigint>"))


def item_shingles(items: DataFrame, containment: float) -> DataFrame:
    """item_id, width, size, hash, in_sketch: one row a distinct shingle of an item."""
    w = items.select("item_id", F.monotonically_increasing_id().alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("width", F.least(F.size("w"), F.lit(SHINGLE)))
    hashes = F.coalesce(*[F.when(F.col("width") == k, shingles(F.col("w"), k)) for k in range(1, SHINGLE + 1)])
    sets = w.select("item", "item_id", "width", F.array_sort(F.array_distinct(hashes)).alias("set")).withColumn("size", F.size("set"))
    # upper end of the size class: sizes up to 8 alone, then steps of a quarter of a power of two
    step = F.greatest(F.lit(1.0), F.pow(2.0, F.floor(F.log2("size")) - 2))
    upper = (F.ceil(F.col("size") / step) * step).cast("int")
    missing = upper - F.ceil(upper * containment - 1e-9)
    return sets.select("item", "item_id", "width", "size", upper.alias("size_class"), F.least("size", missing + 1).cast("int").alias("k"), F.posexplode("set").alias("at", "hash")) \
        .withColumn("in_sketch", F.col("at") < F.col("k")).drop("at", "k")


def contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment: the pairs at or above ``containment``."""
    index = stored(item_shingles(items, containment), "items")
    sketch = index.where("in_sketch").select("hash").distinct()
    widths = sorted(r["width"] for r in index.select("width").distinct().collect())
    if not widths:
        return docs.where("false").select("doc_id", F.lit(None).cast(dict(items.dtypes)["item_id"]).alias("item_id"),
                                          F.lit(0).cast("long").alias("n_shared"), F.lit(0).cast("long").alias("n_item"), F.lit(0.0).alias("containment"))

    texts = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("digest"))

    def exploded(rows: DataFrame) -> DataFrame:
        w = rows.select(*[c for c in rows.columns if c != "text"], words(F.col("text")).alias("w"))
        return w.select(*[c for c in rows.columns if c != "text"], F.explode(F.concat(*[shingles(F.col("w"), k) for k in widths])).alias("hash"))

    met = stored(exploded(texts).join(sketch, "hash", "left_semi").select("doc_id", "digest").distinct(), "met")
    mine = met.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    again = texts.join(mine, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left_semi")
    pairs = exploded(again).join(index.drop("size_class", "width"), "hash").select("doc_id", "digest", "item", "item_id", "size", "hash", "in_sketch")
    held = pairs.distinct().groupBy("doc_id", "digest", "item", "item_id", "size").agg(
        F.count("*").alias("n_shared"), F.max("in_sketch").alias("found"))
    return held.where(F.col("found") & (F.col("n_shared") >= F.col("size") * F.lit(containment) - F.lit(1e-9))) \
        .groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("size"), "n_shared", "size")).alias("m")) \
        .select("doc_id", "item_id", F.col("m.n_shared").cast("long").alias("n_shared"), F.col("m.size").cast("long").alias("n_item"),
                (F.col("m.n_shared") / F.col("m.size")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``docs`` without the documents that hold an item; the text decides, so ids may be null or repeated."""
    digest = F.md5("text")
    hit = stored(contaminated(docs.select(digest.alias("doc_id"), "text"), items, containment).select(F.col("doc_id").alias("digest")).distinct(), "contaminated")
    name = fresh_name(docs, "_digest")
    return docs.withColumn(name, digest).join(hit.withColumnRenamed("digest", name), name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
