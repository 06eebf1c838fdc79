"""Substring dedup (operator 3): level-wise doubling.

A word is removed when a window of ``window`` consecutive words of its document
covers it whose word sequence also starts anywhere else, the same document
included; windows are judged on the input.

Level 1 looks at half windows, and only at those every full window is bound to
contain in the same place of its text: the half windows with the smallest hash
among a window's.  Equal windows choose equal half windows, so a window whose
chosen half does not repeat cannot repeat.  Level 2 hashes the full windows
around repeated halves and counts them.  From there each level joins the
hashes of two neighbouring repeated windows to one of twice the length, until
no candidate survives; ``longest_repeat`` tells how far a document got.
Counting is an aggregation with map-side combine, and repeated hashes are
joined back, so a passage found everywhere is no single task's work.

Exact copies are settled before: of a class of equal word sequences one member
stands for all in the search, and when a class has two members every window of
it repeats.

Words are runs of anything but space, tab, newline, vertical tab, form feed
and carriage return.  Defined cases: null and empty texts have no words;
documents shorter than the window lose nothing; equal rows are copies of each
other; ``doc_id`` may be null or repeated; extra columns are ignored; a very
long document is one row with arrays as long as itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, mixed, stored, window_hashes, word_hashes

WINDOW = 35
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _sliding(f, x: np.ndarray, width: int) -> np.ndarray:
    """f (minimum or maximum) over every run of ``width`` values, by doubling."""
    size = 1
    while size * 2 <= width:
        x = f(x[:-size], x[size:])
        size *= 2
    return f(x[:len(x) - (width - size)], x[width - size:]) if size < width else x


def _halves(h: np.ndarray, window: int):
    """Hashes of the half windows, the smallest within each window, and where chosen ones stand."""
    half = (window + 1) // 2
    span = window - half + 1
    halves = window_hashes(h, half)
    low = _sliding(np.minimum, halves, span)
    edge = np.zeros(span - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, low, edge]), span) == halves)
    return halves, low, chosen, span


def _lists(parts: list[np.ndarray], kind):
    import pyarrow as pa

    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _scan(window: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sizes, shas, keys, chosen = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = (text or b"").split()
                sha = hashlib.sha256(b" ".join(words))
                sizes.append(len(words))
                shas.append(sha.hexdigest())
                keys.append(sha.digest()[:16])
                if len(words) >= window:
                    halves, _, at, _ = _halves(word_hashes(words), window)
                    chosen.append(halves[at].view(np.int64))
                else:
                    chosen.append(np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(shas), pa.array(keys, pa.binary()), _lists(chosen, pa.int64())],
                names=["doc_id", "n_words", "sha", "key", "halves"])

    return run


def _windows(window: int):
    """Candidate windows around the repeated halves: position, hash, and a second hash to check it."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rids, places, hashes, checks, bodies = [], [], [], [], []
            for rid, sha, alone, flagged, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                words = (text or b"").split()
                body = b" ".join(words)
                if hashlib.sha256(body).hexdigest() != sha:
                    continue  # another text under the same doc_id
                h = word_hashes(words)
                halves, low, at, span = _halves(h, window)
                at = at[np.asarray(flagged, np.int64)]
                hit = np.zeros(len(low), bool)
                for back in range(span):
                    p = at - back
                    q = (p >= 0) & (p < len(low))
                    p = p[q]
                    hit[p[low[p] == halves[at[q]]]] = True
                p = np.flatnonzero(hit)
                rids.append(rid)
                places.append(p)
                hashes.append(window_hashes(h, window)[p].view(np.int64))
                checks.append((window_hashes(h, window, 0xC2B2AE3D27D4EB4F)[p] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                bodies.append(body if alone else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.int64()), _lists(places, pa.int32()), _lists(hashes, pa.int64()), _lists(checks, pa.int32()), pa.array(bodies, pa.binary())],
                names=["rid", "pos", "h", "c", "body"])

    return run


def _doubled(step: int):
    """Windows of twice the length from two repeated ones that stand ``step`` apart."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rids, places, hashes, checks = [], [], [], []
            for rid, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = rows.values
                p, h, c = (rows.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                order = np.argsort(p)
                p, h, c = p[order], h[order].view(np.uint64), c[order].view(np.uint32).astype(np.uint64)
                k = np.searchsorted(p, p + step)
                two = (k < len(p)) & (p[np.minimum(k, len(p) - 1)] == p + step)
                k, a = k[two], np.flatnonzero(two)
                if len(a):
                    rids.append(rid)
                    places.append(p[a])
                    hashes.append(mixed(h[a] * np.uint64(0x9E3779B97F4A7C15) + h[k]).view(np.int64))
                    checks.append((mixed(c[a] * np.uint64(0xC2B2AE3D27D4EB4F) + c[k]) >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rids, pa.int64()), _lists(places, pa.int32()), _lists(hashes, pa.int64()), _lists(checks, pa.int32())],
                names=["rid", "pos", "h", "c"])

    return run


def _strip(window: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rids, removed, shas = [], [], []
            for rid, body, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = body.split()
                p = places.values.to_numpy(zero_copy_only=False)
                d = np.zeros(len(words) + 1, np.int64)
                np.add.at(d, p, 1)
                np.add.at(d, p + window, -1)
                gone = np.cumsum(d[:-1]) > 0
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
                rids.append(rid)
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                                             names=["rid", "removed", "left_sha"])

    return run


def _repeated(found: DataFrame) -> DataFrame:
    """Rows of ``found`` (arrays a document) whose (h, c) occurs more than once: rid, rows."""
    flat = found.select("rid", F.explode(F.arrays_zip("pos", "h", "c")).alias("x")) \
        .select("rid", F.col("x.pos").alias("pos"), F.col("x.h").alias("h"), F.col("x.c").alias("c"))
    often = flat.groupBy("h", "c").agg(F.count("*").alias("n")).where("n > 1").select("h", "c")
    return flat.join(often, ["h", "c"]).groupBy("rid").agg(F.collect_list(F.struct("pos", "h", "c")).alias("rows"))


def substring_dedup(docs: DataFrame, window: int = WINDOW, doubling: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, longest_repeat: one row a document.

    ``longest_repeat`` is the longest level (window, twice that, ...) at which
    a window of the document repeats, 0 if none; with ``doubling`` off the search
    ends at ``window``.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    scanned = stored(texts.mapInArrow(_scan(window), "doc_id long, n_words long, sha string, key binary, halves array<long>")
                     .withColumn("rid", F.monotonically_increasing_id()), "halves")
    classes = scanned.groupBy("key").agg(F.count("*").alias("copies"), F.min("rid").alias("first"))
    rows = stored(scanned.select("rid", "doc_id", "n_words", "sha", "key").join(classes, "key")
                  .select("rid", "doc_id", "n_words", "sha", "copies", (F.col("rid") == F.col("first")).alias("first")), "classes")

    speak = rows.where(F.col("first") & (F.col("n_words") >= window)).select("rid")
    halves = scanned.select("rid", "halves").join(speak, "rid").select("rid", F.posexplode("halves").alias("i", "h"))
    often = halves.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    flagged = stored(halves.join(often, "h").groupBy("rid").agg(F.collect_list("i").alias("flagged"))
                     .join(rows.select("rid", "doc_id", "sha", (F.col("copies") == 1).alias("alone")), "rid"), "flagged")

    discard(scanned)
    near = texts.join(flagged.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
    found = stored(near.select("rid", "sha", "alone", "flagged", "text")
                   .mapInArrow(_windows(window), "rid long, pos array<int>, h array<long>, c array<int>, body binary"), "windows")
    level = stored(_repeated(found), f"level-{window}")
    stripped = stored(found.where("body is not null").select("rid", "body").join(level.select("rid", F.col("rows.pos").alias("pos")), "rid")
                      .select("rid", "body", "pos").mapInArrow(_strip(window), "rid long, removed long, left_sha string"), "stripped")
    discard(found)

    length = window
    reach = stored(level.select("rid", F.lit(length).cast("long").alias("reach")), "reach")
    while doubling:
        longer = stored(_repeated(level.mapInArrow(_doubled(length), "rid long, pos array<int>, h array<long>, c array<int>")),
                        f"level-{2 * length}")
        discard(level)
        level, length = longer, 2 * length
        if level.isEmpty():
            break
        reach = reach.union(stored(level.select("rid", F.lit(length).cast("long").alias("reach")), "reach"))
    discard(level)
    reach = reach.groupBy("rid").agg(F.max("reach").alias("reach"))

    whole = (F.col("copies") > 1) & (F.col("n_words") >= window)
    return rows.join(stripped, "rid", "left").join(reach, "rid", "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"),
        F.greatest(F.coalesce("reach", F.lit(0)), F.when(whole, window * F.pow(2, F.floor(F.log2(F.col("n_words") / window))))
                   .otherwise(0)).cast("long").alias("longest_repeat"))
