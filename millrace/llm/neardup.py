"""Order MinHash near-duplicates (operator 1).

The k-mers of a document are its runs of ``KMER`` words, labelled by occurrence.
For each of ``SKETCHES`` hash functions the two k-mers of smallest hash, in the
order they have in the text, make a sketch: two documents share it with a
probability that follows their edit similarity.  Documents that share a sketch
are candidates; a candidate pair is linked when a banded alignment of the
words finds an edit similarity 1 - edits / longer length of at least 0.8.

Equal texts are one class from the start (an aggregation), and only one member
of a class is compared.  Most links are found with one or two alignments a
document: with the smallest, then with the largest member of the bucket (a
shared sketch) with which it shares most sketches.  What is left are the buckets
that still span several components.  There every pair of members of different
components is looked at, without exception, but only once (in the bucket of
the first sketch that both share) and not as rows: members are dealt to blocks,
blocks meet in tasks, and a task compares lengths and word histograms as arrays.
Both only rule out pairs that need too many edits; what remains is aligned there,
unless links found in the task already connect it, and only links leave.  The
largest component of a bucket isn't compared with itself, so one big group of
copies costs as many rows as it has members.

Components come from the distributed star contraction in ``common``.

Defined cases: null, empty and blank texts have no words and are alone in their
class, kept; a text of fewer than ``KMER`` words is one k-mer; the document kept
of a class is the one with the smallest doc_id (nulls last; among equal rows the
first); repeated rows are copies, and different texts under one id, or under
none, are different documents; extra columns are ignored by ``near_duplicates``
and kept by ``deduplicate``, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import connected_components, discard, fresh_name, mixed, stored, window_hashes, word_hashes

KMER = 3  # words; with five, a fifth of the pairs at the threshold shared no sketch
SKETCHES = 32
TAKEN = 2  # k-mers a sketch takes
SIMILARITY = 0.8
BLOCK = 512  # members of a bucket in a block
BINS = 256  # of a word histogram


def kmer_hashes(h: np.ndarray, k: int = KMER) -> np.ndarray:
    """Hash of each run of k words; a shorter text is one run."""
    return window_hashes(h, min(k, len(h)))


def sketches(kmers: np.ndarray, count: int = SKETCHES, taken: int = TAKEN) -> np.ndarray:
    """Order MinHash: for each function the ``taken`` smallest occurrence-labelled k-mers, in text order."""
    n = len(kmers)
    order = np.argsort(kmers, kind="stable")
    s = kmers[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    run = np.flatnonzero(new)
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = np.arange(n) - np.repeat(run, np.diff(np.append(run, n)))
    labelled = mixed(kmers + occurrence * np.uint64(0x9E3779B97F4A7C15))
    factors = mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    t = min(taken, n)
    at = np.empty((count, t), np.int64)
    step = max(1, 200_000 // n)
    for j in range(0, count, step):
        v = labelled[None, :] * factors[j:j + step, None]
        rows = np.arange(len(v))
        for i in range(t):
            low = v.argmin(1)
            at[j:j + step, i] = low
            v[rows, low] = np.uint64(0xFFFFFFFFFFFFFFFF)
    at.sort(axis=1)
    out = factors.copy()
    for i in range(t):
        out = mixed(out * np.uint64(0xBF58476D1CE4E5B9) + kmers[at[:, i]])
    return out


def edits_within(a: list, b: list, most: int) -> int | None:
    """Edit distance of two sequences if at most ``most``, else None: banded alignment.

    Only cells at most ``most`` off the diagonal are computed; a column of the
    band is a pair of bit vectors (the steps up and down between its cells), so
    one column takes a few operations on whole integers.
    """
    m, n = len(a), len(b)
    if abs(m - n) > most:
        return None
    head = 0
    while head < min(m, n) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(m, n) - head and a[m - 1 - tail] == b[n - 1 - tail]:
        tail += 1
    a, b = a[head:m - tail], b[head:n - tail]
    m, n = len(a), len(b)
    if not m or not n:
        return m + n if m + n <= most else None
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    low, top = 0, min(m, most)  # the band holds rows low + 1 .. top
    plus, minus, score = (1 << top) - 1, 0, top
    for j in range(n):
        if top < m:
            plus |= 1 << (top - low)
            top += 1
            score += 1
        if j > most:
            plus >>= 1
            minus >>= 1
            low += 1
        width = top - low
        full = (1 << width) - 1
        same = (where.get(b[j], 0) >> low) & full
        zero = (((same & plus) + plus) ^ plus) | same | minus
        up = (minus | ~(zero | plus)) & full
        down = zero & plus & full
        last = 1 << (width - 1)
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = (up << 1) | 1
        down <<= 1
        plus = (down | ~(zero | up)) & full
        minus = up & zero & full
    return score if score <= most else None


def _scan(batches):
    """Length, class key, sketches and word histogram of each document."""
    import pyarrow as pa

    for batch in batches:
        sizes, keys, histograms, flat, offsets = [], [], [], [], [0]
        for text in batch.column(1):
            words = (text.as_py() or b"").split()
            sizes.append(len(words))
            keys.append(hashlib.sha256(b" ".join(words)).digest()[:16] if words else None)
            if words:
                h = word_hashes(words)
                flat.append(sketches(kmer_hashes(h)))
                # counts above 255 as 255: differences can only get smaller
                histograms.append(np.minimum(np.bincount((h % np.uint64(BINS)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes())
            else:
                histograms.append(None)
            offsets.append(offsets[-1] + (SKETCHES if words else 0))
        values = np.concatenate(flat).view(np.int64) if flat else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)), pa.array(histograms, pa.binary())],
            names=["doc_id", "n_words", "key", "sketches", "histogram"])


def _bodies(batches):
    """Words of the documents, joined by one space, and their key."""
    import pyarrow as pa

    for batch in batches:
        keys, bodies = [], []
        for text in batch.column(1):
            body = b" ".join((text.as_py() or b"").split())
            keys.append(hashlib.sha256(body).digest()[:16])
            bodies.append(body)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(bodies, pa.binary())], names=["doc_id", "key", "body"])


def most_edits(m: int, n: int, similarity: float) -> int:
    """The largest number of edits at which texts of m and n words are similar enough."""
    longer = max(m, n)
    d = int((1 - similarity) * longer) + 1
    while 1 - d / longer < similarity - 1e-12:
        d -= 1
    return d


def _aligned(similarity: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep, hub, hub_words = [], None, []
            for i in range(batch.num_rows):
                words, y = batch.column(2)[i].as_py().split(), batch.column(3)[i].as_py()
                if y != hub:
                    hub, hub_words = y, y.split()
                if edits_within(words, hub_words, most_edits(len(words), len(hub_words), similarity)) is not None:
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return run


def _links(pairs: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose alignment is similar enough."""
    one = pairs.join(bodies.select(F.col("rid").alias("a"), F.col("body").alias("body_a")), "a")
    two = one.join(bodies.select(F.col("rid").alias("b"), F.col("body").alias("body_b")), "b")
    return two.select("a", "b", "body_a", "body_b").mapInArrow(_aligned(similarity), "a long, b long")


def _fit(m, n, similarity: float):
    """Whether lengths allow the similarity (columns or arrays)."""
    low, high = (np.minimum, np.maximum) if isinstance(m, np.ndarray) else (F.least, F.greatest)
    return low(m, n) >= high(m, n) * similarity - 1e-9


def _block_links(similarity: float):
    """Links between members of different components in groups of two blocks (or one)."""

    def compare(g, out):
        i, x, y = (int(g.column(c)[0].as_py()) for c in ("i", "x", "y"))
        block, rid, comp, n = (g.column(c).to_numpy() for c in ("block", "rid", "comp", "n_words"))
        left = np.flatnonzero(block == x)
        right = left if x == y else np.flatnonzero(block == y)
        if not len(left) or not len(right):
            return
        s = g.column("sketches").combine_chunks().flatten().to_numpy().reshape(len(rid), -1)
        h = np.frombuffer(b"".join(g.column("histogram").to_pylist()), np.uint8).reshape(len(rid), BINS).astype(np.int16)
        near = _fit(n[left][:, None], n[right][None, :], similarity) & (comp[left][:, None] != comp[right][None, :])
        if x == y:
            near &= rid[left][:, None] < rid[right][None, :]
        for j in range(i):  # met in an earlier sketch's bucket
            near &= s[left, j][:, None] != s[right, j][None, :]
        a, b = np.nonzero(near)
        a, b = left[a], right[b]
        into: dict = {}  # components joined by the links found here

        def root(c):
            while c in into:
                c = into[c]
            return c

        words: dict = {}

        def words_of(k):
            if k not in words:
                words[k] = g.column("body")[k].as_py().split()
            return words[k]

        for k in range(0, len(a), 50_000):
            p, q = a[k:k + 50_000], b[k:k + 50_000]
            d = h[p] - h[q]
            least = np.maximum(np.maximum(d, 0).sum(1), np.maximum(-d, 0).sum(1))
            ok = least <= (1 - similarity) * np.maximum(n[p], n[q]) + 1e-9
            for v, w in zip(p[ok].tolist(), q[ok].tolist()):
                cv, cw = root(int(comp[v])), root(int(comp[w]))
                if cv != cw and edits_within(words_of(v), words_of(w), most_edits(int(n[v]), int(n[w]), similarity)) is not None:
                    into[max(cv, cw)] = min(cv, cw)
                    out.append((max(int(rid[v]), int(rid[w])), min(int(rid[v]), int(rid[w]))))

    def run(batches):
        import pyarrow as pa

        def pairs(table):
            keys = np.stack([table.column(c).to_numpy() for c in ("i", "s", "x", "y")])
            ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            return np.r_[0, ends, table.num_rows]

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            table = new if held is None else pa.concat_tables([held, new])
            at = pairs(table)
            out = []
            for start, end in zip(at[:-2], at[1:-1]):
                if end - start > 1:
                    compare(table.slice(start, end - start), out)
            held = table.slice(at[-2])
            yield _pair_batch(out)
        if held is not None:
            out = []
            if held.num_rows > 1:
                compare(held, out)
            yield _pair_batch(out)

    return run


def _pair_batch(out):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([v for v, _ in out], pa.int64()), pa.array([w for _, w in out], pa.int64())], names=["a", "b"])


def _open_links(member: DataFrame, label: DataFrame, tested: DataFrame, heads: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that connect all members of different components which share a sketch and are similar enough.

    A bucket of two members that were compared before (``tested``) is done."""
    spread = member.join(label, "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
    sizes = spread.groupBy("i", "s", "comp").agg(F.count("*").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    buckets = sizes.groupBy("i", "s").agg(F.sum("n").alias("all"), F.max(F.struct("n", "comp")).alias("big"), F.count("*").alias("comps"),
                                          F.min("low").alias("low"), F.max("high").alias("high")).where("comps > 1")
    done = tested.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct().withColumn("done", F.lit(True))
    buckets = buckets.join(done, ["low", "high"], "left").where("all > 2 or done is null")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    buckets = buckets.select("i", "s", F.col("big.comp").alias("big"), blocks(F.col("big.n")).alias("own"), blocks(F.col("all") - F.col("big.n")).alias("rest"))
    deal = lambda n: F.pmod(F.xxhash64("rid"), n).cast("int")
    rows = spread.drop("low", "high").join(buckets, ["i", "s"]).withColumn("in_big", F.col("comp") == F.col("big"))
    # blocks 0 .. rest - 1 hold the other components, the next ones the largest, which meets the others only
    rows = rows.withColumn("block", F.when(F.col("in_big"), F.col("rest") + deal(F.col("own"))).otherwise(deal(F.col("rest"))))
    rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.when(F.col("in_big"), F.col("rest")).otherwise(F.col("rest") + F.col("own")) - 1)))
    rows = rows.select("i", "s", F.least("block", "met").alias("x"), F.greatest("block", "met").alias("y"), "block", "rid", "comp").join(heads, "rid").join(bodies, "rid")
    dealt = rows.repartition("i", "s", "x", "y").sortWithinPartitions("i", "s", "x", "y")
    return dealt.mapInArrow(_block_links(similarity), "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its near-duplicates), kept: one row a document."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    scanned = stored(texts.mapInArrow(_scan, "doc_id long, n_words long, key binary, sketches array<long>, histogram binary")
                     .withColumn("rid", F.monotonically_increasing_id()), "sketches")
    classes = scanned.where("key is not null").groupBy("key").agg(F.min("rid").alias("head"))
    rows = stored(scanned.select("rid", "doc_id", "key").join(classes, "key", "left").withColumn("head", F.coalesce("head", "rid")), "classes")
    firsts = rows.where("rid = head and key is not null").select("rid")
    heads = stored(scanned.join(firsts, "rid").select("rid", "n_words", "sketches", "histogram"), "heads")
    discard(scanned)
    sketched = heads.select("rid", F.posexplode("sketches").alias("i", "s")).repartition("i", "s")
    shared = sketched.groupBy("i", "s").agg(F.count("*").alias("n"), F.min("rid").alias("low"), F.max("rid").alias("high")).where("n > 1").drop("n")
    member = stored(sketched.join(shared, ["i", "s"]), "buckets")
    wanted = rows.join(member.select("rid").distinct(), "rid").select("rid", "doc_id", "key")
    # by id and text: an id, or none, may stand for many texts
    read = texts.join(wanted.select("doc_id").distinct().withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    read = read.mapInArrow(_bodies, "_id long, _key binary, body binary")
    bodies = stored(wanted.join(read, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))).select("rid", "body").dropDuplicates(["rid"]), "bodies")
    size = heads.select("rid", "n_words")

    def with_hub(hub: str) -> DataFrame:
        """Each document and the hub with which it shares most sketches."""
        met = member.where(F.col("rid") != F.col(hub)).groupBy("rid", hub).agg(F.count("*").alias("n"))
        best = met.groupBy("rid").agg(F.max_by(hub, F.struct("n", -F.col(hub))).alias("hub")).select(F.col("rid").alias("a"), F.col("hub").alias("b"))
        return stored(best, "hubs")

    def hub_links(best: DataFrame, label: DataFrame | None) -> DataFrame:
        """The links among those pairs; pairs of one component need no comparison."""
        if label is not None:
            of = lambda c: label.select(F.col("rid").alias(c), F.col("comp").alias(f"c{c}"))
            best = best.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
        sized = best.join(size.select(F.col("rid").alias("a"), F.col("n_words").alias("m")), "a") \
            .join(size.select(F.col("rid").alias("b"), F.col("n_words").alias("n")), "b").where(_fit(F.col("m"), F.col("n"), similarity))
        return stored(_links(sized.select("a", "b"), bodies, similarity), "links")

    def labelled(links: DataFrame) -> DataFrame:
        return connected_components(links, tag="classes").select(F.col("node").alias("rid"), F.col("component").alias("comp"))

    low, high = with_hub("low"), with_hub("high")
    links = hub_links(low, None)
    more = hub_links(high, labelled(links))
    if not more.isEmpty():
        links = links.union(more)
    label = labelled(links)
    last = stored(_open_links(member, label, low.union(high), heads, bodies, similarity), "links")
    for table in (member, low, high, heads, bodies):
        discard(table)
    if not last.isEmpty():
        label = labelled(links.union(last))

    of_class = rows.join(label.withColumnRenamed("rid", "head"), "head", "left") \
        .select("rid", "doc_id", F.coalesce("comp", "head").alias("comp"))
    first = of_class.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"))
    return of_class.join(first, "comp").select("doc_id", F.col("first.doc_id").alias("class_id"), (F.col("rid") == F.col("first.rid")).alias("kept"))


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row (the first) of each class of near-duplicates, all its columns as they are."""
    rid = fresh_name(docs, "_rid")
    tagged = stored(docs.withColumn(rid, F.monotonically_increasing_id()), "tagged")
    kept = near_duplicates(tagged.select(F.col(rid).alias("doc_id"), "text"), similarity).where("kept").select(F.col("doc_id").alias(rid))
    return tagged.join(kept, rid, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
