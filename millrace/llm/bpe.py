"""Byte-level BPE encoding and decoding (operator 11) with Spark's higher-order functions.

A text is split by the vocabulary's pattern; each match (word) becomes the array
of its bytes, and a fold merges the neighbours whose joined bytes have the
lowest rank until no joined pair is in the vocabulary.  Ranks come from a
literal map of all pairs (left piece, right piece) whose joined bytes are a
piece.  It is laid out as arrays: a map column would be searched key by key,
here two hashes and a displacement give the one place where a key can be
(``Places``).  Decoding looks each id up in a literal array and joins the
pieces as hexadecimal text, turned into bytes once, so it stays linear.

The fold runs once for each distinct word as far as a bounded table goes:
``frequent_words`` counts the words of the whole corpus, and the ``CACHE`` most
frequent ones that are no single piece are folded first; a literal holds their
ids next to the vocabulary, as one text a bucket, in which a word is found by its
marks (a text a word, and places for them, took the driver beyond its memory).
Any other word is folded where it stands.  Which words are in the table changes
the time, never an id.  Documents aren't shuffled: only word counts are.

Java's regular expressions and the tokenizer library's know different Unicode
versions.  ``java_pattern`` asks the library itself which characters it takes as
letters, digits and white space, and adds or removes the difference.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated
rows and rows with equal ids are encoded each for itself; extra columns pass
through, and an input column named as the result's is replaced; an empty table
gives an empty one.  Special tokens are never made: their names are text.
"""

from __future__ import annotations

import base64
import re
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import discard, release, stored

CACHE = 180_000  # frequent words held beside the vocabulary
CACHE_BYTES = 64  # longest word held
LONG = 512  # bytes; longer words merge all pairs of a rank at once
PLAN_TEXT = 100_000  # characters kept of a plan's description
BUCKETS = 1 << 17  # of held words
MARK = "\x1e"  # separates values of a literal, and words from their ids; a word that holds it or ENTRY is not held
ENTRY = "\x1f"  # begins a held word


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def java_pattern(spark: SparkSession, pattern: str) -> str:
    """``pattern`` with its letter, digit and white space classes as the tokenizer library takes them."""
    import tiktoken

    classes = [name for name in (r"\p{L}", r"\p{N}", r"\s") if name in pattern]
    byte_ranks = {bytes([i]): i for i in range(256)}
    # a character a row: a text of them all would stand in plans, and those in the driver's memory
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    chars = spark.range(1, 0x110000).where("id not between 55296 and 57343").select(F.col("id").cast("int").alias("code"), *[char.rlike(name).alias(name) for name in classes])
    taken = chars.where(F.array_contains(F.array(*[F.col(f"`{name}`") for name in classes]), True)).toArrow() if classes else None

    def spans(codes: np.ndarray) -> str:
        starts = np.flatnonzero(np.diff(codes, prepend=-2) != 1)
        return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in zip(codes[starts], codes[np.r_[starts[1:] - 1, len(codes) - 1]]))

    for name in classes:
        encoding = tiktoken.Encoding("class", pat_str=name + "+", mergeable_ranks=byte_ranks, special_tokens={})
        # by plane: the ids of a text are a list
        texts = ("".join(chr(c) for c in range(max(1, at), at + 0x10000) if not 0xD800 <= c < 0xE000) for at in range(0, 0x110000, 0x10000))
        wanted = np.array([ord(c) for text in texts for c in bytes(encoding.encode_ordinary(text)).decode()], np.int64)
        known = np.sort(taken["code"].to_numpy()[taken[name].to_numpy()]).astype(np.int64)
        more, less = np.setdiff1d(wanted, known), np.setdiff1d(known, wanted)
        java = name
        if len(more):  # a quick range test comes before the list
            java = rf"[{name}[\x{{{more.min():x}}}-\x{{10ffff}}&&[{spans(more)}]]]"
        if len(less):
            java = f"[{java}&&[^{spans(less)}]]"
        pattern = pattern.replace(name, java)
        if name == r"\s":
            pattern = pattern.replace(r"\S", "[^" + java + "]")
    # the library's $ is the very end of the text
    return re.sub(r"(?<!\\)\$", r"\\z", pattern)


def words(text: Column, java: str) -> Column:
    """The pattern's matches, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java), F.lit(0))


class Places:
    """One place a key in an array of ``size`` slots, found by displacement.

    ``hash`` chooses a displacement, which is exclusive-ored with the low bits
    of a seeded ``xxhash64``; seed and displacements are chosen so that no two
    keys meet.  The hashes are Spark's own, so they are computed in a frame.
    ``keys`` is a table of one or more columns.
    """

    SEEDS = 8  # tried at each size

    def __init__(self, spark: SparkSession, keys: pa.Table):
        names, n = keys.column_names, len(keys)
        frame = spark.createDataFrame(keys)
        self.groups = 1 << max(2, (n // 2).bit_length())
        self.size = 1 << max(4, (n + n // 8).bit_length())
        seed = 0
        while True:
            rows = frame.select(*names, F.hash(*names).alias("h"), F.xxhash64(F.lit(seed), *names).alias("x")).toArrow()
            if self._place(rows["h"].to_numpy().astype(np.int64) & (self.groups - 1), rows["x"].to_numpy(), seed):
                self.keys = rows.select(names)
                return
            seed += 1
            if seed % self.SEEDS == 0:
                self.size *= 2

    def _place(self, group: np.ndarray, x: np.ndarray, seed: int) -> bool:
        low = x & (self.size - 1)
        if len(np.unique(group << 32 | low)) < len(low):  # two keys of a group that no displacement parts
            return False
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0]) if len(low) else np.empty(0, int)
        members = sorted(np.split(order, starts[1:]), key=len, reverse=True) if len(low) else []
        taken, shift, self.slots = bytearray(self.size), np.zeros(self.groups, np.int32), np.zeros(len(low), np.int64)
        for rows in members:
            lows = low[rows].tolist()
            for d in range(self.size):
                if not any(taken[v ^ d] for v in lows):
                    break
            else:
                return False
            shift[group[rows[0]]] = d
            for i, v in zip(rows.tolist(), lows):
                taken[v ^ d] = 1
                self.slots[i] = v ^ d
        self.shift, self.seed = shift, seed
        return True

    def slot(self, shift: Column, *key: Column) -> Column:
        """The place of ``key`` (from 0); ``shift`` is the array of displacements."""
        d = F.get(shift, F.hash(*key).bitwiseAND(F.lit(self.groups - 1)))
        return F.xxhash64(F.lit(self.seed), *key).bitwiseAND(F.lit(self.size - 1)).cast("int").bitwiseXOR(d)


def array_literal(values, kind: str) -> Column:
    """A constant array; written as one text, which the optimizer splits and casts once."""
    return F.split(F.lit(MARK.join(map(str, values))), MARK).cast(f"array<{kind}>")


class Vocabulary:
    """The literals of a rank file: pairs of pieces with their ranks, and the pieces."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int], pattern: str):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.ranks, self.java = ranks, java_pattern(spark, pattern)
        # the literals are megabytes: plans that hold them are described in short
        spark.conf.set("spark.sql.maxPlanStringLength", PLAN_TEXT)
        self.bits = max(ranks.values()).bit_length()
        if 3 * self.bits > 62:
            raise ValueError("ranks beyond 20 bits")
        left, right, joined = [], [], []
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    joined.append(rank)
        pairs = pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64()), "rank": pa.array(joined, pa.int64())})
        self.pairs = Places(spark, pairs.select(["a", "b"]))
        if not self.pairs.keys.equals(pairs.select(["a", "b"])):  # the frame keeps the order of its rows
            raise RuntimeError("pairs were reordered")
        a, b, rank = (pairs[c].to_numpy() for c in ("a", "b", "rank"))
        self.entries = np.full(self.pairs.size, -1, np.int64)
        self.entries[self.pairs.slots] = a << 2 * self.bits | b << self.bits | rank
        self.pairs.keys = None
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def literal(self) -> Column:
        """One struct of all that the fold reads."""
        return F.struct(array_literal(self.entries.tolist(), "bigint").alias("pairs"), array_literal(self.pairs.shift.tolist(), "int").alias("shift"),
                        array_literal(self.byte_ids.tolist(), "bigint").alias("bytes"))

    def rank(self, t: Column, a: Column, b: Column) -> Column:
        """The rank of pieces ``a`` and ``b`` joined; ``limit`` or more if there is none.

        An entry is the pair's two ids followed by its rank: exclusive-ored with
        the ids, it leaves the rank alone if it is this pair's entry.
        """
        ids = F.shiftleft(a, 2 * self.bits).bitwiseOR(F.shiftleft(b, self.bits))
        return F.get(t["pairs"], self.pairs.slot(t["shift"], a, b)).bitwiseXOR(ids).bitwiseAND(F.lit(2 ** 62 - 1))

    @property
    def limit(self) -> int:
        return 1 << self.bits

    def folded(self, t: Column, word: Column) -> Column:
        """Ids of a word: ranked merges folded over its bytes (``t``: the literal)."""
        n = F.octet_length(word)
        # a character a byte
        codes = F.transform(F.split(F.decode(word.cast("binary"), "ISO-8859-1"), ""), lambda c: F.get(t["bytes"], F.ascii(c)))
        steps = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))

        def run(parts):
            few = F.transform(F.aggregate(steps, self._cells(t, parts), lambda s, _: self._merge_first(t, s)), self._id)
            start = F.struct(parts.alias("parts"), self._ranks(t, parts).alias("ranks"))
            many = F.aggregate(steps, start, lambda s, _: self._merge_all(t, s), lambda s: s["parts"])
            return F.when(n <= LONG, few).otherwise(many)

        return _bound(codes, run)

    def _ranks(self, t: Column, parts: Column) -> Column:
        """The rank of every pair of neighbours."""
        return F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p, i: self.rank(t, p, F.get(parts, i + 1)))

    # A word of ``LONG`` bytes at most is an array of cells, one a piece: the rank of the piece and the
    # next one joined, the number of its first byte, its id.  The least cell is the leftmost pair of the lowest rank.
    @property
    def _low(self) -> int:
        """Bits below a cell's rank."""
        return self.bits + LONG.bit_length()

    def _id(self, cell: Column) -> Column:
        return cell.bitwiseAND(F.lit(self.limit - 1))

    def _cells(self, t: Column, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: self._ranked(t, F.shiftleft(i.cast("bigint"), self.bits).bitwiseOR(p), p, F.get(parts, i + 1)))

    def _ranked(self, t: Column, below: Column, a: Column, b: Column) -> Column:
        """A cell of ``below``, whose id is ``a``, with the rank of ``a`` and ``b`` joined (none if ``b`` is null)."""
        return F.shiftleft(F.least(self.rank(t, a, b), F.lit(self.limit)), self._low).bitwiseOR(below)

    def _merge_first(self, t: Column, cells: Column) -> Column:
        """The leftmost pair of the lowest rank merged; only the two ranks beside it are looked up."""
        below = F.lit((1 << self._low) - 1)

        def merged(low, at):  # pieces ``at`` and ``at`` + 1, from 1, become one: a piece's rank is its id
            def both(piece):
                here = self._ranked(t, low.bitwiseAND(F.lit((1 << self._low) - self.limit)).bitwiseOR(piece), piece, self._id(F.get(cells, at + 1)))
                before = _bound(F.get(cells, at - 2), lambda c: self._ranked(t, c.bitwiseAND(below), self._id(c), piece))
                return F.concat(F.slice(cells, F.lit(1), F.greatest(at - 2, F.lit(0))), F.when(at > 1, F.array(before, here)).otherwise(F.array(here)),
                                F.slice(cells, at + 2, F.size(cells)))

            return _bound(F.shiftright(low, self._low), both)

        return _bound(F.array_min(cells), lambda low: F.when(low < F.lit(self.limit << self._low), _bound(
            F.array_position(cells, low).cast("int"), lambda at: merged(low, at))).otherwise(cells))

    def _merge_all(self, t: Column, state: Column) -> Column:
        """All pairs of the lowest rank merged, from the left, none overlapping."""
        parts, ranks = state["parts"], state["ranks"]

        def merged(low):
            # 1: a pair starts here; x: it would overlap the one before
            flags = F.regexp_replace(F.array_join(F.transform(ranks, lambda r: F.when(r == low, "1").otherwise("0")), ""), "11", "1x")

            def rebuilt(starts):
                kept = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: (i == 0) | (F.get(starts, i - 1) != "1"))
                return F.transform(kept, lambda i: F.when(F.get(starts, i) == "1", low).otherwise(F.get(parts, i)))

            return _bound(_bound(F.split(flags, ""), rebuilt), lambda p: F.struct(p.alias("parts"), self._ranks(t, p).alias("ranks")))

        return _bound(F.array_min(ranks), lambda low: F.when(low < self.limit, merged(low)).otherwise(state))


def _bound(value: Column, body) -> Column:
    """``body`` of a variable that stands for ``value``, which is so held and computed once."""
    return F.transform(F.array(value), body)[0]


@contextmanager
def _constant(row: DataFrame):
    """The value of a frame of one row and column, as a constant that never passes through the driver's Python.

    It is a session variable: frames made within the block keep its value.
    """
    spark, name = row.sparkSession, f"constant_{uuid.uuid4().hex}"
    spark.sql(f"DECLARE VARIABLE {name} {row.schema[0].dataType.simpleString()}")
    try:
        spark.sql(f"SET VARIABLE {name} = (SELECT * FROM {{row}})", row=row)
        yield F.expr(f"system.session.{name}")
    finally:
        spark.sql(f"DROP TEMPORARY VARIABLE {name}")


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", limit: int = CACHE) -> pa.Table:
    """(word, ids as text, joined by commas) of at most ``limit`` words, the most frequent ones of all texts that are no single piece.

    Counted over the whole corpus; a histogram of the counts gives the least
    count that leaves no more than ``limit`` words, so nothing is sorted and no
    more than those come to the driver.
    """
    frame = _frequent(docs, vocabulary, text, limit)
    schema = _single_words(vocabulary).schema
    return schema.empty_table() if frame is None else frame.toArrow().cast(schema)


def _frequent(docs: DataFrame, vocabulary: Vocabulary, text: str, limit: int) -> DataFrame | None:
    """``frequent_words`` as a written table (None: no word)."""
    single = docs.sparkSession.createDataFrame(_single_words(vocabulary).select(["word"]))
    each = docs.select(F.explode(words(F.col(f"`{text}`"), vocabulary.java)).alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("n")).where("n > 1").where(F.octet_length("word") <= CACHE_BYTES)
    counts = stored(counts.where(~F.contains("word", F.lit(MARK)) & ~F.contains("word", F.lit(ENTRY))).join(single, "word", "left_anti"), "word-counts")
    # 16 classes a doubling: the class that no longer fits is left out whole
    size = F.floor(F.log2("n") * 16)
    histogram = counts.groupBy(size.alias("c")).agg(F.count("*").alias("words")).orderBy(F.desc("c")).collect()
    room, least = limit, None
    for row in histogram:
        if row["words"] > room:
            break
        room, least = room - row["words"], row["c"]
    found = None
    if least is not None:
        ids = _bound(vocabulary.literal(), lambda t: F.array_join(vocabulary.folded(t, F.col("word")), ","))
        found = stored(counts.where(size >= least).select("word", ids.alias("ids")), "held-words")
    discard(counts)
    return found


def _single_words(vocabulary: Vocabulary) -> pa.Table:
    """The pieces that are text, with their ids."""
    words, ids = [], []
    for piece, rank in vocabulary.ranks.items():
        try:
            word = piece.decode()
        except UnicodeDecodeError:
            continue
        if MARK not in word and ENTRY not in word:
            words.append(word)
            ids.append(str(rank))
    return pa.table({"word": pa.array(words, pa.string()), "ids": pa.array(ids, pa.string())})


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", cache: int = CACHE) -> DataFrame:
    """``docs`` with the column ``ids``: the token ids of ``text`` (array of int)."""
    spark = docs.sparkSession
    known = spark.createDataFrame(_single_words(vocabulary))
    found = _frequent(docs, vocabulary, text, cache) if cache else None
    if found is not None:
        known = known.union(found)
    bucket = lambda word: F.hash(word).bitwiseAND(F.lit(BUCKETS - 1))
    # joined by Spark: lists or a literal of the words would take hundreds of MB of the driver
    entries = known.groupBy(bucket("word").alias("at")).agg(F.array_join(F.collect_list(F.concat(F.lit(ENTRY), "word", F.lit(MARK), "ids")), "").alias("entries"))
    every = spark.range(BUCKETS).join(entries, F.col("id") == F.col("at"), "left").select(F.struct("id", F.coalesce("entries", F.lit("")).alias("entries")).alias("b"))
    held_words = every.agg(F.sort_array(F.collect_list("b"))["entries"].alias("held"))
    # a word's ids are text here, so that a text's ids are cast at once

    def of(word, t, h):
        # what follows the word in its bucket, up to the next one; if it isn't there, what precedes the first one: nothing
        entry = F.call_function("substring_index", F.get(h, bucket(word)), F.concat(F.lit(ENTRY), word, F.lit(MARK)), F.lit(-1))
        return _bound(F.substring_index(entry, ENTRY, 1), lambda ids: F.when((ids != "") & ~F.contains(word, F.lit(MARK)), ids)
                      .otherwise(F.array_join(vocabulary.folded(t, word), ",")))

    with _constant(held_words) as held:
        every = _bound(vocabulary.literal(), lambda t: _bound(held, lambda h: F.array_join(
            F.transform(words(F.col(f"`{text}`"), vocabulary.java), lambda w: of(w, t, h)), ",")))
        out = docs.withColumn(ids, _bound(every, lambda e: F.when(e != "", F.split(e, ",").cast("array<int>")).otherwise(F.array().cast("array<int>"))))
    if found is not None:
        discard(found)
    release(spark)  # of what the constants were made from
    return out


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the binary column ``out``: the pieces of ``ids`` joined (an unknown id, or null ids: null)."""
    pieces = ["?"] * (max(vocabulary.ranks.values()) + 1)  # no hexadecimal digit: unhex gives null
    for piece, rank in vocabulary.ranks.items():
        pieces[rank] = piece.hex()
    joined = _bound(array_literal(pieces, "string"), lambda t: F.transform(F.col(f"`{ids}`"), lambda i: F.coalesce(F.get(t, i), F.lit("?"))))
    return df.withColumn(out, F.unhex(F.array_join(joined, "")))


def little_endian(vocabulary: Vocabulary, ids: Column) -> Column:
    """Ids as consecutive little-endian unsigned 32-bit integers (binary)."""
    codes = [i.to_bytes(4, "little").hex() for i in range(max(vocabulary.ranks.values()) + 1)]
    return F.unhex(_bound(array_literal(codes, "string"), lambda t: F.array_join(F.transform(ids, lambda i: F.get(t, i)), "")))


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: texts encoded, ids decoded, both hashed."""
    vocabulary = Vocabulary(docs.sparkSession, ranks, pattern)
    back = decode(encode(docs.select("doc_id", "text"), vocabulary), vocabulary)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(little_endian(vocabulary, F.col("ids")), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
