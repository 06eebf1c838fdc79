"""Packing (operator 4): cutting-stock column generation.

Documents become token ids followed by an end id; a document is cut into full
pieces of ``capacity`` ids and one remainder.  The driver sees only the
histogram of length classes (exact up to 64 ids, then steps of 8; at most
``capacity`` rows).  A linear program over
cutting patterns is solved by column generation: the master's duals price the
lengths, a knapsack dynamic program over the capacity finds the best new
pattern, until none improves or the bound (total ids / capacity) is reached
within ``gap``.  Patterns are rounded down; the fewer than one sequence a
pattern left over is packed first-fit decreasing.  Pieces are ranked within
their class (ranks are offsets of salted groups plus a row number, so a length
that a third of all pieces share is ranked by many tasks), and a rank tells
sequence and slot by a lookup in the pattern table, whose size the capacity
bounds; offsets are running sums within the sequence (at most ``capacity``
pieces).

Defined cases: null text counts as empty (its one id is the end id); every
input row is packed, equal rows each on their own; an empty table gives no
pieces; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

CAPACITY = 1024
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
EXACT, STEP = 64, 8  # length classes: exact up to EXACT ids, then rounded up to a multiple of STEP
SPACE = re.compile(r"[\s\u180e]")
JOINED = re.compile(r"[\s\u180e] [\s\u180e]")  # a space inside a run of white space
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

class TextIds:
    """Ids (little-endian unsigned 32 bits) of texts, chunk by chunk.

    The ids are those of the vocabulary file read with ``tokenizers``; its
    merges are run by ``tiktoken``, which gives the same ids four times as fast.

    The vocabulary's split pattern takes a run of white space but its last
    character as one piece, so it joins across a space only where that space has
    white space on both sides, or stands with others or at the end.  Elsewhere
    a text's ids are the ids of its space-separated chunks.  Chunks met for the
    first time are encoded together, and cut apart by the byte lengths of their
    tokens (those that hold white space each alone); they are remembered up to
    ``LIMIT``.  Other texts are encoded whole.  A special token's name in a text
    is that token, as the file's own tokenizer has it, and what stands before and
    after it is encoded apart; with ``names_as_text`` it is text.
    """

    LIMIT = 800_000

    def __init__(self, tokenizer: str, names_as_text: bool = False):
        import json

        import public_tokenizers
        import tiktoken

        with open(tokenizer if os.sep in tokenizer else public_tokenizers.path(tokenizer), encoding="utf-8") as f:
            file = json.load(f)
        vocabulary = file["model"]["vocab"]
        self.special = {} if names_as_text else {t["content"]: int(t["id"]) for t in file.get("added_tokens", []) if t.get("special")}
        self.names = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # a byte-level vocabulary writes each byte as one character: printable Latin-1 as itself, the rest from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte = {chr(b): b for b in plain}
        byte.update((chr(256 + k), b) for k, b in enumerate(b for b in range(256) if b not in plain))
        ranks = {bytes(byte[c] for c in word): i for word, i in vocabulary.items() if all(c in byte for c in word)}
        ranks = {word: i for word, i in ranks.items() if not (word.startswith(b"<|") and word.endswith(b"|>"))}
        self.tok = tiktoken.Encoding(tokenizer, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
        for word, i in ranks.items():
            self.bytes_of[i] = len(word)
        self.known: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", self._ids(t)).tobytes() for t in texts]

    def _ids(self, text: str) -> list[int]:
        if self.names is None or not self.names.search(text):
            return self.tok.encode_ordinary(text)
        ids, at = [], 0
        for m in self.names.finditer(text):
            ids += [*self.tok.encode_ordinary(text[at:m.start()]), self.special[m.group()]]
            at = m.end()
        return ids + self.tok.encode_ordinary(text[at:])

    def learn(self, chunks: set[str]) -> None:
        new = list(chunks.difference(self.known))
        if len(self.known) + len(new) > self.LIMIT:
            self.known.clear()
            new = list(chunks)
        spaced = [c for c in new if SPACE.search(c)]
        self.known.update(zip(spaced, self.whole([" " + c for c in spaced])))
        new = [c for c in new if c not in self.known] if spaced else new
        for at in range(0, len(new), 2000):
            part = new[at:at + 2000]
            ids = np.array(self.tok.encode_ordinary(" " + " ".join(part)), "<u4")
            ends = np.cumsum(self.bytes_of[ids])
            cuts = np.cumsum([1 + len(c.encode()) for c in part])
            stop = np.searchsorted(ends, cuts) + 1
            raw, s = ids.tobytes(), 0
            for c, e in zip(part, stop.tolist()):
                self.known[c] = raw[4 * s:4 * e]
                s = e

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain, rest = [], []
        for i, t in enumerate(texts):
            (rest if "  " in t or t.endswith(" ") or JOINED.search(t) or self.names and self.names.search(t) else plain).append(i)
        for i, ids in zip(rest, self.whole([texts[i] for i in rest])):
            out[i] = ids
        for at in range(0, len(plain), 500):
            group = plain[at:at + 500]
            split = [texts[i].split(" ") for i in group]
            heads = self.whole([x.pop(0) for x in split])
            self.learn(set().union(*split))
            for i, head, chunks in zip(group, heads, split):
                out[i] = head + b"".join(map(self.known.__getitem__, chunks))
        return out


_TOKENIZERS: dict[str, TextIds] = {}


def text_ids(tokenizer: str) -> TextIds:
    """The worker's encoder for a vocabulary file (its memory of chunks lasts as long as the worker)."""
    if tokenizer not in _TOKENIZERS:
        _TOKENIZERS[tokenizer] = TextIds(tokenizer)
    return _TOKENIZERS[tokenizer]


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: full ones from its start, then the remainder."""

    def run(batches):
        import pyarrow as pa

        ids_of = text_ids(tokenizer)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            doc, start, length, crc, total = [], [], [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for d, ids in zip(batch.column(0).to_pylist(), ids_of(texts)):
                ids += end
                n = len(ids) // 4
                for s in range(0, n, capacity):
                    part = ids[4 * s:4 * (s + capacity)]
                    doc.append(d)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_pattern(lengths: np.ndarray, price: np.ndarray, capacity: int) -> dict[int, int]:
    """Unbounded knapsack: the pattern of largest total price that fits (index -> copies)."""
    full = np.zeros(capacity + 1)
    full[lengths] = np.maximum(price, 0)
    best = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        worth = best[c - 1::-1] + full[1:c + 1]  # last item has length 1..c
        k = int(worth.argmax())
        if worth[k] > best[c - 1] + 1e-15:
            best[c], last[c] = worth[k], k + 1
        else:
            best[c] = best[c - 1]
    where = {int(x): i for i, x in enumerate(lengths)}
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        if last[c] and full[last[c]] > 0:
            i = where[int(last[c])]
            out[i] = out.get(i, 0) + 1
            c -= int(last[c])
        else:
            c -= 1
    return out


def first_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int):
    """A pattern and an amount for each class that meet the demand exactly.

    Each pattern takes the longest classes that are left and fit; it is used
    until one of its classes runs out, which then owns it.  Later patterns lack
    that class, so the patterns form a triangular basis.
    """
    left, m = demand.astype(float), len(lengths)
    basis, amount, gone = [{}] * m, np.zeros(m), np.zeros(m, bool)
    for _ in range(m):
        room, pattern = capacity, {}
        for i in range(m - 1, -1, -1):
            if not gone[i] and lengths[i] <= room:
                k = min(room // int(lengths[i]), max(1, int(left[i])))
                pattern[i] = k
                room -= k * int(lengths[i])
        owner = min(pattern, key=lambda i: left[i] / pattern[i])
        n = left[owner] / pattern[owner]
        for i, k in pattern.items():
            left[i] = max(0.0, left[i] - k * n)
        left[owner], gone[owner] = 0.0, True
        basis[owner], amount[owner] = pattern, n
    return basis, amount


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 0.001,
                   max_columns: int = 4000) -> list[tuple[dict[int, int], float]]:
    """Column generation: [(pattern as index -> copies, amount)] whose amounts cover the demand.

    Revised simplex with an explicit basis inverse (at most ``capacity`` rows),
    one column swapped in at a time: a surplus column where a price is negative,
    else the pattern that prices best.  Patterns are priced halfway between the
    duals and length / capacity, the duals of a plan without padding, which
    keeps them from swinging; the duals alone decide when nothing improves.
    ``gap`` is the distance to the bound below which more columns are not worth
    it; ``max_columns`` only bounds the driver's time, stopping costs padding,
    never pieces.
    """
    m = len(lengths)
    basis, amount = first_patterns(lengths, demand, capacity)
    matrix = np.zeros((m, m))
    for j, pattern in enumerate(basis):
        matrix[list(pattern), j] = list(pattern.values())
    inverse = np.linalg.inv(matrix)
    cost = np.ones(m)
    price = cost @ inverse
    even = lengths / capacity
    bound = float((lengths * demand).sum()) / capacity
    for _ in range(max_columns):
        if (cost * amount).sum() <= bound * (1 + gap):
            break
        least = int(price.argmin())
        if price[least] < -1e-7:
            pattern, unit, gain = None, 0.0, price[least]
            column = -inverse[:, least]
        else:
            for share in (0.5, 0.25, 0.0):
                pattern = best_pattern(lengths, share * even + (1 - share) * price, capacity)
                worth = sum(price[i] * k for i, k in pattern.items())
                if worth > 1 + 1e-7:
                    break
            else:
                break
            unit, gain = 1.0, 1 - worth
            column = inverse[:, list(pattern)] @ np.array(list(pattern.values()), float)
        ok = column > 1e-9
        ratio = np.full(m, np.inf)
        ratio[ok] = np.maximum(amount[ok], 0) / column[ok]
        r = int(ratio.argmin())
        step = ratio[r]
        amount -= step * column
        amount[r] = step
        row = inverse[r] / column[r]
        touched = np.flatnonzero(np.abs(column) > 1e-12)
        inverse[touched] -= np.outer(column[touched], row)
        inverse[r] = row
        basis[r], cost[r] = pattern, unit
        price = price + gain * row
    return [(p, float(x)) for p, x in zip(basis, amount) if p is not None and x > 1e-9]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """[(pattern as class -> copies, number of sequences)] that takes up every piece exactly once."""
    plan = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    left = {k: v for k, v in histogram.items() if v > 0 and k < capacity}
    if left:
        lengths = np.array(sorted(left))
        for pattern, amount in sorted(solve_patterns(lengths, np.array([left[x] for x in lengths], float), capacity),
                                      key=lambda x: -x[1]):
            by_length = {int(lengths[i]): k for i, k in pattern.items()}
            n = min([int(amount + 1e-6)] + [left[x] // k for x, k in by_length.items()])
            if n > 0:
                plan.append((by_length, n))
                for x, k in by_length.items():
                    left[x] -= n * k
    # the rest: first-fit decreasing into the fullest bin with room
    rooms: list[tuple[int, int]] = []
    bins: list[dict[int, int]] = []
    for x in sorted(left, reverse=True):
        for _ in range(left[x]):
            k = bisect.bisect_left(rooms, (x, -1))
            if k < len(rooms):
                room, b = rooms.pop(k)
            else:
                room, b = capacity, len(bins)
                bins.append({})
            bins[b][x] = bins[b].get(x, 0) + 1
            if room > x:
                bisect.insort(rooms, (room - x, b))
    return plan + [(b, 1) for b in bins]


def pattern_table(plan: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """class -> (first rank, copies a sequence, first sequence, slot of the first copy), by rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for pattern, n in plan:
        slot = 0
        for size, k in sorted(pattern.items(), reverse=True):
            rows.setdefault(size, []).append((taken.get(size, 0), k, first, slot))
            taken[size] = taken.get(size, 0) + n * k
            slot += k
        first += n
    return {x: tuple(np.array(c, np.int64) for c in zip(*r)) for x, r in rows.items()}


def length_class(length: Column, capacity: int) -> Column:
    """The size a piece counts with in the plan; never below its length."""
    return F.when(length <= EXACT, length).otherwise(
        F.least(F.lit(capacity), F.ceil(length / STEP) * STEP)).cast("long")


def ranked(pieces: DataFrame, per_salt: int = 20_000) -> DataFrame:
    """``pieces`` with ``rank``, gapless from 0 within each class."""
    total = pieces.count()
    salts = max(1, total // per_salt)
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    groups = salted.groupBy("class", "_salt").agg(F.count("*").alias("_n"))
    w = Window.partitionBy("class").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = groups.select("class", "_salt", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("class", "_salt").orderBy(*order)) - 1
    return salted.withColumn("_own", own).join(base, ["class", "_salt"]) \
        .withColumn("rank", (F.col("_base") + F.col("_own")).cast("long")).drop("_salt", "_own", "_base")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row a piece.

    Sequences are to be padded to ``capacity``, except where their length is a
    power of two.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity), "pieces")
    pieces = pieces.withColumn("class", length_class(F.col("length"), capacity))
    spark = docs.sparkSession
    histogram = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(pattern_table(plan_sequences(histogram, capacity)))

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            size = batch.column("class").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            seq = np.empty(len(size), np.int64)
            slot = np.empty(len(size), np.int64)
            for x in np.unique(size):
                here = size == x
                start, copies, first, at = shared.value[int(x)]
                r = rank[here]
                k = np.searchsorted(start, r, side="right") - 1
                inside = r - start[k]
                seq[here] = first[k] + inside // copies[k]
                slot[here] = at[k] + inside % copies[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(slot)],
                                             names=[*batch.schema.names[:5], "sequence_id", "slot"])

    rows = ranked(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "rank")
    placed = rows.mapInArrow(place, PIECES + ", sequence_id long, slot long")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("slot")
