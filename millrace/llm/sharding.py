"""Sharding (operator 2): a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized
table (offset and skip, both hashed from the shard's name).  Shards take turns
claiming the next free slot they prefer until the table is full, so slot counts
differ by at most one turn, and when a shard joins or leaves most slots keep
their owner.  The table (``table_size`` rows, fixed by parameter whatever the
data) is broadcast; placing a row is one hash and one lookup.

Defined cases: a null key is placed like the key ``""`` prefixed by a marker of
its own (all null keys share one slot); equal keys share a slot; an empty
input gives an empty result; other columns are passed through, and a column of
the input named like an output column is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_SIZE = 65537  # prime; at least 100 slots a shard keeps shares within about 1 %


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _h(name: str, seed: str) -> int:
    return int.from_bytes(hashlib.md5(f"{seed}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], table_size: int = TABLE_SIZE,
                 weights: dict[str, int] | None = None) -> list[str]:
    """Owner of each slot.  A shard of weight w claims w slots a turn (default 1)."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not _is_prime(table_size) or table_size < len(shards):
        raise ValueError("the table size must be a prime, and not below the number of shards")
    order = sorted(shards)
    offset = {s: _h(s, "offset") % table_size for s in order}
    skip = {s: _h(s, "skip") % (table_size - 1) + 1 for s in order}
    turn = {s: (weights or {}).get(s, 1) for s in order}
    if any(w < 0 for w in turn.values()) or not any(turn.values()):
        raise ValueError("weights must not be negative, nor all zero")
    at = dict.fromkeys(order, 0)
    owner: list[str | None] = [None] * table_size
    left = table_size
    while left:
        for s in order:
            for _ in range(turn[s]):
                if not left:
                    break
                slot = (offset[s] + at[s] * skip[s]) % table_size
                while owner[slot] is not None:
                    at[s] += 1
                    slot = (offset[s] + at[s] * skip[s]) % table_size
                owner[slot] = s
                at[s] += 1
                left -= 1
    return owner


def slot_of(*keys: str, table_size: int = TABLE_SIZE) -> Column:
    """Slot of a row by its key columns (null differs from the empty string)."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{k}`").cast("string")), F.lit("0")) for k in keys]
    word = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 15), 16, 10).cast("long")
    return F.pmod(word, F.lit(table_size)).cast("int")


def assign(df: DataFrame, keys: list[str], shards: list[str], table_size: int = TABLE_SIZE,
           weights: dict[str, int] | None = None) -> DataFrame:
    """``df`` with columns ``slot`` and ``shard``."""
    spark = df.sparkSession
    rows = list(enumerate(lookup_table(shards, table_size, weights)))
    schema = T.StructType([T.StructField("slot", T.IntegerType(), False), T.StructField("shard", T.StringType(), False)])
    owners = spark.createDataFrame(rows, schema)
    df = df.withColumn("slot", slot_of(*keys, table_size=table_size)).drop("shard")
    return df.join(F.broadcast(owners), "slot")


def write_shards(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write rows that carry ``shard`` to one folder a shard.

    Rows are dealt by (shard, salt), with as many salts as the fullest shard
    needs files, so that a shard of any size is written by many tasks.
    """
    most = df.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    salts = max(1, -(-most // rows_per_file))
    df.withColumn("_salt", F.floor(F.rand(7) * salts)).repartition("shard", "_salt").drop("_salt") \
        .write.partitionBy("shard").mode("overwrite").parquet(path)
