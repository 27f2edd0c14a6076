"""Sharding by a permutation-filled lookup table.

The table has a prime number of slots. Every shard visits all slots in an order of its own (offset and step from a hash of
its name); in turn, each shard takes the next slot of its order that is free, until none is left. Slots are shared out
almost evenly, and a shard that leaves or comes moves few others. Placing a row is one hash and one lookup in the broadcast
table, whose size is the parameter ``slots``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65537


def _number(text: str) -> int:
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[int]:
    """The shard number of each slot. A shard of weight w takes w slots in each of its turns."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be a prime not below the number of shards")
    names = sorted(shards)  # the result doesn't depend on the order in which shards are named
    offset = [_number(f"offset {n}") % slots for n in names]
    step = [_number(f"step {n}") % (slots - 1) + 1 if slots > 2 else 1 for n in names]
    at, out, left = offset[:], [-1] * slots, slots
    numbers = [shards.index(n) for n in names]
    while left:
        for i, name in enumerate(names):
            for _ in range((weights or {}).get(name, 1)):
                if not left:
                    break
                while out[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % slots
                out[at[i]] = numbers[i]
                left -= 1
    return out


def place(df: DataFrame, shards: list[str], key: str = "doc_id", slots: int = SLOTS, weights: dict[str, int] | None = None) -> DataFrame:
    """``key``, ``slot`` and ``shard`` (name) of every row. Equal keys share a slot, null keys have one of their own hash.

    No shuffle; the broadcast table has exactly ``slots`` rows. Other columns are left out; see ``write``.
    """
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int")
    return df.select(F.col(key), slot.alias("slot")).join(F.broadcast(lookup(df.sparkSession, shards, slots, weights)), "slot").select(key, "slot", "shard")


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> DataFrame:
    names = [shards[i] for i in fill(shards, slots, weights)]
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame({"slot": range(slots), "shard": names}), "slot int, shard string")


def write(df: DataFrame, path: str, shards: list[str], key: str = "doc_id", slots: int = SLOTS, rows_per_file: int = 1_000_000) -> None:
    """Writes all rows and columns below ``path``, a folder ``_shard=name`` for each shard.

    Rows go to tasks by slot and by a salt of the whole row's position hash inside heavy slots, so that a shard with a third
    of the rows is written by many tasks.
    """
    slot = F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int")
    table = lookup(df.sparkSession, shards, slots).select(F.col("slot").alias("_slot"), F.col("shard").alias("_shard"))
    placed = df.withColumn("_slot", slot).join(F.broadcast(table), "_slot").drop("_slot")
    placed.hint("rebalance", F.col("_shard")).write.option("maxRecordsPerFile", rows_per_file).partitionBy("_shard").parquet(path)
