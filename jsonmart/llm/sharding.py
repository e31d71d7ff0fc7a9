"""Shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table whose size is a prime: a start and a
step, both from a hash of its name; a prime size makes every such walk visit all slots. Shards take
turns, each claiming the first slot on its walk that is still free, until the table is full. So shares differ by
one slot at most, and when a shard comes or goes most slots stay where they were. A row's key hashes to a slot,
and the table names the shard. The table has a fixed number of slots, whatever the data, and is broadcast;
rows are placed where they lie, without a shuffle.

Defined cases. A null key is placed as the empty text, all such rows in one shard; equal keys share a shard,
so repeated rows stay together. Empty tables give no rows. Other columns pass through; on a clash the new columns
get longer names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name

SHARDS = 64
SLOTS = 65537  # prime, a thousand times the shards: their shares differ by 0.1 % at most


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(names: list[str], slots: int = SLOTS) -> list[int]:
    """For every slot the number of the shard that claimed it."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shard names must be distinct, and there must be one")
    if slots < len(names) or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime, not below the number of shards")
    at = [_hash(f"start {x}") % slots for x in names]
    step = [_hash(f"step {x}") % (slots - 1) + 1 for x in names]
    owner, free = [-1] * slots, slots
    while free:
        for shard in range(len(names)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots


def with_shard(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``docs`` with the columns slot (long) and shard (int)."""
    slot, shard = free_name(docs, "slot"), free_name(docs, "shard")
    table = _table(docs.sparkSession, lookup_table([f"shard-{k}" for k in range(shards)], slots), slot, shard)
    placed = docs.withColumn(slot, slot_of(F.col(key), slots))
    # ``slots`` rows of two numbers, whatever the size of ``docs``
    return placed.join(F.broadcast(table), slot, "left").select(*[f"`{c}`" for c in docs.columns], slot, shard)


def _table(spark: SparkSession, owners: list[int], slot: str, shard: str) -> DataFrame:
    """The lookup table as rows, from a text literal; no Python runs for it on the executors."""
    cells = spark.range(1).select(F.posexplode(F.split(F.lit(" ".join(map(str, owners))), " ")))
    return cells.select(F.col("pos").cast("long").alias(slot), F.col("col").cast("int").alias(shard))


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS, parts: int = 1) -> None:
    """``docs`` as Parquet, a folder per shard; ``parts`` tasks write each shard, so that none holds a whole one."""
    placed = with_shard(docs, key, shards)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(parts))
    shard = placed.columns[-1]
    placed.repartition(shards * parts, F.col(shard), salt).write.partitionBy(shard).parquet(path)
