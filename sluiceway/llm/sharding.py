"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: it starts at an offset and goes on in
steps, both from a hash of its name, and meets every slot once. The shards take turns, each claiming its first slot
that is still free, until none is left. So all shards have as many slots, give or take one, and few slots
change hands when a shard comes or goes. A key's slot is its hash modulo the table size; the table, whose size is a
parameter and never depends on the data, is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 4099
MAX_TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{number:02d}" for number in range(32))
HEX_DIGITS = 15


def name_hash(text: str) -> int:
    return int(hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()[:HEX_DIGITS], 16)


def preferences(shard: str, size: int) -> tuple[int, int]:
    """Offset and step of a shard's order of preference."""
    return name_hash(f"{shard}/offset") % size, name_hash(f"{shard}/step") % (size - 1) + 1


def fill(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard number of each slot. Rejects a size that is not prime, too large to broadcast, or below the number of shards."""
    if len(set(shards)) != len(shards) or not shards:
        raise ValueError("shards need different names")
    if not len(shards) <= size <= MAX_TABLE_SIZE or size < 2 or any(size % n == 0 for n in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size has to be a prime number from the number of shards up to {MAX_TABLE_SIZE}")
    table: list[int | None] = [None] * size
    places = [preferences(shard, size) for shard in shards]
    turn = [0] * len(shards)
    for claim in range(size):
        number = claim % len(shards)
        offset, step = places[number]
        while table[(offset + turn[number] * step) % size] is not None:
            turn[number] += 1
        table[(offset + turn[number] * step) % size] = number
    return table


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """`(slot, shard)`, one row per slot."""
    filled = F.from_json(F.lit(str(fill(shards, size))), "array<int>")
    names = F.from_json(F.lit("[" + ",".join(f'"{name}"' for name in shards) + "]"), "array<string>")
    slots = spark.range(1).select(F.posexplode(filled).alias("slot", "number"))
    return slots.select("slot", F.element_at(names, F.col("number") + 1).alias("shard"))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key's text; a null key counts as an empty one."""
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HEX_DIGITS)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(size).cast("long")).cast("int")


def place(df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """`df` with `slot` and `shard` by the text of column `key`; columns of these names are replaced.

    A projection and a join with a broadcast table of `size` rows: no shuffle, whatever the skew of the data. Null and
    empty keys share a slot; equal keys always meet; no rows give no rows.
    """
    rows = df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), size))
    return rows.join(F.broadcast(lookup_table(df.sparkSession, shards, size)), "slot")


def write(df: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> None:
    """Write `df` as Parquet, a directory per shard. Slots spread a shard over several files; Spark splits large ones."""
    placed = place(df, key, shards, size)
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
