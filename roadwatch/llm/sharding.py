"""Sharding by a permutation-filled lookup table (consistent hashing with bounded lookup).

Every shard has a preference order over the slots of a table of prime size: a
start and a step, both hashed from its name, walk through all slots. The
shards take turns, each claiming its next free slot, until the table is full;
so shards hold equal numbers of slots (in proportion to weight) and adding or
removing one moves few of them. The table is made once from the shard names
alone, has a fixed number of slots whatever the data, and is broadcast; a row
is placed by one hash and one lookup.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots; a prime, at least 100 times the shards it is meant for.
SLOTS = 65537


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> list[int]:
    """The lookup table: for each slot the number of its shard in ``shards``.

    Names must be distinct and ``slots`` prime. A shard of weight ``w`` claims
    ``w`` slots a turn; by default all weigh 1.
    """
    weights = weights or [1] * len(shards)
    if not shards or len(set(shards)) != len(shards) or len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("shards must be distinct names, with a weight of 1 or more each")
    if slots < len(shards) or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime of at least the number of shards")
    at = [_hash(f"start:{s}") % slots for s in shards]
    step = [1 + _hash(f"step:{s}") % (slots - 1) for s in shards]
    table = [-1] * slots
    free = slots
    while True:
        for i, w in enumerate(weights):
            for _ in range(w):
                while table[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % slots
                table[at[i]] = i
                free -= 1
                if not free:
                    return table


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS, weights: list[int] | None = None) -> DataFrame:
    """The table as ``(slot, shard)``, ``slots`` rows."""
    numbers = F.split(F.lit(",".join(map(str, fill(shards, slots, weights)))), ",")
    names = F.array(*map(F.lit, shards))
    return spark.range(1).select(F.posexplode(numbers).alias("slot", "number")) \
        .select("slot", F.element_at(names, F.col("number").cast("int") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of the md5 of its text, modulo the table's size (NULL: as empty)."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(docs: DataFrame, shards: list[str], id_col: str = "doc_id", slots: int = SLOTS,
          weights: list[int] | None = None) -> DataFrame:
    """``docs`` with ``slot`` and ``shard`` (columns of those names are replaced).

    One broadcast join with the table of ``slots`` rows; no shuffle. Rows of
    equal ids share a shard; a NULL id is placed like an empty one.
    """
    table = lookup(docs.sparkSession, shards, slots, weights)
    rows = docs.drop("slot", "shard").withColumn("slot", slot_of(F.col(id_col), slots))
    return rows.join(F.broadcast(table), "slot").select(*rows.columns, "shard")


def write_shards(placed: DataFrame, path: str, parts: int = 1) -> None:
    """Write one folder per shard, each by ``parts`` tasks, so that a shard that a
    repeated id has made large is still split."""
    salt = F.pmod(F.xxhash64(*[c for c, t in placed.dtypes if not t.startswith("map")]), F.lit(parts))
    placed.repartition("shard", salt).write.partitionBy("shard").parquet(path)
