"""Shards by a lookup table that the shards fill in turn from their own permutations of its slots."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots: a prime, well over 100 for each of 64 shards.
SLOTS = 16_381
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def fill(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard (its index) of each slot. Every shard prefers the slots in the order (offset + k * skip) mod slots and, when its
    turn comes, claims the first one that is still free. The work is in proportion to slots * log(slots), whatever the data.
    """
    if not shards:
        raise ValueError("at least one shard is needed")
    if len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct and no more than slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be prime, else some permutation misses slots")
    number = lambda name, what: int(hashlib.md5(f"{what}/{name}".encode()).hexdigest()[:15], 16)
    at = [number(s, "offset") % slots for s in shards]
    skip = [number(s, "skip") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            table[at[i]] = i
            free -= 1
            if not free:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """60 bits of the key's MD5, mod slots; a null key counts as the empty string."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long") % slots).cast("int")


def lookup(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    return spark.createDataFrame([(s, i, shards[i]) for s, i in enumerate(fill(shards, slots))], "slot int, shard int, shard_name string")


def place(df: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """df with slot, shard and shard_name. The table, which alone is broadcast, has `slots` rows whatever df holds; df isn't shuffled.

    Rows with equal keys share a shard; a null key has the shard of the empty string. Columns of df of these three names are
    replaced. No rows in, no rows out.
    """
    plain = df.drop("slot", "shard", "shard_name").withColumn("slot", slot_of(F.col(key), slots))
    return plain.join(F.broadcast(lookup(df.sparkSession, shards, slots)), "slot").select(*plain.columns, "shard", "shard_name")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, rows_per_file: int = 1_000_000) -> None:
    """A folder of Parquet for each shard. The write isn't shuffled, so that a large shard needs no single task."""
    place(df, key, shards, slots).drop("slot", "shard_name").write.partitionBy("shard").option("maxRecordsPerFile", rows_per_file).parquet(path)


def oracle(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> str:
    """Placement in SQL, over the table that tests/llm compares with a step-by-step simulation of the turns."""
    return f"""
    WITH k AS (SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {slots} AS INTEGER) AS slot FROM documents),
    t AS (SELECT {fill(shards, slots)} AS lookup)
    SELECT doc_id, slot, lookup[slot + 1] AS shard, format('shard-{{:03d}}', lookup[slot + 1]) AS shard_name FROM k, t
    """
