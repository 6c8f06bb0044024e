"""Placement of documents on shards by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a prime-sized table, an arithmetic progression that
visits all of them.  The shards take turns, each claiming its most preferred slot that is still free, until none
is.  All get the same number of slots within one, and a shard's loss or arrival moves few others' slots.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS, SLOTS = 256, 65_537


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(names: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the position in ``names`` of the shard that holds it; names are distinct, slots is prime."""
    if not names or len(set(names)) < len(names) or slots < len(names) or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("distinct shard names and at least as many slots, a prime number, are needed")
    at = [_hash(f"offset:{n}") % slots for n in names]
    skip = [_hash(f"skip:{n}") % (slots - 1) + 1 for n in names]
    table, taken = [-1] * slots, 0
    while True:
        for i in range(len(names)):
            p = at[i]
            while table[p] >= 0:
                p = (p + skip[i]) % slots
            table[p] = i
            at[i] = (p + skip[i]) % slots
            taken += 1
            if taken == slots:
                return table


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:04d}" for i in range(n)]


def lookup(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(fill(names, slots))), "slot long, shard int")


def place(docs: DataFrame, names: list[str] | None = None, slots: int = SLOTS, key: str = "doc_id") -> DataFrame:
    """(doc_id, slot, shard) for each row with an id: where the document goes.

    The slot is that of the id's MD5, so it depends neither on the engine nor on the table's other rows; repeated ids go
    to one shard.  Rows without an id are left out and an empty table gives an empty one; other columns, the texts too, are never read.  The table's
    size is a parameter, so broadcasting it costs the same at any amount of data.
    """
    names = names or shard_names()
    spark = docs.sparkSession
    d = docs.select(F.col(key).alias("doc_id")).where("doc_id is not null")
    slot = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long") % slots
    return d.withColumn("slot", slot).join(F.broadcast(lookup(spark, names, slots)), "slot").select("doc_id", "slot", "shard")


def oracle() -> str:
    table = ", ".join(map(str, fill(shard_names())))
    return f"""WITH s AS (SELECT doc_id, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % {SLOTS} AS slot FROM documents WHERE doc_id IS NOT NULL),
t AS (SELECT [{table}] AS shards)
SELECT doc_id, slot, shards[slot + 1]::INTEGER AS shard FROM s, t"""
