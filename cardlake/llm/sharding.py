"""Operator 3: placement of documents on shards by a permutation-filled table.

Each shard has its own order of preference over a prime number of slots (an
offset and a step from its name). Shards take turns; each claims its next slot
that is still free, until all are claimed. So shares differ by one slot at most,
and when a shard comes or goes most slots keep their owner. The table's size is
a parameter, whatever the data; it is broadcast, and a document finds its shard
by one lookup, without a shuffle.

A null id is placed like the empty text. Equal ids come to the same shard;
repeated rows stay. Extra columns pass through; an input column named like an
output column is replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.common import documents, unused

SLOTS = 8191
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@functools.cache
def lookup(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The owner of each slot, as the shard's place in the list."""
    if any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or slots < 2 or not shards or len(shards) > slots:
        raise ValueError("a prime number of slots, and shards of at most so many")
    at = [_number(f"offset:{s}") % slots for s in shards]
    step = [_number(f"step:{s}") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int) -> Column:
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots


def with_shard(df: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Add ``slot`` and ``shard`` (the shard's place in the list)."""
    owners = ",".join(map(str, lookup(tuple(shards), slots)))
    placed = df.withColumn("slot", slot_of(F.col(key), slots))
    at, owner = unused(placed, "_slot", "_owner")
    table = df.sparkSession.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias(at, owner))
    table = table.select(F.col(at).cast("long"), F.col(owner).cast("long"))
    return placed.join(F.broadcast(table), F.col("slot") == F.col(at)).withColumn("shard", F.col(owner)).drop(at, owner)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_shard(documents(spark, sf_dir).select("doc_id")).select("doc_id", "slot", "shard")


def oracle() -> str:
    return f"""
WITH t AS (SELECT [{",".join(map(str, lookup()))}] AS owner),
s AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, CAST(owner[slot + 1] AS BIGINT) AS shard FROM s, t
"""
