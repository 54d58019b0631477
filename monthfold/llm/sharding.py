"""Consistent placement by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table.
Shards take turns; each claims the first slot of its order that is still free.
The table has a fixed number of rows, so it is broadcast, and placing a row is one
hash and one lookup. A changed shard list moves few of the other slots.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthfold.llm.common import own

SLOTS = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(200))


def preference(shard: str, slots: int) -> tuple[int, int]:
    """First choice and step of a shard; the slot of choice k is (first + k * step) mod slots."""
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def fill(shards: tuple[str, ...], slots: int = SLOTS) -> list[str]:
    """The shard of every slot. ``slots`` must be a prime above the number of shards."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be different and at least one")
    if slots <= len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime above the number of shards")
    table: list[str | None] = [None] * slots
    at = {shard: preference(shard, slots) for shard in sorted(shards)}
    left = slots
    while True:
        for shard, (slot, step) in at.items():
            while table[slot] is not None:
                slot = (slot + step) % slots
            table[slot] = shard
            at[shard] = ((slot + step) % slots, step)
            left -= 1
            if not left:
                return table


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key: 32 bits of its MD5, modulo the number of slots. Null: as empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % slots).cast("int")


def place(df: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Rows of ``df`` as (key, slot, shard), one for each row.

    Equal keys share a shard; so do all null keys and the empty text. No rows: no
    rows. The broadcast table has exactly ``slots`` rows.
    """
    table = df.sparkSession.createDataFrame(list(enumerate(fill(shards, slots))), "table_slot int, shard string")
    placed = own(df, key).withColumn("slot", slot_of(F.col(f"`{key}`"), slots))
    return placed.join(F.broadcast(table), F.col("slot") == F.col("table_slot")).drop("table_slot")
