"""Sharding by a permutation-filled lookup table, in DataFrame operations only.

Shards take turns claiming slots of a table of prime size; each follows its own preference order
(offset + j * skip, which visits every slot as the size is prime).  A row's slot is a hash of its
key, so placement is one lookup, shards get equal shares to within one slot, and adding or losing
a shard moves little besides its own rows.  The table depends on parameters alone and is bounded
by ``MOST_SLOTS``, so it is broadcast whatever the size of the data.

Defined results: a null key counts as empty text, repeated keys share their shard, an empty table
gives no rows, other columns pass through whatever their names; names of the two new columns that
the table has already get underscores until they are new.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import new_name

SHARDS, SLOTS, MOST_SLOTS = 64, 6571, 1_000_003


def _number(text: str) -> int:
    """The first 15 hex digits of the text's MD5."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: int = SHARDS, slots: int = SLOTS) -> list[int]:
    """Shard of each slot."""
    if not 1 <= shards <= slots <= MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"want a prime number of slots up to {MOST_SLOTS}, and no more shards than slots")
    skip = [_number(f"skip-{s}") % (slots - 1) + 1 for s in range(shards)]
    at = [_number(f"offset-{s}") % slots for s in range(shards)]
    table, left = [-1] * slots, slots
    while True:
        for s in range(shards):
            while table[at[s]] >= 0:
                at[s] = (at[s] + skip[s]) % slots
            table[at[s]] = s
            left -= 1
            if not left:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return (F.conv(digits, 16, 10).cast("long") % slots).cast("int")


def assign_shards(df: DataFrame, key_col: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS, slot_name: str = "slot", shard_name: str = "shard") -> DataFrame:
    """``df`` with two more columns: its slot and its shard."""
    table = lookup_table(shards, slots)
    placed = df.sparkSession.sql(f"SELECT posexplode(array({','.join(map(str, table))})) AS (slot, shard)")
    # The table's own columns travel as one struct, so their names meet no other.
    rows = df.select(F.struct("*").alias("row"), slot_of(df[key_col], slots).alias("slot"))
    slot_name = new_name(slot_name, df.columns)
    shard_name = new_name(shard_name, [*df.columns, slot_name])
    return rows.join(F.broadcast(placed), "slot").select(*[F.col("row")[c].alias(c) for c in df.columns], F.col("slot").alias(slot_name), F.col("shard").alias(shard_name))
