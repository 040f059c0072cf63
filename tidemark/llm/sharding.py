"""Sharding by a permutation-filled lookup table (Maglev hashing)."""

from __future__ import annotations

from collections.abc import Sequence

import xxhash
from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 65_537  # a prime, over 100 times the shards it is meant for


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the number of its shard.

    A shard prefers the slots ``offset + k * skip`` (mod ``slots``), both from its name. Shards take turns, each
    claiming the first slot it prefers that is still free, so their shares differ by one slot at most; if a shard
    goes, few slots of the others move.
    """
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, one at least and no more than there are slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    at = [xxhash.xxh3_64_intdigest(s.encode(), seed=1) % slots for s in shards]
    skip = [xxhash.xxh3_64_intdigest(s.encode(), seed=2) % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for shard in range(len(shards)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            table[at[shard]] = shard
            free -= 1
            if not free:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: the first 60 bits of the MD5 of its text, modulo ``slots``."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def with_shard(df: DataFrame, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """Adds ``slot`` and ``shard``, replacing columns of these names.

    The table has ``slots`` entries whatever the input and goes to the tasks with the plan; placing a row is one
    lookup, without a shuffle. Equal keys, repeated rows included, share a shard. A null key is in slot 0. Other columns
    stay, texts are not read. An empty table gives no rows.
    """
    # One literal, folded to an array when the query is planned.
    numbers = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",").cast("array<int>")
    names = F.split(F.lit("\n".join(shards)), "\n")
    slot = F.coalesce(slot_of(F.col(key), slots), F.lit(0))
    return df.withColumn("slot", slot).withColumn("shard", F.get(names, F.get(numbers, F.col("slot"))))
