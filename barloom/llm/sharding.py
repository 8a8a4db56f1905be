"""Shard placement by a permutation-filled lookup table, in DataFrame functions only."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prime, and some hundred times the number of shards, so shares differ by about a hundredth.
SLOTS = 65_537


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (its index) of each slot.

    Every shard prefers slots in an order of its own, offset + k x skip modulo the prime ``slots``;
    in turn each claims the next slot on its list that is still free. Shares differ by at most one
    slot, and a shard that leaves gives up its slots while few others change hands.
    """
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    digests = [hashlib.sha256(s.encode()).digest() for s in shards]
    at = [int.from_bytes(d[:8], "big") % slots for d in digests]
    skip = [int.from_bytes(d[8:16], "big") % (slots - 1) + 1 for d in digests]
    table, left = [-1] * slots, slots
    while True:
        for shard in range(len(shards)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            table[at[shard]] = shard
            left -= 1
            if not left:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its digest modulo ``slots``; a null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(rows: DataFrame, key_col: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``slot`` (int) and ``shard`` (string) after the key in ``key_col``.

    One join on the slot with a broadcast table of exactly ``slots`` rows: no shuffle, and no key
    is too hot, since rows stay where they are. Equal keys share a shard, a null key counts as the
    empty text; columns named slot or shard are replaced. An empty table gives an empty result.
    """
    listed = ",".join(map(str, lookup_table(shards, slots)))
    names = F.array(*(F.lit(s) for s in shards))
    table = (rows.sparkSession.range(1).select(F.posexplode(F.split(F.lit(listed), ","))
                                               .alias("slot", "number"))
             .select("slot", F.get(names, F.col("number").cast("int")).alias("shard")))
    return (rows.drop("slot", "shard").withColumn("slot", slot_of(F.col(key_col), slots))
            .join(F.broadcast(table), "slot").select(
                *(c for c in rows.columns if c not in ("slot", "shard")), "slot", "shard"))
