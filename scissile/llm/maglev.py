"""Shard placement by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table (an
offset and a skip from two hashes of its name); shards take turns claiming their
next free slot until the table is full.  A key's shard is table[hash(key) mod
size]: one lookup, shares within one slot of each other, and few moves when a
shard comes or goes.  The table has a fixed number of rows, whatever the data,
and is broadcast.

Defined results: a null key hashes as the string "null"; equal keys share a
shard; keys of any length are hashed whole; repeated rows are kept; columns named
slot or shard are replaced, after one of them has served as the key if it is the
key; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots: a prime well over a hundred times the shards.
SLOTS = 65537


def preference(name: str, slots: int) -> tuple[int, int]:
    """(offset, skip): the shard prefers slot (offset + i * skip) mod slots, i = 0, 1, ..."""
    h = hashlib.md5(name.encode()).digest()
    return int.from_bytes(h[:8], "big") % slots, int.from_bytes(h[8:], "big") % (slots - 1) + 1


def fill_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """The shard (its place in `shards`) of each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names")
    if slots < 3 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or slots < len(shards):
        raise ValueError("slots must be a prime of at least the number of shards")
    order = [preference(x, slots) for x in shards]
    turn, table, free = [0] * len(shards), [-1] * slots, slots
    while free:
        for k, (offset, skip) in enumerate(order):
            while True:
                slot = (offset + turn[k] * skip) % slots
                turn[k] += 1
                if table[slot] < 0:
                    break
            table[slot] = k
            free -= 1
            if not free:
                break
    return np.array(table, np.int32)


def slot_of(key, slots: int = SLOTS):
    """The slot of a key column: the first 60 bits of its MD5, modulo slots."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(slots))


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """df with slot (long) and shard (string); columns of df by these names are replaced."""
    table = [(i, shards[k]) for i, k in enumerate(fill_table(shards, slots).tolist())]
    lookup = df.sparkSession.createDataFrame(table, "slot long, shard string")
    others = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    return df.select(*others, slot_of(F.col(f"`{key}`"), slots).alias("slot")).join(F.broadcast(lookup), "slot")


def write_shards(placed: DataFrame, uri: str) -> None:
    """A folder per shard; each task appends files of its own, so that no shard is gathered anywhere."""
    placed.write.partitionBy("shard").parquet(uri)
