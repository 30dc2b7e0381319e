"""Sharding by a permutation-filled lookup table.

Every shard has a permutation of the slots of a table of prime size M, made of
an offset and a step. Shards take turns: each claims the first slot of its
permutation that is still free, until all are taken. A key is hashed to a slot,
and the table gives the shard. Shares differ by one slot at most, and when a
shard is added or leaves, most slots keep their owner.

The table is the only thing broadcast: M rows of two integers, whatever the
data (M is a parameter, 65,537 by default). Placing is one hash and one lookup
per row in the JVM, without a shuffle.

Cases: a null key hashes to a slot of its own like any value, so repeated and
null keys are placed together. An empty table stays empty. Extra columns pass
through; names for the added ones that exist already, in any case, are refused.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = 64


def _number(name: str, purpose: str) -> int:
    return int.from_bytes(hashlib.md5(f"{purpose}:{name}".encode()).digest()[:7], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Owner (position in ``shards``) of every slot."""
    if not is_prime(slots):
        raise ValueError(f"{slots} slots: the number of slots has to be prime")
    if not 0 < len(set(shards)) == len(shards) <= slots:
        raise ValueError("shards need different names, at least one, and no more than slots")
    owner = [-1] * slots
    place = [_number(s, "offset") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    left = slots
    while left:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % slots
            owner[place[i]] = i
            left -= 1
            if not left:
                break
    return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The table as a frame: ``slot``, ``shard``."""
    return spark.createDataFrame(list(enumerate(fill(shards, slots))), "slot int, shard int")


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo M."""
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint") % slots).cast("int")


def place(
    df: DataFrame,
    key: Column,
    shards: list[str],
    slots: int = SLOTS,
    slot_name: str = "slot",
    shard_name: str = "shard",
) -> DataFrame:
    """``df`` with the slot of the key and the shard that owns it."""
    taken = {c.lower() for c in df.columns}
    clash = [c for c in (slot_name, shard_name) if c.lower() in taken]
    if clash or slot_name.lower() == shard_name.lower():
        raise ValueError(f"columns exist already: {clash or [slot_name]}; name others")
    table = lookup_table(df.sparkSession, shards, slots).toDF(slot_name, shard_name)
    return (
        df.withColumn(slot_name, slot_of(key, slots))
        .join(F.broadcast(table), slot_name)
        .select(*[F.col(f"`{c}`") for c in df.columns], slot_name, shard_name)
    )


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def digest(docs: DataFrame) -> DataFrame:
    """Every document with the slot and shard of its id."""
    return place(docs.select("doc_id"), F.col("doc_id"), shard_names())
