"""Placement of rows on shards through a permutation-filled lookup table.

Every shard prefers the table's slots in an order of its own.  The shards take turns, and
each claims the first slot of its order that is still free, until the table is full.  All
shards get the same number of slots but for one, and when a shard leaves, few slots of the
others change hands.  A row's key picks a slot, and the slot names the shard.

The table has a fixed number of slots whatever the data, so it is filled once while the
plan is built and broadcast; placing a row is one hash and one probe.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.text import point, unused

MOST_SLOTS = 65_537
HASH_DIGITS = 15


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:HASH_DIGITS], 16)


def lookup_table(shards: Sequence[str], slots: int) -> list[int]:
    """For each slot the position of its shard in ``shards``.

    ``slots`` must be a prime, so that every step width visits all slots, and at least the
    number of shards; the bound on it keeps the broadcast small.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not len(shards) <= slots <= MOST_SLOTS or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime from the number of shards to {MOST_SLOTS}")
    at = [_number(f"{name}/offset") % slots for name in shards]
    step = [_number(f"{name}/skip") % (slots - 1) + 1 for name in shards]
    owner = [-1] * slots
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[at[shard]] >= 0:
            at[shard] = (at[shard] + step[shard]) % slots
        owner[at[shard]] = shard
    return owner


def lookup_frame(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    """The table as rows (slot, shard); its size is set by ``slots`` alone."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")
    names = F.array(*[F.lit(name) for name in shards])
    rows = spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
    return rows.select("slot", F.get(names, F.col("owner").cast("int")).alias("shard"))


def place(
    df: DataFrame, shards: Sequence[str], slots: int, key: str = "doc_id", shard: str = "shard", slot: str | None = None
) -> DataFrame:
    """All rows and columns of ``df`` with the shard of each row's key (and its slot, if named).

    A null key counts as an empty text; equal keys share a shard, so repeated rows stay
    together.  An empty frame gives an empty frame.  Names that ``df`` already has are
    taken by the new columns with underscores added.
    """
    table = lookup_frame(df.sparkSession, shards, slots)
    at, to = unused(df, slot or "slot"), unused(df, shard)
    hashed = df.withColumn(at, F.pmod(point(F.col(key), HASH_DIGITS), F.lit(slots)).cast("int"))
    joined = hashed.join(F.broadcast(table.withColumnsRenamed({"slot": at, "shard": to})), at, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *([at] if slot else []), to)
