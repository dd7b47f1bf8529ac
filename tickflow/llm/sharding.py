"""Sharding by a permutation-filled lookup table.

Every shard prefers the slots of a table of prime size in an order of its own: an offset and a
skip from its name's hash run through all slots. Shards take turns; each takes the slot it likes
best among those still free, until the table is full. So every shard has the same number of slots
per turn in a round, give or take one, and when a shard comes or goes few slots change hands. A
row's key hash names a slot, and a broadcast of the table names the shard in constant time.

The table is filled by one fold in Spark SQL. It depends on the shards alone and holds
``slots`` entries however many rows there are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
"""A prime, at least a hundred times the shards' turns, so that shares differ by 1 % at most."""
MAX_SLOTS = 1 << 21


@dataclass(frozen=True)
class Lookup:
    """A filled table: ``table`` has (slot, shard) for each of ``slots`` slots."""

    table: DataFrame
    slots: int


# One step: the shard whose turn it is looks at its next slot, and takes it if it is free.
# ``owners`` holds two bytes per slot, ``looked`` four bytes per shard.
_STEP = """
    CASE WHEN s.taken = {slots} THEN s ELSE
        transform(array(named_struct(
            'turn', s.turn,
            'shard', order[s.turn],
            'looked', cast(conv(hex(substring(s.looked, 4 * order[s.turn] + 1, 4)), 16, 10) AS bigint)
        )), t -> transform(array(
            (s.offsets[t.shard] + t.looked * s.skips[t.shard]) % {slots}
        ), slot -> named_struct(
            'owners', CASE WHEN substring(s.owners, cast(2 * slot + 1 AS int), 2) = X'FFFF'
                THEN overlay(s.owners PLACING unhex(lpad(hex(t.shard), 4, '0')) FROM cast(2 * slot + 1 AS int) FOR 2)
                ELSE s.owners END,
            'looked', overlay(s.looked PLACING unhex(lpad(hex(t.looked + 1), 8, '0')) FROM 4 * t.shard + 1 FOR 4),
            'turn', CASE WHEN substring(s.owners, cast(2 * slot + 1 AS int), 2) = X'FFFF'
                THEN (t.turn + 1) % size(order) ELSE t.turn END,
            'offsets', s.offsets,
            'skips', s.skips,
            'taken', s.taken + CASE WHEN substring(s.owners, cast(2 * slot + 1 AS int), 2) = X'FFFF' THEN 1 ELSE 0 END
        ))[0])[0]
    END
"""


def _prime(number: int) -> bool:
    return number > 1 and all(number % d for d in range(2, math.isqrt(number) + 1))


def _hash(text: str) -> str:
    """SQL for 60 bits of a text's md5."""
    return f"cast(conv(substring(md5({text}), 1, 15), 16, 10) AS bigint)"


def lookup_table(
    spark: SparkSession, shards: Sequence[str] | Mapping[str, int], slots: int = SLOTS
) -> Lookup:
    """The table of some shards.

    ``shards`` are distinct names, or names with their turns in a round, which give a shard a
    multiple of another's share. ``slots`` must be a prime, at most ``MAX_SLOTS``, and more than
    all turns of a round. The order of the names decides who goes first.
    """
    turns = dict(shards) if isinstance(shards, Mapping) else dict.fromkeys(shards, 1)
    names = list(turns)
    if not names or len(names) != len(shards) or None in turns or min(turns.values()) < 1:
        raise ValueError("shards need distinct names and at least one turn each")
    if not _prime(slots) or slots > MAX_SLOTS or sum(turns.values()) >= slots or len(names) >= 0xFFFF:
        raise ValueError("slots must be a prime that exceeds the turns of a round")
    order = [number for number, name in enumerate(names) for _ in range(turns[name])]
    setup = spark.range(1).select(F.lit(names).alias("names"), F.lit(order).cast("array<int>").alias("order"))
    # Kept in the fold's state, where they are computed once.
    offsets = f"transform(names, n -> {_hash("concat('offset ', n)")} % {slots})"
    skips = f"transform(names, n -> {_hash("concat('skip ', n)")} % {slots - 1} + 1)"
    # All slots are found after about slots * ln(slots) looks; the fold stops looking by itself.
    looks = int(2 * slots * (math.log(slots) + 1))
    owners, looked, turn, taken = f"unhex(repeat('FFFF', {slots}))", f"unhex(repeat('00000000', {len(names)}))", 0, 0
    while taken < slots:
        first = f"named_struct('owners', {owners}, 'looked', {looked}, 'turn', {turn}, " \
            f"'offsets', {offsets}, 'skips', {skips}, 'taken', {taken})"
        step = _STEP.format(slots=slots)
        filled = setup.selectExpr(f"aggregate(sequence(1, {looks}), {first}, (s, look) -> {step}) AS s").select("s.*")
        state = filled.head()
        turn, taken = state["turn"], state["taken"]
        owners, looked = f"X'{state['owners'].hex()}'", f"X'{state['looked'].hex()}'"
    number = "cast(conv(hex(substring(owners, cast(2 * slot + 1 AS int), 2)), 16, 10) AS int)"
    table = spark.range(slots).select(F.col("id").alias("slot"), F.lit(bytes(state["owners"])).alias("owners"))
    return Lookup(table.withColumn("names", F.lit(names)).selectExpr("slot", f"names[{number}] AS shard"), slots)


def slot_of(keys: Sequence[str], slots: int) -> Column:
    """The slot of a row, from all its key columns; a null key differs from every text."""
    parts = [
        F.when(F.col(key).isNull(), F.lit("-")).otherwise(
            F.concat(F.char_length(F.col(key).cast("string")).cast("string"), F.lit(":"), F.col(key).cast("string"))
        )
        for key in keys
    ]
    hashed = F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("long")
    return F.pmod(hashed, F.lit(slots)).cast("long")


def place(rows: DataFrame, keys: Sequence[str], lookup: Lookup) -> DataFrame:
    """The rows with the columns slot and shard; columns of these names are replaced.

    Equal keys go to one shard, null keys too. To split a key that is too common for a shard,
    add a column to ``keys`` that tells its rows apart. No shuffle: the table is broadcast, which
    ``MAX_SLOTS`` bounds.
    """
    slotted = rows.drop("shard", "slot").withColumn("slot", slot_of(keys, lookup.slots))
    return slotted.join(F.broadcast(lookup.table), "slot").select(*rows.drop("shard", "slot").columns, "slot", "shard")


def write_shards(rows: DataFrame, keys: Sequence[str], lookup: Lookup, path: str, files: int = 1) -> None:
    """Write the rows to one folder per shard, each in ``files`` files or so, by key and so
    independent of how the input was dealt."""
    placed = place(rows, keys, lookup)
    part = F.pmod(F.xxhash64(*keys), F.lit(files))
    placed.repartition("shard", part).drop("slot").write.partitionBy("shard").parquet(path)
