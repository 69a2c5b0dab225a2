"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table:
an offset and a step from the MD5 of its name, so that ``(offset + j * step) mod
size`` visits each slot once. Shards take turns; at its turn a shard claims the
first slot of its order that is still free. A row's key hashes to a slot, the
slot names the shard. Shards get the same number of slots (to within one), and
adding or removing a shard moves few slots between the others.

Everything is SQL: the table is filled by one ``aggregate`` in one row, whose
size depends on the parameters alone, and rows find their shard by a broadcast
hash lookup of ``size`` rows; rows are never shuffled.

Defined cases: null parts of a key hash as an empty text, so all rows without
key share a slot; equal keys share a slot; an empty table gives no rows; other
columns pass unchanged, but for columns called ``slot`` or ``shard``, which are
replaced (they may be part of the key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
SLOTS_PER_SHARD = 100
MAX_SLOTS = 65_537
_FREE = "FFFF"


def table_size(shards: int, slots_per_shard: int = SLOTS_PER_SHARD) -> int:
    """The smallest prime that gives each shard at least so many slots."""
    size = max(shards * slots_per_shard, 2)
    while any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        size += 1
    return size


def _hashed(text: Column, size: int) -> Column:
    """The first 60 bits of the MD5, modulo size."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(size))


def lookup_table(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """One row per slot: ``slot``, ``shard`` (position of its name in the list).

    ``size`` must be prime, not below the number of shards and at most MAX_SLOTS.
    """
    if not 0 < len(shards) <= size <= MAX_SLOTS or len(shards) >= int(_FREE, 16):
        raise ValueError("the table needs between one slot per shard and MAX_SLOTS slots")
    if len(set(shards)) < len(shards):
        raise ValueError("shard names repeat")
    names = F.array(*[F.lit(name) for name in shards])
    orders = spark.range(1).select(
        F.transform(names, lambda n: _hashed(F.concat(n, F.lit("/offset")), size)).alias("offsets"),
        F.transform(names, lambda n: _hashed(F.concat(n, F.lit("/step")), size - 1) + 1).alias("steps"),
    )
    # A step tries one slot for the shard whose turn it is. Slots are two bytes each in a
    # binary, which is read and overwritten in place of copying an array of numbers.
    count = len(shards)
    filled = orders.selectExpr(
        f"""aggregate(
            sequence(1, {count * size}),
            named_struct('owners', unhex(repeat('{_FREE}', {size})), 'tried', array_repeat(0L, {count}),
                         'turn', 0, 'claimed', 0),
            (state, step) -> CASE WHEN state.claimed = {size} THEN state
                WHEN substring(state.owners, cast(2 * ((offsets[state.turn] + state.tried[state.turn] * steps[state.turn])
                     % {size}) + 1 as int), 2) = unhex('{_FREE}')
                THEN named_struct(
                    'owners', overlay(state.owners PLACING unhex(lpad(hex(state.turn), 4, '0'))
                        FROM cast(2 * ((offsets[state.turn] + state.tried[state.turn] * steps[state.turn]) % {size}) + 1 as int)
                        FOR 2),
                    'tried', transform(state.tried, (t, k) -> t + cast(k = state.turn as bigint)),
                    'turn', cast((state.turn + 1) % {count} as int), 'claimed', state.claimed + 1)
                ELSE named_struct(
                    'owners', state.owners,
                    'tried', transform(state.tried, (t, k) -> t + cast(k = state.turn as bigint)),
                    'turn', state.turn, 'claimed', state.claimed) END,
            state -> state.owners) AS owners"""
    )
    return filled.selectExpr("owners", f"explode(sequence(0L, {size - 1}L)) AS slot").selectExpr(
        "slot", "cast(conv(hex(substring(owners, cast(2 * slot + 1 as int), 2)), 16, 10) as int) AS shard"
    )


def place(rows: DataFrame, key: list[str], shards: list[str], size: int | None = None) -> DataFrame:
    """The rows with ``slot`` and ``shard``.

    A key shared by very many rows fills one shard; name a further column in
    ``key`` to spread it.
    """
    size = size or table_size(len(shards))
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key]
    slots = F.broadcast(lookup_table(rows.sparkSession, shards, size))  # size rows of 12 bytes
    others = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in ("slot", "shard")]
    placed = rows.select(*others, _hashed(F.concat_ws("\u001f", *parts), size).alias("slot"))
    return placed.join(slots, "slot", "left").select(*others, "slot", "shard")


def shard_names(count: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(count)]
