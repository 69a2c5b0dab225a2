"""Row-level cleaning: keep-last, sentinels, required values, orphans."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from salesops.functions import is_blank, null_if_sentinel
from salesops.session import materialize, measure

# Texts that stand for a missing date.
DATE_SENTINELS = ("Na", "NA", "N/A", "nan", "None")


def _as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _same_key(pk: list[str]) -> Column:
    """Equality with the columns ``_0``, ``_1`` ... of the other side; NULL equals NULL."""
    condition = F.lit(True)
    for i, c in enumerate(pk):
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{i}"))
    return condition


def last_first(ordinal: Column | str) -> Column:
    """An ordinal as an order without NULL: rows without one come before all others."""
    ordinal = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return F.struct(ordinal.isNotNull().alias("known"), ordinal.alias("ordinal"))


def _order(df: DataFrame, ordinal: Column | str) -> Column:
    """The ordinal, and among equal ones the content: the same row is last in every run."""
    return F.struct(last_first(ordinal).alias("order"), F.xxhash64(*df.columns).alias("content"))


def _last_per_key(df: DataFrame, pk: list[str], ordinal: Column | str) -> DataFrame:
    row = F.struct(*[F.col(c) for c in df.columns if c not in pk])
    last = df.groupBy(*pk).agg(F.max_by(row, _order(df, ordinal)).alias("_row"))
    return last.select(*[F.col(c) if c in pk else F.col("_row")[c].alias(c) for c in df.columns])


# Bits of the filter of repeated keys, and how many of them are one row of it (Spark's bitmaps have that size).
FILTER_BITS = 1 << 27
_BITMAP_BITS = 1 << 15


def _key_bit(pk: list[str], prefix: str = "") -> Column:
    """The bit of a key: its hash within the filter, whose size is fixed."""
    return F.pmod(F.xxhash64(*[F.col(f"{prefix}{c}") for c in pk]), F.lit(FILTER_BITS))


def _may_repeat(df: DataFrame, pk: list[str], repeated: DataFrame) -> DataFrame:
    """The rows with a flag ``_hit``: true for every row of a repeated key, and for few others.

    A bit of a fixed-size bitmap is set for each repeated key. The bitmap is at
    most ``FILTER_BITS`` / 8 bytes (16 MB), however many keys there are, and is
    broadcast for that reason alone.
    """
    bits = repeated.select(_key_bit([f"{i}" for i in range(len(pk))], "_").alias("_bit"))
    bitmap = bits.groupBy(F.floor(F.col("_bit") / _BITMAP_BITS).alias("_slot")).agg(
        F.bitmap_construct_agg(F.col("_bit") % _BITMAP_BITS).alias("_bits")
    )
    placed = df.withColumn("_bit", _key_bit(pk))
    found = placed.join(F.broadcast(bitmap), F.floor(F.col("_bit") / _BITMAP_BITS) == F.col("_slot"), "left")
    # Bits of a byte count from the lowest.
    byte = F.conv(F.hex(F.expr("substring(_bits, int((_bit % 32768) div 8) + 1, 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    return found.withColumn("_hit", hit).select(*df.columns, "_hit")


def _repeated_keys(df: DataFrame, pk: list[str]) -> tuple[DataFrame, int, bool]:
    """Stored keys that occur more than once (``_0``, ``_1`` ...), their number, and whether they are few."""
    counted = df.groupBy(*[F.col(c).alias(f"_{i}") for i, c in enumerate(pk)]).agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(counted.where("_n > 1").drop("_n"))
    return (repeated, *measure(repeated))


def _parted(df: DataFrame, pk: list[str], repeated: DataFrame, small: bool) -> tuple[DataFrame, DataFrame]:
    """Rows that surely have a key of their own, and all others; neither part is shuffled for that."""
    if small:
        keys = F.broadcast(repeated)
        return df.join(keys, _same_key(pk), "left_anti"), df.join(keys, _same_key(pk), "left_semi")
    flagged = _may_repeat(df, pk, repeated)
    return flagged.where(~F.col("_hit")).drop("_hit"), flagged.where("_hit").drop("_hit")


def dedupe_keep_last(df: DataFrame, pk: str | Iterable[str], ordinal: Column | str) -> DataFrame:
    """One row per key, the last by ``ordinal``. NULL keys are one key, a NULL ordinal comes first.

    Runs a job at once, to find the repeated keys, counted on the key columns
    alone. If there are none, the frame is returned as it is. Otherwise whole rows
    are shuffled only for repeated keys: all others pass a broadcast anti join or,
    if the repeated keys are many, a broadcast filter of fixed size, which lets
    few others through to the exact step. That step merges on the map side, so a
    key with a large share of the rows reaches the shuffle as one row per task.
    ``df`` is read up to three times: pass a scan or a stored frame.
    """
    pk = _as_list(pk)
    repeated, count, small = _repeated_keys(df, pk)
    if count == 0:
        return df
    single, others = _parted(df, pk, repeated, small)
    return single.unionByName(_last_per_key(others, pk, ordinal))


def duplicate_report(
    df: DataFrame, pk: str | Iterable[str], ordinal: Column | str, beside: Iterable[str] = ()
) -> DataFrame:
    """Keys that occur more than once: rows lost by keep-last, and whether they differ.

    Copies are counted by content first, so a hot key is merged before the
    second step. ``lost_conflicting`` counts lost rows whose content is not that
    of the row kept. The ordinal is not content; if it is an expression, name
    its columns in ``beside``.
    """
    pk = _as_list(pk)
    ignored = {*pk, *beside, *([ordinal] if isinstance(ordinal, str) else ())}
    content = F.struct(*[F.col(c) for c in df.columns if c not in ignored])
    variants = df.groupBy(*pk, F.xxhash64(content).alias("_content")).agg(
        F.count(F.lit(1)).alias("_copies"), F.max(last_first(ordinal)).alias("_latest")
    )
    per_key = variants.groupBy(*pk).agg(
        F.sum("_copies").alias("total_rows"),
        F.max_by("_copies", "_latest").alias("_same_as_kept"),
        F.count(F.lit(1)).alias("variants"),
    )
    return per_key.where(F.col("total_rows") > 1).select(
        *pk,
        "total_rows",
        (F.col("total_rows") - 1).alias("lost"),
        (F.col("total_rows") - F.col("_same_as_kept")).alias("lost_conflicting"),
        "variants",
    )


def discarded_rows(df: DataFrame, pk: str | Iterable[str], ordinal: Column | str, spread: int = 64) -> DataFrame:
    """The rows that keep-last removes: with the rows it keeps they are the input, row by row.

    Only rows of repeated keys can be among them; these are stored, the others are
    passed over as in ``dedupe_keep_last``. The last row of a key is the last of
    the last rows of its ``spread`` parts, so that a hot key is not sorted in one
    task: rows that are not their part's last are discarded at once, and the
    parts' last rows, at most ``spread`` per key, are compared with each other.
    Of rows equal in everything all but one are discarded. Runs jobs at once.
    """
    pk = _as_list(pk)
    repeated, count, small = _repeated_keys(df, pk)
    if count == 0:
        return df.limit(0)
    order = F.struct(last_first(ordinal).alias("order"), F.xxhash64(*df.columns).alias("content"))
    others = _parted(df, pk, repeated, small)[1]
    part = F.pmod(F.monotonically_increasing_id(), F.lit(spread))
    stored = materialize(others.withColumn("_order", order).withColumn("_part", part))
    keys = [F.col(f"`{c}`") for c in pk]
    latest = F.col("_order").desc()
    in_part = stored.withColumn("_back", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(latest)))
    lasts = in_part.where("_back = 1").withColumn("_back", F.row_number().over(Window.partitionBy(*keys).orderBy(latest)))
    return in_part.where("_back > 1").unionByName(lasts.where("_back > 1")).select(*df.columns)


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name contains the pattern, ignoring case."""
    return [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]


def null_sentinels(df: DataFrame, name_pattern: str = "date", sentinels: Iterable[str] = DATE_SENTINELS) -> DataFrame:
    """Blank out sentinel texts in the columns whose name matches."""
    matched = set(columns_matching(df, name_pattern))
    return df.select(
        *[null_if_sentinel(c, sentinels).alias(c) if c in matched else F.col(c) for c in df.columns]
    )


def require_non_blank(df: DataFrame, column: str) -> DataFrame:
    """Drop rows without a value in a required column."""
    return df.where(~is_blank(df, column))


def drop_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Keep rows whose key exists in the parent, and rows without a key.

    Only distinct keys are compared with the parent, so a key that many rows
    share is one row there and whole child rows need no shuffle: the orphan
    keys, if few, are broadcast into an anti join, which lets rows without a
    key pass. Without orphans the child is returned as it is. ``child`` is read twice: pass a scan or a stored frame.
    """
    keys = parent.select(F.col(pk).alias("_parent_key"))
    references = child.where(~is_blank(child, fk)).select(F.col(fk).alias("_orphan")).distinct()
    orphans = materialize(references.join(keys, F.col("_orphan") == F.col("_parent_key"), "left_anti"))
    count, small = measure(orphans)
    if count == 0:
        return child
    return child.join(F.broadcast(orphans) if small else orphans, F.col(fk) == F.col("_orphan"), "left_anti")


def drop_orphans_chain(
    tables: Mapping[str, DataFrame], edges: Iterable[tuple[str, str, str, str]]
) -> dict[str, DataFrame]:
    """N13 along (child, fk, parent, pk) edges, given parents first.

    Each step stores its orphan keys only, which also cuts the lineage: a level
    is its own table minus stored keys, however long the chain is.
    """
    kept = dict(tables)
    for child, fk, parent, pk in edges:
        kept[child] = drop_orphans(kept[child], fk, kept[parent], pk)
    return kept


def rename_positional(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """New names by position."""
    return df.toDF(*names)


def row_count(df: DataFrame, step: str, table: str, metric: str = "rows") -> DataFrame:
    """One audit row with the number of rows of a frame."""
    return df.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit(step).alias("step"), F.lit(table).alias("table"), F.lit(metric).alias("metric"), "value"
    )


def store_counted(df: DataFrame, conditions: Mapping[str, Column | None]) -> tuple[DataFrame, dict[str, int]]:
    """A stored frame, and how many of its rows meet each condition (None: all), counted by the job that writes it."""
    observation = Observation()
    counts = [
        F.count(F.lit(1) if c is None else F.when(c, F.lit(1))).alias(name) for name, c in conditions.items()
    ]
    stored = materialize(df.observe(observation, *counts))
    return stored, dict(observation.get)


def audit_rows(session: SparkSession, step: str, table: str, values: Mapping[str, int]) -> DataFrame:
    """Audit rows of numbers that a job has counted on its way."""
    rows = [(step, table, metric, value) for metric, value in values.items()]
    return session.createDataFrame(rows, "step string, table string, metric string, value bigint")


def audit_log(entries: Iterable[DataFrame]) -> DataFrame:
    """The audit rows (step, table, metric, value) as one frame."""
    log = None
    for entry in entries:
        log = entry if log is None else log.unionByName(entry)
    return log


def before_after(step: str, table: str, before: DataFrame, after: DataFrame) -> list[DataFrame]:
    """Rows before and after a step."""
    return [row_count(before, step, table, "rows_before"), row_count(after, step, table, "rows_after")]


def profile_lookup(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and distinct non-NULL values of each lookup, in one shuffle.

    Values are counted per lookup and value first, so a frequent value is
    merged on the map side. A lookup without rows gets zeros.
    """
    union = None
    for number, (df, column) in enumerate(tables.values()):
        part = df.select(F.lit(number).alias("_lookup"), F.col(column).cast("string").alias("value"))
        union = part if union is None else union.unionByName(part)
    per_value = union.groupBy("_lookup", "value").agg(F.count(F.lit(1)).alias("n"))
    profile = per_value.groupBy("_lookup").agg(
        F.sum("n").alias("total_rows"), F.count("value").alias("distinct_values")
    )
    session = union.sparkSession
    declared = session.createDataFrame(list(enumerate(tables)), "_lookup int, table string")
    none = F.lit(0).cast("bigint")
    return declared.join(profile, "_lookup", "left").select(
        "table", F.coalesce("total_rows", none).alias("total_rows"), F.coalesce("distinct_values", none).alias("distinct_values")
    )
