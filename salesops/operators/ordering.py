"""Global numbering and running totals without a single-partition window.

Both work on *distinct* values. A value that many rows share is therefore one
row here, whatever share of the input it holds, and partitions hold ranges of
values, so peers never sit in two of them. The only windows without a
PARTITION BY run over one row per shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesops.session import materialize, small_side

# Peers of one value are numbered in pieces of this many rows.
PIECE = 1 << 16
# monotonically_increasing_id() keeps the row's index in its partition in the low bits.
_ROW_BITS = 33


def _ahead(order: str) -> Window:
    return Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def number_rows(rows: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """1-based global row number in an order that has no ties.

    End the order with a unique column: the range partitions are cut on all of
    it, so rows that share the first columns spread over several partitions.
    """
    row_id = F.monotonically_increasing_id()
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row_id", row_id)
    ).select(
        *rows.columns,
        F.shiftright("_row_id", _ROW_BITS).alias("_range"),
        F.col("_row_id").bitwiseAND((1 << _ROW_BITS) - 1).alias("_index"),
    )
    ahead = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = ahead.select(
        F.col("_range").alias("_in_range"),
        F.coalesce(F.sum("_rows").over(_ahead("_range")), F.lit(0)).alias("_rows_ahead"),
    )
    return placed.join(F.broadcast(offsets), F.col("_range") == F.col("_in_range")).select(
        *rows.columns, (F.col("_rows_ahead") + F.col("_index") + 1).cast("bigint").alias(name)
    )


def number_output(ordered: DataFrame, name: str = "position") -> DataFrame:
    """1-based position of each row in the order that a frame comes in, for instance after ``orderBy``."""
    placed = ordered.withColumn("_place", F.monotonically_increasing_id())
    return number_rows(placed, [F.col("_place")], name).drop("_place")


def number_values(values: DataFrame, group: str, value: str) -> DataFrame:
    """1-based position of each distinct value within its group, in code-point order.

    One range shuffle for all groups together; the position is read off the
    sorted partitions, so no window touches the values.
    Returns ``group``, ``value``, ``position``.
    """
    row_id = F.monotonically_increasing_id()
    placed = materialize(
        values.select(group, value)
        .distinct()
        .repartitionByRange(group, value)
        .sortWithinPartitions(group, value)
        .select(
            group,
            value,
            F.shiftright(row_id, _ROW_BITS).alias("_range"),
            row_id.bitwiseAND((1 << _ROW_BITS) - 1).alias("_index"),
        )
    )
    return _shifted(placed, group).select(
        group, value, (F.col("_index") + F.col("_shift") + 1).cast("bigint").alias("position")
    )


def number_within(rows: DataFrame, group: str, order: list[Column], name: str = "position") -> DataFrame:
    """W5 within groups: 1-based row number in each group, in an order that has no ties.

    Ranges are cut on the group and the whole order, so a group with a large
    share of all rows spreads over many of them; the number is read off the
    sorted ranges and shifted by what the group has in earlier ones. No window
    touches the rows. NULL is a group of its own.
    """
    row_id = F.monotonically_increasing_id()
    placed = materialize(
        rows.repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .select(
            *rows.columns,
            F.shiftright(row_id, _ROW_BITS).alias("_range"),
            row_id.bitwiseAND((1 << _ROW_BITS) - 1).alias("_index"),
        )
    )
    shifted = F.col("_index") + F.col("_shift") + 1
    return _shifted(placed, group).select(*rows.columns, shifted.cast("bigint").alias(name))


def _shifted(placed: DataFrame, group: str) -> DataFrame:
    """Rows of sorted ranges with ``_shift``: what their group has in earlier ranges, less its first index in this one.

    One row per (range, group): at most ranges + groups rows, as ranges are contiguous. Groups may be many.
    """
    pieces = placed.groupBy("_range", group).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_index").alias("_first_index")
    )
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col("_range").alias("_in_range"),
        F.col(group).alias("_group"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first_index")).alias("_shift"),
    )
    on = (F.col("_range") == F.col("_in_range")) & F.col(group).eqNullSafe(F.col("_group"))
    return placed.join(small_side(starts), on)


def ordered_totals(rows: DataFrame, value: str, amount: str | None = None) -> DataFrame:
    """For each distinct value, largest first: what lies ahead of it and up to it.

    ``peers`` rows share the value; ``rows_before`` rows have a larger one, so
    the rank is ``rows_before + 1``; ``running_total`` sums ``amount`` over all
    rows down to and including the peers, as the default window frame does.
    ``all_rows`` and ``all_total`` repeat the grand totals.
    """
    placed, offsets = ranges_of_values(rows, value, amount)
    return running_in_ranges(placed, offsets, value)


def ranges_of_values(rows: DataFrame, value: str, amount: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct values with their peers, stored in ranges from the largest down; and what lies ahead of each range.

    ``_gain`` of a range is the total of its positive peers.
    """
    summed = F.sum(amount or value)
    placed = materialize(
        rows.groupBy(value)
        .agg(F.count(F.lit(1)).alias("peers"), summed.alias("peer_total"))
        .repartitionByRange(F.col(value).desc())
        .withColumn("_range", F.spark_partition_id())
    )
    gain = F.sum(F.when(F.col("peer_total") > 0, F.col("peer_total")))
    ranges = placed.groupBy("_range").agg(
        F.sum("peers").alias("_rows"), F.sum("peer_total").alias("_total"), F.coalesce(gain, F.lit(0)).alias("_gain")
    )
    everywhere = Window.partitionBy()
    offsets = ranges.select(
        "_range",
        "_gain",
        F.coalesce(F.sum("_rows").over(_ahead("_range")), F.lit(0)).alias("_rows_ahead"),
        F.coalesce(F.sum("_total").over(_ahead("_range")), F.lit(0)).alias("_total_ahead"),
        F.sum("_rows").over(everywhere).alias("all_rows"),
        F.sum("_total").over(everywhere).alias("all_total"),
    )
    return placed, offsets


def running_in_ranges(placed: DataFrame, offsets: DataFrame, value: str) -> DataFrame:
    """Running rows and totals of the values of some ranges."""
    local = Window.partitionBy("_range").orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_local_rows", F.sum("peers").over(local))
        .withColumn("_local_total", F.sum("peer_total").over(local))
        .join(F.broadcast(offsets), "_range")
        .select(
            value,
            "peers",
            "peer_total",
            (F.col("_rows_ahead") + F.col("_local_rows") - F.col("peers")).alias("rows_before"),
            (F.col("_rows_ahead") + F.col("_local_rows")).alias("running_rows"),
            (F.col("_total_ahead") + F.coalesce("_local_total", F.lit(0))).alias("running_total"),
            "all_rows",
            "all_total",
        )
    )


def expand_positions(totals: DataFrame) -> DataFrame:
    """One row per position from ``ordered_totals``, numbered by ``position``.

    Values with very many peers are cut into pieces that are spread over the
    cluster before they are expanded, so no task emits a hot value alone.
    """
    few = totals.where(F.col("peers") <= PIECE).withColumn(
        "position", F.explode(F.sequence(F.col("rows_before") + 1, F.col("running_rows")))
    )
    piece_starts = F.sequence(
        F.col("rows_before") + 1, F.col("running_rows"), F.lit(PIECE).cast("bigint")
    )
    many = (
        totals.where(F.col("peers") > PIECE)
        .withColumn("_start", F.explode(piece_starts))
        .repartition("_start")
        .withColumn(
            "position",
            F.explode(
                F.sequence(F.col("_start"), F.least(F.col("_start") + (PIECE - 1), F.col("running_rows")))
            ),
        )
        .drop("_start")
    )
    return few.unionByName(many)


def rank_within(rows: DataFrame, ranks: dict[str, tuple[str | None, str]]) -> DataFrame:
    """W1, W2, W5 in several orders and within groups: competition ranks, largest first; equal values share one.

    ``ranks`` maps the new column to (group, value); without a group the order is
    over all rows. All orders share one range shuffle of (order, group, value),
    one row per different value, cut on all three: a group with a large share of
    the rows spreads over ranges, as does an order. Inside a range values are
    counted, and each (order, group) is shifted by what it has in earlier ranges,
    one row per range and group. NULL values are ranked last, NULL is a group.
    ``rows`` is read once per rank and once for all of them: pass a stored frame.
    """
    names = list(ranks)
    entries = [
        F.struct(
            F.lit(number).alias("_order"),
            (F.col(group).cast("string") if group else F.lit(None).cast("string")).alias("_group"),
            *[(F.col(value) if at == number else F.lit(None).cast(dict(rows.dtypes)[ranks[other][1]])).alias(f"_v{at}") for at, other in enumerate(names)],
        )
        for number, (group, value) in enumerate(ranks.values())
    ]
    values = [f"_v{at}" for at in range(len(names))]
    segment = [F.col("_order"), F.col("_group")]
    down = [F.col(v).desc() for v in values]
    placed = materialize(
        rows.select(F.inline(F.array(*entries)))
        .groupBy("_order", "_group", *values)
        .agg(F.count(F.lit(1)).alias("_peers"))
        .repartitionByRange(*segment, *down)
        .withColumn("_range", F.spark_partition_id())
    )
    # One row per range and segment: at most ranges + segments, as ranges are contiguous.
    pieces = placed.groupBy("_range", "_order", "_group").agg(F.sum("_peers").alias("_rows"))
    earlier = Window.partitionBy("_order", "_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col("_range").alias("_in"), F.col("_order").alias("_of"), F.col("_group").alias("_g"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_ahead"),
    )
    local = Window.partitionBy("_range", "_order", "_group").orderBy(*down).rowsBetween(Window.unboundedPreceding, -1)
    same = (F.col("_range") == F.col("_in")) & (F.col("_order") == F.col("_of")) & F.col("_group").eqNullSafe(F.col("_g"))
    ranked_values = materialize(
        placed.withColumn("_local", F.coalesce(F.sum("_peers").over(local), F.lit(0)))
        .join(small_side(offsets), same)
        .select("_order", "_group", *values, (F.col("_ahead") + F.col("_local") + 1).cast("bigint").alias("_rank"))
    )
    ranked = rows
    for number, (name, (group, value)) in enumerate(ranks.items()):
        table = ranked_values.where(F.col("_order") == number).select(
            F.col("_group").alias(f"_g{number}"), F.col(f"_v{number}"), F.col("_rank").alias(name)
        )
        on = F.col(value).eqNullSafe(F.col(f"_v{number}"))
        if group:
            on = on & F.col(group).cast("string").eqNullSafe(F.col(f"_g{number}"))
        ranked = ranked.join(table, on, "left").drop(f"_g{number}", f"_v{number}")
    return ranked


def add_ranks(rows: DataFrame, ranks: dict[str, str]) -> DataFrame:
    """Competition ranks over all rows, largest first, from one range shuffle; ``ranks`` maps new columns to ranked ones.

    Rank tables are unique on the value, so a value many rows share is split by the skew join.
    """
    return rank_within(rows, {name: (None, value) for name, value in ranks.items()})


def shift_over_ranges(
    rows: DataFrame,
    order: list[Column],
    lagged: dict[str, tuple[str, int]] | None = None,
    firsts: dict[str, str] | None = None,
) -> DataFrame:
    """W7, W8 over any number of rows: values of earlier rows, and of the first row, in an order without ties.

    ``lagged`` maps a new column to (column, rows back, 1 or more), ``firsts`` to a
    column. Sorted ranges are stored with each row's place. Inside a range the
    window stays there; the first rows of a range take theirs from what the ranges
    before hand over, the last few values of each, one row per range. No window
    runs over all rows. NULLs are values as any other.
    """
    lagged, firsts = lagged or {}, firsts or {}
    most = max((back for _, back in lagged.values()), default=1)
    row_id = F.monotonically_increasing_id()
    placed = materialize(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*rows.columns, F.shiftright(row_id, _ROW_BITS).alias("_range"), row_id.bitwiseAND((1 << _ROW_BITS) - 1).alias("_index"))
    )
    sizes = placed.groupBy("_range").agg(F.max("_index").alias("_last"))
    handed = {c: f"_c{k}" for k, c in enumerate(dict.fromkeys(c for c, _ in lagged.values()))}
    # The last rows of each range, at most ``most``: nothing else of it is read by the ranges after.
    ends = (
        placed.join(F.broadcast(sizes.withColumnRenamed("_range", "_of")), F.col("_range") == F.col("_of"))
        .where(F.col("_index") > F.col("_last") - most)
        .groupBy("_range")
        .agg(F.sort_array(F.collect_list(F.struct("_index", *[F.col(c).alias(n) for c, n in handed.items()]))).alias("_ends"))
    )
    # As many non-empty ranges back as rows are asked for hold enough rows, each at least one.
    back = Window.orderBy("_range").rowsBetween(-most, -1)
    borders = ends.select(F.col("_range").alias("_of"), F.flatten(F.collect_list("_ends").over(back)).alias("_before"))
    local = Window.partitionBy("_range").orderBy("_index")
    joined = placed.join(F.broadcast(borders), F.col("_range") == F.col("_of"))
    found = []
    for name, (column, back_by) in lagged.items():
        # From the end of what was handed over: 1 is the row just before the range.
        place = F.size("_before") - (F.lit(back_by) - F.col("_index")).cast("int")
        border = F.get(F.col("_before"), place)[handed[column]]
        inside = F.lag(column, back_by).over(local)
        found.append(F.when(F.col("_index") >= back_by, inside).otherwise(F.when(place >= 0, border)).alias(name))
    shifted = joined.select(*rows.columns, "_range", "_index", *found)
    opening = placed.where("_index = 0")
    values = {n: opening.agg(F.min_by(c, "_range")).scalar() for n, c in firsts.items()}
    return shifted.select(*rows.columns, *lagged, *[value.alias(n) for n, value in values.items()])
