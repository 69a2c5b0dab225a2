"""The business questions as operators. Columns are arguments, so one function
serves any schema. Money comes as decimals, or as integers in ``1/minor`` units;
both are summed exactly.

Equal results are ordered by the group as a last key, so output is stable."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesops.functions import (
    days_between,
    major_units,
    mean,
    percent,
    quarter_number,
    quarter_text,
    round_half_up,
    wide,
)
from salesops.operators.ordering import (
    add_ranks,
    expand_positions,
    number_values,
    ordered_totals,
    ranges_of_values,
    running_in_ranges,
)
from salesops.session import materialize, small_side


def period_sales(
    lines: DataFrame, date: str, category: str, parent_key: str, qty: str, amount: str, label: str = "category",
    minor: int = 1, reduced: bool = False,
) -> DataFrame:
    """Q1: quarter x category: distinct parents, units, revenue; in order. See ``period_totals``."""
    return period_totals(lines, date, category, parent_key, qty, amount, label, minor, reduced).orderBy(
        "quarter", F.desc("revenue"), label
    )


def period_totals(
    lines: DataFrame, date: str, category: str, parent_key: str, qty: str, amount: str, label: str = "category",
    minor: int = 1, reduced: bool = False,
) -> DataFrame:
    """Q1 without its order, for further steps.

    Lines are grouped by a quarter number; its text is made per result row.
    ``reduced``: there is one line per parent and category, so that parents need
    no distinct count.
    """
    parents = F.count(parent_key) if reduced else F.countDistinct(parent_key)
    return (
        lines.groupBy(quarter_number(date).alias("_quarter"), F.col(category).alias(label))
        .agg(
            parents.alias("orders"),
            F.sum(qty).alias("units_sold"),
            major_units(F.sum(amount), minor).alias("revenue"),
        )
        .select(quarter_text("_quarter").alias("quarter"), label, "orders", "units_sold", "revenue")
    )


def pivot_sum(df: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Q1p: one column per value of a column, summed, 0 where there is nothing.

    The sums per row and value are stored before the values are read from them,
    so that ``df`` is evaluated once; the job runs at once. More values than
    ``spark.sql.pivotMaxValues`` are an error, as in Spark's own pivot; a NULL value is the
    column ``null``.
    """
    totals = materialize(df.groupBy(row, column).agg(F.sum(value).alias("_total")))
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    values = [r[0] for r in totals.select(column).distinct().orderBy(column).limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"column {column} has more than {most} values")
    return totals.groupBy(row).pivot(column, values).agg(F.sum("_total")).fillna(0).orderBy(row)


def head_ordered(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """Q1h: first k rows of an order (a distributed top-k)."""
    return df.orderBy(*order).limit(k)


def leaderboard(facts: DataFrame, group: str, key: str, amount: str, minor: int = 1) -> DataFrame:
    """Q2: per group distinct orders, total and average amount."""
    return (
        facts.groupBy(group)
        .agg(
            F.countDistinct(key).alias("total_orders"),
            major_units(F.sum(amount), minor).alias("total_revenue"),
            round_half_up(mean(amount, minor), 0).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), group)
    )


def distinct_by_bitmap(df: DataFrame, groups: Sequence[str], key: str, name: str = "distinct_keys") -> DataFrame:
    """Exact distinct keys per group by bitmaps, for keys that are numbered densely.

    A key is a bit: its bucket, of 32,768 keys, and its place there. Tasks set bits
    before they pass anything on, so what is shuffled is one bitmap of 4 KB per
    (group, bucket) and task instead of every (group, key) pair; a hot group is
    spread by its buckets. Integer keys are taken as they are; other keys are
    numbered first (N2), which costs a shuffle of the distinct keys and a join.
    NULL keys do not count, a group of NULL keys has 0. For keys that are sparse
    within groups a plain distinct count is cheaper.
    """
    if dict(df.dtypes)[key] not in ("tinyint", "smallint", "int", "bigint"):
        numbered = number_values(df.where(F.col(key).isNotNull()).select(F.lit(0).alias("_all"), key), "_all", key)
        numbers = small_side(numbered.select(F.col(key).alias("_text"), F.col("position").alias("_number")))
        df = df.select(*groups, key).join(numbers, F.col(key) == F.col("_text"), "left").select(*groups, F.col("_number").alias(key))
    number = F.col(key).cast("bigint")
    per_bucket = df.groupBy(*groups, F.bitmap_bucket_number(number).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")
    )
    counted = F.when(F.col("_bucket").isNull(), 0).otherwise(F.bitmap_count("_bits"))
    return per_bucket.groupBy(*groups).agg(F.sum(counted).cast("bigint").alias(name))


def rate_by_group(df: DataFrame, group: str, hit: Column, score: str) -> DataFrame:
    """Q3: per group rows, hits, hit rate and average score."""
    won = F.sum(F.when(hit, 1).otherwise(0))
    rows = F.count(F.lit(1))
    return (
        df.groupBy(group)
        .agg(
            rows.alias("total_leads"),
            won.alias("won"),
            percent(won, rows).alias("win_rate_pct"),
            round_half_up(mean(score), 1).alias("avg_lead_score"),
        )
        .orderBy(F.desc("win_rate_pct"), group)
    )


def count_and_mean(
    df: DataFrame, groups: Sequence[str], key: str, score: str, order: Sequence[Column | str], count_name: str = "total_leads"
) -> DataFrame:
    """Rows with a key and their average score per group."""
    return (
        df.groupBy(*groups)
        .agg(F.count(key).alias(count_name), round_half_up(mean(score), 1).alias("avg_lead_score"))
        .orderBy(*order, *groups)
    )


def mix(df: DataFrame, group: str, key: str, qty: str, label: str) -> DataFrame:
    """Q5: lines and units per tier."""
    return (
        df.groupBy(F.col(group).alias(label))
        .agg(F.count(key).alias("line_items"), F.sum(qty).alias("units_sold"))
        .orderBy(F.desc("units_sold"), label)
    )


def rep_leaderboard(facts: DataFrame, rep: str, key: str, amount: str, reps: DataFrame, minor: int = 1) -> DataFrame:
    """A1: per rep deals, revenue, share, estimated commission, and both ranks.

    ``reps`` has the columns rep, ``user_name`` and ``rate`` (percent). The facts
    are reduced to one row per rep before they meet ``reps``, and that result is
    stored; ranks and the total read the stored rows, so nothing passes through
    a window over all reps. Jobs run at once; so they do in ``pareto_curve``.
    """
    totals = facts.groupBy(rep).agg(F.countDistinct(key).alias("deals"), F.sum(amount).alias("revenue"))
    stored = materialize(
        totals.join(reps, rep).select(
            "user_name",
            "deals",
            "revenue",
            (major_units("revenue", minor).cast("double") * F.col("rate").cast("double")).alias("_earned"),
        )
    )
    total = stored.agg(F.sum(wide(stored, "revenue"))).scalar()
    ranked = add_ranks(stored, {"revenue_rank": "revenue", "commission_rank": "_earned"})
    return ranked.select(
        "user_name",
        "deals",
        major_units("revenue", minor).alias("revenue"),
        "revenue_rank",
        percent(major_units("revenue", minor), major_units(total, minor)).alias("pct_of_total"),
        round_half_up(F.try_divide(F.col("_earned"), F.lit(100.0)), 0).alias("est_commission"),
        "commission_rank",
    ).orderBy("revenue_rank", "user_name")


def pareto_curve(facts: DataFrame, entity: str, amount: str, minor: int = 1) -> DataFrame:
    """A2: cumulative share of entities against cumulative share of the amount.

    Entities with the same amount are alike in the result, so the curve is
    computed on distinct amounts and each one is expanded to its positions.
    """
    per_entity = facts.groupBy(entity).agg(F.sum(amount).alias("revenue"))
    per_entity = per_entity.withColumn("revenue", wide(per_entity, "revenue"))
    totals = ordered_totals(per_entity, "revenue")
    return (
        expand_positions(totals)
        .select(
            F.col("position").alias("rank"),
            percent("position", "all_rows").alias("pct_accounts"),
            percent(major_units("running_total", minor), major_units("all_total", minor)).alias("pct_revenue_cum"),
        )
        .orderBy("rank")
    )


def pareto_cutoff(curve: DataFrame, pct: float = 80) -> DataFrame:
    """The first point of a curve at or above a share."""
    return curve.where(F.col("pct_revenue_cum") >= pct).orderBy("rank").limit(1)


def pareto_point(facts: DataFrame, entity: str, amount: str, pct: float = 80, minor: int = 1) -> DataFrame:
    """A2c without the curve: the first point at or above a share, found by weighted selection.

    Ranges of amounts know their totals, so the one that holds the point is known
    before any row of it is read; only that range is opened. As amounts fall, the
    running total is highest where they turn negative: a range can hold the point
    if the total before it and its positive part together reach the share. No
    entity is expanded; equal amounts share a point, whose rank is their first.
    """
    per_entity = facts.groupBy(entity).agg(F.sum(amount).alias("revenue"))
    per_entity = per_entity.withColumn("revenue", wide(per_entity, "revenue"))
    return first_at_share(per_entity, "revenue", pct, minor)


def first_at_share(rows: DataFrame, value: str, pct: float, minor: int = 1) -> DataFrame:
    """The first point of the curve of ``value``, largest first, whose rounded share is ``pct`` or more."""
    placed, offsets = ranges_of_values(rows, value)

    def share(total: Column) -> Column:
        return percent(major_units(total, minor), major_units(F.col("all_total"), minor))

    # One row per range. A total that is not positive makes no rising curve: then every range is opened.
    reach = share(F.col("_total_ahead") + F.col("_gain"))
    able = offsets.where((F.col("all_total") <= 0) | (reach >= pct))
    chosen = able.select(F.min(F.when(F.col("all_total") > 0, F.col("_range"))).alias("r"), F.max("_range").alias("last")).first()
    opened = placed.where(F.lit(False)) if chosen["last"] is None else placed
    if chosen["r"] is not None:
        opened = placed.where(F.col("_range") == chosen["r"])
    return (
        running_in_ranges(opened, offsets, value)
        .select(
            (F.col("rows_before") + 1).alias("rank"),
            percent(F.col("rows_before") + 1, "all_rows").alias("pct_accounts"),
            share(F.col("running_total")).alias("pct_revenue_cum"),
        )
        .where(F.col("pct_revenue_cum") >= pct)
        .orderBy("rank")
        .limit(1)
    )


def funnel(stages: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """A3: distinct keys per stage, share of the first and of the previous stage.

    The counts are distributed; the windows run over one row per stage.
    """
    counts = None
    for step, (name, df, key) in enumerate(stages, start=1):
        one = df.agg(F.countDistinct(key).alias("cnt")).select(
            F.lit(step).alias("step"), F.lit(name).alias("stage_name"), "cnt"
        )
        counts = one if counts is None else counts.unionByName(one)
    return _shares(counts)


def funnel_of_counts(counts: DataFrame, stages: Sequence[tuple[str, str]]) -> DataFrame:
    """A3 from one row of counts: ``stages`` are (name, column)."""
    rows = F.array(
        *[
            F.struct(F.lit(step).alias("step"), F.lit(name).alias("stage_name"), F.col(column).alias("cnt"))
            for step, (name, column) in enumerate(stages, start=1)
        ]
    )
    return _shares(counts.select(F.inline(rows)))


def _shares(counts: DataFrame) -> DataFrame:
    in_order = Window.orderBy("step")
    return (
        counts.withColumn("pct_of_leads", percent("cnt", F.first_value("cnt").over(in_order)))
        .withColumn("step_conversion", percent("cnt", F.lag("cnt").over(in_order)))
        .orderBy("step")
        .drop("step")
    )


def rate_by_band(
    df: DataFrame, entity: str, measure: str, hit: Column, bands: Sequence[tuple[float | None, str]], ordered: bool = False
) -> DataFrame:
    """A4, A4o: entities banded by their largest measure; hit rate per band.

    ``bands`` are (inclusive upper bound, label); the last one takes everything
    else, also entities without a measure. ``ordered`` keeps the bands' order
    instead of sorting by rate.
    """
    per_entity = df.groupBy(entity).agg(
        F.max(measure).alias("_top"), F.max(F.when(hit, 1).otherwise(0)).alias("_hit")
    )
    number = None
    for position, (upper, _) in enumerate(bands[:-1]):
        within = F.col("_top") <= upper
        number = F.when(within, position) if number is None else number.when(within, position)
    number = number.otherwise(len(bands) - 1) if number is not None else F.lit(0)
    labels = F.array(*[F.lit(label) for _, label in bands])
    won = F.sum("_hit")
    rows = F.count(F.lit(1))
    result = (
        per_entity.groupBy(number.alias("_band"))
        .agg(rows.alias("opportunities"), won.alias("won"), percent(won, rows).alias("win_rate_pct"))
        .withColumn("discount_band", F.element_at(labels, F.col("_band") + 1))
    )
    order = ["_band"] if ordered else [F.desc("win_rate_pct"), "_band"]
    return result.orderBy(*order).select("discount_band", "opportunities", "won", "win_rate_pct")


def cycle_time(df: DataFrame, group: str, start: str, end: str, fastest: bool = True) -> DataFrame:
    """A5: per group rows, mean days from start to end, and the fastest."""
    days = days_between(end, start)
    measures = [F.count(F.lit(1)).alias("deals"), round_half_up(mean(days), 0).alias("avg_cycle_days")]
    if fastest:
        measures.append(F.min(days).alias("fastest_days"))
    return df.groupBy(group).agg(*measures).orderBy("avg_cycle_days", group)


def above_group_mean(
    df: DataFrame, group: str, name: str, score: str, k: int, tie: str, group_name: str | None = None
) -> DataFrame:
    """Rows scoring above the mean of their group; the k largest gaps.

    The comparison uses the exact mean, the reported mean and the gap use the
    rounded one. Group means are broadcast only if they are few; ``df`` is read
    twice.
    """
    means = small_side(
        df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("_group")).agg(mean(score).alias("_mean"))
    )
    shown = group_name or group
    return (
        df.join(means, F.col(group) == F.col("_group"))
        .where(F.col(score).cast("double") > F.col("_mean"))
        .withColumn("city_avg_score", round_half_up("_mean", 1))
        .orderBy((F.col(score).cast("double") - F.col("city_avg_score")).desc(), tie)
        .limit(k)
        .select(shown, name, score, "city_avg_score")
    )


def payment_behaviour(
    df: DataFrame, method: str, issued: str, due: str, paid: str, fee: str, overdue_count: bool = True,
    minor: int = 1,
) -> DataFrame:
    """Paid documents per method: overdue share, days to pay, late fees."""
    rows = F.count(F.lit(1))
    late = F.sum(F.when(F.col(paid) > F.col(due), 1).otherwise(0))
    measures = [rows.alias("paid_invoices")]
    if overdue_count:
        measures.append(late.alias("overdue"))
    measures += [
        percent(late, rows).alias("overdue_pct"),
        round_half_up(mean(days_between(paid, issued)), 0).alias("avg_days_to_pay"),
        round_half_up(major_units(F.sum(wide(df, fee)), minor), 0).alias("total_late_fees"),
    ]
    return (
        df.where(F.col(paid).isNotNull())
        .groupBy(F.col(method).alias("payment_method"))
        .agg(*measures)
        .orderBy(F.desc("overdue_pct"), "payment_method")
    )


def open_deal_aging(
    df: DataFrame, stage: str, open_stages: Iterable[str], expected: str, amount: str, as_of: Column,
    minor: int = 1,
) -> DataFrame:
    """Open rows past their expected date: count, value, mean days over.

    ``as_of`` is a date or a one-value subquery.
    """
    days = days_between(as_of, expected)
    return (
        df.where(F.col(stage).isin(*open_stages))
        .select(F.col(stage).alias("stage"), F.col(amount).alias("_amount"), days.alias("_days"))
        .where(F.col("_days") > 0)
        .groupBy("stage")
        .agg(
            F.count(F.lit(1)).alias("stuck_deals"),
            round_half_up(major_units(F.sum("_amount"), minor), 0).alias("pipeline_value"),
            round_half_up(mean("_days"), 0).alias("avg_days_overdue"),
        )
        .orderBy(F.desc("pipeline_value"), "stage")
    )
