"""Bitmaps, ranks within groups, values of earlier rows, the cutoff of a curve and keep-last beyond the broadcast bound."""

import random
import re

import pytest
from pyspark.sql import functions as F

from salesops.operators import analytics, rows
from salesops.operators.ordering import number_within, rank_within, shift_over_ranges
from salesops.plans.given import reports, storage
from salesops.plans.given.registry import GivenTables
from salesops.session import materialize

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_count_exactly(spark):
    rnd = random.Random(2)
    keys = [None, 0, -1, -40_000, 32_767, 32_768, 2**40, 5, 5, *(rnd.randrange(-100_000, 100_000) for _ in range(3000))]
    data = [(rnd.choice(["x", "y", None]), k, None if k is None else f"k{k % 700}") for k in keys * 2] + [("only null", None, None)]
    df = spark.createDataFrame(data, "g string, k long, t string")
    for column, place in (("k", 1), ("t", 2)):
        got = {r.g: r.n for r in analytics.distinct_by_bitmap(df, ["g"], column, "n").collect()}
        assert got == {g: len({r[place] for r in data if r[0] == g} - {None}) for g in {r[0] for r in data}}
    assert analytics.distinct_by_bitmap(df.limit(0), ["g"], "k").collect() == []
    # Between the tasks go bitmaps by group and bucket, then numbers by group; no keys.
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(analytics.distinct_by_bitmap(df, ["g"], "k")))
    assert len(exchanges) == 2 and all("g#" in e for e in exchanges) and not any(re.search(r"\bk#", e) for e in exchanges)


def test_ranks_within_groups(many_ranges):
    """A group with most rows, ties, NULL groups and values, several orders at once."""
    rnd = random.Random(4)
    data = [(i, rnd.choice(["hot"] * 8 + ["a", "b", None]), rnd.choice([None, *range(60)]), rnd.random()) for i in range(2000)]
    stored = materialize(many_ranges.createDataFrame(data, "id int, g string, v int, w double"))
    ranks = {"in_group": ("g", "v"), "overall": (None, "v"), "of_w": ("g", "w")}

    def rank(row, group, value):
        peers = [r for r in data if group is None or r[group] == row[group]]
        low = float("-inf")
        return 1 + sum((low if r[value] is None else r[value]) > (low if row[value] is None else row[value]) for r in peers)

    got = {r.id: (r.in_group, r.overall, r.of_w) for r in rank_within(stored, ranks).collect()}
    assert got == {r[0]: (rank(r, 1, 2), rank(r, None, 2), rank(r, 1, 3)) for r in data}


def test_one_range_shuffle_for_all_ranks(spark, monkeypatch):
    """The written plans: one range exchange, however many orders there are."""
    from salesops.operators import ordering

    plans = []
    real = ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda df: plans.append(_plan(df)) or real(df))
    reports.rep_leaderboard(GivenTables(spark, SMALL))
    assert sum(p.count("Exchange rangepartitioning") for p in plans) == 1


def test_numbers_within_groups(many_ranges):
    data = [(i, "hot" if i % 3 else f"g{i % 30}" if i % 2 else None) for i in range(1500)]
    df = many_ranges.createDataFrame(data, "id int, g string").repartition(5)
    got = {r.id: r.position for r in number_within(df, "g", [F.col("id").desc()]).collect()}
    want = {}
    for group in {g for _, g in data}:
        want |= {i: k for k, i in enumerate(sorted((i for i, g in data if g == group), reverse=True), start=1)}
    assert got == want


@pytest.mark.parametrize("size", [0, 1, 4, 300])
def test_earlier_rows_over_ranges(many_ranges, size):
    """Values handed over borders, also over ranges with fewer rows than are looked back."""
    rnd = random.Random(size)
    data = [(rnd.randrange(50), i, None if rnd.random() < 0.2 else i * 10) for i in range(size)]
    df = many_ranges.createDataFrame(data, "d int, id int, v int").repartition(3)
    shifted = shift_over_ranges(df, [F.col("d"), F.col("id")], {"one": ("v", 1), "five": ("id", 5)}, {"start": "v"})
    ordered = sorted(data)
    back = lambda k, n, c: ordered[k - n][c] if k >= n else None
    want = [(*r, back(k, 1, 2), back(k, 5, 1), ordered[0][2]) for k, r in enumerate(ordered)]
    assert sorted(map(tuple, shifted.collect()), key=lambda r: r[:2]) == want
    windows = re.findall(r"windowspecdefinition\((\w+)#", _plan(shifted))
    assert "Exchange SinglePartition" not in _plan(df) and windows.count("_range") >= 2


@pytest.mark.parametrize("seed", range(4))
def test_cutoff_is_the_curves_first_point(many_ranges, seed):
    rnd = random.Random(seed)
    low = (0, -60, 0, -400)[seed]
    data = [(f"e{rnd.randrange(150)}", rnd.choice([5, 7, rnd.randrange(low, 100)])) for _ in range(500)]
    facts = many_ranges.createDataFrame(data, "e string, v long")
    for pct in (0.5, 50, 80, 100):
        curve = analytics.pareto_cutoff(analytics.pareto_curve(facts, "e", "v"), pct).collect()
        assert analytics.pareto_point(facts, "e", "v", pct).collect() == curve
    assert analytics.pareto_point(facts.limit(0), "e", "v").collect() == []


def test_cutoff_expands_nothing(spark):
    found = reports.pareto_cutoff(GivenTables(spark, SMALL))
    assert "Generate" not in _plan(found) and found.count() == 1


def _keep_last(data):
    last = {}
    for r in data:
        if r[0] not in last or (r[1] is not None, r[1] or 0) >= (last[r[0]][1] is not None, last[r[0]][1] or 0):
            last[r[0]] = r
    return last


def test_keep_last_and_discarded_without_broadcast(no_broadcast):
    """Many repeated keys: single rows pass a filter and are not shuffled; kept and discarded rows are the input."""
    rnd = random.Random(9)
    numbers = rnd.sample(range(10_000), 3000)
    keys = ["hot"] * 900 + [f"k{rnd.randrange(300)}" for _ in range(1000)] + [f"s{i}" for i in range(1100)]
    data = [(k, n, f"text {n}") for k, n in zip(keys, numbers, strict=True)]
    stored = materialize(no_broadcast.createDataFrame(data, "k string, o int, t string"))
    kept = rows.dedupe_keep_last(stored, "k", "o")
    want = _keep_last(data)
    assert sorted(map(tuple, kept.collect())) == sorted(want.values())
    gone = [tuple(r) for r in rows.discarded_rows(stored, "k", "o").collect()]
    assert sorted(gone) == sorted(r for r in data if want[r[0]] != r)
    # Of the union's two parts the one with the rows of single keys has no exchange but the filter's.
    single = _plan(rows._parted(stored, ["k"], *rows._repeated_keys(stored, ["k"])[::2])[0])
    above = single[: single.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in above and "Exchange" not in above and "Sort" not in above
    flagged = rows._may_repeat(stored, ["k"], rows._repeated_keys(stored, ["k"])[0])
    hits = {r.k for r in flagged.where("_hit").collect()}
    assert {k for k in keys if keys.count(k) > 1} <= hits and len(hits) < 330


def test_discarded_rows_that_are_equal(spark):
    """Copies of a whole row, NULL keys and NULL ordinals: all but one row of each key go."""
    data = [("a", 1, "x")] * 200 + [(None, 2, "y"), (None, None, "z"), (None, None, "z"), ("b", 3, "w")]
    df = materialize(spark.createDataFrame(data, "k string, o int, t string"))
    gone = sorted(map(tuple, rows.discarded_rows(df, "k", "o", spread=3).collect()), key=str)
    assert gone == sorted([("a", 1, "x")] * 199 + [(None, None, "z")] * 2, key=str)
    both = gone + [tuple(r) for r in rows.dedupe_keep_last(df, "k", "o").collect()]
    assert sorted(both, key=str) == sorted(data, key=str)


def test_pivot_lists_every_type(spark):
    types = {r[0] for r in spark.read.parquet(f"{SMALL}/part.parquet").select("p_type").distinct().collect()}
    assert types <= set(reports.PART_TYPES)
    assert set(reports.quarterly_sales_pivot(GivenTables(spark, SMALL)).columns) == {"quarter", *types}


def test_pivot_limit_and_null(spark):
    df = spark.createDataFrame([("r", "a", 1), ("r", None, 2), ("s", "a", 3), ("s", "a", 4)], "x string, c string, v int")
    assert [r.asDict() for r in analytics.pivot_sum(df, "x", "c", "v").collect()] == [
        {"x": "r", "null": 2, "a": 1}, {"x": "s", "null": 0, "a": 7},
    ]
    spark.conf.set("spark.sql.pivotMaxValues", "1")
    try:
        with pytest.raises(ValueError, match="more than 1"):
            analytics.pivot_sum(df, "x", "c", "v")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_tables_in_buckets_join_where_they_lie(spark):
    plan = _plan(storage.bucketed_line_totals(GivenTables(spark, SMALL)))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
