import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesops import functions as sf
from salesops.operators import analytics as a


def test_pareto_with_ties_and_exact_crossing(many_ranges):
    df = many_ranges.createDataFrame([("a", 40), ("b", 20), ("c", 20), ("d", 10), ("e", 10), ("a", 0)], "k string, v int")
    curve = a.pareto_curve(df, "k", "v")
    assert list(map(tuple, curve.collect())) == [
        (1, 20.0, 40.0), (2, 40.0, 80.0), (3, 60.0, 80.0), (4, 80.0, 100.0), (5, 100.0, 100.0),
    ]
    assert tuple(a.pareto_cutoff(curve, 80).first()) == (2, 40.0, 80.0)
    assert tuple(a.pareto_cutoff(curve, 80.1).first()) == (4, 80.0, 100.0)


def test_funnel_with_an_empty_stage(spark):
    some = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    none = some.where("k > 5")
    got = a.funnel([("first", some, "k"), ("empty", none, "k"), ("after", none, "k")]).collect()
    assert list(map(tuple, got)) == [("first", 2, 100.0, None), ("empty", 0, 0.0, 0.0), ("after", 0, 0.0, None)]


def test_band_edges_and_missing_measure(spark):
    rows = [("o5", 5, 1), ("o5", 1, 0), ("o10", 10, 0), ("o15", 15, 1), ("o16", 16, 1), ("none", None, 0)]
    df = spark.createDataFrame(rows, "k string, d int, won int")
    bands = [(5, "0-5%"), (10, "6-10%"), (15, "11-15%"), (None, "16-25%")]
    got = a.rate_by_band(df, "k", "d", F.col("won") == 1, bands, ordered=True).collect()
    assert list(map(tuple, got)) == [("0-5%", 1, 1, 100.0), ("6-10%", 1, 0, 0.0), ("11-15%", 1, 1, 100.0), ("16-25%", 2, 1, 50.0)]
    by_rate = a.rate_by_band(df, "k", "d", F.col("won") == 1, bands).collect()
    assert [r[0] for r in by_rate] == ["0-5%", "11-15%", "16-25%", "6-10%"]


def test_above_mean_compares_with_the_exact_mean(spark):
    # The mean of g is 50.04 and shows as 50.0; a score of exactly 50.0 is not above it.
    rows = [("g", "low", Decimal("50.00"), 1), ("g", "high", Decimal("50.08"), 2), ("h", "only", Decimal("9.00"), 3), (None, "lost", Decimal("99.00"), 4)]
    df = spark.createDataFrame(rows, "g string, name string, score decimal(6,2), id int")
    got = a.above_group_mean(df, "g", "name", "score", 20, "id").collect()
    assert [(r["name"], r["city_avg_score"]) for r in got] == [("high", 50.0)]


def test_rank_shares_and_commission_order(spark):
    facts = spark.createDataFrame([("r1", "o1", 100), ("r1", "o1", 50), ("r2", "o2", 150), ("r3", "o3", 100)], "rep string, o string, v bigint")
    reps = spark.createDataFrame([("r1", "Ann", 1.0), ("r2", "Bo", 3.0), ("r3", "Cy", 20.0)], "rep string, user_name string, rate double")
    got = a.rep_leaderboard(facts, "rep", "o", "v", reps).collect()
    assert list(map(tuple, got)) == [
        ("Ann", 1, 150, 1, 37.5, 2.0, 3), ("Bo", 1, 150, 1, 37.5, 5.0, 2), ("Cy", 1, 100, 3, 25.0, 20.0, 1),
    ]


def test_pivot_fills_missing_cells(spark):
    df = spark.createDataFrame([("q1", "a", Decimal("1.50")), ("q1", "a", Decimal("2.00")), ("q2", "b", Decimal("3.00"))], "q string, c string, v decimal(10,2)")
    got = a.pivot_sum(df, "q", "c", "v").collect()
    assert list(map(tuple, got)) == [("q1", Decimal("3.50"), Decimal("0.00")), ("q2", Decimal("0.00"), Decimal("3.00"))]


def test_payments_without_date_are_left_out(spark):
    day = datetime.date
    rows = [("m", day(2020, 1, 1), day(2020, 1, 31), day(2020, 1, 31), Decimal("1.00")), ("m", day(2020, 1, 1), day(2020, 1, 31), day(2020, 2, 1), Decimal("2.50")), ("m", day(2020, 1, 1), day(2020, 1, 2), None, Decimal("9.00"))]
    df = spark.createDataFrame(rows, "m string, issued date, due date, paid date, fee decimal(10,2)")
    assert tuple(a.payment_behaviour(df, "m", "issued", "due", "paid", "fee").first()) == ("m", 2, 1, 50.0, 31.0, 4.0)


def test_only_open_deals_past_their_date_are_stale(spark):
    day = datetime.date
    rows = [("Won", day(2020, 1, 1), 5), ("Open", day(2020, 1, 1), 7), ("Open", day(2020, 1, 11), 8), ("Open", None, 9), ("Open", day(2020, 1, 10), 1)]
    df = spark.createDataFrame(rows, "stage string, expected date, v int")
    as_of = F.lit("2020-01-11").cast("date")
    assert list(map(tuple, a.open_deal_aging(df, "stage", ["Open"], "expected", "v", as_of).collect())) == [("Open", 2, 8.0, 6.0)]


@pytest.mark.parametrize("value, digits, wanted", [(2.5, 0, 3.0), (-2.5, 0, -3.0), (0.25, 1, 0.3), (-0.04, 1, 0.0), (None, 1, None)])
def test_round_half_away_from_zero(spark, value, digits, wanted):
    assert spark.createDataFrame([(value,)], "v double").select(sf.round_half_up("v", digits)).first()[0] == wanted


def test_division_by_zero_is_null(spark):
    assert spark.range(1).select(sf.percent(F.lit(1), F.lit(0))).first()[0] is None


def test_quarter_label(spark):
    df = spark.createDataFrame([(datetime.date(2021, m, 1),) for m in (1, 3, 4, 12)], "d date")
    assert [r[0] for r in df.select(sf.quarter_label("d")).collect()] == ["2021-Q1", "2021-Q1", "2021-Q2", "2021-Q4"]
