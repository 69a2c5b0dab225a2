import random

import pytest
from pyspark.sql import functions as F

from salesops.operators import ordering


@pytest.fixture(scope="module")
def amounts():
    """A third of the rows share one amount; some have none."""
    rng = random.Random(7)
    rows = [(i, 500) for i in range(1000)]
    rows += [(1000 + i, rng.randint(0, 400) * 3) for i in range(1900)]
    rows += [(2900 + i, None) for i in range(100)]
    rng.shuffle(rows)
    return rows


def _brute_rank(rows):
    key = [-1 if v is None else v for _, v in rows]
    return {k: 1 + sum(other > mine for other in key) for (k, _), mine in zip(rows, key)}


def test_rank_with_hot_value_and_nulls(many_ranges, amounts):
    df = many_ranges.createDataFrame(amounts, "id int, v int").repartition(5)
    got = {r["id"]: r["place"] for r in ordering.add_ranks(df, {"place": "v"}).collect()}
    assert got == _brute_rank(amounts)


def test_running_total_shares_peers(many_ranges, amounts):
    rows = [(i, v) for i, v in amounts if v is not None]
    df = many_ranges.createDataFrame(rows, "id int, v int")
    got = {r["v"]: (r["running_rows"], r["running_total"], r["all_rows"]) for r in ordering.ordered_totals(df, "v").collect()}
    for v, (count, total, n) in got.items():
        ahead = [x for _, x in rows if x >= v]
        assert (count, total, n) == (len(ahead), sum(ahead), len(rows))


def test_several_ranges_are_in_use(many_ranges, amounts):
    df = many_ranges.createDataFrame([a for a in amounts if a[1] is not None], "id int, v int")
    used = df.select("v").distinct().repartitionByRange("v").select(F.spark_partition_id()).distinct().count()
    assert used > 3


def test_positions_of_hot_value_are_cut_into_pieces(many_ranges, amounts, monkeypatch):
    monkeypatch.setattr(ordering, "PIECE", 64)
    rows = [(i, v) for i, v in amounts if v is not None]
    df = many_ranges.createDataFrame(rows, "id int, v int")
    got = ordering.expand_positions(ordering.ordered_totals(df, "v")).select("position", "v").collect()
    by_position = dict(got)
    assert len(got) == len(by_position) == len(rows)
    assert [by_position[p] for p in range(1, len(rows) + 1)] == sorted((v for _, v in rows), reverse=True)


def test_row_number_splits_hot_value(many_ranges, amounts):
    df = many_ranges.createDataFrame(amounts, "id int, v int")
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = {r["id"]: r["position"] for r in ordering.number_rows(df, order).collect()}
    wanted = sorted(amounts, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == {k: i for i, (k, _) in enumerate(wanted, start=1)}


def test_values_are_numbered_per_group_in_code_point_order(many_ranges):
    rng = random.Random(3)
    values = ["Zulu", "alpha", "Alpha", "é", "z", "Ω", "10", "9", "\U0001f69a"] + [f"v{rng.randint(0, 10**6)}" for _ in range(400)]
    rows = [(g, v) for g in ("a", "b", "c") for v in rng.choices(values, k=300)]
    got = ordering.number_values(many_ranges.createDataFrame(rows, "g string, v string"), "g", "v").collect()
    for g in ("a", "b", "c"):
        wanted = sorted({v for h, v in rows if h == g}, key=lambda v: v.encode())
        assert {r["v"]: r["position"] for r in got if r["g"] == g} == {v: i for i, v in enumerate(wanted, 1)}


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id int, v int")
    assert ordering.ordered_totals(empty, "v").count() == 0
    assert ordering.number_rows(empty, [F.col("id").asc()]).count() == 0
