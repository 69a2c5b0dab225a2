"""Inputs that the given tables do not hold: missing ordinals, equal rows, blank members, empty tables, huge sums."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesops import session
from salesops.operators import analytics, dimensions, integrity, rows
from salesops.plans import reports
from salesops.sources import lost_values, typed

KEYED = "pk string, ordinal long, x string"


def _rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def _null_ordinals(spark):
    return spark.createDataFrame(
        [("a", None, "x"), ("b", None, "old"), ("b", 1, "new"), ("c", None, "p"), ("c", None, "p"), (None, 2, "q")], KEYED
    )


def test_missing_ordinals_give_the_same_rows_on_both_ways(spark, monkeypatch):
    frame = _null_ordinals(spark)
    want = [("a", None, "x"), ("b", 1, "new"), ("c", None, "p"), (None, 2, "q")]
    assert _rows(rows.dedupe_keep_last(frame, "pk", "ordinal")) == sorted(want, key=str)
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", -1)
    assert _rows(rows.dedupe_keep_last(frame, "pk", "ordinal")) == sorted(want, key=str)
    named = spark.createDataFrame([("1", None, "only"), ("2", 1, "old"), ("2", 2, "new"), ("2", None, "none")], KEYED)
    assert _rows(dimensions.id_value_map(named, "pk", "x", "ordinal")) == [("1", "only"), ("2", "new")]


def test_kept_and_discarded_are_the_input(spark, monkeypatch):
    frame = _null_ordinals(spark).unionByName(
        spark.createDataFrame([("c", None, "p"), ("d", 5, "one"), ("d", 5, "two"), (None, 1, "r"), ("e", 3, None)], KEYED)
    )
    for bound in (session.BROADCAST_MAX_ROWS, -1):
        monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", bound)
        kept, lost = (f(frame, "pk", "ordinal") for f in (rows.dedupe_keep_last, rows.discarded_rows))
        assert _rows(kept.unionByName(lost)) == _rows(frame)
        assert kept.select("pk").distinct().count() == kept.count() == 6
    assert rows.discarded_rows(frame.where("pk in ('a', 'e')"), "pk", "ordinal").count() == 0


def test_the_ordinal_is_not_content(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 1, "x"), ("b", 2, "y")], "pk string, seq long, x string")
    assert _rows(rows.duplicate_report(frame, "pk", "seq")) == [("a", 2, 1, 0, 1), ("b", 2, 1, 1, 2)]
    assert _rows(rows.duplicate_report(frame, "pk", F.col("seq"), beside=["seq"])) == [("a", 2, 1, 0, 1), ("b", 2, 1, 1, 2)]


def test_blank_members_link(spark):
    cities = spark.createDataFrame([("1", "York", 1), ("2", "", 2), ("3", None, 3)], "id string, city string, seq long")
    merged = dimensions.merge_dimensions([(cities, "city")], "CTY", "city_id", "city")
    keys = {r.city: r.city_id for r in merged.collect()}
    mapping = dimensions.key_mapping(dimensions.id_value_map(cities, "id", "city", "seq"), merged, "city_id", "city")
    assert _rows(mapping) == [("1", keys["York"]), ("2", keys[""]), ("3", keys[""])]


def test_relink_and_one_column_read_two(spark, tmp_path):
    wide = spark.range(10).selectExpr("id", "string(id % 3) as fk", *[f"id as c{k}" for k in range(9)])
    wide.write.parquet(str(tmp_path / "wide"))
    mapping = spark.createDataFrame([("1", "N1")], "old_id string, new_id string")
    linked = dimensions.relink(spark.read.parquet(str(tmp_path / "wide")), "fk", mapping, "new_fk").select("new_fk")
    plan = linked._jdf.queryExecution().executedPlan().toString()
    (scan,) = [line for line in plan.split("\n") if "FileScan" in line]
    assert "ReadSchema: struct<id:bigint,fk:string>" in scan
    assert linked.where("new_fk = 'N1'").count() == 3


def test_keys_are_not_joined_texts(spark):
    frame = spark.createDataFrame([("a\u0001", "b"), ("a", "\u0001b"), ("a", None)], "x string, y string")
    assert _rows(integrity.check_unique({"t": frame}, [("t", ("x", "y")), ("t", "x")])) == [
        ("t", "x", 1, 1, 0), ("t", "x, y", 0, 0, 1),
    ]


def test_empty_tables_are_reported(spark):
    none = spark.createDataFrame([], "k string")
    assert _rows(integrity.check_unique({"t": none}, [("t", "k")])) == [("t", "k", 0, 0, 0)]
    assert _rows(rows.profile_lookup({"t": (none, "k")})) == [("t", 0, 0)]


def test_invoices_without_an_order_count(spark):
    tables = {
        "Invoice": spark.sql("select * from values ('o1', 100.00), ('o2', 50.00), (null, 7.00) as t(order_id, total_amount)"),
        "Orders": spark.createDataFrame([("o1", "q1"), ("o3", "q2")], "order_id string, quote_id string"),
        "Quote": spark.createDataFrame([("q1",)], "quote_id string"),
        "QuoteLineItem": spark.createDataFrame([("q1",), ("q1",), ("q9",)], "quote_id string"),
    }
    found = reports.revenue_fanout(tables).first()
    assert (found.true_total, found.joined_total) == (157.0, 200.0)


def test_sums_of_sums_beyond_bigint(spark):
    most = 9_000_000_000_000_000_000
    facts = spark.createDataFrame([("a", 1, most), ("b", 2, most - 1000), ("c", 3, 5)], "rep string, deal long, cents long")
    curve = analytics.pareto_curve(facts, "rep", "cents", minor=100).collect()
    assert [(r["rank"], r.pct_revenue_cum) for r in curve] == [(1, 50.0), (2, 100.0), (3, 100.0)]
    reps = spark.createDataFrame([("a", "A", 10.0), ("b", "B", 5.0)], "rep string, user_name string, rate double")
    board = analytics.rep_leaderboard(facts.where("rep <> 'c'"), "rep", "deal", "cents", reps, minor=100).collect()
    assert [r.pct_of_total for r in board] == [50.0, 50.0]
    paid = facts.selectExpr("'card' as method", "date'2020-01-01' as issued", "date'2020-01-02' as due", "date'2020-01-03' as paid", "cents")
    fees = analytics.payment_behaviour(paid, "method", "issued", "due", "paid", "cents", minor=100).first().total_late_fees
    assert abs(fees / 1.8e17 - 1) < 1e-9


def test_rates_with_a_sign(spark):
    tables = {
        "Invoice": spark.sql("select * from values ('o1', 100.00), ('o2', 300.00) as t(order_id, total_amount)"),
        "Orders": spark.createDataFrame([("o1", "q1"), ("o2", "q2")], "order_id string, quote_id string"),
        "Quote": spark.createDataFrame([("q1", "p1"), ("q2", "p2")], "quote_id string, opportunity_id string"),
        "Opportunity": spark.createDataFrame([("p1", "u1", "c"), ("p2", "u2", "c")], "opportunity_id string, user_id string, customer_id string"),
        "Users": spark.createDataFrame([("u1", "A", "7%"), ("u2", "B", "none")], "user_id string, user_name string, commission_rate string"),
    }
    assert {r.user_name: r.est_commission for r in reports.rep_leaderboard(tables).collect()} == {"A": 7.0, "B": None}


def test_absent_columns(spark):
    raw = spark.createDataFrame([("1", "x"), ("two", "y")], "n string, t string")
    schema = "n int, t string, level int, late date"
    assert _rows(typed(raw, schema, {"level": 3})) == sorted([(1, "x", 3, None), (None, "y", 3, None)], key=str)
    assert _rows(lost_values(raw, schema, "r")) == [("r", "n", 1)]
    assert T.IntegerType() == typed(raw, schema).schema["level"].dataType


def test_scratch_is_marked_for_removal(spark):
    path = session.scratch_path(spark, "x")
    assert any(path.startswith(root) for root in session._roots)


def test_input_is_measured(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_for(spark, str(tmp_path)) > 1000
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
