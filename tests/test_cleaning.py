import hashlib

import pytest
from pyspark.sql import functions as F

from salesops import functions as sf
from salesops.operators import dimensions as dim
from salesops.operators import rows


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame(
        [
            (1, "L1", "Hot"), (2, "L2", "Cold"), (3, "L2", "Warm"), (4, None, "Cold"), (5, "L4", "Na"),
            (6, "L5", None), (7, "L6", "hot"), (8, "L7", "N/A"), (9, "L8", "na"),
        ],
        "n int, id string, status string",
    )


def test_dimension_has_real_values_in_code_point_order(lookup):
    built = dim.build_dimension(lookup, "id", "status", "LST").collect()
    assert sorted(map(tuple, built)) == [
        ("LST00001", "Cold"), ("LST00002", "Hot"), ("LST00003", "Warm"), ("LST00004", "hot"), ("LST00005", "na"),
    ]


def test_last_value_of_an_id_wins_and_blank_ids_drop_out(lookup):
    got = dict(map(tuple, dim.id_value_map(lookup, "id", "status", "n").collect()))
    assert got == {"L1": "Hot", "L2": "Warm", "L4": "Na", "L5": None, "L6": "hot", "L7": "N/A", "L8": "na"}


def _mapping(lookup):
    built = dim.build_dimension(lookup, "id", "status", "LST")
    return dim.key_mapping(dim.id_value_map(lookup, "id", "status", "n"), built, "id", "status")


def test_repoint_keeps_rows_and_nulls_what_does_not_resolve(spark, lookup):
    fact = spark.createDataFrame([(1, "L2"), (2, "L4"), (3, "L99"), (4, None), (5, ""), (6, "L1"), (7, "L1")], "k int, fk string")
    got = dict(map(tuple, dim.repoint_fk(fact, "fk", _mapping(lookup)).collect()))
    assert got == {1: "LST00003", 2: None, 3: None, 4: None, 5: None, 6: "LST00002", 7: "LST00002"}


def test_repointing_twice_is_wrong_because_old_and_new_ids_overlap(spark):
    lookup = spark.createDataFrame([("IND00001", "Mining"), ("IND00002", "Building")], "id string, name string")
    built = dim.build_dimension(lookup, "id", "name", "IND")
    mapping = dim.key_mapping(dim.id_value_map(lookup, "id", "name", "id"), built, "id", "name")
    fact = spark.createDataFrame([("IND00001",)], "fk string")
    once = dim.repoint_fk(fact, "fk", mapping)
    assert once.first()["fk"] == "IND00002"
    assert dim.repoint_fk(once, "fk", mapping).first()["fk"] == "IND00001"


def test_repoint_with_hot_and_missing_keys_without_broadcast(no_broadcast, lookup):
    fact = no_broadcast.range(6000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "L1").when(F.col("id") % 3 == 1, None).otherwise("L8").alias("fk")
    )
    got = dim.repoint_fk(fact, "fk", _mapping(lookup)).groupBy("fk").count().collect()
    assert sorted(map(tuple, got), key=str) == [("LST00002", 2000), ("LST00005", 2000), (None, 2000)]


def test_merged_dimension_has_no_sentinels(spark):
    a = spark.createDataFrame([("Leeds",), ("Na",), (None,)], "x string")
    b = spark.createDataFrame([("Leeds",), ("Bristol",)], "y string")
    got = dim.merge_dimensions([(a, "x"), (b, "y")], "CTY", "id", "city").collect()
    assert sorted(map(tuple, got)) == [("CTY00001", ""), ("CTY00002", "Bristol"), ("CTY00003", "Leeds"), ("CTY00004", "Na")]


def test_prefix_is_repaired_only_at_the_start(spark):
    df = spark.createDataFrame([("CIT00001",), ("SCT00001",), ("XCIT0001",)], "k string")
    assert [r[0] for r in df.select(sf.repair_prefix("k", "CIT", "SCT")).collect()] == ["SCT00001", "SCT00001", "XCIT0001"]


def test_key_is_wider_beyond_five_digits(spark):
    got = spark.range(99_999, 100_001).select(sf.format_key("CUS", "id")).collect()
    assert [r[0] for r in got] == ["CUS99999", "CUS100000"]


@pytest.mark.parametrize("modulus", [1, 2, 9, 1009, 2**31 - 1])
def test_md5_modulo_is_that_of_the_whole_digest(spark, modulus):
    keys = ["CUS12345", "", "ü", "CUS00001", "x" * 500]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(sf.md5_modulo("k", modulus)).collect()
    assert [r[0] for r in got] == [int(hashlib.md5(k.encode()).hexdigest(), 16) % modulus for k in keys]


def test_hash_fill_keeps_genuine_references(spark):
    titles = spark.createDataFrame([(f"T{i}", f"title {i}") for i in range(9)], "id string, title string")
    built = dim.build_dimension(titles, "id", "title", "JOB")
    mapping = dim.key_mapping(dim.id_value_map(titles, "id", "title", "id"), built, "id", "title")
    fact = spark.createDataFrame([("CUS12345", "T3"), ("CUS12345", "T77"), ("CUS12345", None)], "c string, t string")
    got = dim.hash_fill(fact, "c", "t", mapping, built, "id", "title", "genuine").collect()
    assert sorted(map(tuple, got)) == [("CUS12345", "JOB00004", True), ("CUS12345", "JOB00009", False), ("CUS12345", "JOB00009", False)]


def test_hash_fill_takes_the_dimensions_own_places(spark, monkeypatch):
    """Same picks without numbering the members a second time."""
    titles = spark.createDataFrame([(f"T{i}", f"title {i * 7 % 40}") for i in range(40)], "id string, title string")
    built = dim.build_dimension(titles, "id", "title", "JOB", place="place")
    mapping = dim.key_mapping(dim.id_value_map(titles, "id", "title", "id"), built, "id", "title")
    fact = spark.createDataFrame([(f"CUS{i}", f"T{i}" if i % 3 else None) for i in range(90)], "c string, t string")
    want = dim.hash_fill(fact, "c", "t", mapping, built.drop("place"), "id", "title", "genuine").collect()
    monkeypatch.delattr(dim, "number_values")
    got = dim.hash_fill(fact, "c", "t", mapping, built, "id", "title", "genuine", "place")
    assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(got.collect()) == sorted(want)


def _copies(spark):
    """A hot key, NULL keys, a key once, a key with equal copies."""
    hot = [("hot", i, f"v{i}") for i in range(1000)]
    return spark.createDataFrame(
        hot + [(None, 2000 + i, "blank") for i in range(50)] + [("one", 5000, "x"), ("same", 6000, "y"), ("same", 6001, "y")],
        "pk string, _ordinal int, payload string",
    ).repartition(6)


_KEPT = {("hot", 999, "v999"), (None, 2049, "blank"), ("one", 5000, "x"), ("same", 6001, "y")}


def test_keep_last(spark):
    assert set(map(tuple, rows.dedupe_keep_last(_copies(spark), "pk", "_ordinal").collect())) == _KEPT


def test_keep_last_when_repeated_keys_are_many(no_broadcast):
    assert set(map(tuple, rows.dedupe_keep_last(_copies(no_broadcast), "pk", "_ordinal").collect())) == _KEPT


def test_keep_last_returns_one_row_for_fully_equal_rows(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x")], "pk string, o int, v string")
    assert rows.dedupe_keep_last(df, "pk", "o").collect() == [("a", 1, "x")]


def test_discarded_rows_and_their_conflicts(spark):
    df = _copies(spark)
    lost = rows.discarded_rows(df.where("pk is not null"), "pk", "_ordinal")
    assert lost.count() == 1000 - 1 + 1
    report = {r["pk"]: r for r in rows.duplicate_report(df, "pk", "_ordinal").collect()}
    assert set(report) == {"hot", None, "same"}
    assert (report["hot"]["lost"], report["hot"]["lost_conflicting"]) == (999, 999)
    assert (report["same"]["lost"], report["same"]["lost_conflicting"]) == (1, 0)
    assert (report[None]["lost"], report[None]["lost_conflicting"]) == (49, 0)


def test_sentinels_only_in_date_columns_and_case_sensitive(spark):
    df = spark.createDataFrame([("Na", "Na"), ("N/A", "x"), ("na", "y"), ("2020-01-02", "z"), (None, None)], "Close_Date string, note string")
    got = list(map(tuple, rows.null_sentinels(df).collect()))
    assert got == [(None, "Na"), (None, "x"), ("na", "y"), ("2020-01-02", "z"), (None, None)]


def test_required_value_drops_null_and_empty(spark):
    df = spark.createDataFrame([("1",), ("",), (None,)], "v string")
    assert rows.require_non_blank(df, "v").collect() == [("1",)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_orphans_over_three_levels(request, spark, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    tables = {
        "a": spark.createDataFrame([("a1",), ("a1",)], "a string"),
        "b": spark.createDataFrame([("b1", "a1"), ("b2", "a9"), ("b3", None), ("b4", "")], "b string, a string"),
        "c": spark.createDataFrame([("c1", "b1"), ("c2", "b2"), ("c3", "b3"), ("c4", "b9")], "c string, b string"),
        "d": spark.createDataFrame([("d1", "c1"), ("d2", "c2"), ("d3", "c3")] + [("hot", "c4")] * 500, "d string, c string"),
    }
    kept = rows.drop_orphans_chain(tables, [("b", "a", "a", "a"), ("c", "b", "b", "b"), ("d", "c", "c", "c")])
    got = {name: sorted(r[0] for r in df.collect()) for name, df in kept.items()}
    assert got == {"a": ["a1", "a1"], "b": ["b1", "b3", "b4"], "c": ["c1", "c3"], "d": ["d1", "d3"]}


def test_profile_counts_values_but_not_null(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "v string")
    assert rows.profile_lookup({"t": (df, "v")}).collect() == [("t", 3, 1)]


def test_rows_are_counted_by_the_job_that_writes_them(spark):
    df = spark.range(100).withColumn("even", F.col("id") % 2 == 0)
    stored, counts = rows.store_counted(df, {"all": None, "even": F.col("even"), "none": F.col("id") < 0})
    assert counts == {"all": 100, "even": 50, "none": 0} and stored.count() == 100
    empty, counts = rows.store_counted(df.where("id < 0"), {"all": None})
    assert counts == {"all": 0} and empty.count() == 0
    log = rows.audit_rows(spark, "step", "t", {"all": 100, "even": 50})
    assert sorted(tuple(r) for r in log.collect()) == [("step", "t", "all", 100), ("step", "t", "even", 50)]
