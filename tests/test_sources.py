import datetime

import pytest

from salesops import sources
from salesops.operators import rows
from salesops.session import checkpoint_dir, cluster_settings, materialize, small_side


def _write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return str(path)


def test_raw_csv_keeps_text_as_it_is(spark, tmp_path):
    text = ' id , name,note \n1,"a, ""b""",  x \n\n2,,Na\n007,é\\n,"",\n'.replace('"",\n', '""\n')
    df = sources.read_raw_csv(spark, _write(tmp_path / "t.csv", text, "utf-8-sig"))
    assert df.columns == ["id", "name", "note"]
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    got = {r["id"]: (r["name"], r["note"] or None) for r in df.collect()}
    assert got == {"1": ('a, "b"', "  x "), "2": (None, "Na"), "007": ("é\\n", None)}


def test_line_breaks_in_quotes_are_an_option(spark, tmp_path):
    path = _write(tmp_path / "t.csv", 'id,note\n1,"two\nlines"\n')
    assert sources.read_raw_csv(spark, path, multi_line=True).collect() == [("1", "two\nlines")]


def test_ordinal_is_the_file_order_over_files_and_splits(spark, tmp_path):
    for part in range(3):
        lines = "".join(f"k{i % 50},{part}-{i:04d}\n" for i in range(2000))
        _write(tmp_path / "t.csv" / f"part-{part}.csv", "id,v\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = sources.read_raw_csv(spark, str(tmp_path / "t.csv"), ordinal=True)
        assert df.rdd.getNumPartitions() > 6
        kept = rows.dedupe_keep_last(df, "id", sources.ORDINAL)
        got = {r["id"]: r["v"] for r in kept.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"k{i}": f"2-{1950 + i:04d}" for i in range(50)}


def test_typed_load_binds_by_name_and_counts_lost_values(spark, tmp_path):
    path = _write(tmp_path / "t.csv", "n,flag,day,name\n 5 ,1,2020-01-31,a\nx,0,Na,\n,,,b\n")
    schema = "name string, day date, flag boolean, n int"
    got = sources.load_typed(spark, path, schema).collect()
    assert list(map(tuple, got)) == [("a", datetime.date(2020, 1, 31), True, 5), (None, None, False, None), ("b", None, None, None)]
    lost = sources.lost_values(sources.read_raw_csv(spark, path), schema, "t")
    assert {r["column"]: r["lost"] for r in lost.collect()} == {"day": 1, "flag": 0, "n": 1}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_tables_round_trip_and_rebuild(spark, tmp_path, fmt):
    tables = {
        "a": spark.createDataFrame([("1", ' "x", y '), ("2", None), ("3", "")], "id string, v string"),
        "b": spark.createDataFrame([], "id string"),
    }
    for _ in range(2):
        assert sources.rebuild(tables, str(tmp_path / "out"), fmt) == {"a": 3, "b": 0}
    path = str(tmp_path / "out" / f"a.{fmt}")
    back = sources.read_raw_csv(spark, path) if fmt == "csv" else spark.read.parquet(path)
    assert {r["id"]: r["v"] or None for r in back.collect()} == {"1": ' "x", y ', "2": None, "3": None}


def test_catalog_views_and_counts(spark, tmp_path):
    _write(tmp_path / "One.csv", "a,b\n1,2\n")
    _write(tmp_path / "Two.csv", "c\n1\n2\n")
    _write(tmp_path / "notes.txt", "no table")
    catalog = sources.read_catalog(spark, str(tmp_path))
    assert sorted(catalog) == ["One", "Two"]
    assert dict(map(tuple, sources.table_counts(catalog).collect())) == {"One": 1, "Two": 2}
    assert sources.register_tables(catalog) == ["One", "Two"]
    assert sources.run_sql(spark, "select sum(cast(c as int)) from Two").first()[0] == 3


def test_checkpoint_folder_is_the_one_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_dir(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_sides_are_broadcast_only_below_the_bounds(spark, monkeypatch):
    from salesops import session

    df = materialize(spark.range(100))
    plan = "ResolvedHint"
    assert plan in small_side(df, stored=True)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 99)
    assert plan not in small_side(df, stored=True)._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(session, "BROADCAST_MAX_ROWS", 1000)
    monkeypatch.setattr(session, "BROADCAST_MAX_BYTES", 10)
    assert plan not in small_side(df, stored=True)._jdf.queryExecution().analyzed().toString()


def test_shuffle_sizing_grows_with_the_input():
    assert cluster_settings(0, 8)["spark.sql.shuffle.partitions"] == "16"
    assert cluster_settings(10**12, 8)["spark.sql.shuffle.partitions"] == "7451"
    assert cluster_settings(10**14, 8)["spark.sql.shuffle.partitions"] == "745059"
