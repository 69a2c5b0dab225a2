"""The command line, in this process."""

import shutil
import sys

import pytest

import salesops.__main__ as command
from salesops import sources
from salesops.plans import model
from salesops.sources import files

QUOTES = "Quote.csv"


def _run(monkeypatch, spark, *arguments):
    monkeypatch.setattr(sys, "argv", ["salesops", *map(str, arguments)])
    monkeypatch.setattr(command, "build_session", lambda: spark)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        return command.main()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_clean_part_of_the_tables(monkeypatch, spark, raw, tmp_path, capfd):
    part = tmp_path / "raw"
    part.mkdir()
    for name in ("Role", "Users", "BillingCity", "BillingAddress"):
        shutil.copy(f"{raw[0]}/{name}.csv", part)
    assert _run(monkeypatch, spark, "clean", part, tmp_path / "clean", "--audit", tmp_path / "audit") == 0
    assert "dimension" in capfd.readouterr().out
    assert sorted(p.name for p in (tmp_path / "clean").iterdir()) == [
        "BillingAddress.csv", "City.csv", "Role.csv", "Users.csv",
    ]
    steps = {(r["step"], r["table"]) for r in spark.read.parquet(str(tmp_path / "audit")).collect()}
    assert {("dimension", "Role"), ("city", "BillingAddress")} <= steps


def _line(folder, table, text):
    """One more file of rows; the first line is the header."""
    (folder / f"{table}.csv" / "part-zzz.csv").write_text(text)


def test_load_and_report(monkeypatch, spark, cleaned, tmp_path, capfd):
    clean, tables = tmp_path / "clean", tmp_path / "tables"
    shutil.copytree(cleaned[0], clean)
    assert _run(monkeypatch, spark, "load", clean, tables) == 0
    assert "City: 5 rows" in capfd.readouterr().out
    out = tmp_path / "out"
    assert _run(monkeypatch, spark, "report", tables, "warranty_mix", "sales_funnel", "--out", out) == 0
    shown = capfd.readouterr().out
    assert "Platinum" in shown and "Invoiced" in shown and str(out) in shown
    assert sorted(p.name for p in out.iterdir()) == ["sales_funnel.parquet", "warranty_mix.parquet"]
    assert spark.read.parquet(f"{out}/sales_funnel.parquet").count() == 5


def test_reports_are_complete(monkeypatch, spark, tmp_path, capfd):
    """More rows than any preview shows."""
    long = spark.range(250).selectExpr("id as rank")
    monkeypatch.setattr(command, "REPORTS", {"pareto_curve": lambda tables: long})
    monkeypatch.setattr(command, "open_tables", lambda *_: {})
    assert _run(monkeypatch, spark, "report", tmp_path, "pareto_curve", "--out", tmp_path / "out") == 0
    assert "first 20 rows" in capfd.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/out/pareto_curve.parquet").count() == 250


@pytest.mark.parametrize(
    ("table", "text", "message"),
    [
        ("Orders", "order_id,order_date,quote_id\nORD99999,2022-01-01,QUO99999\n", "foreign key Orders.quote_id: 1"),
        ("Role", None, "primary key Role."),
        ("Lead", "lead_id,lead_score,created_date\nLEA99999,101,2022-01-01\n", "range Lead.lead_score: 1"),
        ("Lead", "lead_id,lead_score,created_date\nLEA99999,5,\n", "not null Lead.created_date: 1"),
        ("Lead", "lead_id,lead_score,created_date\nLEA99999,five,2022-01-01\n", "Lead.lead_score: 1"),
    ],
)
def test_broken_input_fails(monkeypatch, spark, cleaned, tmp_path, capfd, table, text, message):
    clean, tables = tmp_path / "clean", tmp_path / "tables"
    shutil.copytree(cleaned[0], clean)
    folder = clean / f"{table}.csv"
    lines = next(p for p in sorted(folder.glob("part-*.csv")) if len(p.read_text().splitlines()) > 1).read_text().splitlines()
    if text is None:  # a row once more
        text = "\n".join([lines[0], lines[1]]) + "\n"
    else:  # the file's columns, empty but for the given ones
        given = dict(zip(*(line.split(",") for line in text.splitlines()), strict=True))
        text = lines[0] + "\n" + ",".join(given.get(c, "") for c in lines[0].split(",")) + "\n"
    _line(clean, table, text)
    assert _run(monkeypatch, spark, "load", clean, tables) == 1
    assert message in capfd.readouterr().err
    assert not [*tmp_path.glob("tables/**/*.parquet")]


def test_defaults_for_absent_columns(monkeypatch, spark, cleaned, tmp_path):
    clean, tables = tmp_path / "clean", tmp_path / "tables"
    shutil.copytree(cleaned[0], clean, ignore=shutil.ignore_patterns(QUOTES))
    frame = spark.read.option("header", True).csv(f"{cleaned[0]}/{QUOTES}").drop("revision_number")
    frame.write.option("header", True).csv(str(clean / QUOTES))
    assert _run(monkeypatch, spark, "load", clean, tables) == 0
    quotes = sources.open_tables(spark, str(tables), model.SCHEMAS)["Quote"]
    assert {r[0] for r in quotes.select("revision_number").collect()} == {1}


def test_failed_load_leaves_the_former_tables(monkeypatch, spark, cleaned, tmp_path, capfd):
    clean, tables = tmp_path / "clean", tmp_path / "tables"
    shutil.copytree(cleaned[0], clean)
    header = next((clean / "City.csv").glob("part-*.csv")).read_text().splitlines()[0]
    assert _run(monkeypatch, spark, "load", clean, tables) == 0
    _line(clean, "City", f"{header}\nCTY00001,again\n")
    assert _run(monkeypatch, spark, "load", clean, tables) == 1
    assert "primary key City." in capfd.readouterr().err
    assert sources.open_tables(spark, str(tables), model.SCHEMAS)["City"].count() == 5
    assert len([*(tables / "_versions").iterdir()]) == 1
    _line(clean, "City", f"{header}\nCTY00006,new\n")
    assert _run(monkeypatch, spark, "load", clean, tables) == 0
    assert sources.open_tables(spark, str(tables), model.SCHEMAS)["City"].count() == 6
    # The former set stays for those who read it.
    assert len([*(tables / "_versions").iterdir()]) == 2


def test_the_two_latest_sets_stay(spark, tmp_path):
    for k in range(4):
        staged = sources.staging_folder(str(tmp_path))
        sources.rebuild({"t": spark.range(k)}, staged)
        sources.publish(spark, str(tmp_path), staged)
        assert sources.open_tables(spark, str(tmp_path), {"t": "id long"})["t"].count() == k
        assert len([*(tmp_path / "_versions").iterdir()]) == min(k + 1, 2)


def test_of_two_loads_at_once_one_fails(spark, tmp_path):
    staged = [sources.staging_folder(str(tmp_path)) for _ in range(2)]
    sources.publish(spark, str(tmp_path), staged[0])
    (tmp_path / "_manifest" / "2").write_text("{}")
    real = files._manifests
    try:
        files._manifests = lambda *_: [1]
        with pytest.raises(FileExistsError):
            sources.publish(spark, str(tmp_path), staged[1])
    finally:
        files._manifests = real
    (tmp_path / "_manifest" / "2").unlink()
    assert sources.published(spark, str(tmp_path))["path"] == staged[0]


def test_reports_join_tables_as_they_lie(monkeypatch, spark, cleaned, tmp_path):
    """Lines, quotes and orders meet without a shuffle or a sort of any of them."""
    tables = tmp_path / "tables"
    assert _run(monkeypatch, spark, "load", cleaned[0], tables) == 0
    opened = sources.open_tables(spark, str(tables), model.SCHEMAS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = opened["QuoteLineItem"].select("quote_id", "quantity").join(opened["Orders"].select("quote_id", "order_date"), "quote_id")
        joined = lines.join(opened["Quote"].select("quote_id", "discount"), "quote_id").groupBy("quote_id").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
    plain = {n: spark.read.parquet(f"{sources.published(spark, str(tables))['path']}/{n}.parquet") for n in ("QuoteLineItem", "Orders")}
    assert lines.count() == plain["QuoteLineItem"].join(plain["Orders"], "quote_id").count() > 0
