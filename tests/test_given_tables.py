"""Every registered query against its SQL on DuckDB, over the smallest given tables."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from salesops.plans.given import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _check_plan(plan):
    """No cross join, no Python, pruned scans, and only summaries in one partition."""
    assert not re.search(r"CartesianProduct|NestedLoop|EvalPython|InPandas|InArrow", plan)
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next((x for x in lines[i + 1 :] if not re.search(r"[:+]- (\*\(\d+\) )?Project|Union", x)), "")
            assert re.search(r"Aggregate|LocalLimit|LocalTableScan", below), (line, below)


def _compare(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    _check_plan(result._jdf.queryExecution().executedPlan().toString())
    columns = sorted(result.columns)
    rows = sorted(repr([row[c] for c in columns]) for row in result.collect())
    expected = duck.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in expected.description}
    assert sorted(described) == columns
    assert {f.name: TYPES.get(f.dataType.simpleString()) for f in result.schema.fields} == described
    order = [d[0] for d in expected.description]
    wanted = sorted(repr([row[order.index(c)] for c in columns]) for row in expected.fetchall())
    assert rows == wanted


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    _compare(spark, duck, name)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["quarter", "category", "orders", "units_sold", "revenue"]
    assert result.count() > 0


@pytest.mark.parametrize(
    "name, columns",
    [
        ("quarterly_sales_by_category", {"l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"}),
        ("rep_leaderboard", {"l_orderkey", "l_suppkey", "l_extendedprice"}),
        ("win_rate_by_band", {"l_orderkey", "l_discount"}),
        ("fanout_audit", {"l_orderkey"}),
        ("check_foreign_keys", {"l_orderkey", "l_partkey", "l_suppkey"}),
        ("drop_orphans_chain", {"l_orderkey"}),
    ],
)
def test_scans_read_the_needed_columns_only(spark, name, columns):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "lineitem.parquet" in line]
    for scan in scans:
        listed = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
        assert {c.split("#")[0] for c in listed.split(",")} <= columns
    assert scans or name == "rep_leaderboard"


@pytest.mark.parametrize(
    "name",
    [
        "dedupe_keep_last", "drop_orphans", "drop_orphans_chain", "cascade_delete", "above_city_mean",
        "repoint_fk", "hash_fill", "rep_leaderboard", "pareto_curve", "global_row_number", "build_dimensions",
    ],
)
def test_query_without_broadcast(no_broadcast, many_ranges, duck, name):
    """The other way of every size check, over several ranges, gives the same rows."""
    _compare(no_broadcast, duck, name)
