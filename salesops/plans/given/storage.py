"""Readers, writers and the catalog on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops import sources
from salesops.plans.given.registry import GivenTables, query
from salesops.session import scratch_path


def _exported(t: GivenTables, names: dict[str, DataFrame]) -> str:
    """The tables as a folder of CSVs below the shared scratch folder."""
    folder = scratch_path(t.spark, "csv")
    sources.write_tables(names, folder, "csv")
    return folder


def _customers(t: GivenTables) -> DataFrame:
    """Names with commas and quotes, and empty fields, to test the quoting."""
    return t["customer"].select(
        "c_custkey",
        F.concat("c_name", F.lit(', the "'), "c_mktsegment", F.lit('"')).alias("c_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.col("c_acctbal").cast("int").cast("string").alias("rounded"),
    )


_CUSTOMERS = """SELECT {key} AS c_custkey, c_name || ', the "' || c_mktsegment || '"' AS c_name,
  CASE WHEN c_acctbal >= 0 THEN {balance} END AS c_acctbal"""


@query(
    _CUSTOMERS.format(key="CAST(c_custkey AS VARCHAR)", balance="CAST(c_acctbal AS VARCHAR)")
    + ", CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) AS rounded FROM customer"
)
def read_raw_csv(t: GivenTables) -> DataFrame:
    folder = _exported(t, {"customer": _customers(t)})
    return sources.read_raw_csv(t.spark, f"{folder}/customer.csv")


@query(
    """SELECT 'customer' AS "table", count(*) AS total_rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'supplier', count(*) FROM supplier"""
)
def read_catalog(t: GivenTables) -> DataFrame:
    folder = _exported(t, {"customer": _customers(t), "orders": t["orders"], "supplier": t["supplier"]})
    return sources.table_counts(sources.read_catalog(t.spark, folder))


@query(
    _CUSTOMERS.format(key="c_custkey", balance="CAST(c_acctbal AS DOUBLE)")
    + ", CAST(trunc(c_acctbal) AS BIGINT) AS rounded FROM customer"
)
def load_typed(t: GivenTables) -> DataFrame:
    """Columns in another order than in the file: they are bound by name."""
    folder = _exported(t, {"customer": _customers(t)})
    schema = "rounded bigint, c_acctbal double, c_name string, c_custkey bigint"
    return sources.load_typed(t.spark, f"{folder}/customer.csv", schema)


@query(
    """SELECT 'customer' AS "table", 'c_name' AS "column", count(*) AS lost FROM customer
UNION ALL SELECT 'customer', 'c_custkey', CAST(0 AS BIGINT)"""
)
def lost_values(t: GivenTables) -> DataFrame:
    """A name read as a number is lost in every row, a key in none."""
    folder = _exported(t, {"customer": _customers(t)})
    raw = sources.read_raw_csv(t.spark, f"{folder}/customer.csv")
    return sources.lost_values(raw, "c_name int, c_custkey bigint", "customer")


_COUNTS = """SELECT 'lineitem' AS "table", count(*) AS total_rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'customer', count(*) FROM customer"""


def _three(t: GivenTables) -> dict[str, DataFrame]:
    return {name: t[name] for name in ("lineitem", "orders", "customer")}


@query(_COUNTS)
def write_tables(t: GivenTables) -> DataFrame:
    """Counts taken while writing."""
    counts = sources.write_tables(_three(t), scratch_path(t.spark, "tables"))
    return t.spark.createDataFrame(list(counts.items()), "table string, total_rows bigint")


@query(_COUNTS)
def rebuild(t: GivenTables) -> DataFrame:
    """Writing a second time replaces the tables, it does not append."""
    folder = scratch_path(t.spark, "rebuild")
    sources.rebuild(_three(t), folder)
    sources.rebuild(_three(t), folder)
    written = {name: t.spark.read.parquet(f"{folder}/{name}.parquet") for name in _three(t)}
    return sources.table_counts(written)


_SQL = """SELECT n_name, count(*) AS customers FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name"""


@query(_SQL.format(customer="customer", nation="nation"))
def register_and_sql(t: GivenTables) -> DataFrame:
    sources.register_tables({"sales_customer": t["customer"], "sales_nation": t["nation"]})
    return sources.run_sql(t.spark, _SQL.format(customer="sales_customer", nation="sales_nation"))


@query(_COUNTS)
def table_counts(t: GivenTables) -> DataFrame:
    return sources.table_counts(_three(t))


def laid_out(t: GivenTables, buckets: int = 8) -> dict[str, DataFrame]:
    """Orders and lines in buckets of their order key, below the shared scratch folder."""
    folder, keys = scratch_path(t.spark, "buckets"), {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    layout = {name: {"key": key, "buckets": buckets} for name, key in keys.items()}
    sources.rebuild({name: t[name] for name in keys}, folder, layout=layout)
    schemas = {name: ", ".join(f"{c} {kind}" for c, kind in t[name].dtypes) for name in keys}
    return sources.open_set(t.spark, folder, schemas, layout)


@query(
    """SELECT o_orderkey, max(o_orderstatus) AS status, count(*) AS total_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"""
)
def bucketed_line_totals(t: GivenTables) -> DataFrame:
    """J1 over tables laid out by key: orders, their lines and the grouping need no shuffle and no sort."""
    tables = laid_out(t)
    # A side may be small enough to be broadcast; the merge join is asked for, as facts are large.
    joined = tables["orders"].hint("merge").join(tables["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey").agg(
        F.max("o_orderstatus").alias("status"), F.count(F.lit(1)).alias("total_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("units")
    )
