"""Constraint checks on the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.operators import integrity as v
from salesops.operators.integrity import ForeignKey
from salesops.plans.given.registry import GivenTables, money, query, sql_big, sql_money, sql_total
from salesops.plans.given.reports import orders_by_nation

KEYS = [
    ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey", True),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey", True),
    ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]
PRIMARY = {"nation": "n_nationkey", "customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey"}


def _tables(t: GivenTables) -> dict[str, DataFrame]:
    return {name: t[name] for name in ("nation", "customer", "orders", "lineitem", "part", "supplier")}


KNOWN_CUSTOMERS, KNOWN_PARTS = "customers in credit", "small parts"
BROKEN_KEYS = [
    replace(k, parent={"customer": KNOWN_CUSTOMERS, "part": KNOWN_PARTS}.get(k.parent, k.parent)) for k in KEYS
]


def _broken(t: GivenTables) -> dict[str, DataFrame]:
    """Parents with rows taken out, under names of their own, and orders of low priority without a customer."""
    tables = _tables(t)
    tables[KNOWN_CUSTOMERS] = tables["customer"].where("c_acctbal >= 0")
    tables[KNOWN_PARTS] = tables["part"].where("p_size <= 40")
    tables["orders"] = tables["orders"].withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    )
    return tables


_VIOLATIONS = """SELECT 'customer' AS child, 'c_nationkey' AS fk, 'nation' AS parent, count(*) AS violations
  FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'orders', 'o_custkey', 'customers in credit', count(*) FROM orders
  WHERE o_orderpriority <> '5-LOW' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT 'lineitem', 'l_orderkey', 'orders', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem', 'l_partkey', 'small parts', count(*) FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)
UNION ALL SELECT 'lineitem', 'l_suppkey', 'supplier', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"""


@query(_VIOLATIONS)
def check_foreign_keys(t: GivenTables) -> DataFrame:
    return v.check_foreign_keys(_broken(t), BROKEN_KEYS)


@query(
    f"""SELECT child, parent, {sql_big("sum(violations)")} AS violations FROM ({_VIOLATIONS}) GROUP BY 1, 2 HAVING sum(violations) > 0"""
)
def violation_summary(t: GivenTables) -> DataFrame:
    return v.violation_summary(v.check_foreign_keys(_broken(t), BROKEN_KEYS))


def _unique_sql(table: str, key: str, columns: str, source: str | None = None) -> str:
    first = columns.split(",")[0]
    return f"""SELECT '{table}' AS "table", '{key}' AS key, count(*) FILTER (WHERE n > 1 AND known) AS duplicate_keys,
  {sql_big("coalesce(sum(CASE WHEN n > 1 AND known THEN n - 1 END), 0)")} AS extra_rows,
  {sql_big("coalesce(sum(CASE WHEN NOT known THEN n END), 0)")} AS null_rows
  FROM (SELECT {columns}, count(*) AS n, {first} IS NOT NULL AS known FROM {source or table} GROUP BY ALL)"""


@query(
    " UNION ALL ".join(
        [
            _unique_sql("lineitem", "l_orderkey, l_linenumber", "l_orderkey, l_linenumber"),
            _unique_sql("orders", "o_orderkey", "o_orderkey"),
            _unique_sql("customer", "c_custkey", "c_custkey"),
        ]
    )
)
def check_primary_key(t: GivenTables) -> DataFrame:
    return v.check_unique(
        _tables(t), [("lineitem", ("l_orderkey", "l_linenumber")), ("orders", "o_orderkey"), ("customer", "c_custkey")]
    )


@query(
    " UNION ALL ".join(
        [
            _unique_sql("part", "p_name", "p_name"),
            _unique_sql("supplier", "s_name", "s_name"),
            _unique_sql("orders", "o_custkey", "k", "(SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS k FROM orders)"),
        ]
    )
)
def check_unique(t: GivenTables) -> DataFrame:
    return v.check_unique(_broken(t), [("part", "p_name"), ("supplier", "s_name"), ("orders", "o_custkey")])


@query(
    """SELECT 'orders' AS "table", 'not null' AS rule, 'o_custkey' AS "column", count(*) AS violations FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT 'orders', 'not null', 'o_orderdate', count(*) FROM orders WHERE o_orderdate IS NULL
UNION ALL SELECT 'customer', 'not null', 'c_name', count(*) FROM customer WHERE c_name IS NULL"""
)
def check_not_null(t: GivenTables) -> DataFrame:
    return v.check_not_null(_broken(t), {"orders": ["o_custkey", "o_orderdate"], "customer": ["c_name"]})


@query(
    """SELECT 'lineitem' AS "table", 'range' AS rule, 'l_quantity' AS "column", count(*) AS violations FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 20
UNION ALL SELECT 'lineitem', 'range', 'l_discount', count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.05
UNION ALL SELECT 'customer', 'range', 'c_acctbal', count(*) FROM customer WHERE c_acctbal < 0"""
)
def check_range(t: GivenTables) -> DataFrame:
    return v.check_range(
        _tables(t), {"lineitem": {"l_quantity": (1, 20), "l_discount": (0, 0.05)}, "customer": {"c_acctbal": (0, None)}}
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey, CAST(1 AS BIGINT) AS revision_number FROM orders"""
)
def fill_defaults(t: GivenTables) -> DataFrame:
    return v.fill_defaults(
        _broken(t)["orders"].select("o_orderkey", "o_custkey"), {"revision_number": 1, "o_custkey": 0}
    )


@query(
    """WITH c AS (SELECT * FROM customer WHERE c_acctbal >= 0), o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
SELECT 'customer' AS "table", count(*) AS remaining FROM c UNION ALL SELECT 'orders', count(*) FROM o
UNION ALL SELECT 'lineitem', count(*) FROM l"""
)
def cascade_delete(t: GivenTables) -> DataFrame:
    tables = {name: t[name] for name in ("customer", "orders")}
    # A line has no single-column key of its own: it is removed by its order.
    tables["lineitem"] = t["lineitem"].select("l_orderkey")
    gone = tables["customer"].where("c_acctbal < 0").select("c_custkey")
    left = v.cascade_delete(tables, "customer", gone, KEYS, PRIMARY | {"lineitem": "l_orderkey"})
    counts = [df.agg(F.count(F.lit(1)).alias("remaining")).select(F.lit(n).alias("table"), "remaining") for n, df in left.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# Customers name the customer who referred them; disputed lines keep their order, all others go with it.
RESTRICTED_KEYS = [
    ForeignKey("customer", "c_referrer", "customer", "c_custkey"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey", True),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey", True),
    ForeignKey("disputed", "l_orderkey", "orders", "o_orderkey"),
]


def restricted_tables(t: GivenTables) -> dict[str, DataFrame]:
    lines = t["lineitem"]
    disputed = (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 49)
    referrer = F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") + 1).alias("c_referrer")
    return {
        "customer": t["customer"].select("c_custkey", "c_acctbal", referrer),
        "orders": t["orders"].select("o_orderkey", "o_custkey"),
        # A line has no single-column key of its own: it is removed by its order.
        "lineitem": lines.where(~disputed).select("l_orderkey"),
        "disputed": lines.where(disputed).select("l_orderkey"),
    }


@query(
    """WITH RECURSIVE asked AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal < 5000),
disputed AS (SELECT DISTINCT o_custkey AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_quantity >= 49),
refused AS (
  SELECT k FROM asked WHERE k IN (SELECT k FROM disputed)
    OR k IN (SELECT c_custkey + 1 FROM customer WHERE c_custkey % 3 <> 0 AND c_acctbal >= 5000)
  UNION SELECT asked.k FROM refused JOIN asked ON asked.k = refused.k + 1 WHERE refused.k % 3 <> 0),
gone AS (SELECT k FROM asked WHERE k NOT IN (SELECT k FROM refused)),
o AS (SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT k FROM gone)),
l AS (SELECT l_returnflag = 'R' AND l_quantity >= 49 AS d FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
SELECT 'customer' AS "table", count(*) AS remaining FROM customer WHERE c_custkey NOT IN (SELECT k FROM gone)
UNION ALL SELECT 'orders', count(*) FROM o
UNION ALL SELECT 'lineitem', count(*) FROM l WHERE NOT d
UNION ALL SELECT 'disputed', count(*) FROM l WHERE d
UNION ALL SELECT 'refused', count(*) FROM refused"""
)
def cascade_delete_restricted(t: GivenTables) -> DataFrame:
    """Customers with a low balance go, but for those whom a disputed line or a remaining customer needs."""
    tables = restricted_tables(t)
    gone = tables["customer"].where("c_acctbal < 5000").select("c_custkey")
    primary = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}
    left, refused = v.delete_unless_referenced(tables, "customer", gone, RESTRICTED_KEYS, primary)
    counted = None
    for name, df in {**left, "refused": refused}.items():
        one = df.agg(F.count(F.lit(1)).alias("remaining")).select(F.lit(name).alias("table"), "remaining")
        counted = one if counted is None else counted.unionByName(one)
    return counted


_PRICE = sql_money("o_totalprice")


@query(
    f"""WITH a AS (SELECT {sql_total(_PRICE)} AS x, sum({_PRICE}) AS dx FROM orders),
b AS (SELECT {sql_total(_PRICE)} AS y, sum({_PRICE}) AS dy FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
SELECT x AS true_total, y AS joined_total, y / x AS inflation, CAST(dy - dx AS DOUBLE) AS excess FROM a, b"""
)
def fanout_audit(t: GivenTables) -> DataFrame:
    orders = t["orders"].select("o_orderkey", money("o_totalprice").alias("amount"))
    return v.fanout_audit(orders, "o_orderkey", "amount", t["lineitem"], "l_orderkey")


@query(f"SELECT {sql_total(_PRICE)} AS grouped_total, {sql_total(_PRICE)} AS true_total, true AS matches FROM orders")
def reconcile(t: GivenTables) -> DataFrame:
    facts = t["orders"].select(money("o_totalprice").alias("amount"))
    grouped = orders_by_nation(t).groupBy("n_name").agg(F.sum(money("o_totalprice")).alias("total"))
    return v.reconcile(grouped, "total", facts, "amount")


@query(
    f"""SELECT {sql_total(_PRICE)} AS grouped_total, (SELECT {sql_total(_PRICE)} FROM orders) AS true_total, false AS matches
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0"""
)
def reconcile_mismatch(t: GivenTables) -> DataFrame:
    """Totals over part of the customers must be reported as not matching."""
    some = t["customer"].where("c_acctbal >= 0").select(F.col("c_custkey").alias("_kept"))
    grouped = (
        orders_by_nation(t).join(some, F.col("c_custkey") == F.col("_kept"), "left_semi")
        .groupBy("n_name").agg(F.sum(money("o_totalprice")).alias("total"))
    )
    return v.reconcile(grouped, "total", t["orders"].select(money("o_totalprice").alias("amount")), "amount")


@query(
    """SELECT count(*) AS parents, count(*) FILTER (WHERE n >= 2) AS parents_with_many
  FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)"""
)
def lines_per_parent(t: GivenTables) -> DataFrame:
    return v.lines_per_parent(t["lineitem"], "l_orderkey")
