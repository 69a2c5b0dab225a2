"""Cleaning operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.functions import repair_prefix
from salesops.operators import dimensions as dim
from salesops.operators import ordering, rows
from salesops.plans.given.registry import GivenTables, money, query, sql_big, sql_key, sql_money
from salesops.session import materialize

# A priority that stands for "no value" in these queries.
NO_PRIORITY = ("", "4-NOT SPECIFIED")
# All other line columns, in this order, give lines with the same key a total order.
LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINE_ORDER_DESC = ", ".join(f"{c} DESC" for c in LINE_ORDER)


def _priorities(t: GivenTables) -> DataFrame:
    """A raw lookup: one row per occurrence, its id a text."""
    return t["orders"].select(F.col("o_orderkey").cast("string").alias("priority_id"), F.col("o_orderpriority").alias("priority"))


_PRIORITY_DIM = f"""SELECT {sql_key("PRI", "row_number() OVER (ORDER BY priority)")} AS priority_id, priority
  FROM (SELECT DISTINCT o_orderpriority AS priority FROM orders WHERE o_orderpriority NOT IN ('', '4-NOT SPECIFIED'))"""


def _priority_dim(t: GivenTables) -> DataFrame:
    return dim.build_dimension(_priorities(t), "priority_id", "priority", "PRI", NO_PRIORITY)


@query(_PRIORITY_DIM)
def build_dimension(t: GivenTables) -> DataFrame:
    return _priority_dim(t)


@query(
    f"""WITH v AS (
  SELECT DISTINCT 'priority' AS dimension, o_orderpriority AS value FROM orders WHERE o_orderpriority NOT IN ('', '4-NOT SPECIFIED')
  UNION SELECT DISTINCT 'segment', c_mktsegment FROM customer UNION SELECT DISTINCT 'part', p_name FROM part)
SELECT dimension, upper(substr(dimension, 1, 3)) || printf('%05d', row_number() OVER (PARTITION BY dimension ORDER BY value)) AS id,
  value FROM v"""
)
def build_dimensions(t: GivenTables) -> DataFrame:
    customers = t["customer"].select("c_custkey", "c_mktsegment")
    parts = t["part"].select("p_partkey", "p_name")
    built, _ = dim.build_dimensions(
        {
            "priority": (_priorities(t), "id", "priority", "PRI", NO_PRIORITY),
            "segment": (customers, "id", "c_mktsegment", "SEG", ()),
            "part": (parts, "id", "p_name", "PAR", ()),
        }
    )
    frames = [df.toDF("id", "value").select(F.lit(name).alias("dimension"), "id", "value") for name, df in built.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    f"""SELECT {sql_key("CUS", "row_number() OVER (ORDER BY c_name)")} AS customer_id, c_name
  FROM (SELECT DISTINCT c_name FROM customer)"""
)
def surrogate_key(t: GivenTables) -> DataFrame:
    return dim.surrogate_keys(t["customer"], "c_name", "CUS", "customer_id")


_LAST_LINE = f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER_DESC}) AS rn FROM lineitem"""


@query(
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS old_id, l_returnflag AS value FROM (
  SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, {_LINE_ORDER_DESC}) AS rn
  FROM lineitem) WHERE rn = 1"""
)
def id_value_map(t: GivenTables) -> DataFrame:
    lookup = t["lineitem"].withColumn("id", F.col("l_orderkey").cast("string"))
    return dim.id_value_map(lookup, "id", "l_returnflag", F.struct("l_linenumber", *LINE_ORDER))


def _priority_mapping(t: GivenTables) -> DataFrame:
    lookup = _priorities(t)
    id_map = dim.id_value_map(lookup, "priority_id", "priority", "priority")
    return dim.key_mapping(id_map, materialize(_priority_dim(t)), "priority_id", "priority")


@query(
    f"""WITH dim AS ({_PRIORITY_DIM})
SELECT l_orderkey, {sql_big("l_linenumber")} AS l_linenumber, l_partkey, l_suppkey, priority_id
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN dim ON priority = o_orderpriority"""
)
def repoint_fk(t: GivenTables) -> DataFrame:
    lines = t["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_orderkey").cast("string").alias("priority_id")
    )
    return dim.repoint_fk(lines, "priority_id", _priority_mapping(t))


@query(
    f"""SELECT {sql_key("VAL", "row_number() OVER (ORDER BY value)")} AS value_id, value
  FROM (SELECT p_type AS value FROM part UNION SELECT c_mktsegment FROM customer)"""
)
def merge_dimensions(t: GivenTables) -> DataFrame:
    return dim.merge_dimensions([(t["part"], "p_type"), (t["customer"], "c_mktsegment")], "VAL", "value_id", "value")


def _city_mapping(t: GivenTables, prefix: str) -> DataFrame:
    """Raw city lookup with prefixed ids -> keys of the city dimension."""
    lookup = t["nation"].select(F.format_string(f"{prefix}%05d", "n_nationkey").alias("id"), "n_name")
    cities = materialize(dim.merge_dimensions([(t["nation"], "n_name")], "CTY", "city_id", "city_name"))
    return dim.key_mapping(dim.id_value_map(lookup, "id", "n_name", "n_name"), cities, "city_id", "city_name")


_CITIES = f"""WITH city AS (SELECT {sql_key("CTY", "row_number() OVER (ORDER BY n_name)")} AS city_id, n_name AS city_name
  FROM (SELECT DISTINCT n_name FROM nation))"""


@query(
    f"""{_CITIES} SELECT c_custkey, c_name, city_id FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN city ON city_name = n_name"""
)
def relink(t: GivenTables) -> DataFrame:
    customers = t["customer"].select(
        "c_custkey", "c_name", F.format_string("BCT%05d", "c_nationkey").alias("billing_city_id")
    )
    return dim.relink(customers, "billing_city_id", _city_mapping(t, "BCT"), "city_id")


def _repaired(t: GivenTables) -> DataFrame:
    suppliers = t["supplier"].select(
        "s_suppkey",
        F.concat(F.lit("via CIT "), "s_name").alias("s_note"),
        # Part of the keys is beyond repair.
        F.when(F.col("s_acctbal") < 0, F.format_string("XIT%05d", "s_nationkey"))
        .otherwise(F.format_string("CIT%05d", "s_nationkey"))
        .alias("shipping_city_id"),
    )
    fixed = repair_prefix("shipping_city_id", "CIT", "SCT")
    return dim.relink(suppliers, "shipping_city_id", _city_mapping(t, "SCT"), "city_id", fixed)


@query(
    f"""{_CITIES} SELECT s_suppkey, 'via CIT ' || s_name AS s_note, CASE WHEN s_acctbal < 0 THEN NULL ELSE city_id END AS city_id
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN city ON city_name = n_name"""
)
def repair_key_prefix(t: GivenTables) -> DataFrame:
    return _repaired(t)


@query(
    """SELECT count(*) AS total_rows, count(*) FILTER (WHERE s_acctbal >= 0) AS resolved,
  count(*) FILTER (WHERE s_acctbal < 0) AS unresolved FROM supplier"""
)
def recovery_counts(t: GivenTables) -> DataFrame:
    return dim.recovery_counts(_repaired(t), "city_id")


def _md5_mod(x: str, n: str) -> str:
    """The 128-bit digest modulo n, word by word."""
    r = "CAST(0 AS BIGINT)"
    for start in (1, 9, 17, 25):
        word = f"CAST(('0x' || substr(md5({x}), {start}, 8)) AS BIGINT)"
        r = f"(({r} * (4294967296 % {n}) + {word}) % {n})"
    return r


@query(
    f"""WITH seg AS (SELECT {sql_key("SEG", "row_number() OVER (ORDER BY v)")} AS id, v, row_number() OVER (ORDER BY v) AS rn
  FROM (SELECT DISTINCT c_mktsegment AS v FROM customer)),
n AS (SELECT count(*) AS n FROM seg),
picked AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, {_md5_mod("c_name", "n")} AS pick FROM customer, n)
SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 5000 THEN g.id ELSE f.id END AS segment_id, c_acctbal >= 5000 AS genuine
  FROM picked JOIN seg g ON g.v = c_mktsegment JOIN seg f ON f.rn = pick + 1"""
)
def hash_fill(t: GivenTables) -> DataFrame:
    """Customers with a low balance have a dangling segment id or none at all."""
    customers = t["customer"]
    lookup = customers.select(F.col("c_custkey").cast("string").alias("id"), "c_mktsegment")
    segments = materialize(dim.build_dimension(lookup, "segment_id", "c_mktsegment", "SEG", place="place"))
    id_map = dim.id_value_map(lookup, "id", "c_mktsegment", "c_mktsegment")
    mapping = dim.key_mapping(id_map, segments, "segment_id", "c_mktsegment")
    fact = customers.select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_acctbal") >= 5000, F.col("c_custkey").cast("string"))
        .when(F.col("c_acctbal") >= 0, F.lit("JOB99999"))
        .alias("segment_id"),
    )
    return dim.hash_fill(fact, "c_name", "segment_id", mapping, segments, "segment_id", "c_mktsegment", "genuine", "place")


_LINE = f"l_orderkey, {sql_big('l_linenumber')} AS l_linenumber, " + ", ".join(LINE_ORDER)


@query(f"SELECT {_LINE} FROM ({_LAST_LINE}) WHERE rn = 1")
def dedupe_keep_last(t: GivenTables) -> DataFrame:
    return rows.dedupe_keep_last(t["lineitem"], ["l_orderkey", "l_linenumber"], F.struct(*LINE_ORDER))


@query(f"SELECT {_LINE} FROM ({_LAST_LINE}) WHERE rn > 1")
def discarded_rows(t: GivenTables) -> DataFrame:
    lines = t["lineitem"].withColumn("_ordinal", F.struct("l_orderkey", "l_linenumber", *LINE_ORDER))
    return rows.discarded_rows(lines, ["l_orderkey", "l_linenumber"], "_ordinal").drop("_ordinal")


@query(
    f"""WITH e AS (SELECT user_id, event_type, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events), k AS (SELECT user_id, event_type AS kept FROM e WHERE rn = 1)
SELECT user_id, count(*) AS total_rows, count(*) - 1 AS lost, count(*) FILTER (WHERE event_type <> kept) AS lost_conflicting,
  count(DISTINCT event_type) AS variants FROM e JOIN k USING (user_id) GROUP BY 1 HAVING count(*) > 1"""
)
def duplicate_report(t: GivenTables) -> DataFrame:
    """Events per user; copies with the same type count as equal."""
    seen = t["events"].select("user_id", "event_type", F.struct("ts", "event_id").alias("_ordinal"))
    return rows.duplicate_report(seen, "user_id", "_ordinal")


def _dated(t: GivenTables) -> DataFrame:
    """Orders whose close date and note hold a sentinel text while they are open."""
    return t["orders"].select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", "Na")
        .when(F.col("o_orderstatus") == "P", "na")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("Close_Date"),
        F.when(F.col("o_orderstatus") == "O", "Na").otherwise(F.col("o_orderpriority")).alias("note"),
    )


_DATED = """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN NULL WHEN 'P' THEN 'na'
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS Close_Date,
  CASE WHEN o_orderstatus = 'O' THEN 'Na' ELSE o_orderpriority END AS note FROM orders"""


@query(_DATED)
def null_sentinels(t: GivenTables) -> DataFrame:
    return rows.null_sentinels(_dated(t))


@query(f"SELECT * FROM ({_DATED}) WHERE Close_Date IS NOT NULL")
def require_non_blank(t: GivenTables) -> DataFrame:
    return rows.require_non_blank(rows.null_sentinels(_dated(t)), "Close_Date")


def _linked_orders(t: GivenTables) -> DataFrame:
    """Orders; the ones of low priority have no customer."""
    return t["orders"].select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("o_custkey")
    )


_KEPT_ORDERS = """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey FROM orders
  WHERE o_orderpriority = '5-LOW' OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""


@query(_KEPT_ORDERS)
def drop_orphans(t: GivenTables) -> DataFrame:
    return rows.drop_orphans(_linked_orders(t), "o_custkey", t["customer"].where("c_acctbal >= 0"), "c_custkey")


@query(
    f"""WITH o AS ({_KEPT_ORDERS}), l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
SELECT 'customer' AS "table", count(*) AS n FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'orders', count(*) FROM o UNION ALL SELECT 'lineitem', count(*) FROM l"""
)
def drop_orphans_chain(t: GivenTables) -> DataFrame:
    kept = rows.drop_orphans_chain(
        {
            "customer": t["customer"].where("c_acctbal >= 0").select("c_custkey"),
            "orders": _linked_orders(t),
            "lineitem": t["lineitem"].select("l_orderkey", "l_linenumber"),
        },
        [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")],
    )
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in kept.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT * FROM orders")
def pass_through(t: GivenTables) -> DataFrame:
    return t["orders"]


@query("SELECT s_suppkey AS rep_id, s_name AS rep_name, s_acctbal AS balance, 'n' || s_nationkey AS area FROM supplier")
def column_surgery(t: GivenTables) -> DataFrame:
    """Rename by position, add a column, drop one."""
    renamed = rows.rename_positional(t["supplier"], ["rep_id", "rep_name", "nation", "balance"])
    return renamed.withColumn("area", F.concat(F.lit("n"), F.col("nation").cast("string"))).drop("nation")


@query(
    f"""WITH last AS ({_LAST_LINE}), o AS ({_KEPT_ORDERS})
SELECT 'keep last' AS step, 'lineitem' AS "table", 'rows_before' AS metric, count(*) AS value FROM lineitem
UNION ALL SELECT 'keep last', 'lineitem', 'rows_after', count(*) FROM last WHERE rn = 1
UNION ALL SELECT 'orphans', 'orders', 'rows_before', count(*) FROM orders
UNION ALL SELECT 'orphans', 'orders', 'rows_after', count(*) FROM o"""
)
def audit_log(t: GivenTables) -> DataFrame:
    keys = t["lineitem"]
    deduped = rows.dedupe_keep_last(keys, ["l_orderkey", "l_linenumber"], F.struct(*LINE_ORDER))
    entries = rows.before_after("keep last", "lineitem", keys, deduped)
    entries += rows.before_after("orphans", "orders", t["orders"], drop_orphans(t))
    return rows.audit_log(entries)


@query(
    """SELECT 'part type' AS "table", count(*) AS total_rows, count(DISTINCT p_type) AS distinct_values FROM part
UNION ALL SELECT 'priority', count(*), count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'return flag', count(*), count(DISTINCT l_returnflag) FROM lineitem
UNION ALL SELECT 'segment', count(*), count(DISTINCT c_mktsegment) FROM customer"""
)
def profile_lookup(t: GivenTables) -> DataFrame:
    return rows.profile_lookup(
        {
            "part type": (t["part"], "p_type"),
            "priority": (t["orders"], "o_orderpriority"),
            "return flag": (t["lineitem"], "l_returnflag"),
            "segment": (t["customer"], "c_mktsegment"),
        }
    )


@query(
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders"""
)
def global_row_number(t: GivenTables) -> DataFrame:
    """Row number over all rows without a single-partition window."""
    orders = t["orders"].select("o_orderkey", "o_totalprice")
    return ordering.number_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


@query(
    """SELECT o_orderkey, o_orderdate, rank() OVER (ORDER BY o_orderdate DESC) AS date_rank FROM orders"""
)
def global_rank(t: GivenTables) -> DataFrame:
    """Rank over all rows; dates have many peers."""
    orders = materialize(t["orders"].select("o_orderkey", "o_orderdate", F.unix_date(F.to_date("o_orderdate")).alias("_day")))
    return ordering.add_ranks(orders, {"date_rank": "_day"}).drop("_day")


@query(
    f"""SELECT DISTINCT qty, {sql_big("count(*) OVER (PARTITION BY qty)")} AS peers, {sql_big("rank() OVER (ORDER BY qty DESC)")} - 1 AS rows_before,
  CAST(sum(amount) OVER (ORDER BY qty DESC) AS DOUBLE) AS running_total
  FROM (SELECT {sql_big("l_quantity")} AS qty, {sql_money("l_extendedprice")} AS amount FROM lineitem)"""
)
def running_total_with_peers(t: GivenTables) -> DataFrame:
    """Running total in which peers share the total."""
    lines = t["lineitem"].select(F.col("l_quantity").cast("bigint").alias("qty"), money("l_extendedprice").alias("amount"))
    return ordering.ordered_totals(lines, "qty", "amount").select("qty", "peers", "rows_before", "running_total")
