"""Single expressions, joins, aggregates, windows, sorts and set operations
(P, J, G, W, T, U, F). Each is what a Spark user writes for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesops import functions as sf
from salesops.operators import rows
from salesops.operators.analytics import distinct_by_bitmap as count_by_bitmap
from salesops.operators.ordering import add_ranks, number_output, rank_within, shift_over_ranges
from salesops.plans.given.reports import orders_by_nation
from salesops.plans.given.registry import (
    GivenTables,
    money,
    query,
    sql_big,
    sql_mean,
    sql_money,
    sql_percent,
    sql_quarter,
    sql_round,
    sql_total,
)
from salesops.session import materialize, small_side

# --- projections, filters, predicates -------------------------------------------------


@query(
    f"""SELECT o_orderkey AS id, {sql_quarter("o_orderdate")} AS quarter, o_orderstatus || '/' || o_orderpriority AS label FROM orders"""
)
def project_computed_columns(t: GivenTables) -> DataFrame:
    """P1, F3"""
    return t["orders"].select(
        F.col("o_orderkey").alias("id"),
        sf.quarter_label("o_orderdate").alias("quarter"),
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("label"),
    )


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_name <> '' AND c_nationkey <= 10 AND c_acctbal > 1000")
def filter_comparisons(t: GivenTables) -> DataFrame:
    """P2"""
    c = F.col
    wanted = (c("c_mktsegment") == "BUILDING") & (c("c_name") != "") & (c("c_nationkey") <= 10) & (c("c_acctbal") > 1000)
    return t["customer"].where(wanted).select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'P')")
def filter_in_list(t: GivenTables) -> DataFrame:
    """P3"""
    return t["orders"].where(F.col("o_orderstatus").isin("O", "P")).select("o_orderkey")


@query("SELECT event_id, user_id FROM events WHERE value IS NOT NULL AND value BETWEEN 1 AND 100")
def filter_not_null_between(t: GivenTables) -> DataFrame:
    """P4, P5"""
    value = F.col("value")
    return t["events"].where(value.isNotNull() & value.between(1, 100)).select("event_id", "user_id")


@query("SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'middle' ELSE 'large' END AS size_band FROM part")
def case_buckets(t: GivenTables) -> DataFrame:
    """P6"""
    band = F.when(F.col("p_size") <= 10, "small").when(F.col("p_size") <= 30, "middle").otherwise("large")
    return t["part"].select("p_partkey", band.alias("size_band"))


_BIG = """WITH priced AS (SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2002-01-01') AS age FROM orders),
old AS (SELECT * FROM priced WHERE age > 1000) SELECT o_orderkey, age FROM old"""


@query(_BIG)
def filter_on_computed_column(t: GivenTables) -> DataFrame:
    """P7, P8"""
    priced = t["orders"].select(
        "o_orderkey", sf.days_between(F.lit("2002-01-01").cast("date"), "o_orderdate").alias("age")
    )
    return priced.where(F.col("age") > 1000)


@query(f"SELECT o_orderkey FROM orders WHERE {sql_money('o_totalprice')} > (SELECT {sql_mean(sql_money('o_totalprice'))} FROM orders)")
def scalar_subquery(t: GivenTables) -> DataFrame:
    """The one-value subquery runs once and is pushed to the scan."""
    orders = t["orders"].select("o_orderkey", money("o_totalprice").alias("price"))
    average = orders.agg(sf.mean("price")).scalar()
    return orders.where(F.col("price").cast("double") > average).select("o_orderkey")


@query(
    f"""WITH c AS (SELECT *, {sql_money("c_acctbal")} AS score FROM customer)
SELECT a.c_custkey, (SELECT {sql_mean("b.score")} FROM c b WHERE b.c_nationkey = a.c_nationkey) AS nation_mean FROM c a
WHERE CAST(a.score AS DOUBLE) > (SELECT {sql_mean("b.score")} FROM c b WHERE b.c_nationkey = a.c_nationkey)"""
)
def correlated_mean(t: GivenTables) -> DataFrame:
    """The correlated mean is built once per group and joined back."""
    customers = t["customer"].select("c_custkey", "c_nationkey", money("c_acctbal").alias("score"))
    means = small_side(customers.groupBy(F.col("c_nationkey").alias("_nation")).agg(sf.mean("score").alias("nation_mean")))
    joined = customers.join(means, F.col("c_nationkey") == F.col("_nation"))
    return joined.where(F.col("score").cast("double") > F.col("nation_mean")).select("c_custkey", "nation_mean")


@query(
    """SELECT 'customers' AS name, (SELECT count(*) FROM customer) AS n UNION ALL SELECT 'orders', (SELECT count(*) FROM orders)
UNION ALL SELECT 'lines', (SELECT count(*) FROM lineitem)"""
)
def inline_rows(t: GivenTables) -> DataFrame:
    """P11, U2, G7"""
    def count(name: str, table: str) -> DataFrame:
        return t[table].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")

    return count("customers", "customer").unionByName(count("orders", "orders")).unionByName(count("lines", "lineitem"))


@query("SELECT o_orderkey, o_orderdate FROM orders")
def columns_by_pattern(t: GivenTables) -> DataFrame:
    """P12"""
    orders = t["orders"]
    return orders.select("o_orderkey", *rows.columns_matching(orders, "DATE"))


# --- joins ----------------------------------------------------------------------------


@query(
    f"""SELECT r_name, n_name, p_type, {sql_total(sql_money("l_extendedprice"))} AS revenue FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3"""
)
def join_six_tables(t: GivenTables) -> DataFrame:
    """Lines are reduced per order and type before they meet orders and customers."""
    parts = t["part"].select("p_partkey", "p_type")
    per_order = (
        t["lineitem"].select("l_orderkey", "l_partkey", sf.minor_units("l_extendedprice").alias("amount"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey", "p_type")
        .agg(F.sum("amount").alias("amount"))
    )
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    customers = t["customer"].select("c_custkey", "c_nationkey").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        per_order.join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("r_name", "n_name", "p_type")
        .agg(sf.major_units(F.sum("amount"), 100).alias("revenue"))
    )


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, p_name FROM lineitem
  LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) ON l_partkey = p_partkey"""
)
def join_left_lookup(t: GivenTables) -> DataFrame:
    """J2"""
    parts = t["part"].where("p_size <= 25").select("p_partkey", "p_name")
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def join_left_semi(t: GivenTables) -> DataFrame:
    """J3"""
    returned = t["lineitem"].where("l_returnflag = 'R'").select("l_orderkey")
    return t["orders"].select("o_orderkey").join(returned, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_left_anti(t: GivenTables) -> DataFrame:
    """J4"""
    lines = t["lineitem"].select("l_orderkey")
    return t["orders"].select("o_orderkey").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")


@query("SELECT o_orderkey, date_diff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS age FROM orders")
def one_row_aggregate(t: GivenTables) -> DataFrame:
    """The one-row side is a scalar subquery, no cross join."""
    orders = t["orders"]
    last = orders.agg(F.max("o_orderdate")).scalar()
    return orders.select("o_orderkey", sf.days_between(last, "o_orderdate").alias("age"))


# --- aggregates -----------------------------------------------------------------------


@query(
    f"""SELECT event_type, count(*) AS n, count(value) AS with_value, count(DISTINCT user_id) AS users,
  {sql_total(sql_money("value"))} AS total, {sql_mean(sql_money("value"))} AS average, min(value) AS low, max(value) AS high
  FROM events GROUP BY 1"""
)
def grouped_aggregates(t: GivenTables) -> DataFrame:
    """G1, G2, G3"""
    events = t["events"].select("event_type", "user_id", "value", money("value").alias("amount"))
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("value").alias("with_value"),
        F.countDistinct("user_id").alias("users"),
        F.sum("amount").alias("total"),
        sf.mean("amount").alias("average"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


@query(
    f"""SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS shipped, max(CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END)::BIGINT AS taxed,
  {sql_percent("count(*) FILTER (WHERE l_linestatus = 'F')", "count(*)")} AS shipped_pct FROM lineitem GROUP BY 1"""
)
def conditional_aggregates(t: GivenTables) -> DataFrame:
    """G4, G5, F16"""
    shipped = F.count_if(F.col("l_linestatus") == "F")
    return t["lineitem"].groupBy("l_returnflag").agg(
        shipped.alias("shipped"),
        F.max(F.when(F.col("l_tax") > 0.07, 1).otherwise(0)).alias("taxed"),
        sf.percent(shipped, F.count(F.lit(1))).alias("shipped_pct"),
    )


@query(
    """SELECT n_lines, count(*) AS orders FROM (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) GROUP BY 1"""
)
def two_level_aggregate(t: GivenTables) -> DataFrame:
    """G6"""
    per_order = t["lineitem"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
    return per_order.groupBy("n_lines").agg(F.count(F.lit(1)).alias("orders"))


@query(
    f"""SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers, {sql_total(sql_money("o_totalprice"))} AS total,
  max(o_orderdate) AS latest FROM orders"""
)
def global_aggregate(t: GivenTables) -> DataFrame:
    """G7"""
    return t["orders"].agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("o_custkey").alias("customers"),
        F.sum(money("o_totalprice")).alias("total"),
        F.max("o_orderdate").alias("latest"),
    )


@query(
    f"""SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3"""
)
def group_by_key_with_labels(t: GivenTables) -> DataFrame:
    """Lines are counted per key first; labels join the counts."""
    counts = t["lineitem"].groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    labels = t["supplier"].select("s_suppkey", "s_name", "s_nationkey")
    return counts.join(labels, F.col("l_suppkey") == F.col("s_suppkey")).select("s_suppkey", "s_name", "s_nationkey", "n")


@query(
    """SELECT event_type, count(*) FILTER (WHERE value < 10) AS "low", count(*) FILTER (WHERE value >= 10 AND value < 50) AS "middle",
  count(*) FILTER (WHERE value >= 50) AS "high" FROM events GROUP BY 1"""
)
def pivot_counts(t: GivenTables) -> DataFrame:
    """G10, F14"""
    band = F.when(F.col("value") < 10, "low").when(F.col("value") < 50, "middle").when(F.col("value") >= 50, "high")
    banded = t["events"].select("event_type", band.alias("band"))
    return banded.groupBy("event_type").pivot("band", ["low", "middle", "high"]).agg(F.count(F.lit(1))).fillna(0)


@query(
    "SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS position FROM (SELECT DISTINCT p_brand, p_type FROM part)"
)
def distinct_values(t: GivenTables) -> DataFrame:
    """G11, T7"""
    return number_output(t["part"].select("p_brand", "p_type").distinct().orderBy("p_brand", "p_type"))


# --- windows --------------------------------------------------------------------------


@query(
    f"""SELECT s_suppkey, {sql_percent("bal", "sum(bal) OVER ()")} AS share, count(*) OVER () AS n
  FROM (SELECT s_suppkey, {sql_money("abs(s_acctbal)")} AS bal FROM supplier)"""
)
def share_of_total(t: GivenTables) -> DataFrame:
    """Totals as scalar subqueries instead of a window over everything."""
    suppliers = t["supplier"].select("s_suppkey", F.abs("s_acctbal").cast("decimal(18,2)").alias("bal"))
    total = suppliers.agg(F.sum("bal")).scalar()
    n = suppliers.agg(F.count(F.lit(1))).scalar()
    return suppliers.select("s_suppkey", sf.percent("bal", total).alias("share"), n.alias("n"))


@query(
    f"""SELECT s_suppkey, rank() OVER (ORDER BY s_acctbal * (s_suppkey % 7 + 1) DESC) AS weighted_rank FROM supplier"""
)
def rank_over_expression(t: GivenTables) -> DataFrame:
    """W2"""
    weight = (F.col("s_acctbal") * (F.col("s_suppkey") % 7 + 1)).alias("weighted")
    suppliers = materialize(t["supplier"].select("s_suppkey", weight))
    return add_ranks(suppliers, {"weighted_rank": "weighted"}).drop("weighted")


@query(
    f"""WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS orders FROM orders GROUP BY 1)
SELECT strftime(month, '%Y-%m') AS month, orders, first_value(orders) OVER (ORDER BY month) AS first_month,
  lag(orders) OVER (ORDER BY month) AS previous_month FROM m"""
)
def first_value_and_lag(t: GivenTables) -> DataFrame:
    """The windows run over one row per month."""
    monthly = t["orders"].groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("orders"))
    in_order = Window.orderBy("month")
    return monthly.select(
        "month",
        "orders",
        F.first_value("orders").over(in_order).alias("first_month"),
        F.lag("orders").over(in_order).alias("previous_month"),
    )


@query(
    """SELECT c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS rank_in_nation,
  rank() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey % 100 DESC) AS rank_in_segment,
  rank() OVER (ORDER BY c_acctbal DESC) AS rank_overall FROM customer"""
)
def rank_in_group(t: GivenTables) -> DataFrame:
    """W1 within groups: three orders from one range shuffle."""
    customers = t["customer"].select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal", (F.col("c_custkey") % 100).alias("last_digits")
    )
    ranks = {
        "rank_in_nation": ("c_nationkey", "c_acctbal"),
        "rank_in_segment": ("c_mktsegment", "last_digits"),
        "rank_overall": (None, "c_acctbal"),
    }
    return rank_within(materialize(customers), ranks).select("c_custkey", *ranks)


@query(
    """SELECT o_orderkey, lag(o_totalprice) OVER w AS previous_price, lag(o_custkey, 3) OVER w AS third_customer,
  first_value(o_totalprice) OVER w AS first_price FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey)"""
)
def lag_over_orders(t: GivenTables) -> DataFrame:
    """W7, W8 over all orders, without a window over all rows."""
    orders = t["orders"].select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    lagged = {"previous_price": ("o_totalprice", 1), "third_customer": ("o_custkey", 3)}
    shifted = shift_over_ranges(orders, [F.col("o_orderdate"), F.col("o_orderkey")], lagged, {"first_price": "o_totalprice"})
    return shifted.select("o_orderkey", *lagged, "first_price")


@query(
    """SELECT n_name, count(DISTINCT o_custkey) AS customers, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN c_name END) AS names
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""
)
def distinct_by_bitmap(t: GivenTables) -> DataFrame:
    """Customers with orders per nation, by number and (of finished orders) by name."""
    named = orders_by_nation(t).join(t["customer"].select(F.col("c_custkey").alias("_key"), "c_name"), F.col("o_custkey") == F.col("_key"))
    facts = named.join(t["orders"].select(F.col("o_orderkey").alias("_order"), "o_orderstatus"), F.col("o_orderkey") == F.col("_order"))
    finished = facts.withColumn("c_name", F.when(F.col("o_orderstatus") == "F", F.col("c_name")))
    names = count_by_bitmap(finished, ["n_name"], "c_name", "names").withColumnRenamed("n_name", "_nation")
    customers = count_by_bitmap(orders_by_nation(t), ["n_name"], "o_custkey", "customers")
    return customers.join(names, F.col("n_name") == F.col("_nation")).drop("_nation")


# --- sorts, limits --------------------------------------------------------------------


@query(
    """SELECT n_name, c_name, row_number() OVER (ORDER BY n_name, c_name DESC) AS position
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""
)
def sort_mixed(t: GivenTables) -> DataFrame:
    """T1"""
    joined = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
    return number_output(joined.select("n_name", "c_name").orderBy("n_name", F.desc("c_name")))


@query("SELECT p_partkey, p_retailprice, p_size::BIGINT AS p_size FROM part ORDER BY p_retailprice / p_size DESC, p_partkey LIMIT 15")
def top_k_by_expression(t: GivenTables) -> DataFrame:
    """T2, T3, T4"""
    parts = t["part"].select("p_partkey", "p_retailprice", "p_size")
    return parts.orderBy((F.col("p_retailprice") / F.col("p_size")).desc(), "p_partkey").limit(15)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 400000 ORDER BY o_orderdate, o_orderkey LIMIT 1")
def first_row_meeting(t: GivenTables) -> DataFrame:
    """T5"""
    return t["orders"].where("o_totalprice >= 400000").orderBy("o_orderdate", "o_orderkey").limit(1).select("o_orderkey", "o_totalprice")


@query(
    """SELECT o_orderstatus, count(*) AS n, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END) AS position
  FROM orders GROUP BY o_orderstatus"""
)
def custom_order(t: GivenTables) -> DataFrame:
    """T6"""
    counts = t["orders"].groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    place = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "P", 1).otherwise(2)
    return number_output(counts.orderBy(place))


# --- set operations -------------------------------------------------------------------


@query("SELECT c_nationkey::BIGINT AS nationkey FROM customer UNION SELECT s_nationkey::BIGINT FROM supplier")
def set_union(t: GivenTables) -> DataFrame:
    """U1"""
    customers = t["customer"].select(F.col("c_nationkey").alias("nationkey"))
    return customers.unionByName(t["supplier"].select(F.col("s_nationkey").alias("nationkey"))).distinct()


@query("SELECT c_custkey, CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN NULL ELSE c_mktsegment END AS segment FROM customer")
def set_difference_of_constants(t: GivenTables) -> DataFrame:
    """U3, F13"""
    listed = {"FURNITURE", "MACHINERY", ""} - {""}
    return t["customer"].select("c_custkey", sf.null_if_sentinel("c_mktsegment", sorted(listed)).alias("segment"))


# --- scalar functions -----------------------------------------------------------------


@query(
    f"""SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, quarter(o_orderdate) AS q,
  (month(o_orderdate) + 2) // 3 AS q_by_division FROM orders"""
)
def date_parts(t: GivenTables) -> DataFrame:
    """F1, F2"""
    day = "o_orderdate"
    return t["orders"].select(
        "o_orderkey",
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        F.quarter(day).alias("q"),
        F.expr("(month(o_orderdate) + 2) div 3").alias("q_by_division"),
    )


@query(
    """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, date_diff('day', o_orderdate, l_shipdate) AS days, l_shipdate > o_orderdate AS later
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def date_difference(t: GivenTables) -> DataFrame:
    """F4, F5"""
    orders = t["orders"].select("o_orderkey", "o_orderdate")
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        sf.days_between("l_shipdate", "o_orderdate").alias("days"),
        (F.col("l_shipdate") > F.col("o_orderdate")).alias("later"),
    )


@query(
    f"""SELECT p_partkey, CAST(p_size AS DOUBLE) AS size_real, TRY_CAST(p_brand AS BIGINT) AS brand_number,
  {sql_round("p_retailprice / 7")} AS whole, {sql_round("p_retailprice / 7", 1)} AS tenth FROM part"""
)
def cast_and_round(t: GivenTables) -> DataFrame:
    """F6, F7"""
    seventh = F.col("p_retailprice") / 7
    return t["part"].select(
        "p_partkey",
        F.col("p_size").cast("double").alias("size_real"),
        F.col("p_brand").try_cast("bigint").alias("brand_number"),
        sf.round_half_up(seventh).alias("whole"),
        sf.round_half_up(seventh, 1).alias("tenth"),
    )


@query("SELECT s_suppkey, regexp_replace(s_name, '^Supplier#', 'SUP') AS fixed, printf('SUP%05d', s_suppkey) AS key FROM supplier")
def regex_and_key_format(t: GivenTables) -> DataFrame:
    """F8, F10"""
    return t["supplier"].select(
        "s_suppkey",
        sf.repair_prefix("s_name", "Supplier#", "SUP").alias("fixed"),
        sf.format_key("SUP", "s_suppkey").alias("key"),
    )


def _words(x: str, n: int) -> str:
    r = "CAST(0 AS BIGINT)"
    for start in (1, 9, 17, 25):
        r = f"(({r} * (4294967296 % {n}) + CAST(('0x' || substr(md5({x}), {start}, 8)) AS BIGINT)) % {n})"
    return r


@query(f"SELECT c_custkey, {_words('c_name', 9)} AS nine, {_words('c_name', 1009)} AS many FROM customer")
def hash_modulo(t: GivenTables) -> DataFrame:
    """F9"""
    return t["customer"].select(
        "c_custkey", sf.md5_modulo("c_name", 9).alias("nine"), sf.md5_modulo("c_name", 1009).alias("many")
    )


@query(
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance FROM customer"""
)
def blanks_and_nulls(t: GivenTables) -> DataFrame:
    """F12, F14"""
    emptied = F.regexp_replace("c_mktsegment", "^BUILDING$", "")
    shown = t["customer"].select(
        "c_custkey",
        sf.blank_to_null(emptied).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )
    return shown.fillna(0, ["balance"])


@query(
    """SELECT n_name, format('{:,}', count(*)) AS orders, format('{:,}', CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT)) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""
)
def thousands_separator(t: GivenTables) -> DataFrame:
    """F15"""
    totals = orders_by_nation(t).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    return totals.select(
        "n_name", sf.thousands("n").alias("orders"), sf.thousands(F.expr("floor(total div 100)")).alias("revenue")
    )


@query("SELECT p_partkey AS part_key, p_name AS part_name FROM part")
def trimmed_header(t: GivenTables) -> DataFrame:
    """padded column names are trimmed as they are for a raw CSV."""
    padded = t["part"].select("p_partkey", "p_name").toDF(" part_key ", "part_name  ")
    return padded.toDF(*[c.strip() for c in padded.columns])
