"""Business questions on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.functions import minor_units
from salesops.operators import analytics as a
from salesops.operators.ordering import number_output
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

# Discount bands (inclusive upper bound in percent, label).
BANDS = [(2, "0-2%"), (5, "3-5%"), (8, "6-8%"), (None, "9-10%")]


def sales_lines(t: GivenTables) -> DataFrame:
    lines = t["lineitem"].select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("qty"), minor_units("l_extendedprice").alias("amount")
    )
    parts = t["part"].select("p_partkey", "p_type")
    orders = t["orders"].select("o_orderkey", "o_orderdate")
    # One row per order and type meets the orders, instead of every line.
    per_order = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey", "p_type")
        .agg(F.sum("qty").alias("qty"), F.sum("amount").alias("amount"))
    )
    return per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


_LINES = """
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"""
_Q1 = f"""SELECT {sql_quarter("o_orderdate")} AS quarter, p_type AS category,
  count(DISTINCT o_orderkey) AS orders, {sql_big("sum(CAST(l_quantity AS BIGINT))")} AS units_sold,
  {sql_total(sql_money("l_extendedprice"))} AS revenue {_LINES} GROUP BY 1, 2"""


@query(_Q1)
def quarterly_sales_by_category(t: GivenTables) -> DataFrame:
    return a.period_sales(sales_lines(t), "o_orderdate", "p_type", "o_orderkey", "qty", "amount", minor=100, reduced=True)


# The part types of the given tables; a test compares them with the tables.
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "SELECT quarter, "
    + ", ".join(f"""coalesce(sum(revenue) FILTER (WHERE category = '{v}'), 0) AS "{v}\"""" for v in PART_TYPES)
    + f" FROM ({_Q1}) GROUP BY quarter"
)
def quarterly_sales_pivot(t: GivenTables) -> DataFrame:
    sales = a.period_totals(sales_lines(t), "o_orderdate", "p_type", "o_orderkey", "qty", "amount", minor=100, reduced=True)
    return a.pivot_sum(sales, "quarter", "category", "revenue")


@query(f"{_Q1} ORDER BY quarter, revenue DESC, category LIMIT 12")
def quarterly_sales_head(t: GivenTables) -> DataFrame:
    return a.head_ordered(quarterly_sales_by_category(t), ["quarter", F.desc("revenue"), "category"], 12)


def orders_by_nation(t: GivenTables) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", minor_units("o_totalprice").alias("amount"))
    customers = t["customer"].select("c_custkey", "c_nationkey")
    nations = t["nation"].select("n_nationkey", "n_name")
    return orders.join(
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")),
        F.col("o_custkey") == F.col("c_custkey"),
    )


_PRICE = sql_money("o_totalprice")


@query(
    f"""SELECT n_name, count(DISTINCT o_orderkey) AS total_orders, {sql_total(_PRICE)} AS total_revenue,
  {sql_round(sql_mean(_PRICE))} AS avg_order_value
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""
)
def territory_leaderboard(t: GivenTables) -> DataFrame:
    return a.leaderboard(orders_by_nation(t), "n_name", "o_orderkey", "amount", minor=100)


_BALANCE = sql_money("c_acctbal")


@query(
    f"""SELECT c_mktsegment, count(*) AS total_leads,
  {sql_big("sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)")} AS won,
  {sql_percent("sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)", "count(*)")} AS win_rate_pct,
  {sql_round(sql_mean(_BALANCE), 1)} AS avg_lead_score
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def win_rate_by_source(t: GivenTables) -> DataFrame:
    customers = t["customer"].select("c_custkey", "c_mktsegment", money("c_acctbal").alias("score"))
    facts = t["orders"].select("o_custkey", "o_orderstatus").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return a.rate_by_group(facts, "c_mktsegment", F.col("o_orderstatus") == "F", "score")


def customers_by_nation(t: GivenTables) -> DataFrame:
    customers = t["customer"].select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", money("c_acctbal").alias("score")
    )
    return customers.join(t["nation"].select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))


@query(
    f"""SELECT n_name, c_mktsegment, count(c_custkey) AS total_leads, {sql_round(sql_mean(_BALANCE), 1)} AS avg_lead_score
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2"""
)
def leads_by_city_and_source(t: GivenTables) -> DataFrame:
    return a.count_and_mean(
        customers_by_nation(t), ["n_name", "c_mktsegment"], "c_custkey", "score", ["n_name", F.desc("total_leads")]
    )


@query(
    f"""SELECT n_name, {sql_round(sql_mean(_BALANCE), 1)} AS avg_lead_score, count(c_custkey) AS leads
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""
)
def lead_score_by_city(t: GivenTables) -> DataFrame:
    return a.count_and_mean(
        customers_by_nation(t), ["n_name"], "c_custkey", "score", [F.desc("avg_lead_score")], "leads"
    )


@query(
    f"""SELECT l_returnflag AS warranty_type, count(l_linenumber) AS line_items,
  {sql_big("sum(CAST(l_quantity AS BIGINT))")} AS units_sold FROM lineitem GROUP BY 1"""
)
def warranty_mix(t: GivenTables) -> DataFrame:
    lines = t["lineitem"].select("l_returnflag", "l_linenumber", F.col("l_quantity").cast("bigint").alias("qty"))
    return a.mix(lines, "l_returnflag", "l_linenumber", "qty", "warranty_type")


_RATE = "CAST(s_suppkey % 20 + 1 AS DOUBLE)"
_REP = f"""SELECT s_name AS user_name, deals, revenue, rank() OVER by_revenue AS revenue_rank,
  {sql_percent("revenue", f"(SELECT {sql_total(sql_money('l_extendedprice'))} FROM lineitem)")} AS pct_of_total,
  {sql_round(f"revenue * {_RATE} / 100.0")} AS est_commission, rank() OVER by_earning AS commission_rank
FROM supplier JOIN (SELECT l_suppkey, count(DISTINCT l_orderkey) AS deals, {sql_total(sql_money("l_extendedprice"))} AS revenue
  FROM lineitem GROUP BY l_suppkey) ON s_suppkey = l_suppkey
WINDOW by_revenue AS (ORDER BY revenue DESC), by_earning AS (ORDER BY revenue * {_RATE} DESC)"""


@query(_REP)
def rep_leaderboard(t: GivenTables) -> DataFrame:
    lines = t["lineitem"].select("l_orderkey", F.col("l_suppkey").alias("s_suppkey"), minor_units("l_extendedprice").alias("amount"))
    reps = t["supplier"].select(
        "s_suppkey", F.col("s_name").alias("user_name"), (F.col("s_suppkey") % 20 + 1).alias("rate")
    )
    return a.rep_leaderboard(lines, "s_suppkey", "l_orderkey", "amount", reps, minor=100)


@query(f"{_REP} ORDER BY revenue_rank, user_name LIMIT 10")
def rep_leaderboard_head(t: GivenTables) -> DataFrame:
    return a.head_ordered(rep_leaderboard(t), ["revenue_rank", "user_name"], 10)


_CURVE = f"""WITH entity AS (SELECT o_custkey, sum({_PRICE}) AS rev FROM orders GROUP BY 1),
curve AS (SELECT row_number() OVER (ORDER BY rev DESC, o_custkey) AS rank, count(*) OVER () AS n,
  sum(rev) OVER (ORDER BY rev DESC) AS running, sum(rev) OVER () AS total FROM entity),
pareto AS (SELECT rank, {sql_percent("rank", "n")} AS pct_accounts, {sql_percent("running", "total")} AS pct_revenue_cum
  FROM curve)"""


@query(f"{_CURVE} SELECT * FROM pareto")
def pareto_curve(t: GivenTables) -> DataFrame:
    orders = t["orders"].select("o_custkey", minor_units("o_totalprice").alias("amount"))
    return a.pareto_curve(orders, "o_custkey", "amount", minor=100)


@query(f"{_CURVE} SELECT * FROM pareto WHERE pct_revenue_cum >= 80 ORDER BY rank LIMIT 1")
def pareto_cutoff(t: GivenTables) -> DataFrame:
    orders = t["orders"].select("o_custkey", minor_units("o_totalprice").alias("amount"))
    return a.pareto_point(orders, "o_custkey", "amount", minor=100)


@query(
    f"""WITH per_order AS (SELECT o_orderkey, count(l_orderkey) > 0 AS lined, coalesce(bool_or(l_linestatus = 'F'), false) AS shipped,
    coalesce(bool_or(l_linestatus = 'F' AND l_returnflag = 'R'), false) AS returned
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
reached AS (SELECT [count(*), count_if(lined)::BIGINT, count_if(shipped)::BIGINT, count_if(returned)::BIGINT] AS n FROM per_order)
SELECT unnest(['Leads', 'With lines', 'Shipped', 'Returned']) AS stage_name, unnest(n) AS cnt,
  unnest([{", ".join(sql_percent(f"n[{k}]", "n[1]") for k in (1, 2, 3, 4))}]) AS pct_of_leads,
  unnest([NULL, {", ".join(sql_percent(f"n[{k}]", f"n[{k - 1}]") for k in (2, 3, 4))}]) AS step_conversion FROM reached"""
)
def sales_funnel(t: GivenTables) -> DataFrame:
    """One pass over the lines: flags per order, then counts of the flags."""
    shipped = F.col("l_linestatus") == "F"
    per_order = (
        t["lineitem"].where("l_orderkey is not null")
        .groupBy("l_orderkey")
        .agg(F.bool_or(shipped).alias("shipped"), F.bool_or(shipped & (F.col("l_returnflag") == "R")).alias("returned"))
    )
    counts = per_order.agg(
        F.count(F.lit(1)).alias("lined"), F.count_if("shipped").alias("shipped"), F.count_if("returned").alias("returned")
    ).withColumn("leads", t["orders"].agg(F.countDistinct("o_orderkey")).scalar())
    return a.funnel_of_counts(
        counts, [("Leads", "leads"), ("With lines", "lined"), ("Shipped", "shipped"), ("Returned", "returned")]
    )


def _discounted(t: GivenTables) -> DataFrame:
    """Lines are reduced to one row per order before they meet the orders."""
    whole_percent = F.round(F.col("l_discount") * 100).cast("int")
    top = t["lineitem"].groupBy("l_orderkey").agg(F.max(whole_percent).alias("top_discount"))
    return top.join(t["orders"].select("o_orderkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))


_BAND = f"""WITH per_order AS (
  SELECT o_orderkey, max(CAST(round(l_discount * 100) AS INT)) AS d,
    max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS won
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT CASE WHEN d <= 2 THEN '0-2%' WHEN d <= 5 THEN '3-5%' WHEN d <= 8 THEN '6-8%' ELSE '9-10%' END AS discount_band,
  count(*) AS opportunities, {sql_big("sum(won)")} AS won, {sql_percent("sum(won)", "count(*)")} AS win_rate_pct
FROM per_order GROUP BY 1"""


@query(_BAND)
def win_rate_by_band(t: GivenTables) -> DataFrame:
    return a.rate_by_band(_discounted(t), "l_orderkey", "top_discount", F.col("o_orderstatus") == "F", BANDS)


@query(f"SELECT *, row_number() OVER (ORDER BY length(discount_band), discount_band) AS position FROM ({_BAND})")
def win_rate_by_band_ordered(t: GivenTables) -> DataFrame:
    bands = a.rate_by_band(
        _discounted(t), "l_orderkey", "top_discount", F.col("o_orderstatus") == "F", BANDS, ordered=True
    )
    return number_output(bands)


def _shipments(t: GivenTables) -> DataFrame:
    return t["lineitem"].select("l_orderkey", "l_shipdate").join(
        t["orders"].select("o_orderkey", "o_orderdate", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey")
    )


_DAYS = "date_diff('day', o_orderdate, l_shipdate)"
_CYCLE = f"""SELECT o_orderpriority, count(*) AS deals, {sql_round(sql_mean(_DAYS))} AS avg_cycle_days
  {{extra}} FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""


@query(_CYCLE.format(extra=f", min({_DAYS}) AS fastest_days"))
def cycle_time_by_source(t: GivenTables) -> DataFrame:
    return a.cycle_time(_shipments(t), "o_orderpriority", "o_orderdate", "l_shipdate")


@query(_CYCLE.format(extra=""))
def cycle_time_short(t: GivenTables) -> DataFrame:
    return a.cycle_time(_shipments(t), "o_orderpriority", "o_orderdate", "l_shipdate", fastest=False)


def _above(k: int) -> str:
    gap = "CAST(score AS DOUBLE) - city_avg_score"
    return f"""WITH c AS (SELECT c_custkey, c_name, c_nationkey, n_name, {_BALANCE} AS score
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT c_nationkey, {sql_mean("score")} AS mean FROM c GROUP BY 1),
g AS (SELECT c.*, mean, {sql_round("mean", 1)} AS city_avg_score FROM c JOIN m USING (c_nationkey))
SELECT n_name, c_name, CAST(score AS DOUBLE) AS score, city_avg_score FROM g WHERE CAST(score AS DOUBLE) > mean
ORDER BY {gap} DESC, c_custkey LIMIT {k}"""


@query(_above(20))
def above_city_mean(t: GivenTables) -> DataFrame:
    return a.above_group_mean(customers_by_nation(t), "c_nationkey", "c_name", "score", 20, "c_custkey", "n_name")


@query(_above(10))
def above_city_mean_short(t: GivenTables) -> DataFrame:
    return a.above_group_mean(customers_by_nation(t), "c_nationkey", "c_name", "score", 10, "c_custkey", "n_name")


def _payments(t: GivenTables) -> DataFrame:
    # Cents times whole percents of tax: 1/10,000 units.
    fee = minor_units("l_extendedprice") * minor_units("l_tax")
    lines = t["lineitem"].select("l_orderkey", "l_returnflag", "l_shipdate", fee.alias("fee"))
    orders = t["orders"].select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "due", F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")
    )


def _payment_sql(overdue: bool) -> str:
    late = "sum(CASE WHEN l_shipdate > o_orderdate + INTERVAL 90 DAY THEN 1 ELSE 0 END)"
    shown = f"{sql_big(late)} AS overdue," if overdue else ""
    fees = sql_total("CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))")
    return f"""SELECT l_returnflag AS payment_method, count(*) AS paid_invoices, {shown}
  {sql_percent(late, "count(*)")} AS overdue_pct, {sql_round(sql_mean(_DAYS))} AS avg_days_to_pay,
  {sql_round(fees)} AS total_late_fees
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate IS NOT NULL GROUP BY 1"""


@query(_payment_sql(True))
def payment_behaviour(t: GivenTables) -> DataFrame:
    return a.payment_behaviour(_payments(t), "l_returnflag", "o_orderdate", "due", "l_shipdate", "fee", minor=10_000)


@query(_payment_sql(False))
def payment_behaviour_short(t: GivenTables) -> DataFrame:
    return a.payment_behaviour(
        _payments(t), "l_returnflag", "o_orderdate", "due", "l_shipdate", "fee", overdue_count=False, minor=10_000
    )


@query(
    f"""SELECT o_orderstatus AS stage, count(*) AS stuck_deals, {sql_round(sql_total(_PRICE))} AS pipeline_value,
  {sql_round(sql_mean("date_diff('day', o_orderdate, limit_date)"))} AS avg_days_overdue
FROM orders JOIN (SELECT max(o_orderdate) - INTERVAL 30 DAY AS limit_date FROM orders) ON date_diff('day', o_orderdate, limit_date) > 0
WHERE o_orderstatus IN ('O', 'P') GROUP BY o_orderstatus"""
)
def open_deal_aging(t: GivenTables) -> DataFrame:
    orders = t["orders"]
    deals = orders.select(
        "o_orderstatus",
        minor_units("o_totalprice").alias("amount"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("expected"),
    )
    as_of = orders.agg(F.max("o_orderdate")).scalar()
    return a.open_deal_aging(deals, "o_orderstatus", ["O", "P"], "expected", "amount", as_of, minor=100)
