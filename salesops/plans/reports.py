"""The business questions over the sales model. Each takes the typed tables by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.operators import analytics as a
from salesops.operators import integrity
from salesops.session import materialize

Tables = Mapping[str, DataFrame]

# Discount bands (inclusive upper bound, label) and open stages.
DISCOUNT_BANDS = [(5, "0-5%"), (10, "6-10%"), (15, "11-15%"), (None, "16-25%")]
OPEN_STAGES = ["Prospecting", "Negotiation"]
WON = "Won"


def _sales_lines(t: Tables) -> DataFrame:
    """Order lines with their vehicle type, one row per order and type."""
    per_quote = (
        t["QuoteLineItem"].select("quote_id", "product_id", "quantity", "total_price")
        .join(t["Product"].select("product_id", "vehicle_type_id"), "product_id")
        .join(t["VehicleType"], "vehicle_type_id")
        .groupBy("quote_id", "vehicle_type")
        .agg(F.sum("quantity").alias("quantity"), F.sum("total_price").alias("total_price"))
    )
    return (
        per_quote.join(t["Quote"].select("quote_id"), "quote_id")
        .join(t["Orders"].select("order_id", "order_date", "quote_id"), "quote_id")
    )


def _lead_cities(t: Tables) -> DataFrame:
    """Leads with the billing city of their customer's account.

    The customers get their city first, so that leads are shuffled once only.
    """
    customers = (
        t["Customer"].select("customer_id", "customer_name", "account_id")
        .join(
            t["Account"].select("account_id", "billing_address_id")
            .join(t["BillingAddress"].select("billing_address_id", "city_id").join(t["City"], "city_id"), "billing_address_id"),
            "account_id",
        )
        .select("customer_id", "customer_name", "city_id", "city_name")
    )
    return t["Lead"].select("lead_id", "lead_score", "lead_source_id", "customer_id").join(customers, "customer_id")


def _invoiced(t: Tables) -> DataFrame:
    """Invoiced total per order, with the order's rep and customer.

    Invoices are summed per order before the join, on the join's own key.
    """
    per_order = t["Invoice"].groupBy("order_id").agg(F.sum("total_amount").alias("total_amount"))
    orders = (
        t["Orders"].select("order_id", "quote_id")
        .join(t["Quote"].select("quote_id", "opportunity_id"), "quote_id")
        .join(t["Opportunity"].select("opportunity_id", "user_id", "customer_id"), "opportunity_id")
        .select("order_id", "user_id", "customer_id")
    )
    return per_order.join(orders, "order_id")


def _lead_outcomes(t: Tables) -> DataFrame:
    return (
        t["Opportunity"].select("opportunity_id", "lead_id", "stage_id")
        .join(t["Stage"], "stage_id")
        .join(t["Lead"].select("lead_id", "lead_score", "lead_source_id", "created_date"), "lead_id")
        .join(t["LeadSource"], "lead_source_id")
    )


def quarterly_sales_by_category(t: Tables) -> DataFrame:
    return a.period_sales(
        _sales_lines(t), "order_date", "vehicle_type", "order_id", "quantity", "total_price", "vehicle_type", reduced=True
    )


def quarterly_sales_pivot(t: Tables) -> DataFrame:
    """One column per vehicle type that was sold."""
    sales = a.period_totals(
        _sales_lines(t), "order_date", "vehicle_type", "order_id", "quantity", "total_price", "vehicle_type", reduced=True
    )
    return a.pivot_sum(sales, "quarter", "vehicle_type", "revenue")


def quarterly_sales_head(t: Tables) -> DataFrame:
    order = ["quarter", F.desc("revenue"), "vehicle_type"]
    return a.head_ordered(quarterly_sales_by_category(t), order, 12)


def territory_leaderboard(t: Tables) -> DataFrame:
    cities = t["ShippingAddress"].select("shipping_address_id", "city_id").join(t["City"], "city_id")
    orders = (
        t["Orders"].select("order_id", "shipping_address_id")
        .join(cities, "shipping_address_id")
        .select("order_id", "city_name")
    )
    # Joined on the order last: the distinct count reuses that partitioning.
    facts = t["Invoice"].select("order_id", "total_amount").join(orders, "order_id")
    return a.leaderboard(facts, "city_name", "order_id", "total_amount")


def win_rate_by_source(t: Tables) -> DataFrame:
    return a.rate_by_group(_lead_outcomes(t), "lead_source", F.col("stage") == WON, "lead_score")


def leads_by_city_and_source(t: Tables) -> DataFrame:
    leads = _lead_cities(t).join(t["LeadSource"], "lead_source_id")
    order = ["city_name", F.desc("total_leads")]
    return a.count_and_mean(leads, ["city_name", "lead_source"], "lead_id", "lead_score", order)


def lead_score_by_city(t: Tables) -> DataFrame:
    counted = a.count_and_mean(
        _lead_cities(t), ["city_name"], "lead_id", "lead_score", [F.desc("avg_lead_score")], "leads"
    )
    return counted.select("city_name", "avg_lead_score", "leads")


def warranty_mix(t: Tables) -> DataFrame:
    lines = t["QuoteLineItem"].select("line_item_id", "quantity", "warranty_id").join(t["Warranty"], "warranty_id")
    return a.mix(lines, "warranty", "line_item_id", "quantity", "warranty_type")


def rep_leaderboard(t: Tables) -> DataFrame:
    # The number a rate begins with, as in '7%'; a rate without one earns nothing known.
    leading = F.regexp_extract("commission_rate", r"^\s*([-+]?(\d+\.?\d*|\.\d+))", 1)
    rate = leading.try_cast("double").alias("rate")
    return a.rep_leaderboard(
        _invoiced(t), "user_id", "order_id", "total_amount", t["Users"].select("user_id", "user_name", rate)
    )


def rep_leaderboard_head(t: Tables) -> DataFrame:
    return a.head_ordered(rep_leaderboard(t), ["revenue_rank", "user_name"], 10)


def _revenue_of_accounts(t: Tables) -> DataFrame:
    per_customer = _invoiced(t).groupBy("customer_id").agg(F.sum("total_amount").alias("total_amount"))
    customers = t["Customer"].select("customer_id", "account_id").join(t["Account"].select("account_id"), "account_id")
    return per_customer.join(customers, "customer_id")


def pareto_curve(t: Tables) -> DataFrame:
    return a.pareto_curve(_revenue_of_accounts(t), "account_id", "total_amount")


def pareto_cutoff(t: Tables) -> DataFrame:
    return a.pareto_point(_revenue_of_accounts(t), "account_id", "total_amount")


def sales_funnel(t: Tables) -> DataFrame:
    """Existence is all that counts, so each stage is a semi join on distinct keys."""
    quotes = t["Quote"].select("quote_id", "opportunity_id")
    orders = t["Orders"].select("order_id", "quote_id")
    billed = orders.join(t["Invoice"].select("order_id").distinct(), "order_id", "left_semi")
    return a.funnel(
        [
            ("Leads", t["Lead"], "lead_id"),
            ("Opportunities", t["Opportunity"], "opportunity_id"),
            ("Quoted", quotes, "opportunity_id"),
            ("Ordered", quotes.join(orders.select("quote_id").distinct(), "quote_id", "left_semi"), "opportunity_id"),
            ("Invoiced", quotes.join(billed.select("quote_id").distinct(), "quote_id", "left_semi"), "opportunity_id"),
        ]
    )


def _discounts(t: Tables) -> DataFrame:
    """Quotes are reduced to one row per opportunity before the join."""
    top = t["Quote"].groupBy("opportunity_id").agg(F.max("discount").alias("discount"))
    return t["Opportunity"].select("opportunity_id", "stage_id").join(t["Stage"], "stage_id").join(top, "opportunity_id")


def win_rate_by_band(t: Tables) -> DataFrame:
    return a.rate_by_band(_discounts(t), "opportunity_id", "discount", F.col("stage") == WON, DISCOUNT_BANDS)


def win_rate_by_band_ordered(t: Tables) -> DataFrame:
    return a.rate_by_band(
        _discounts(t), "opportunity_id", "discount", F.col("stage") == WON, DISCOUNT_BANDS, ordered=True
    )


def _cycles(t: Tables) -> DataFrame:
    return (
        t["Opportunity"].select("opportunity_id", "lead_id")
        .join(t["Lead"].select("lead_id", "lead_source_id", "created_date"), "lead_id")
        .join(t["LeadSource"], "lead_source_id")
        .join(t["Quote"].select("quote_id", "opportunity_id"), "opportunity_id")
        .join(t["Orders"].select("quote_id", "order_date"), "quote_id")
    )


def cycle_time_by_source(t: Tables) -> DataFrame:
    return a.cycle_time(_cycles(t), "lead_source", "created_date", "order_date")


def cycle_time_short(t: Tables) -> DataFrame:
    return a.cycle_time(_cycles(t), "lead_source", "created_date", "order_date", fastest=False)


def _above_city_mean(t: Tables, k: int) -> DataFrame:
    leads = materialize(_lead_cities(t).select("city_id", "city_name", "customer_name", "lead_score", "lead_id"))
    return a.above_group_mean(leads, "city_id", "customer_name", "lead_score", k, "lead_id", "city_name")


def above_city_mean(t: Tables) -> DataFrame:
    return _above_city_mean(t, 20)


def above_city_mean_short(t: Tables) -> DataFrame:
    return _above_city_mean(t, 10)


def _payments(t: Tables) -> DataFrame:
    columns = ["payment_method_id", "invoice_date", "due_date", "payment_date", "late_fees"]
    return t["Invoice"].select(*columns).join(t["PaymentMethod"], "payment_method_id")


def payment_behaviour(t: Tables) -> DataFrame:
    return a.payment_behaviour(
        _payments(t), "payment_method", "invoice_date", "due_date", "payment_date", "late_fees"
    )


def payment_behaviour_short(t: Tables) -> DataFrame:
    return a.payment_behaviour(
        _payments(t), "payment_method", "invoice_date", "due_date", "payment_date", "late_fees", overdue_count=False
    )


def open_deal_aging(t: Tables) -> DataFrame:
    deals = t["Opportunity"].select("stage_id", "expected_close_date", "opportunity_amount").join(t["Stage"], "stage_id")
    as_of = t["Orders"].agg(F.max("order_date")).scalar()
    return a.open_deal_aging(deals, "stage", OPEN_STAGES, "expected_close_date", "opportunity_amount", as_of)


def revenue_fanout(t: Tables) -> DataFrame:
    """Invoice total, and what it would be if invoices were joined to order lines."""
    # Every invoice counts, also without an order or a quote: those have no lines.
    billed = (
        t["Invoice"].select("order_id", "total_amount")
        .join(t["Orders"].select("order_id", "quote_id"), "order_id", "left")
        .join(t["Quote"].select("quote_id", F.col("quote_id").alias("known_quote")), "quote_id", "left")
        .select(F.col("known_quote").alias("quote_id"), "total_amount")
    )
    return integrity.fanout_audit(billed, "quote_id", "total_amount", t["QuoteLineItem"], "quote_id")


def territory_reconciliation(t: Tables) -> DataFrame:
    return integrity.reconcile(territory_leaderboard(t), "total_revenue", t["Invoice"], "total_amount")


REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        quarterly_sales_by_category,
        quarterly_sales_pivot,
        quarterly_sales_head,
        territory_leaderboard,
        win_rate_by_source,
        leads_by_city_and_source,
        lead_score_by_city,
        warranty_mix,
        rep_leaderboard,
        rep_leaderboard_head,
        pareto_curve,
        pareto_cutoff,
        sales_funnel,
        win_rate_by_band,
        win_rate_by_band_ordered,
        cycle_time_by_source,
        cycle_time_short,
        above_city_mean,
        above_city_mean_short,
        payment_behaviour,
        payment_behaviour_short,
        open_deal_aging,
        revenue_fanout,
        territory_reconciliation,
    )
}
