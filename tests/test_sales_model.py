"""Raw export -> clean model -> constraints -> reports."""

import csv
import glob
import hashlib
import os

import duckdb
import pytest

from salesops import sources
from salesops.operators.integrity import require_no_violations
from salesops.plans import model, verify
from salesops.plans.clean import clean_model
from salesops.plans.reports import DISCOUNT_BANDS, OPEN_STAGES, REPORTS
from tests.sales_export import STATES


@pytest.fixture(scope="module")
def rows(typed):
    return {name: [r.asDict() for r in df.collect()] for name, df in typed.items()}


@pytest.fixture(scope="module")
def duck(typed):
    connection = duckdb.connect()
    for name, df in typed.items():
        connection.register(f"{name}_arrow", df.toArrow())
        connection.execute(f'CREATE TABLE "{name}" AS SELECT * FROM {name}_arrow')
    return connection


def test_all_tables_of_the_model_are_there(cleaned, rows):
    assert set(cleaned[1]) == set(model.SCHEMAS)
    assert {name: len(r) for name, r in rows.items()} == cleaned[1]


def test_constraints_hold(typed):
    require_no_violations(verify.foreign_key_violations(typed))
    broken = verify.constraint_report(typed).where("violations > 0").collect()
    # The blank payment status is no member, so nothing else may be broken.
    assert broken == []


def test_model_sizes():
    assert len(model.SCHEMAS) == 27
    assert len(model.FOREIGN_KEYS) == 31 and sum(k.cascade for k in model.FOREIGN_KEYS) == 8
    assert sum(map(len, model.NOT_NULL.values())) == 37
    assert len(model.UNIQUE) == 4 and sum(map(len, model.RANGES.values())) == 5


@pytest.mark.parametrize("lookup", sorted(STATES))
def test_dimension_and_every_reference_keep_their_value(raw, rows, lookup):
    """The value behind a reference is the same before and after."""
    id_col, value_col = list(rows[lookup][0])
    prefix, references = model.LOOKUPS[lookup]
    values = sorted({v for v in STATES[lookup] if v not in ("", "Na")})
    assert {r[id_col]: r[value_col] for r in rows[lookup]} == {f"{prefix}{i:05d}": v for i, v in enumerate(values, 1)}
    old = {r[id_col]: r[value_col] for r in raw[1][lookup]}
    new = {r[id_col]: r[value_col] for r in rows[lookup]}
    for fact, fk in references:
        pk = model.PRIMARY_KEYS[fact]
        before = {r[pk]: old.get(r[fk]) for r in raw[1][fact]}
        for r in rows[fact]:
            wanted = before[r[pk]]
            assert new.get(r[fk]) == (None if wanted in ("", "Na") else wanted)


def test_cities_are_merged_and_shipping_keys_repaired(raw, rows):
    names = {r["city_id"]: r["city_name"] for r in rows["City"]}
    assert sorted(names.values()) == ["Bristol", "Derby", "Ely", "Leeds", "York"]
    shipping = {r["shipping_city_id"][3:]: r["shipping_city"] for r in raw[1]["ShippingCity"]}
    for r in rows["ShippingAddress"]:
        assert names[r["city_id"]] == shipping[r["shipping_address_id"][3:]]


def test_job_titles_are_kept_or_filled_by_hash(raw, rows, cleaned):
    titles = sorted({r["job_title_name"] for r in raw[1]["JobTitle"]})
    old = {r["job_title_id"]: r["job_title_name"] for r in raw[1]["JobTitle"] if r["job_title_id"]}
    names = {r["job_title_id"]: r["job_title_name"] for r in rows["JobTitle"]}
    before = {r["customer_id"]: r["job_title_id"] for r in raw[1]["Customer"]}
    for r in rows["Customer"]:
        picked = titles[int(hashlib.md5(r["customer_id"].encode()).hexdigest(), 16) % len(titles)]
        assert names[r["job_title_id"]] == old.get(before[r["customer_id"]], picked)
    log = cleaned[2]
    genuine = sum(r["job_title_id"] in old for r in raw[1]["Customer"])
    assert log["job title", "Customer", "kept"] == genuine
    assert log["job title", "Customer", "filled"] == len(raw[1]["Customer"]) - genuine


def test_last_row_of_a_key_is_kept_and_orphans_are_gone(raw, rows, cleaned):
    """The surviving keys follow from the last rows and the chain of parents."""
    last = {t: {r[model.PRIMARY_KEYS[t]]: r for r in raw[1][t]} for t in model.REPEATED_KEYS}
    for table, column in model.REQUIRED.items():
        last[table] = {k: r for k, r in last[table].items() if r[column]}
    for child, fk, parent, _ in model.ORPHAN_LINKS:
        last[child] = {k: r for k, r in last[child].items() if not r[fk] or r[fk] in last[parent]}
    for table, wanted in last.items():
        pk = model.PRIMARY_KEYS[table]
        assert sorted(r[pk] for r in rows[table]) == sorted(wanted)
        assert len(wanted) < len(raw[1][table])
    dates = {r["order_id"]: str(r["order_date"]) for r in rows["Orders"]}
    assert dates == {k: r["order_date"] for k, r in last["Orders"].items()}
    assert cleaned[2]["blank rows", "Opportunity", "rows_before"] == cleaned[2]["blank rows", "Opportunity", "rows_after"] + 1


def test_no_value_is_lost_in_typing(spark, cleaned):
    raw_tables = sources.read_catalog(spark, cleaned[0], model.SCHEMAS)
    for name, df in raw_tables.items():
        assert all(r["lost"] == 0 for r in sources.lost_values(df, model.SCHEMAS[name], name).collect())


def _round(x, digits=0):
    return f"(floor({x} * CAST({10**digits} AS DOUBLE) + 0.5) / CAST({10**digits} AS DOUBLE))"


def _pct(part, whole):
    return _round(f"(CAST(100 AS DOUBLE) * CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0))", 1)


def _mean(x):
    return f"(CAST(sum({x}) AS DOUBLE) / count({x}))"


_LEAD_CITY = """FROM Lead l JOIN Customer c USING (customer_id) JOIN Account a ON c.account_id = a.account_id
  JOIN BillingAddress b USING (billing_address_id) JOIN City ct USING (city_id)"""
_SALES = """FROM Orders o JOIN Quote q USING (quote_id) JOIN QuoteLineItem i USING (quote_id) JOIN Product p USING (product_id)
  JOIN VehicleType v USING (vehicle_type_id)"""
_BILLED = """FROM Invoice i JOIN Orders o USING (order_id) JOIN Quote q USING (quote_id) JOIN Opportunity p USING (opportunity_id)"""
_WON = "CASE WHEN s.stage = 'Won' THEN 1 ELSE 0 END"
_QUARTERS = f"""SELECT year(order_date) || '-Q' || quarter(order_date) AS quarter, vehicle_type, count(DISTINCT order_id) AS orders,
  sum(quantity) AS units_sold, sum(i.total_price) AS revenue {_SALES} GROUP BY 1, 2"""
_REPS = f"""SELECT user_name, deals, revenue, rank() OVER by_revenue AS revenue_rank,
  {_pct("revenue", "sum(revenue) OVER ()")} AS pct_of_total,
  {_round("(CAST(revenue AS DOUBLE) * CAST(commission_rate AS DOUBLE) / 100)")} AS est_commission, rank() OVER by_earning AS commission_rank
FROM Users JOIN (SELECT user_id, count(DISTINCT order_id) AS deals, sum(i.total_amount) AS revenue {_BILLED} GROUP BY user_id) USING (user_id)
WINDOW by_revenue AS (ORDER BY revenue DESC), by_earning AS (ORDER BY revenue * CAST(commission_rate AS DOUBLE) DESC)"""
_PARETO = f"""WITH r AS (SELECT c.account_id, sum(i.total_amount) AS rev {_BILLED} JOIN Customer c ON p.customer_id = c.customer_id GROUP BY 1),
w AS (SELECT row_number() OVER (ORDER BY rev DESC, account_id) AS rank, count(*) OVER () AS n, sum(rev) OVER (ORDER BY rev DESC) AS run,
  sum(rev) OVER () AS total FROM r),
x AS (SELECT rank, {_pct("rank", "n")} AS pct_accounts, {_pct("run", "total")} AS pct_revenue_cum FROM w) SELECT * FROM x"""
_BANDS = f"""WITH d AS (SELECT opportunity_id, max(discount) AS d, max({_WON}) AS won FROM Opportunity JOIN Stage s USING (stage_id)
  JOIN Quote USING (opportunity_id) GROUP BY 1)
SELECT CASE WHEN d <= 5 THEN '0-5%' WHEN d <= 10 THEN '6-10%' WHEN d <= 15 THEN '11-15%' ELSE '16-25%' END AS discount_band,
  count(*) AS opportunities, sum(won) AS won, {_pct("sum(won)", "count(*)")} AS win_rate_pct FROM d GROUP BY 1"""


def _cycle(extra=""):
    return f"""SELECT lead_source, count(*) AS deals, {_round(_mean("date_diff('day', created, order_date)"))} AS avg_cycle_days {extra}
  FROM (SELECT lead_id, created_date AS created, lead_source_id FROM Lead) JOIN LeadSource USING (lead_source_id)
  JOIN Opportunity USING (lead_id) JOIN Quote USING (opportunity_id) JOIN Orders USING (quote_id) GROUP BY 1"""


def _above(k):
    return f"""WITH x AS (SELECT ct.city_id, ct.city_name, c.customer_name, l.lead_score, l.lead_id {_LEAD_CITY}),
m AS (SELECT city_id, {_mean("lead_score")} AS mean, {_round(_mean("lead_score"), 1)} AS city_avg_score FROM x GROUP BY 1)
SELECT city_name, customer_name, lead_score, city_avg_score FROM x JOIN m USING (city_id) WHERE lead_score > mean
ORDER BY lead_score - city_avg_score DESC, lead_id LIMIT {k}"""


def _paid(overdue):
    late = "sum(CASE WHEN payment_date > due_date THEN 1 ELSE 0 END)"
    return f"""SELECT payment_method, count(*) AS paid_invoices, {late + ' AS overdue,' if overdue else ''} {_pct(late, "count(*)")} AS overdue_pct,
  CASE WHEN {_mean("date_diff('day', invoice_date, payment_date)")} < 0
    THEN -floor(0.5 - {_mean("date_diff('day', invoice_date, payment_date)")})
    ELSE {_round(_mean("date_diff('day', invoice_date, payment_date)"))} END AS avg_days_to_pay,
  {_round("CAST(sum(late_fees) AS DOUBLE)")} AS total_late_fees
  FROM Invoice JOIN PaymentMethod USING (payment_method_id) WHERE payment_date IS NOT NULL GROUP BY 1"""


_REACHED = """SELECT [(SELECT count(*) FROM Lead), (SELECT count(*) FROM Opportunity),
  count(DISTINCT opportunity_id), count(DISTINCT opportunity_id) FILTER (WHERE order_id IS NOT NULL),
  count(DISTINCT opportunity_id) FILTER (WHERE invoice_id IS NOT NULL)] AS n
FROM Quote LEFT JOIN Orders USING (quote_id) LEFT JOIN Invoice USING (order_id)"""
EXPECTED = {
    "quarterly_sales_by_category": _QUARTERS,
    "quarterly_sales_pivot": f"""SELECT quarter, coalesce(sum(CASE WHEN vehicle_type = 'Loader' THEN revenue END), 0) AS "Loader",
  coalesce(sum(CASE WHEN vehicle_type = 'Truck' THEN revenue END), 0) AS "Truck" FROM ({_QUARTERS}) GROUP BY 1""",
    "quarterly_sales_head": f"{_QUARTERS} ORDER BY quarter, revenue DESC, vehicle_type LIMIT 12",
    "territory_leaderboard": f"""SELECT city_name, count(DISTINCT order_id) AS total_orders, sum(total_amount) AS total_revenue,
  {_round(_mean("total_amount"))} AS avg_order_value FROM Orders JOIN ShippingAddress USING (shipping_address_id)
  JOIN City USING (city_id) JOIN Invoice USING (order_id) GROUP BY 1""",
    "win_rate_by_source": f"""SELECT lead_source, count(*) AS total_leads, sum({_WON}) AS won, {_pct(f"sum({_WON})", "count(*)")} AS win_rate_pct,
  {_round(_mean("lead_score"), 1)} AS avg_lead_score FROM Lead JOIN LeadSource USING (lead_source_id)
  JOIN Opportunity o USING (lead_id) JOIN Stage s USING (stage_id) GROUP BY 1""",
    "leads_by_city_and_source": f"""SELECT city_name, lead_source, count(lead_id) AS total_leads, {_round(_mean("lead_score"), 1)} AS avg_lead_score
  {_LEAD_CITY} JOIN LeadSource USING (lead_source_id) GROUP BY 1, 2""",
    "lead_score_by_city": f"SELECT city_name, {_round(_mean('lead_score'), 1)} AS avg_lead_score, count(*) AS leads {_LEAD_CITY} GROUP BY 1",
    "warranty_mix": """SELECT warranty AS warranty_type, count(line_item_id) AS line_items, sum(quantity) AS units_sold
  FROM QuoteLineItem JOIN Warranty USING (warranty_id) GROUP BY 1""",
    "rep_leaderboard": _REPS,
    "rep_leaderboard_head": f"{_REPS} ORDER BY revenue_rank, user_name LIMIT 10",
    "pareto_curve": _PARETO,
    "pareto_cutoff": f"{_PARETO} WHERE pct_revenue_cum >= 80 ORDER BY rank LIMIT 1",
    "sales_funnel": f"""SELECT unnest(['Leads', 'Opportunities', 'Quoted', 'Ordered', 'Invoiced']) AS stage_name, unnest(n) AS cnt,
  unnest([{", ".join(_pct(f"n[{k}]", "n[1]") for k in range(1, 6))}]) AS pct_of_leads,
  unnest([NULL, {", ".join(_pct(f"n[{k}]", f"n[{k - 1}]") for k in range(2, 6))}]) AS step_conversion FROM ({_REACHED})""",
    "win_rate_by_band": _BANDS,
    "win_rate_by_band_ordered": _BANDS,
    "cycle_time_by_source": _cycle(", min(date_diff('day', created, order_date)) AS fastest_days"),
    "cycle_time_short": _cycle(),
    "above_city_mean": _above(20),
    "above_city_mean_short": _above(10),
    "payment_behaviour": _paid(True),
    "payment_behaviour_short": _paid(False),
    "open_deal_aging": f"""WITH d AS (SELECT stage, opportunity_amount AS amount,
  date_diff('day', expected_close_date, (SELECT max(order_date) FROM Orders)) AS days FROM Opportunity JOIN Stage USING (stage_id)
  WHERE stage IN ('{OPEN_STAGES[0]}', '{OPEN_STAGES[1]}'))
SELECT stage, count(*) AS stuck_deals, {_round("CAST(sum(amount) AS DOUBLE)")} AS pipeline_value, {_round(_mean("days"))} AS avg_days_overdue
  FROM d WHERE days > 0 GROUP BY 1""",
    "revenue_fanout": """WITH a AS (SELECT sum(total_amount) AS x FROM Invoice), b AS (SELECT sum(i.total_amount) AS y
  FROM Invoice i JOIN Orders USING (order_id) JOIN Quote USING (quote_id) JOIN QuoteLineItem USING (quote_id))
SELECT x AS true_total, y AS joined_total, CAST(y AS DOUBLE) / x AS inflation, y - x AS excess FROM a, b""",
    "territory_reconciliation": "SELECT sum(total_amount) AS grouped_total, sum(total_amount) AS true_total, true AS matches FROM Invoice",
}


def _comparable(row):
    return repr([v if v is None or isinstance(v, (str, bool)) else float(v) for v in row])


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_matches_sql(typed, duck, name):
    result = REPORTS[name](typed)
    columns = sorted(result.columns)
    found = result.collect()
    expected = duck.execute(EXPECTED[name])
    order = [d[0] for d in expected.description]
    assert sorted(order) == columns
    wanted = sorted(_comparable([r[order.index(c)] for c in columns]) for r in expected.fetchall())
    assert sorted(_comparable([r[c] for c in columns]) for r in found) == wanted
    assert found


def test_band_order_and_rate_order(typed):
    labels = [label for _, label in DISCOUNT_BANDS]
    assert [r[0] for r in REPORTS["win_rate_by_band_ordered"](typed).collect()] == labels
    rates = [r["win_rate_pct"] for r in REPORTS["win_rate_by_band"](typed).collect()]
    assert rates == sorted(rates, reverse=True)


# A small raw export written by hand, and the clean tables it must give.
GOLDEN_RAW = {
    "Role": " role_id , role\nR1,Manager\nR2,Agent\nR3,NA\nR4,Manager\nR2,Driver\n",
    "Users": "user_id,user_name,user_email_address,user_phone_number,role_id,commission_rate\n"
    "U1,Ann,a@x,1,R1,5\nU2,Bob,b@x,2,R4,7\nU3,Cid,c@x,3,R3,\nU4,Dee,d@x,4,R2,6\nU5,Eve,e@x,5,R9,6\nU6,Fay,f@x,6,,6\n",
    "BillingCity": "billing_city_id,billing_city\nB1,York\nB2,Bath\nB3,\n",
    "BillingAddress": "billing_address_id,billing_address,billing_city_id\nA1,1 Road,B1\nA2,2 Road,B2\nA3,3 Road,B3\nA4,4 Road,B7\n",
    "Account": "account_id,account_name\nACC1,Old\nACC2,Two\nACC1,New\n",
    "Customer": "customer_id,customer_name,account_id\nC1,One,ACC1\nC2,Lost,ACC9\nC3,Free,\n",
}
GOLDEN_CLEAN = {
    "Role": "role_id,role\nROL00001,Agent\nROL00002,Driver\nROL00003,Manager\n",
    "Users": "user_id,user_name,user_email_address,user_phone_number,role_id,commission_rate\n"
    "U1,Ann,a@x,1,ROL00003,5\nU2,Bob,b@x,2,ROL00003,7\nU3,Cid,c@x,3,,\nU4,Dee,d@x,4,ROL00002,6\nU5,Eve,e@x,5,,6\nU6,Fay,f@x,6,,6\n",
    "City": "city_id,city_name\nCTY00001,\nCTY00002,Bath\nCTY00003,York\n",
    "BillingAddress": "billing_address_id,billing_address,city_id\nA1,1 Road,CTY00003\nA2,2 Road,CTY00002\nA3,3 Road,CTY00001\nA4,4 Road,\n",
    "Account": "account_id,account_name\nACC1,New\nACC2,Two\n",
    "Customer": "customer_id,customer_name,account_id\nC1,One,ACC1\nC3,Free,\n",
}


def _write_golden(folder, tables):
    folder.mkdir()
    for name, text in tables.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def test_golden_folders(spark, tmp_path):
    """A raw folder and its known clean folder: written by hand, or others named by the environment."""
    raw_dir = os.environ.get("GOLDEN_RAW_DIR") or _write_golden(tmp_path / "raw", GOLDEN_RAW)
    clean_dir = os.environ.get("GOLDEN_CLEAN_DIR") or _write_golden(tmp_path / "clean", GOLDEN_CLEAN)
    tables, _ = clean_model(sources.read_catalog(spark, raw_dir, ordinal=True))
    paths = glob.glob(f"{clean_dir}/*.csv")
    assert paths
    for path in paths:
        with open(path, encoding="utf-8-sig", newline="") as handle:
            header, *wanted = list(csv.reader(handle))
        df = tables[os.path.basename(path)[: -len(".csv")]]
        assert set(df.columns) == set(header)
        assert sorted([r[c] or "" for c in header] for r in df.collect()) == sorted(wanted)
