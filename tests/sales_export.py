"""A generated raw export with the defects the cleaning job repairs."""

import csv
import os
import random

from salesops.plans import model

STATES = {
    "Industry": ["Mining", "Logistics", "Building"],
    "LeadSource": ["Website", "Email", "Cold Call"],
    "LeadStatus": ["Hot", "Cold"],
    "LostReason": ["Na", "Price", "Timing"],
    "QuoteStatus": ["Accepted", "Revised"],
    "PaymentMethod": ["Bearer", "Counter"],
    "PaymentStatus": ["Paid", "Overdue", ""],
    "OrderStatus": ["Delivered", "Canceled"],
    "Warranty": ["Gold", "Silver", "Platinum"],
    "VehicleType": ["Truck", "Loader"],
    "FuelType": ["Diesel", "Electric"],
    "Role": ["Manager", "Salesrep"],
    "Stage": ["Won", "Closed", "Negotiation", "Prospecting"],
}
PREFIX = {name: name[:3].upper() for name in STATES}
SIZE = 120


def make_export(folder, seed=1):
    """Write the raw CSVs; return the rows that must survive, by table and key."""
    rng = random.Random(seed)
    tables = {}
    # Lookups hold one row per occurrence; a third of all rows share one value.
    for name, values in STATES.items():
        tables[name] = (
            [column.split()[0] for column in model.SCHEMAS[name].split(", ")],
            [(f"{PREFIX[name]}{i:05d}", values[0] if i % 3 == 0 else rng.choice(values)) for i in range(SIZE)],
        )
    # An id twice: the last one counts.
    tables["Stage"][1].append((f"{PREFIX['Stage']}00001", "Won"))
    towns = ["Leeds", "Bristol", "York", "Derby"]
    tables["BillingCity"] = (["billing_city_id", "billing_city"], [(f"BCT{i:05d}", rng.choice(towns)) for i in range(SIZE)])
    tables["ShippingCity"] = (["shipping_city_id", "shipping_city"], [(f"SCT{i:05d}", rng.choice(towns[1:] + ["Ely"])) for i in range(SIZE)])
    tables["BillingAddress"] = (
        ["billing_address_id", "billing_address", "billing_city_id"],
        [(f"BLI{i:05d}", f"{i} High, Street", f"BCT{i:05d}") for i in range(SIZE)],
    )
    tables["ShippingAddress"] = (
        ["shipping_address_id", "shipping_address", "shipping_city_id"],
        [(f"SCI{i:05d}", f"{i} Low Street", f"CIT{i:05d}") for i in range(SIZE)],
    )
    tables["JobTitle"] = (
        ["job_title_id", "job_title_name"],
        [(f"JOB{i:05d}" if i < 20 else "", rng.choice(["Driver", "Planner", "Owner"])) for i in range(SIZE)],
    )

    def ref(name):
        return f"{PREFIX[name]}{rng.randrange(SIZE):05d}"

    def pick(prefix, n=SIZE):
        # One parent gets a third of the children.
        return f"{prefix}{0 if rng.random() < 0.33 else rng.randrange(n):05d}"

    def day(year=2021):
        return f"{year}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"

    tables["Users"] = (
        ["user_id", "user_name", "user_email_address", "user_phone_number", "role_id", "commission_rate"],
        [(f"USE{i:05d}", f"User {i}", f"u{i}@x.org", "+44 0123", ref("Role"), str(i % 9 + 1)) for i in range(20)],
    )
    tables["Product"] = (
        ["product_id", "vehicle_type_id", "base_price", "inventory_level", "fuel_type_id", "weight_capacity",
         "dimensions", "product_name", "model_year"],
        [(f"PRO{i:05d}", ref("VehicleType"), "900", "3", ref("FuelType"), "70", "1x2", f"Model {i}", "2020") for i in range(15)],
    )
    tables["Account"] = (
        ["account_id", "account_name", "account_email_address", "account_mobile_number", "billing_address_id",
         "user_id", "account_status", "annual_revenue", "industry_id"],
        [(f"ACC{i:05d}", f"Account {i}", f"a{i}@x.org", "1", f"BLI{i:05d}", pick("USE", 20), "1", "1000", ref("Industry"))
         for i in range(SIZE)],
    )
    tables["Customer"] = (
        ["customer_id", "customer_name", "customer_email_address", "customer_mobile_number", "account_id", "job_title_id"],
        [(f"CUS{i:05d}", f"Customer {i}", f"c{i}@x.org", "1", "ACC99999" if i % 40 == 7 else pick("ACC"), f"JOB{i:05d}")
         for i in range(SIZE)],
    )
    tables["Lead"] = (
        ["lead_id", "created_date", "lead_score", "account_id", "lead_source_id", "lead_status_id", "user_id", "customer_id"],
        [(f"LEA{i:05d}", day(2020), str(rng.randint(1, 100)), pick("ACC"), ref("LeadSource"), ref("LeadStatus"), pick("USE", 20), pick("CUS"))
         for i in range(3 * SIZE)],
    )
    tables["Opportunity"] = (
        ["opportunity_id", "close_date", "expected_close_date", "opportunity_amount", "lost_reason_id", "stage_id",
         "product_id", "user_id", "lead_id", "customer_id"],
        [(f"OPP{i:05d}", rng.choice(["Na", day()]), rng.choice(["", "NA", day()]), f"{rng.randint(100, 10**6) / 100:.2f}",
          ref("LostReason"), ref("Stage"), pick("PRO", 15), pick("USE", 20), f"LEA{i:05d}", pick("CUS"))
         for i in range(3 * SIZE)],
    )
    tables["Quote"] = (
        ["quote_id", "expiration_date", "discount", "total_amount", "created_date", "revision_number", "quote_status_id", "opportunity_id"],
        [(f"QUO{i:05d}", rng.choice(["", day()]), rng.choice(["", *map(str, range(26))]), "10.00", day(), "1", ref("QuoteStatus"), pick("OPP", 3 * SIZE))
         for i in range(4 * SIZE)],
    )
    tables["Orders"] = (
        ["order_id", "order_date", "order_status_id", "expected_delivery_date", "delivery_date", "quote_id", "shipping_address_id"],
        [(f"ORD{i:05d}", day(2022), ref("OrderStatus"), day(2022), rng.choice(["Na", day(2022)]), pick("QUO", 4 * SIZE), pick("SCI"))
         for i in range(4 * SIZE)],
    )
    tables["Invoice"] = (
        ["invoice_id", "invoice_date", "due_date", "total_amount", "late_fees", "discount_applied", "order_id",
         "payment_status_id", "payment_method_id", "payment_date", "final_amount"],
        [(f"INV{i:05d}", day(2022), day(2022), str(rng.randint(10, 5000)), f"{rng.randint(0, 999) / 100:.2f}", "0.00",
          pick("ORD", 4 * SIZE), ref("PaymentStatus"), ref("PaymentMethod"), rng.choice(["", "Na", day(2022)]), "1")
         for i in range(4 * SIZE)],
    )
    tables["QuoteLineItem"] = (
        ["line_item_id", "quote_id", "product_id", "quantity", "unit_price", "total_price", "warranty_id"],
        [(f"LIN{i:05d}", pick("QUO", 4 * SIZE), pick("PRO", 15), str(rng.randint(1, 20)), "5.00", f"{rng.randint(100, 99999) / 100:.2f}", ref("Warranty"))
         for i in range(6 * SIZE)],
    )

    # Repeated keys: the later row must be kept. Blank rows must go.
    for name in ("Account", "Customer", "Lead", "Opportunity", "Quote", "Orders", "Invoice", "QuoteLineItem"):
        rows = tables[name][1]
        again = list(rows[3])
        again[1] = day(2023) if name in ("Lead", "Opportunity", "Orders", "Invoice") else again[1]
        rows.append(tuple(again))
    tables["Opportunity"][1].append(("OPP99998", *[""] * 9))
    tables["Invoice"][1].append(("INV99998", *[""] * 10))

    os.makedirs(folder, exist_ok=True)
    for name, (header, rows) in tables.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", newline="", encoding="utf-8") as handle:
            writer = csv.writer(handle)
            writer.writerow(header)
            writer.writerows(rows)
    return {name: [dict(zip(header, row)) for row in rows] for name, (header, rows) in tables.items()}
