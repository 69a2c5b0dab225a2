"""The sales-lifecycle model: tables, keys and constraints as data."""

from __future__ import annotations

from salesops.operators.integrity import ForeignKey

# The model's tables with their column names and types.
SCHEMAS = {
    "City": "city_id string, city_name string",
    "JobTitle": "job_title_id string, job_title_name string",
    "Industry": "industry_id string, industry_name string",
    "LeadSource": "lead_source_id string, lead_source string",
    "LeadStatus": "lead_status_id string, lead_status string",
    "LostReason": "lost_reason_id string, lost_reason string",
    "QuoteStatus": "quote_status_id string, quote_status string",
    "PaymentMethod": "payment_method_id string, payment_method string",
    "PaymentStatus": "payment_status_id string, payment_status string",
    "OrderStatus": "order_status_id string, status_name string",
    "Warranty": "warranty_id string, warranty string",
    "VehicleType": "vehicle_type_id string, vehicle_type string",
    "FuelType": "fuel_type_id string, fuel_type string",
    "Role": "role_id string, role string",
    "Stage": "stage_id string, stage string",
    "BillingAddress": "billing_address_id string, billing_address string, city_id string",
    "ShippingAddress": "shipping_address_id string, shipping_address string, city_id string",
    "Users": "user_id string, user_name string, user_email_address string, user_phone_number string, "
    "role_id string, commission_rate string",
    "Account": "account_id string, account_name string, account_email_address string, "
    "account_mobile_number string, billing_address_id string, user_id string, account_status boolean, "
    "annual_revenue bigint, industry_id string",
    "Customer": "customer_id string, customer_name string, customer_email_address string, "
    "customer_mobile_number string, account_id string, job_title_id string",
    "Lead": "lead_id string, created_date date, lead_score int, account_id string, lead_source_id string, "
    "lead_status_id string, user_id string, customer_id string",
    "Product": "product_id string, product_name string, vehicle_type_id string, model_year int, "
    "base_price bigint, inventory_level int, fuel_type_id string, weight_capacity int, dimensions string",
    "Opportunity": "opportunity_id string, close_date date, expected_close_date date, "
    "opportunity_amount decimal(10,2), lost_reason_id string, stage_id string, product_id string, "
    "user_id string, lead_id string, customer_id string",
    "Quote": "quote_id string, expiration_date date, discount int, total_amount decimal(10,2), "
    "created_date date, revision_number int, quote_status_id string, opportunity_id string",
    "Orders": "order_id string, order_date date, order_status_id string, expected_delivery_date date, "
    "delivery_date date, quote_id string, shipping_address_id string",
    "Invoice": "invoice_id string, invoice_date date, due_date date, total_amount bigint, "
    "late_fees decimal(10,2), discount_applied decimal(10,2), order_id string, payment_status_id string, "
    "payment_method_id string, payment_date date, final_amount bigint",
    "QuoteLineItem": "line_item_id string, quote_id string, product_id string, quantity int, "
    "unit_price decimal(10,2), total_price decimal(10,2), warranty_id string",
}

# The first column of each table is its primary key.
PRIMARY_KEYS = {table: columns.split()[0] for table, columns in SCHEMAS.items()}

# Child.column -> parent.key, parents first along cascading keys.
# True marks the keys along which a deletion travels down.
FOREIGN_KEYS = [
    ForeignKey("BillingAddress", "city_id", "City", "city_id"),
    ForeignKey("ShippingAddress", "city_id", "City", "city_id"),
    ForeignKey("Users", "role_id", "Role", "role_id"),
    ForeignKey("Account", "user_id", "Users", "user_id"),
    ForeignKey("Account", "billing_address_id", "BillingAddress", "billing_address_id"),
    ForeignKey("Account", "industry_id", "Industry", "industry_id"),
    ForeignKey("Customer", "job_title_id", "JobTitle", "job_title_id"),
    ForeignKey("Customer", "account_id", "Account", "account_id", True),
    ForeignKey("Lead", "customer_id", "Customer", "customer_id", True),
    ForeignKey("Lead", "user_id", "Users", "user_id"),
    ForeignKey("Lead", "lead_source_id", "LeadSource", "lead_source_id"),
    ForeignKey("Lead", "lead_status_id", "LeadStatus", "lead_status_id"),
    ForeignKey("Product", "fuel_type_id", "FuelType", "fuel_type_id"),
    ForeignKey("Product", "vehicle_type_id", "VehicleType", "vehicle_type_id"),
    ForeignKey("Opportunity", "customer_id", "Customer", "customer_id", True),
    ForeignKey("Opportunity", "user_id", "Users", "user_id"),
    ForeignKey("Opportunity", "lead_id", "Lead", "lead_id", True),
    ForeignKey("Opportunity", "stage_id", "Stage", "stage_id"),
    ForeignKey("Opportunity", "product_id", "Product", "product_id"),
    ForeignKey("Opportunity", "lost_reason_id", "LostReason", "lost_reason_id"),
    ForeignKey("Quote", "quote_status_id", "QuoteStatus", "quote_status_id"),
    ForeignKey("Quote", "opportunity_id", "Opportunity", "opportunity_id", True),
    ForeignKey("Orders", "shipping_address_id", "ShippingAddress", "shipping_address_id"),
    ForeignKey("Orders", "quote_id", "Quote", "quote_id", True),
    ForeignKey("Orders", "order_status_id", "OrderStatus", "order_status_id"),
    ForeignKey("Invoice", "payment_status_id", "PaymentStatus", "payment_status_id"),
    ForeignKey("Invoice", "payment_method_id", "PaymentMethod", "payment_method_id"),
    ForeignKey("Invoice", "order_id", "Orders", "order_id", True),
    ForeignKey("QuoteLineItem", "product_id", "Product", "product_id"),
    ForeignKey("QuoteLineItem", "quote_id", "Quote", "quote_id", True),
    ForeignKey("QuoteLineItem", "warranty_id", "Warranty", "warranty_id"),
]

# Columns that must be unique besides the primary keys.
UNIQUE = [
    ("BillingAddress", "billing_address"),
    ("ShippingAddress", "shipping_address"),
    ("Users", "user_email_address"),
    ("Customer", "customer_email_address"),
]

# The dimensions have a mandatory second column.
DIMENSIONS = [
    "City", "JobTitle", "Industry", "LeadSource", "LeadStatus", "LostReason", "QuoteStatus", "PaymentMethod",
    "PaymentStatus", "OrderStatus", "Warranty", "VehicleType", "FuelType", "Role", "Stage",
]

# Mandatory columns.
NOT_NULL = {
    **{table: [SCHEMAS[table].split(", ")[1].split()[0]] for table in DIMENSIONS},
    "BillingAddress": ["billing_address"],
    "ShippingAddress": ["shipping_address"],
    "Users": ["user_name", "user_email_address", "user_phone_number"],
    "Account": ["account_name", "account_email_address", "account_mobile_number"],
    "Customer": ["customer_name", "customer_email_address", "customer_mobile_number"],
    "Lead": ["created_date"],
    "Product": ["product_name", "base_price"],
    "Opportunity": ["opportunity_amount"],
    "Quote": ["total_amount", "created_date"],
    "Orders": ["order_date"],
    "Invoice": ["invoice_date", "due_date"],
    "QuoteLineItem": ["unit_price", "total_price"],
}

# Inclusive bounds of numbers.
RANGES = {
    "Lead": {"lead_score": (1, 100)},
    "Product": {"inventory_level": (0, None), "weight_capacity": (0, None)},
    "Quote": {"discount": (0, 25)},
    "QuoteLineItem": {"quantity": (1, 20)},
}

# Defaults for columns an input does not have at all.
DEFAULTS = {
    "Account": {"account_status": True},
    "Quote": {"revision_number": 1},
    "Invoice": {"late_fees": 0, "discount_applied": 0},
}

# Raw lookup -> key prefix and the raw foreign keys that use it.
LOOKUPS = {
    "Industry": ("IND", [("Account", "industry_id")]),
    "LeadSource": ("LSR", [("Lead", "lead_source_id")]),
    "LeadStatus": ("LST", [("Lead", "lead_status_id")]),
    "LostReason": ("LRS", [("Opportunity", "lost_reason_id")]),
    "QuoteStatus": ("QST", [("Quote", "quote_status_id")]),
    "PaymentMethod": ("PMT", [("Invoice", "payment_method_id")]),
    "PaymentStatus": ("PST", [("Invoice", "payment_status_id")]),
    "OrderStatus": ("OST", [("Orders", "order_status_id")]),
    "Warranty": ("WAR", [("QuoteLineItem", "warranty_id")]),
    "VehicleType": ("VHT", [("Product", "vehicle_type_id")]),
    "FuelType": ("FUL", [("Product", "fuel_type_id")]),
    "Role": ("ROL", [("Users", "role_id")]),
    "Stage": ("STG", [("Opportunity", "stage_id")]),
}

# Raw lookups with steps of their own.
OTHER_LOOKUPS = ["JobTitle", "BillingCity", "ShippingCity"]

# Tables whose raw export repeats primary keys.
REPEATED_KEYS = ["Account", "Customer", "Lead", "Opportunity", "Quote", "Orders", "Invoice", "QuoteLineItem"]

# Rows without these are blank rows.
REQUIRED = {"Opportunity": "opportunity_amount", "Invoice": "invoice_date"}

# Entity links along which orphans are dropped, parents first.
ORPHAN_LINKS = [
    ("Customer", "account_id", "Account", "account_id"),
    ("Lead", "customer_id", "Customer", "customer_id"),
    ("Opportunity", "lead_id", "Lead", "lead_id"),
    ("Opportunity", "customer_id", "Customer", "customer_id"),
    ("Quote", "opportunity_id", "Opportunity", "opportunity_id"),
    ("QuoteLineItem", "quote_id", "Quote", "quote_id"),
    ("Orders", "quote_id", "Quote", "quote_id"),
    ("Invoice", "order_id", "Orders", "order_id"),
]

# Tables laid out by key: those that reports join on it, with the key they share.
BUCKET_KEYS = {"Quote": "quote_id", "Orders": "quote_id", "QuoteLineItem": "quote_id"}
