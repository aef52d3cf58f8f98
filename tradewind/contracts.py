"""Canonical tables: columns, keys, domains, references and row rules.

The engine does not enforce any of these; `operators.quality` checks them.
Everything below is fixed by the data model.
"""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: columns of the canonical tables ("?" marks a nullable column)
_TABLES = {
    "companies": "company_id int, company_code string, company_name string, country string, "
    "currency string, is_active boolean, created_at timestamp, updated_at timestamp",
    "branches": "branch_id int, company_id int, branch_code string, branch_name string, city string, "
    "region string, is_active boolean, created_at timestamp, updated_at timestamp",
    "warehouses": "warehouse_id int, company_id int, branch_id int, warehouse_code string, "
    "warehouse_name string, city string, is_active boolean, created_at timestamp, updated_at timestamp",
    "sales_channels": "channel_id int, channel_code string, channel_name string, channel_type string, "
    "is_active boolean",
    "carriers": "carrier_id int, carrier_code string, carrier_name string, service_level string, "
    "is_active boolean",
    "customer_segments": "segment_id int, segment_code string, segment_name string, description? string",
    "customers": "customer_id int, segment_id int, customer_code string, customer_name string, "
    "customer_type string, city string, region string, created_at timestamp, updated_at timestamp, "
    "is_active boolean",
    "product_categories": "category_id int, parent_category_id? int, category_code string, "
    "category_name string, level int, is_active boolean",
    "products": "product_id int, category_id int, sku string, product_name string, brand string, "
    "unit_of_measure string, standard_cost decimal(18,2), list_price decimal(18,2), "
    "shelf_life_days? int, is_active boolean, created_at timestamp, updated_at timestamp",
    "price_lists": "price_list_id int, product_id int, channel_id int, valid_from date, valid_to date, "
    "unit_price decimal(18,2), currency string, is_active boolean",
    "promotions": "promotion_id int, promotion_code string, promotion_name string, channel_id int, "
    "start_date date, end_date date, discount_type string, discount_value decimal(18,2), "
    "budget_amount decimal(18,2), is_active boolean",
    "stock_balances": "warehouse_id int, product_id int, on_hand_qty decimal(18,3), "
    "reserved_qty decimal(18,3), reorder_point decimal(18,3), updated_at timestamp",
    "stock_lots": "lot_id int, product_id int, warehouse_id int, lot_number string, "
    "manufacturing_date date, expiration_date date, quantity_on_hand decimal(18,3), created_at timestamp",
    "sales_orders": "order_id int, company_id int, branch_id int, customer_id int, channel_id int, "
    "order_number string, order_date date, order_status string, currency string, "
    "gross_amount decimal(18,2), discount_amount decimal(18,2), net_amount decimal(18,2), "
    "created_at timestamp, updated_at timestamp",
    "sales_order_lines": "order_line_id int, order_id int, product_id int, warehouse_id int, "
    "promotion_id? int, quantity decimal(18,3), unit_price decimal(18,2), "
    "discount_amount decimal(18,2), gross_amount decimal(18,2), net_amount decimal(18,2), "
    "estimated_cost decimal(18,2)",
    "shipments": "shipment_id int, order_id int, warehouse_id int, carrier_id int, "
    "shipment_number string, planned_ship_date date, actual_ship_date? date, "
    "planned_delivery_date date, actual_delivery_date? date, shipment_status string, "
    "shipping_fee decimal(18,2), created_at timestamp, updated_at timestamp",
    "delivery_attempts": "delivery_attempt_id int, shipment_id int, attempt_number int, "
    "attempt_date date, attempt_status string, failure_reason? string, cod_amount decimal(18,2), "
    "created_at timestamp",
    "stock_moves": "stock_move_id int, warehouse_id int, product_id int, order_line_id? int, "
    "move_type string, move_date date, quantity decimal(18,3), unit_cost decimal(18,2), "
    "move_value decimal(18,2), reference_number string, created_at timestamp",
    "invoices": "invoice_id int, order_id int, customer_id int, invoice_number string, "
    "invoice_date date, due_date date, invoice_status string, gross_amount decimal(18,2), "
    "tax_amount decimal(18,2), discount_amount decimal(18,2), net_amount decimal(18,2), "
    "amount_paid decimal(18,2), created_at timestamp, updated_at timestamp",
    "invoice_lines": "invoice_line_id int, invoice_id int, order_line_id int, product_id int, "
    "quantity decimal(18,3), unit_price decimal(18,2), gross_amount decimal(18,2), "
    "tax_amount decimal(18,2), net_amount decimal(18,2)",
    "payments": "payment_id int, invoice_id int, customer_id int, payment_date date, "
    "payment_method string, payment_status string, amount_paid decimal(18,2), "
    "transaction_reference string, created_at timestamp",
    "returns": "return_id int, order_id int, order_line_id int, customer_id int, product_id int, "
    "return_date date, return_reason string, quantity decimal(18,3), refund_amount decimal(18,2), "
    "return_status string, created_at timestamp",
}

# fixed values: unique keys
KEYS: dict[str, list[tuple[str, ...]]] = {
    "companies": [("company_id",), ("company_code",)],
    "branches": [("branch_id",), ("branch_code",)],
    "warehouses": [("warehouse_id",), ("warehouse_code",)],
    "sales_channels": [("channel_id",), ("channel_code",)],
    "carriers": [("carrier_id",), ("carrier_code",)],
    "customer_segments": [("segment_id",), ("segment_code",)],
    "customers": [("customer_id",), ("customer_code",)],
    "product_categories": [("category_id",), ("category_code",)],
    "products": [("product_id",), ("sku",)],
    "price_lists": [("price_list_id",), ("product_id", "channel_id", "valid_from")],
    "promotions": [("promotion_id",), ("promotion_code",)],
    "stock_balances": [("warehouse_id", "product_id")],
    "stock_lots": [("lot_id",), ("lot_number",)],
    "sales_orders": [("order_id",), ("order_number",)],
    "sales_order_lines": [("order_line_id",)],
    "shipments": [("shipment_id",), ("shipment_number",)],
    "delivery_attempts": [("delivery_attempt_id",), ("shipment_id", "attempt_number")],
    "stock_moves": [("stock_move_id",)],
    "invoices": [("invoice_id",), ("invoice_number",)],
    "invoice_lines": [("invoice_line_id",)],
    "payments": [("payment_id",), ("transaction_reference",)],
    "returns": [("return_id",)],
}

# fixed values: allowed codes
DOMAINS: dict[tuple[str, str], tuple[str, ...]] = {
    ("carriers", "service_level"): ("standard", "express", "same_day", "b2b_freight"),
    ("customers", "customer_type"): ("individual", "business"),
    ("promotions", "discount_type"): ("percent", "fixed_amount"),
    ("sales_orders", "order_status"): (
        "draft", "confirmed", "fulfilled", "invoiced", "paid", "cancelled",
    ),
    ("shipments", "shipment_status"): (
        "planned", "in_transit", "delivered", "failed", "returned", "cancelled",
    ),
    ("delivery_attempts", "attempt_status"): ("delivered", "failed", "rescheduled", "returned"),
    ("stock_moves", "move_type"): (
        "purchase_receipt", "sale_reservation", "sale_delivery", "return_receipt", "adjustment",
    ),
    ("invoices", "invoice_status"): ("open", "partial", "paid", "cancelled"),
    ("payments", "payment_method"): ("bank_transfer", "cash", "card", "e_wallet"),
    ("payments", "payment_status"): ("paid", "reversed"),
    ("returns", "return_status"): ("approved", "refunded", "rejected"),
}

# fixed values: child table, child column, parent table, parent column
REFERENCES: list[tuple[str, str, str, str]] = [
    ("branches", "company_id", "companies", "company_id"),
    ("warehouses", "company_id", "companies", "company_id"),
    ("warehouses", "branch_id", "branches", "branch_id"),
    ("customers", "segment_id", "customer_segments", "segment_id"),
    ("product_categories", "parent_category_id", "product_categories", "category_id"),
    ("products", "category_id", "product_categories", "category_id"),
    ("price_lists", "product_id", "products", "product_id"),
    ("price_lists", "channel_id", "sales_channels", "channel_id"),
    ("promotions", "channel_id", "sales_channels", "channel_id"),
    ("stock_balances", "warehouse_id", "warehouses", "warehouse_id"),
    ("stock_balances", "product_id", "products", "product_id"),
    ("stock_lots", "product_id", "products", "product_id"),
    ("stock_lots", "warehouse_id", "warehouses", "warehouse_id"),
    ("sales_orders", "company_id", "companies", "company_id"),
    ("sales_orders", "branch_id", "branches", "branch_id"),
    ("sales_orders", "customer_id", "customers", "customer_id"),
    ("sales_orders", "channel_id", "sales_channels", "channel_id"),
    ("sales_order_lines", "order_id", "sales_orders", "order_id"),
    ("sales_order_lines", "product_id", "products", "product_id"),
    ("sales_order_lines", "warehouse_id", "warehouses", "warehouse_id"),
    ("sales_order_lines", "promotion_id", "promotions", "promotion_id"),
    ("shipments", "order_id", "sales_orders", "order_id"),
    ("shipments", "warehouse_id", "warehouses", "warehouse_id"),
    ("shipments", "carrier_id", "carriers", "carrier_id"),
    ("delivery_attempts", "shipment_id", "shipments", "shipment_id"),
    ("stock_moves", "warehouse_id", "warehouses", "warehouse_id"),
    ("stock_moves", "product_id", "products", "product_id"),
    ("stock_moves", "order_line_id", "sales_order_lines", "order_line_id"),
    ("invoices", "order_id", "sales_orders", "order_id"),
    ("invoices", "customer_id", "customers", "customer_id"),
    ("invoice_lines", "invoice_id", "invoices", "invoice_id"),
    ("invoice_lines", "order_line_id", "sales_order_lines", "order_line_id"),
    ("invoice_lines", "product_id", "products", "product_id"),
    ("payments", "invoice_id", "invoices", "invoice_id"),
    ("payments", "customer_id", "customers", "customer_id"),
    ("returns", "order_id", "sales_orders", "order_id"),
    ("returns", "order_line_id", "sales_order_lines", "order_line_id"),
    ("returns", "customer_id", "customers", "customer_id"),
    ("returns", "product_id", "products", "product_id"),
]

# fixed values: a row is good when the predicate is true or NULL
ROW_RULES: dict[str, dict[str, str]] = {
    "product_categories": {"level_positive": "level > 0"},
    "products": {
        "cost_not_negative": "standard_cost >= 0",
        "list_price_covers_cost": "list_price >= standard_cost",
        "shelf_life_positive": "shelf_life_days > 0",
    },
    "price_lists": {
        "price_not_negative": "unit_price >= 0",
        "validity_ordered": "valid_to >= valid_from",
    },
    "promotions": {
        "discount_not_negative": "discount_value >= 0",
        "budget_not_negative": "budget_amount >= 0",
        "dates_ordered": "end_date >= start_date",
    },
    "stock_balances": {
        "on_hand_not_negative": "on_hand_qty >= 0",
        "reserved_not_negative": "reserved_qty >= 0",
        "reorder_not_negative": "reorder_point >= 0",
        "reserved_within_on_hand": "reserved_qty <= on_hand_qty",
    },
    "stock_lots": {
        "quantity_not_negative": "quantity_on_hand >= 0",
        "expiry_after_manufacture": "expiration_date > manufacturing_date",
    },
    "sales_orders": {
        "gross_not_negative": "gross_amount >= 0",
        "discount_not_negative": "discount_amount >= 0",
        "net_not_negative": "net_amount >= 0",
        "discount_within_gross": "discount_amount <= gross_amount",
        "net_is_gross_less_discount": "net_amount = gross_amount - discount_amount",
    },
    "sales_order_lines": {
        "quantity_positive": "quantity > 0",
        "price_not_negative": "unit_price >= 0",
        "discount_not_negative": "discount_amount >= 0",
        "gross_not_negative": "gross_amount >= 0",
        "net_not_negative": "net_amount >= 0",
        "cost_not_negative": "estimated_cost >= 0",
        "discount_within_gross": "discount_amount <= gross_amount",
        "net_is_gross_less_discount": "net_amount = gross_amount - discount_amount",
    },
    "shipments": {
        "fee_not_negative": "shipping_fee >= 0",
        "planned_dates_ordered": "planned_delivery_date >= planned_ship_date",
        "shipped_not_before_plan": "actual_ship_date >= planned_ship_date",
        "delivered_not_before_plan": "actual_delivery_date >= planned_ship_date",
    },
    "delivery_attempts": {
        "number_positive": "attempt_number > 0",
        "cod_not_negative": "cod_amount >= 0",
        "failure_has_reason": "attempt_status IN ('delivered', 'rescheduled') OR failure_reason IS NOT NULL",
    },
    "stock_moves": {"quantity_not_zero": "quantity <> 0", "cost_not_negative": "unit_cost >= 0"},
    "invoices": {
        "gross_not_negative": "gross_amount >= 0",
        "tax_not_negative": "tax_amount >= 0",
        "discount_not_negative": "discount_amount >= 0",
        "net_not_negative": "net_amount >= 0",
        "paid_not_negative": "amount_paid >= 0",
        "due_not_before_invoice": "due_date >= invoice_date",
        "paid_within_net": "amount_paid <= net_amount",
    },
    "invoice_lines": {
        "quantity_positive": "quantity > 0",
        "price_not_negative": "unit_price >= 0",
        "gross_not_negative": "gross_amount >= 0",
        "tax_not_negative": "tax_amount >= 0",
        "net_not_negative": "net_amount >= 0",
    },
    "payments": {"amount_positive": "amount_paid > 0"},
    "returns": {"quantity_positive": "quantity > 0", "refund_not_negative": "refund_amount >= 0"},
}


_TYPES = {
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(18,3)": T.DecimalType(18, 3),
}


def schema(table: str) -> T.StructType:
    """Explicit schema of a canonical table."""
    fields = []
    for item in _TABLES[table].split(", "):
        name, kind = item.split(" ", 1)
        fields.append(T.StructField(name.rstrip("?"), _TYPES[kind], name.endswith("?")))
    return T.StructType(fields)


def required(table: str) -> list[str]:
    return [f.name for f in schema(table).fields if not f.nullable]


def tables() -> list[str]:
    return list(_TABLES)
