"""Dimensions, facts, marts and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base_sql import ratio
from catalog.query import Query
from tradewind.operators import serving
from tradewind.plans.warehouse import Warehouse
from tradewind.sources.bindings import Canonical

# the day after the last order: recency and snapshot date of the checks
AS_OF = "2001-08-02"


def warehouse(c: Canonical) -> Warehouse:
    return Warehouse(c, F.lit(AS_OF).cast("date"))


def _model(name: str):
    return lambda c: getattr(warehouse(c), name)


_KPI = "total_orders:i net_revenue:n gross_margin:n gross_margin_rate:n avg_order_line_value:n units_sold:n"
_DAILY = "date_key:d orders:i net_revenue:n units_sold:n gross_margin:n"
_CHANNEL = "channel_code:s channel_name:s channel_type:s orders:i net_revenue:n units_sold:n gross_margin:n"
_PRODUCT = "sku:s product_name:s category_name:s units_sold:n net_revenue:n gross_margin:n"
_ALERT = (
    "warehouse_code:s warehouse_name:s sku:s product_name:s available_qty:n reorder_point:n "
    "avg_daily_sales_14d:n days_of_inventory:n stock_status:s shelf_life_status:s"
)
_LOGISTICS = (
    "carrier_code:s carrier_name:s service_level:s shipments:i avg_fulfillment_lead_days:n "
    "avg_delivery_lead_days:n on_time_delivery_rate:n shipping_fee:n"
)
_RFM = (
    "customer_code:s customer_name:s segment_name:s last_order_date:d recency_days:i frequency_orders:i "
    "monetary_value:n customer_status:s"
)
_SEVERITY = "CASE stock_status WHEN 'OUT_OF_STOCK' THEN 1 WHEN 'REORDER' THEN 2 ELSE 3 END"

_JSON = {
    "kpis": _KPI,
    "daily_sales": _DAILY,
    "sales_by_channel": _CHANNEL,
    "top_products": _PRODUCT,
    "inventory_alerts": _ALERT.replace("warehouse_name:s ", ""),
    "logistics": _LOGISTICS,
    "customers": _RFM,
}


def _dashboard_rows(c: Canonical):
    """Every field of every payload row, read back from the JSON: numbers as numbers, so that their text forms do not matter."""
    rows, fields = warehouse(c).staged().dashboard(), None
    for section, columns in _JSON.items():
        items = []
        for name, kind in (item.split(":") for item in columns.split()):
            value = F.get_json_object("payload", f"$.{name}")
            number, label = (value.cast("double"), F.lit(None).cast("string")) if kind in "ni" else (F.lit(None).cast("double"), value)
            items.append(F.struct(F.lit(name).alias("field"), number.alias("number"), label.alias("label")))
        fields = F.when(F.col("section") == section, F.array(*items)) if fields is None else fields.when(F.col("section") == section, F.array(*items))
    return rows.select("section", "rank", F.inline(fields))


# the order of each section, and how many rows it shows
_SECTIONS = {
    "kpis": ("mart_kpis", "1", None),
    "daily_sales": ("mart_daily", "date_key", None),
    "sales_by_channel": ("mart_channel", "net_revenue DESC, channel_code", None),
    "top_products": ("mart_products", "net_revenue DESC, sku", 8),
    "inventory_alerts": ("mart_alerts", f"{_SEVERITY}, available_qty, warehouse_code, sku", 10),
    "logistics": ("mart_logistics", "shipments DESC, carrier_code", None),
    "customers": ("mart_rfm", "monetary_value DESC, customer_code", 8),
}


def _dashboard_sql() -> str:
    parts = []
    for section, (mart, order, limit) in _SECTIONS.items():
        ranked = f"(SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM {mart}{f' QUALIFY rank <= {limit}' if limit else ''})"
        for name, kind in (item.split(":") for item in _JSON[section].split()):
            number, label = (f"CAST({name} AS DOUBLE)", "CAST(NULL AS VARCHAR)") if kind in "ni" else ("CAST(NULL AS DOUBLE)", f"CAST({name} AS VARCHAR)")
            parts.append(f"SELECT '{section}' AS section, rank, '{name}' AS field, {number} AS number, {label} AS label FROM {ranked}")
    return " UNION ALL ".join(parts)


QUERIES: dict[str, Query] = {
    "d01_dim_date": Query(
        _model("dim_date"),
        "date_key:d year:i quarter:i month:i month_name:s day_of_month:i iso_day_of_week:i day_name:s is_weekend:b",
        f"""SELECT date_key, year(date_key) AS year, quarter(date_key) AS quarter, month(date_key) AS month,
        strftime(date_key, '%b') AS month_name, day(date_key) AS day_of_month, isodow(date_key) AS iso_day_of_week,
        strftime(date_key, '%a') AS day_name, isodow(date_key) >= 6 AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date_key FROM
        (SELECT min(order_date) AS first, greatest(max(order_date), DATE '{AS_OF}') AS last FROM sales_orders))""",
    ),
    "d02_dim_customer": Query(
        _model("dim_customer"),
        "customer_key:i customer_code:s customer_name:s customer_type:s city:s region:s segment_code:s segment_name:s is_active:b",
        "SELECT * FROM dim_customer",
    ),
    "d03_dim_product": Query(
        _model("dim_product"),
        "product_key:i sku:s product_name:s brand:s unit_of_measure:s standard_cost:n list_price:n shelf_life_days:i "
        "category_code:s category_name:s parent_category_code:s parent_category_name:s is_active:b",
        "SELECT * FROM dim_product",
    ),
    "d05_dim_warehouse": Query(
        _model("dim_warehouse"),
        "warehouse_key:i warehouse_code:s warehouse_name:s city:s branch_code:s branch_name:s region:s",
        """SELECT warehouse_id AS warehouse_key, warehouse_code, warehouse_name, w.city, branch_code, branch_name, region
        FROM warehouses w LEFT JOIN branches b ON b.branch_id = w.branch_id""",
    ),
    "f01_fact_sales_order_lines": Query(
        _model("fact_sales_order_lines"),
        "sales_order_line_key:s sales_order_key:i order_number:s date_key:d order_status:s customer_key:i channel_key:i branch_id:i "
        "product_key:i warehouse_key:i promotion_id:i promotion_code:s quantity:n unit_price:n gross_amount:n discount_amount:n "
        "net_amount:n estimated_cost:n gross_margin_amount:n gross_margin_rate:n",
        "SELECT * FROM fact_sales",
    ),
    "f02_fact_inventory_balance": Query(
        _model("fact_inventory_balance"),
        "warehouse_key:i product_key:i snapshot_date:d on_hand_qty:n reserved_qty:n available_qty:n reorder_point:n "
        "stock_status:s quantity_sold_14d:n avg_daily_sales_14d:n days_of_inventory:n",
        "SELECT * FROM fact_stock",
    ),
    "f03_fact_logistics_shipments": Query(
        _model("fact_logistics_shipments"),
        "shipment_key:i sales_order_key:i order_number:s order_date:d warehouse_key:i carrier_key:i planned_ship_date:d "
        "actual_ship_date:d planned_delivery_date:d actual_delivery_date:d shipment_status:s shipping_fee:n "
        "fulfillment_lead_days:i delivery_lead_days:i is_on_time_delivery:b",
        "SELECT * FROM fact_shipments",
    ),
    "f04_fact_payments": Query(
        _model("fact_payments"),
        "payment_key:s invoice_key:i sales_order_key:i customer_key:i date_key:d payment_method:s payment_status:s amount_paid:n",
        """SELECT payment_id AS payment_key, p.invoice_id AS invoice_key, i.order_id AS sales_order_key, p.customer_id AS customer_key,
        payment_date AS date_key, payment_method, payment_status, p.amount_paid FROM payments p JOIN invoices i ON i.invoice_id = p.invoice_id""",
    ),
    "m01_mart_dashboard_kpis": Query(_model("mart_dashboard_kpis"), _KPI, "SELECT * FROM mart_kpis"),
    "m02_mart_daily_sales": Query(_model("mart_daily_sales"), _DAILY, "SELECT * FROM mart_daily"),
    "m03_mart_sales_by_channel": Query(_model("mart_sales_by_channel"), _CHANNEL, "SELECT * FROM mart_channel"),
    "m04_mart_top_products": Query(_model("mart_top_products"), _PRODUCT, "SELECT * FROM mart_products"),
    "m05_mart_inventory_alerts": Query(_model("mart_inventory_alerts"), _ALERT, "SELECT * FROM mart_alerts"),
    "m06_mart_logistics_performance": Query(_model("mart_logistics_performance"), _LOGISTICS, "SELECT * FROM mart_logistics"),
    "m07_mart_customer_rfm": Query(_model("mart_customer_rfm"), _RFM, "SELECT * FROM mart_rfm"),
    "v01_kpis": Query(lambda c: serving.kpis(warehouse(c).mart_dashboard_kpis), _KPI, "SELECT * FROM mart_kpis LIMIT 1"),
    "v02_daily_sales": Query(
        lambda c: serving.daily_sales(warehouse(c).mart_daily_sales), _DAILY, "SELECT * FROM mart_daily ORDER BY date_key"
    ),
    "v03_sales_by_channel": Query(
        lambda c: serving.sales_by_channel(warehouse(c).mart_sales_by_channel), _CHANNEL,
        "SELECT * FROM mart_channel ORDER BY net_revenue DESC",
    ),
    "v04_top_products": Query(
        lambda c: serving.top_products(warehouse(c).mart_top_products), _PRODUCT,
        "SELECT * FROM mart_products ORDER BY net_revenue DESC, sku LIMIT 8",
    ),
    "v05_inventory_alerts": Query(
        lambda c: serving.inventory_alerts(warehouse(c).mart_inventory_alerts), _JSON["inventory_alerts"],
        f"SELECT * FROM mart_alerts ORDER BY {_SEVERITY}, available_qty, warehouse_code, sku LIMIT 10",
    ),
    "v06_logistics": Query(
        lambda c: serving.logistics(warehouse(c).mart_logistics_performance), _LOGISTICS,
        "SELECT * FROM mart_logistics ORDER BY shipments DESC",
    ),
    "v07_customers": Query(
        lambda c: serving.customers(warehouse(c).mart_customer_rfm), _RFM,
        "SELECT * FROM mart_rfm ORDER BY monetary_value DESC, customer_code LIMIT 8",
    ),
    "v08_dashboard_payload": Query(
        _dashboard_rows, "section:s rank:i field:s number:n label:s", _dashboard_sql()
    ),
    "v09_json_value": Query(
        lambda c: serving.json_ready(warehouse(c).mart_customer_rfm), _RFM, "SELECT * FROM mart_rfm"
    ),
    "v10_channel_share": Query(
        lambda c: serving.channel_share(warehouse(c).mart_sales_by_channel),
        "channel_code:s channel_name:s net_revenue:n revenue_share_pct:n",
        f"""SELECT channel_code, channel_name, net_revenue, {ratio('net_revenue * 100', '(SELECT sum(net_revenue) FROM mart_channel)', 2)}
        AS revenue_share_pct FROM mart_channel""",
    ),
}
