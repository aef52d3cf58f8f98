"""Marts over the facts.

No mart sorts: an order inside a stored table is only a hint, and the serving
queries sort what they return. Aggregates that count distinct orders first
reduce to one row per (group, order) with a map-side combine, so a hot group
is spread over all its orders before the last, small step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions import exact_ratio


def _by_order(sales: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Amounts per (keys, order)."""
    return sales.groupBy(*keys, "sales_order_key").agg(
        F.sum("net_amount").alias("net"),
        F.sum("quantity").alias("units"),
        F.sum("gross_margin_amount").alias("margin"),
        F.count("*").alias("line_count"),
    )


def _sales_totals(per_order: DataFrame, keys: Sequence[str]) -> DataFrame:
    return per_order.groupBy(*keys).agg(
        F.count("sales_order_key").alias("orders"),
        F.sum("net").alias("net_revenue"),
        F.sum("units").alias("units_sold"),
        F.sum("margin").alias("gross_margin"),
    )


def mart_dashboard_kpis(sales: DataFrame) -> DataFrame:
    """One row of headline numbers; zeros on empty input."""
    sums = _by_order(sales, []).agg(
        F.count("sales_order_key").alias("total_orders"),
        F.coalesce(F.sum("net"), F.lit(0)).cast("decimal(28,2)").alias("net_revenue"),
        F.coalesce(F.sum("margin"), F.lit(0)).cast("decimal(28,2)").alias("gross_margin"),
        F.coalesce(F.sum("units"), F.lit(0)).cast("decimal(28,3)").alias("units_sold"),
        F.coalesce(F.sum("line_count"), F.lit(0)).cast("decimal(20,0)").alias("line_count"),
    )
    zero = F.lit(0)
    return sums.select(
        "total_orders",
        "net_revenue",
        "gross_margin",
        F.coalesce(exact_ratio("gross_margin", "net_revenue", 4), zero).alias("gross_margin_rate"),
        F.coalesce(exact_ratio("net_revenue", "line_count", 6), zero).alias("avg_order_line_value"),
        "units_sold",
    )


def mart_daily_sales(sales: DataFrame) -> DataFrame:
    return _sales_totals(_by_order(sales, ["date_key"]), ["date_key"]).select(
        "date_key", "orders", "net_revenue", "units_sold", "gross_margin"
    )


def mart_sales_by_channel(sales: DataFrame, channels: DataFrame) -> DataFrame:
    totals = _sales_totals(_by_order(sales, ["channel_key"]), ["channel_key"])
    names = channels.select("channel_key", "channel_code", "channel_name", "channel_type")
    return totals.join(names, "channel_key").select(
        "channel_code", "channel_name", "channel_type", "orders", "net_revenue", "units_sold", "gross_margin"
    )


def mart_top_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Totals per product. The aggregate comes first, so the join sees one row per product."""
    totals = sales.groupBy("product_key").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("net_amount").alias("net_revenue"),
        F.sum("gross_margin_amount").alias("gross_margin"),
    )
    names = products.select("product_key", "sku", "product_name", "category_name")
    return totals.join(names, "product_key").select(
        "sku", "product_name", "category_name", "units_sold", "net_revenue", "gross_margin"
    )


def mart_inventory_alerts(stock: DataFrame, warehouses: DataFrame, products: DataFrame) -> DataFrame:
    """Stock health per warehouse and product; healthy rows stay, unknown shelf life is normal."""
    places = warehouses.select("warehouse_key", "warehouse_code", "warehouse_name")
    items = products.select("product_key", "sku", "product_name", "shelf_life_days")
    short = F.when(F.col("shelf_life_days") <= 180, "SHORT_SHELF_LIFE").otherwise("NORMAL")
    return stock.join(places, "warehouse_key").join(items, "product_key").select(
        "warehouse_code", "warehouse_name", "sku", "product_name", "available_qty", "reorder_point",
        "avg_daily_sales_14d", "days_of_inventory", "stock_status", short.alias("shelf_life_status"),
    )


def _mean(sum_col: str, count_col: str, scale: int) -> Column:
    return exact_ratio(f"cast({sum_col} as decimal(20,0))", f"cast({count_col} as decimal(20,0))", scale)


def mart_logistics_performance(shipments: DataFrame, carriers: DataFrame) -> DataFrame:
    """Per carrier; lead means skip open shipments, the on-time rate counts them as late."""
    sums = shipments.groupBy("carrier_key").agg(
        F.count("*").alias("shipments"),
        F.sum("fulfillment_lead_days").alias("ship_days"),
        F.count("fulfillment_lead_days").alias("ship_count"),
        F.sum("delivery_lead_days").alias("delivery_days"),
        F.count("delivery_lead_days").alias("delivery_count"),
        F.count_if("is_on_time_delivery").alias("on_time"),
        F.sum("shipping_fee").alias("shipping_fee"),
    )
    names = carriers.select("carrier_key", "carrier_code", "carrier_name", "service_level")
    return sums.join(names, "carrier_key").select(
        "carrier_code", "carrier_name", "service_level", "shipments",
        _mean("ship_days", "ship_count", 2).alias("avg_fulfillment_lead_days"),
        _mean("delivery_days", "delivery_count", 2).alias("avg_delivery_lead_days"),
        _mean("on_time", "shipments", 4).alias("on_time_delivery_rate"),
        "shipping_fee",
    )


def mart_customer_rfm(sales: DataFrame, customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Recency, frequency and value of every customer with a sale."""
    today = F.current_date() if as_of is None else as_of
    per_order = sales.groupBy("customer_key", "sales_order_key").agg(
        F.max("date_key").alias("day"), F.sum("net_amount").alias("net")
    )
    per_customer = per_order.groupBy("customer_key").agg(
        F.max("day").alias("last_order_date"),
        F.count("sales_order_key").alias("frequency_orders"),
        F.sum("net").alias("monetary_value"),
    )
    recency = F.datediff(today, F.col("last_order_date"))
    status = F.when(recency > 45, "AT_RISK").when(F.col("frequency_orders") >= 5, "LOYAL").otherwise("ACTIVE")
    names = customers.select("customer_key", "customer_code", "customer_name", "segment_name")
    return per_customer.join(names, "customer_key").select(
        "customer_code", "customer_name", "segment_name", "last_order_date",
        recency.alias("recency_days"), "frequency_orders", "monetary_value", status.alias("customer_status"),
    )
