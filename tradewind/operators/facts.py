"""Fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions import exact_ratio


def fact_sales_order_lines(lines: DataFrame, orders: DataFrame, promotions: DataFrame) -> DataFrame:
    """Order lines with header context, promotion code and margin; every order status is kept."""
    heads = orders.select("order_id", "order_number", "order_date", "order_status", "customer_id", "channel_id", "branch_id")
    codes = promotions.select("promotion_id", "promotion_code")
    margin = F.col("net_amount") - F.col("estimated_cost")
    rate = F.coalesce(exact_ratio("net_amount - estimated_cost", "net_amount", 4), F.lit(0))
    return (
        lines.join(heads, "order_id")
        .join(codes, "promotion_id", "left")
        .select(
            F.col("order_line_id").alias("sales_order_line_key"),
            F.col("order_id").alias("sales_order_key"),
            "order_number",
            F.col("order_date").alias("date_key"),
            "order_status",
            F.col("customer_id").alias("customer_key"),
            F.col("channel_id").alias("channel_key"),
            "branch_id",
            F.col("product_id").alias("product_key"),
            F.col("warehouse_id").alias("warehouse_key"),
            "promotion_id", "promotion_code", "quantity", "unit_price", "gross_amount", "discount_amount",
            "net_amount", "estimated_cost",
            margin.alias("gross_margin_amount"),
            rate.alias("gross_margin_rate"),
        )
    )


def fact_inventory_balance(
    balances: DataFrame, sales: DataFrame, as_of: Column | None = None, last_sale: DataFrame | None = None
) -> DataFrame:
    """Stock per (warehouse, product) against its sales of the 14 days that end at the last sale.

    `last_sale`, a one-row table with `max_date`, spares the search for that day in `sales`.
    """
    newest = sales.agg(F.max("date_key").alias("max_date")) if last_sale is None else last_sale
    # the scalar subquery is folded into a filter on the scan of the order dates
    window_start = F.date_sub(newest.select("max_date").scalar(), 13)
    sold = (
        sales.where(F.col("date_key") >= window_start)
        .groupBy("product_key", "warehouse_key")
        .agg(F.sum("quantity").alias("sold"))
    )
    available = F.col("on_hand_qty") - F.col("reserved_qty")
    quantity = F.coalesce(F.col("sold"), F.lit(0))
    status = (
        F.when(available <= 0, "OUT_OF_STOCK")
        .when(available <= F.col("reorder_point"), "REORDER")
        .otherwise("HEALTHY")
    )
    stock = balances.select(
        F.col("warehouse_id").alias("warehouse_key"),
        F.col("product_id").alias("product_key"),
        "on_hand_qty", "reserved_qty", "reorder_point",
    )
    return stock.join(sold, ["product_key", "warehouse_key"], "left").select(
        "warehouse_key", "product_key",
        (F.current_date() if as_of is None else as_of).alias("snapshot_date"),
        "on_hand_qty", "reserved_qty",
        available.alias("available_qty"),
        "reorder_point",
        status.alias("stock_status"),
        quantity.alias("quantity_sold_14d"),
        exact_ratio("coalesce(sold, 0)", "14BD", 3).alias("avg_daily_sales_14d"),
        # available / (sold / 14), with the one division last
        exact_ratio("(on_hand_qty - reserved_qty) * 14", "coalesce(sold, 0)", 2).alias("days_of_inventory"),
    )


def fact_logistics_shipments(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """Shipments with lead days; an undelivered one is not on time."""
    heads = orders.select("order_id", "order_number", "order_date")
    on_time = F.coalesce(F.col("actual_delivery_date") <= F.col("planned_delivery_date"), F.lit(False))
    return shipments.join(heads, "order_id").select(
        F.col("shipment_id").alias("shipment_key"),
        F.col("order_id").alias("sales_order_key"),
        "order_number", "order_date",
        F.col("warehouse_id").alias("warehouse_key"),
        F.col("carrier_id").alias("carrier_key"),
        "planned_ship_date", "actual_ship_date", "planned_delivery_date", "actual_delivery_date",
        "shipment_status", "shipping_fee",
        F.datediff("actual_ship_date", "order_date").alias("fulfillment_lead_days"),
        F.datediff("actual_delivery_date", "order_date").alias("delivery_lead_days"),
        on_time.alias("is_on_time_delivery"),
    )


def fact_payments(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Every payment, reversed ones too, with the order of its invoice."""
    bills = invoices.select("invoice_id", "order_id")
    return payments.join(bills, "invoice_id").select(
        F.col("payment_id").alias("payment_key"),
        F.col("invoice_id").alias("invoice_key"),
        F.col("order_id").alias("sales_order_key"),
        F.col("customer_id").alias("customer_key"),
        F.col("payment_date").alias("date_key"),
        "payment_method", "payment_status", "amount_paid",
    )
