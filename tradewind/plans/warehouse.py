"""The star schema and its marts over a set of canonical tables, as one lazy object.

Nothing is computed here; `plans.refresh` writes the tables, and then the marts
read the written fact in place of building it six times.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.operators import dimensions, facts, marts, serving
from tradewind.session import stage_table


# columns of the sales fact that marts read
MART_COLUMNS = [
    "sales_order_key", "date_key", "customer_key", "channel_key", "product_key", "warehouse_key",
    "quantity", "net_amount", "gross_margin_amount",
]


class Warehouse:
    """`tables` offers the canonical tables as attributes."""

    def __init__(self, tables, as_of: Column | None = None):
        self.tables, self.as_of = tables, as_of

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.tables.sales_orders, self.as_of)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(self.tables.customers, self.tables.customer_segments)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.tables.products, self.tables.product_categories)

    @cached_property
    def dim_channel(self) -> DataFrame:
        return dimensions.dim_channel(self.tables.sales_channels)

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        return dimensions.dim_warehouse(self.tables.warehouses, self.tables.branches)

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return dimensions.dim_carrier(self.tables.carriers)

    @cached_property
    def fact_sales_order_lines(self) -> DataFrame:
        t = self.tables
        return facts.fact_sales_order_lines(t.sales_order_lines, t.sales_orders, t.promotions)

    @cached_property
    def fact_inventory_balance(self) -> DataFrame:
        return facts.fact_inventory_balance(self.tables.stock_balances, self.fact_sales_order_lines, self.as_of)

    @cached_property
    def fact_logistics_shipments(self) -> DataFrame:
        return facts.fact_logistics_shipments(self.tables.shipments, self.tables.sales_orders)

    @cached_property
    def fact_payments(self) -> DataFrame:
        return facts.fact_payments(self.tables.payments, self.tables.invoices)

    @cached_property
    def mart_dashboard_kpis(self) -> DataFrame:
        return marts.mart_dashboard_kpis(self.fact_sales_order_lines)

    @cached_property
    def mart_daily_sales(self) -> DataFrame:
        return marts.mart_daily_sales(self.fact_sales_order_lines)

    @cached_property
    def mart_sales_by_channel(self) -> DataFrame:
        return marts.mart_sales_by_channel(self.fact_sales_order_lines, self.dim_channel)

    @cached_property
    def mart_top_products(self) -> DataFrame:
        return marts.mart_top_products(self.fact_sales_order_lines, self.dim_product)

    @cached_property
    def mart_inventory_alerts(self) -> DataFrame:
        return marts.mart_inventory_alerts(self.fact_inventory_balance, self.dim_warehouse, self.dim_product)

    @cached_property
    def mart_logistics_performance(self) -> DataFrame:
        return marts.mart_logistics_performance(self.fact_logistics_shipments, self.dim_carrier)

    @cached_property
    def mart_customer_rfm(self) -> DataFrame:
        return marts.mart_customer_rfm(self.fact_sales_order_lines, self.dim_customer, self.as_of)

    def staged(self) -> Warehouse:
        """The same warehouse over a sales fact that is written once, with the columns that marts read.

        Five marts and the stock fact read it; without this each would join the lines again.
        """
        other = Warehouse(self.tables, self.as_of)
        sales = self.fact_sales_order_lines.select(*MART_COLUMNS)
        other.fact_sales_order_lines = stage_table(sales, "sales-fact")
        return other

    def dashboard(self, run: DataFrame | None = None) -> DataFrame:
        """All dashboard sections as (section, rank, payload) rows."""
        sections = {
            "kpis": (serving.kpis(self.mart_dashboard_kpis), []),
            "daily_sales": (self.mart_daily_sales, [F.col("date_key")]),
            "sales_by_channel": (self.mart_sales_by_channel, [F.desc_nulls_first("net_revenue"), F.col("channel_code")]),
            "top_products": (serving.top_products(self.mart_top_products), [F.desc_nulls_first("net_revenue"), F.col("sku")]),
            "inventory_alerts": (
                serving.inventory_alerts(self.mart_inventory_alerts),
                [serving.severity(), F.col("available_qty"), F.col("warehouse_code"), F.col("sku")],
            ),
            "logistics": (self.mart_logistics_performance, [F.desc("shipments"), F.col("carrier_code")]),
            "customers": (serving.customers(self.mart_customer_rfm), [F.desc_nulls_first("monetary_value"), F.col("customer_code")]),
        }
        if run is not None:
            sections = {"pipeline": (run, []), **sections}
        return serving.dashboard_payload(sections)


# what a full refresh writes: the tables of one wave need only those of earlier waves
WAVES = [
    ["dim_date", "dim_customer", "dim_product", "dim_channel", "dim_warehouse", "dim_carrier",
     "fact_sales_order_lines", "fact_logistics_shipments", "fact_payments"],
    ["fact_inventory_balance", "mart_dashboard_kpis", "mart_daily_sales", "mart_sales_by_channel",
     "mart_top_products", "mart_logistics_performance", "mart_customer_rfm"],
    ["mart_inventory_alerts"],
]
MODELS = [name for wave in WAVES for name in wave]
