"""Dimension tables. Joins carry no hint: the optimizer broadcasts a side whose known size allows it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.sources.tables import date_series


def dim_date(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Calendar from the first order to the later of the last order and `as_of` (default: today)."""
    today = F.current_date() if as_of is None else as_of
    bounds = orders.agg(
        F.min("order_date").alias("first"), F.greatest(F.max("order_date"), today).alias("last")
    )
    day = F.col("date_key")
    weekday = F.extract(F.lit("DAYOFWEEK_ISO"), day)
    return date_series(bounds, "first", "last").select(
        "date_key",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("iso_day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )


def dim_customer(customers: DataFrame, segments: DataFrame) -> DataFrame:
    names = segments.select("segment_id", "segment_code", "segment_name")
    return customers.join(names, "segment_id", "left").select(
        F.col("customer_id").alias("customer_key"),
        "customer_code", "customer_name", "customer_type", "city", "region",
        "segment_code", "segment_name", "is_active",
    )


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    own = categories.select("category_id", "parent_category_id", "category_code", "category_name")
    parent = categories.select(
        F.col("category_id").alias("parent_category_id"),
        F.col("category_code").alias("parent_category_code"),
        F.col("category_name").alias("parent_category_name"),
    )
    return products.join(own.join(parent, "parent_category_id", "left"), "category_id", "left").select(
        F.col("product_id").alias("product_key"),
        "sku", "product_name", "brand", "unit_of_measure", "standard_cost", "list_price", "shelf_life_days",
        "category_code", "category_name", "parent_category_code", "parent_category_name", "is_active",
    )


def dim_channel(channels: DataFrame) -> DataFrame:
    return channels.select(
        F.col("channel_id").alias("channel_key"), "channel_code", "channel_name", "channel_type", "is_active"
    )


def dim_warehouse(warehouses: DataFrame, branches: DataFrame) -> DataFrame:
    branch = branches.select("branch_id", "branch_code", "branch_name", "region")
    return warehouses.join(branch, "branch_id", "left").select(
        F.col("warehouse_id").alias("warehouse_key"),
        "warehouse_code", "warehouse_name", "city", "branch_code", "branch_name", "region",
    )


def dim_carrier(carriers: DataFrame) -> DataFrame:
    return carriers.select(
        F.col("carrier_id").alias("carrier_key"), "carrier_code", "carrier_name", "service_level", "is_active"
    )
