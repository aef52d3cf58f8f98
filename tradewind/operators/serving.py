"""Read side of the dashboard: ordered, limited views over the marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tradewind.functions import exact_ratio

def severity() -> Column:
    status = F.col("stock_status")
    return F.when(status == "OUT_OF_STOCK", 1).when(status == "REORDER", 2).otherwise(3)


def kpis(mart: DataFrame) -> DataFrame:
    return mart.limit(1)


def daily_sales(mart: DataFrame) -> DataFrame:
    return mart.orderBy("date_key")


def sales_by_channel(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc_nulls_first("net_revenue"), "channel_code")


def top_products(mart: DataFrame, limit: int = 8) -> DataFrame:
    return mart.orderBy(F.desc_nulls_first("net_revenue"), "sku").limit(limit)


def inventory_alerts(mart: DataFrame, limit: int = 10) -> DataFrame:
    """Most urgent stock first."""
    order = [severity(), F.asc_nulls_last("available_qty"), F.col("warehouse_code"), F.col("sku")]
    return mart.orderBy(*order).limit(limit).drop("warehouse_name")


def logistics(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc("shipments"), "carrier_code")


def customers(mart: DataFrame, limit: int = 8) -> DataFrame:
    return mart.orderBy(F.desc_nulls_first("monetary_value"), "customer_code").limit(limit)


def channel_share(mart: DataFrame) -> DataFrame:
    """Share of revenue per channel in percent, two digits. A mart row exists per channel, so the window is tiny."""
    whole = F.sum("net_revenue").over(Window.partitionBy())
    share = exact_ratio(F.col("net_revenue").cast("decimal(24,2)") * 100, whole.cast("decimal(26,2)"), 2)
    return mart.select("channel_code", "channel_name", "net_revenue", share.alias("revenue_share_pct"))


def json_ready(df: DataFrame) -> DataFrame:
    """Decimals as numbers and dates as ISO text, for the response only."""

    def convert(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(field.name)
        return c

    return df.select(*[convert(f) for f in df.schema.fields])


def dashboard_payload(sections: Mapping[str, tuple[DataFrame, list[Column]]]) -> DataFrame:
    """All sections as (section, rank, payload) rows.

    Each section comes with its order. Sections are limited or hold one row per
    day, channel or carrier, so ranking inside a section stays small.
    """
    parts = []
    for name, (df, order) in sections.items():
        position = F.row_number().over(Window.orderBy(*order)) if order else F.lit(1)
        ranked = df.withColumn("__rank", position)
        body = json_ready(ranked.drop("__rank"))
        ready = json_ready(ranked)
        payload = F.to_json(F.struct(*[F.col(c) for c in body.columns]), {"ignoreNullFields": "false"})
        parts.append(ready.select(F.lit(name).alias("section"), F.col("__rank").alias("rank"), payload.alias("payload")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
