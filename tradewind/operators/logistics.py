"""Shipments and delivery attempts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions import MONEY, occurrence_number
from tradewind.operators.commerce import first_failure

# fixed values: fee per service level, any other level, and days from order to planned delivery
SHIPPING_FEES = {"same_day": 45000, "express": 35000, "b2b_freight": 120000}
OTHER_FEE = 25000
PLANNED_DAYS = {"same_day": 1, "express": 2}
OTHER_PLANNED_DAYS = 3

# fixed values: attempt outcomes
ATTEMPT_STATUS = ("delivered", "failed", "rescheduled", "returned")


def _by_level(values: dict[str, int], other: int) -> Column:
    level, out = F.col("service_level"), F.lit(other)
    for name, value in values.items():
        out = F.when(level == name, value).otherwise(out)
    return out


def shipping_fee() -> Column:
    return _by_level(SHIPPING_FEES, OTHER_FEE).cast(MONEY)


def derive_shipments(
    orders: DataFrame,
    lines: DataFrame,
    carriers: DataFrame,
    requests: DataFrame,
    sendable: Sequence[str] = ("confirmed",),
    keep: Sequence[str] = (),
) -> DataFrame:
    """One shipment per order, from the smallest warehouse among its lines.

    requests: order_id, fulfillment_date, carrier_id.
    """
    origin = lines.groupBy("order_id").agg(F.min("warehouse_id").alias("warehouse_id"))
    heads = orders.select("order_id", "order_date", "order_status")
    levels = carriers.where("is_active").select("carrier_id", "service_level")
    transit = F.when(F.col("service_level") == "same_day", 0).otherwise(1)
    reason = first_failure(
        (F.col("order_status").isNull(), "unknown_order"),
        (~F.col("order_status").isin(*sendable), "order_not_confirmed"),
        (F.col("service_level").isNull(), "invalid_carrier"),
        (F.col("warehouse_id").isNull(), "no_order_lines"),
    )
    return (
        requests.join(heads, "order_id", "left")
        .join(origin, "order_id", "left")
        .join(levels, "carrier_id", "left")
        .select(
            "order_id", "warehouse_id", "carrier_id", *keep,
            F.date_add("order_date", 1).alias("planned_ship_date"),
            F.col("fulfillment_date").alias("actual_ship_date"),
            F.date_add("order_date", _by_level(PLANNED_DAYS, OTHER_PLANNED_DAYS)).alias("planned_delivery_date"),
            F.date_add("fulfillment_date", transit).alias("actual_delivery_date"),
            F.lit("delivered").alias("shipment_status"),
            shipping_fee().alias("shipping_fee"),
            reason.alias("reject_reason"),
        )
    )


def validate_attempts(attempts: DataFrame, shipments: DataFrame) -> DataFrame:
    """Attempts with the first rule they break."""
    planned = shipments.select("shipment_id", "planned_ship_date")
    reason = first_failure(
        (F.col("planned_ship_date").isNull(), "unknown_shipment"),
        (F.col("attempt_date") < F.col("planned_ship_date"), "before_planned_ship_date"),
        (~F.col("attempt_status").isin(*ATTEMPT_STATUS), "invalid_status"),
        (F.col("cod_amount") < 0, "negative_cod"),
    )
    return attempts.join(planned, "shipment_id", "left").select(*attempts.columns, reason.alias("reject_reason"))


def number_attempts(accepted: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Attempt number per shipment in the order of recording (the attempt id, not the date).

    Numbers go on after those of the `stored` attempts of a shipment.
    """
    numbered = occurrence_number(accepted, ["shipment_id"], [], ["delivery_attempt_id"], "attempt_number")
    if stored is None:
        return numbered
    last = stored.groupBy("shipment_id").agg(F.max("attempt_number").alias("__last"))
    number = F.col("attempt_number") + F.coalesce("__last", F.lit(0))
    return numbered.join(last, "shipment_id", "left").select(*accepted.columns, number.alias("attempt_number"))


def first_attempts(shipments: DataFrame) -> DataFrame:
    """The attempt that comes with each sent shipment: number 1, delivered, nothing collected."""
    sent = shipments.where("reject_reason IS NULL") if "reject_reason" in shipments.columns else shipments
    return sent.select(
        "shipment_id",
        F.lit(1).cast("bigint").alias("attempt_number"),
        F.col("actual_delivery_date").alias("attempt_date"),
        F.lit("delivered").alias("attempt_status"),
        F.lit(None).cast("string").alias("failure_reason"),
        F.lit(0).cast(MONEY).alias("cod_amount"),
    )


def fold_attempts(shipments: DataFrame, accepted: DataFrame) -> DataFrame:
    """Shipments after their attempts: status of the last recorded one, date of the last delivered one."""
    last = accepted.groupBy("shipment_id").agg(
        F.max_by("attempt_status", "delivery_attempt_id").alias("__status"),
        F.max_by(
            "attempt_date", F.when(F.col("attempt_status") == "delivered", F.col("delivery_attempt_id"))
        ).alias("__delivered"),
        F.count("*").alias("__attempts"),
    )
    status = F.when(F.col("__status") == "rescheduled", "in_transit").otherwise(
        F.coalesce("__status", "shipment_status")
    )
    changed = {
        "shipment_status": status,
        "actual_delivery_date": F.coalesce("__delivered", "actual_delivery_date"),
    }
    return shipments.join(last, "shipment_id", "left").select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in shipments.columns],
        F.coalesce("__attempts", F.lit(0)).alias("attempts"),
    )
