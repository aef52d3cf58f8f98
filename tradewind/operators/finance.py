"""Invoices and payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions import MONEY, round_money
from tradewind.operators.commerce import first_failure
from tradewind.operators.greedy import accept_in_order
from tradewind.session import cut_lineage

# fixed values: defaults
TAX_RATE = "0.08"
DUE_DAYS = 15


def tax_amount(net: Column, rate: str = TAX_RATE) -> Column:
    return round_money(net * F.lit(rate).cast("decimal(6,4)"))


def derive_invoices(
    requests: DataFrame, orders: DataFrame, existing: DataFrame, rate: str = TAX_RATE
) -> DataFrame:
    """One invoice per confirmed or fulfilled order.

    requests: order_id, invoice_date, due_days. `orders` carries the header totals.
    """
    heads = orders.select(
        "order_id", "customer_id", "order_date", "order_status", "gross_amount", "discount_amount",
        F.col("net_amount").alias("__net"),
    )
    billed = existing.select("order_id").distinct().withColumn("__billed", F.lit(True))
    tax = tax_amount(F.col("__net"), rate)
    reason = first_failure(
        (F.col("order_status").isNull(), "unknown_order"),
        (~F.col("order_status").isin("confirmed", "fulfilled"), "order_not_billable"),
        (F.col("__billed").isNotNull(), "already_invoiced"),
        (F.col("invoice_date") < F.col("order_date"), "before_order_date"),
    )
    return requests.join(heads, "order_id", "left").join(billed, "order_id", "left").select(
        "order_id", "customer_id", "invoice_date",
        F.date_add("invoice_date", F.col("due_days")).alias("due_date"),
        F.lit("open").alias("invoice_status"),
        "gross_amount",
        tax.alias("tax_amount"),
        "discount_amount",
        (F.col("__net") + tax).cast(MONEY).alias("net_amount"),
        F.lit(0).cast(MONEY).alias("amount_paid"),
        reason.alias("reject_reason"),
    )


def derive_invoice_lines(invoices: DataFrame, lines: DataFrame, rate: str = TAX_RATE) -> DataFrame:
    """Lines of the invoiced orders with tax per line."""
    bills = invoices.select("order_id")
    tax = tax_amount(F.col("net_amount"), rate)
    return lines.join(bills, "order_id", "left_semi").select(
        "order_id", "order_line_id", "product_id", "quantity", "unit_price", "gross_amount",
        tax.alias("tax_amount"),
        (F.col("net_amount") + tax).cast(MONEY).alias("net_amount"),
    )


def invoice_reconcile(invoices: DataFrame, invoice_lines: DataFrame) -> DataFrame:
    """Header tax, rounded once, against the sum of the line taxes."""
    sums = invoice_lines.groupBy("order_id").agg(F.sum("tax_amount").alias("line_tax"))
    heads = invoices.select("order_id", F.col("tax_amount").alias("header_tax"))
    line_tax = F.coalesce("line_tax", F.lit(0))
    return heads.join(sums, "order_id", "left").select(
        "order_id", "header_tax", line_tax.alias("line_tax"), (F.col("header_tax") - line_tax).alias("difference")
    )


def settle_payments(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Payments in (date, id) order with reject reason; a refused payment settles nothing.

    payments: payment_id, invoice_id, payment_date, payment_method, amount_paid.
    """
    bills = invoices.select(
        "invoice_id", "order_id", "customer_id", "invoice_date",
        (F.col("net_amount") - F.col("amount_paid")).cast(MONEY).alias("outstanding"),
    )
    asked = payments.select("payment_id", "invoice_id", "payment_date", "payment_method", "amount_paid")
    reason = first_failure(
        (F.col("amount_paid").isNull(), "missing_amount"),
        (F.col("amount_paid") <= 0, "amount_not_positive"),
        (F.col("outstanding").isNull(), "unknown_invoice"),
        (F.col("payment_date").isNull(), "missing_date"),
        (F.col("payment_date") < F.col("invoice_date"), "before_invoice_date"),
    )
    # read once for the refused and three times for the open payments: written, not joined again
    checked = cut_lineage(asked.join(bills, "invoice_id", "left").withColumn("reject_reason", reason))
    settled = accept_in_order(
        checked.where("reject_reason IS NULL"), ["invoice_id"], ["payment_date"], ["payment_id"],
        amount=F.col("amount_paid"), limit=F.col("outstanding"),
    ).withColumn("reject_reason", F.when(~F.col("accepted"), "exceeds_outstanding")).drop("accepted")
    return checked.where("reject_reason IS NOT NULL").unionByName(settled).select(
        "payment_id", "invoice_id", "order_id", "customer_id", "payment_date", "payment_method", "amount_paid", "reject_reason"
    )


def invoice_status(invoices: DataFrame, settled: DataFrame) -> DataFrame:
    """Invoices with the accepted payments booked; an order is paid on exact settlement."""
    booked = (
        settled.where("reject_reason IS NULL").groupBy("invoice_id").agg(F.sum("amount_paid").alias("__booked"))
    )
    paid = (F.col("amount_paid") + F.coalesce("__booked", F.lit(0))).cast(MONEY)
    status = F.when(paid == F.col("net_amount"), "paid").when(paid > 0, "partial").otherwise("open")
    return invoices.join(booked, "invoice_id", "left").select(
        "invoice_id", "order_id", "net_amount", paid.alias("amount_paid"),
        # without an accepted payment nothing is written, so the status stays
        F.when(F.col("__booked").isNull(), F.col("invoice_status")).otherwise(status).alias("invoice_status"),
        F.coalesce(F.col("__booked").isNotNull() & (paid == F.col("net_amount")), F.lit(False)).alias("order_is_paid"),
    )
