"""Order taking: validation, prices, promotions, discounts, totals, status, returns.

Every rule works on whole tables. A row that breaks a rule keeps its place with
the first broken rule in `reject_reason`; nothing raises.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions import MONEY, QUANTITY, exact_ratio, neighbour_values, round_money
from tradewind.operators.greedy import accept_in_order
from tradewind.session import cut_lineage
from tradewind.sources.tables import update_from

# fixed values: price factor per channel code, and the factor of any other channel
PRICE_FACTORS = {"B2B": "0.90", "MKT": "0.97", "WEB": "1.00", "SOCIAL": "0.98"}
OTHER_PRICE_FACTOR = "1.02"

# fixed values: legal status changes
LEGAL_TRANSITIONS = [
    ("draft", "confirmed"),
    ("confirmed", "fulfilled"),
    ("confirmed", "invoiced"),
    ("fulfilled", "invoiced"),
    ("invoiced", "paid"),
]


def first_failure(*tests: tuple[Column, str]) -> Column:
    """Name of the first test that holds, else NULL."""
    out = None
    for broken, reason in tests:
        out = F.when(broken, reason) if out is None else out.when(broken, reason)
    return out


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows)."""
    return rows.where("reject_reason IS NULL").drop("reject_reason"), rows.where("reject_reason IS NOT NULL")


def _active(df: DataFrame, key: str, *more: str) -> DataFrame:
    return df.where("is_active").select(key, *more, F.lit(True).alias(f"__{key}"))


def validate_orders(requests: DataFrame, customers: DataFrame, channels: DataFrame, branches: DataFrame) -> DataFrame:
    """Requests with the company of their branch; branch, customer and channel must be active."""
    joined = (
        requests.join(_active(branches, "branch_id", "company_id"), "branch_id", "left")
        .join(_active(customers, "customer_id"), "customer_id", "left")
        .join(_active(channels, "channel_id"), "channel_id", "left")
    )
    reason = first_failure(
        (F.col("__branch_id").isNull(), "invalid_branch"),
        (F.col("__customer_id").isNull(), "invalid_customer"),
        (F.col("__channel_id").isNull(), "invalid_channel"),
    )
    return joined.select(*requests.columns, "company_id", reason.alias("reject_reason"))


# fixed values: widths in days of the buckets that price ranges are cut at; the last one is longer than any range
BUCKET_DAYS = [8**k for k in range(9)]


def cut_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges from `valid_from` to `valid_to` with `__width` and `__bucket`: one row per bucket touched, at most two.

    The width is the smallest of `BUCKET_DAYS` that is not shorter than the range. Ranges without a day are left out.
    """
    length, width = F.datediff("valid_to", "valid_from") + 1, F.lit(BUCKET_DAYS[-1])
    for days in reversed(BUCKET_DAYS[:-1]):
        width = F.when(length <= days, days).otherwise(width)
    wide = ranges.where("valid_from <= valid_to").withColumn("__width", width)
    return wide.withColumn("__bucket", F.explode(F.sequence(_bucket("valid_from"), _bucket("valid_to"))))


def _bucket(day: str) -> Column:
    return F.floor(F.unix_date(day) / F.col("__width"))


def listed_prices(days: DataFrame, price_lists: DataFrame) -> DataFrame:
    """`listed_price` of each distinct (product, channel, order date) of `days` that has a valid price.

    Ranges are cut at buckets of about their own length and joined on (product, channel, width,
    bucket), each day once per width in use. So a long range is not repeated, and neither a product
    with very many ranges nor one with very many days is gathered in one place. The range that
    starts last wins, the highest id among equals.
    """
    key = ["product_id", "channel_id"]
    asked = days.select(*key, "order_date").where("order_date IS NOT NULL").distinct()
    active = price_lists.where("is_active").select(*key, "valid_from", "valid_to", "price_list_id", F.col("unit_price").alias("__price"))
    entries = cut_ranges(active)
    widths = entries.agg(F.collect_set("__width")).scalar()
    looked_up = asked.withColumn("__width", F.explode(widths)).withColumn("__bucket", _bucket("order_date"))
    found = looked_up.join(entries, [*key, "__width", "__bucket"])
    return (
        found.where(F.col("order_date").between(F.col("valid_from"), F.col("valid_to")))
        .groupBy(*key, "order_date").agg(F.max_by("__price", F.struct("valid_from", "price_list_id")).alias("listed_price"))
    )


def resolve_price(lines: DataFrame, price_lists: DataFrame) -> DataFrame:
    """Add `resolved_price` to lines with product, channel, order date, `unit_price` and `list_price`.

    A given price wins; then the valid price-list entry that starts last (the
    highest id among equals); then the list price. A line is never multiplied.
    """
    listed = listed_prices(lines, price_lists)
    joined = lines.join(listed, ["product_id", "channel_id", "order_date"], "left")
    price = F.coalesce(F.col("unit_price"), F.col("listed_price"), F.col("list_price")).cast(MONEY)
    return joined.select(*lines.columns, price.alias("resolved_price"))


def check_promotion(lines: DataFrame, promotions: DataFrame) -> DataFrame:
    """Add the promotion's terms and `promotion_valid` (NULL without a promotion).

    The promotion must be active, belong to the order's channel and cover its date.
    """
    terms = promotions.select(
        "promotion_id",
        F.col("channel_id").alias("__channel"), "start_date", "end_date", "discount_type", "discount_value",
        F.col("is_active").alias("__active"),
    )
    valid = F.coalesce(
        F.col("__active")
        & (F.col("__channel") == F.col("channel_id"))
        & F.col("order_date").between(F.col("start_date"), F.col("end_date")),
        F.lit(False),
    )
    return lines.join(terms, "promotion_id", "left").select(
        *lines.columns,
        "discount_type", "discount_value",
        F.when(F.col("promotion_id").isNotNull(), valid).alias("promotion_valid"),
    )


def promotion_discount(gross: Column, manual: Column, kind: Column, value: Column) -> Column:
    """A given non-zero discount wins; else percent of gross, or the fixed amount capped at gross."""
    percent = F.round(gross * value / 100, 2)
    by_terms = F.when(kind == "percent", percent).when(kind.isNotNull(), F.least(gross, value))
    return F.when((manual != 0) | kind.isNull(), manual).otherwise(by_terms)


def price_lines(
    requests: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    price_lists: DataFrame,
    promotions: DataFrame,
    open_status: Sequence[str] = ("draft",),
) -> DataFrame:
    """Order lines from requests: price, promotion, discount and amounts at two decimals.

    requests: order_line_id, order_id, product_id, warehouse_id, quantity,
    unit_price (NULL: look it up), discount_amount, promotion_id (may be NULL).
    """
    heads = orders.select("order_id", "channel_id", "order_date", F.col("order_status").alias("__status"))
    items = products.where("is_active").select("product_id", "list_price", "standard_cost")
    priced = check_promotion(
        resolve_price(
            # products first: lines often lie by product already, and then do not move for it
            requests.join(items, "product_id", "left").join(heads, "order_id", "left"), price_lists
        ),
        promotions,
    )
    gross = F.col("quantity") * F.col("resolved_price")
    amounts = priced.withColumn("__gross", gross).withColumn(
        "__discount",
        promotion_discount(F.col("__gross"), F.col("discount_amount"), F.col("discount_type"), F.col("discount_value")),
    )
    reason = first_failure(
        (F.col("quantity") <= 0, "quantity_not_positive"),
        (F.col("__status").isNull(), "unknown_order"),
        (~F.col("__status").isin(*open_status), "order_not_open"),
        (F.col("list_price").isNull(), "invalid_product"),
        (F.col("resolved_price") < 0, "negative_price"),
        (~F.col("promotion_valid"), "invalid_promotion"),
        ((F.col("__discount") < 0) | (F.col("__discount") > F.col("__gross")), "invalid_discount"),
    )
    return amounts.select(
        "order_line_id", "order_id", "product_id", "warehouse_id", "promotion_id", "quantity",
        F.col("resolved_price").alias("unit_price"),
        round_money("__discount").alias("discount_amount"),
        round_money("__gross").alias("gross_amount"),
        round_money(F.col("__gross") - F.col("__discount")).alias("net_amount"),
        round_money(F.col("quantity") * F.col("standard_cost")).alias("estimated_cost"),
        reason.alias("reject_reason"),
    )


def order_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers with the amounts of their lines; a header without lines keeps what it had (0 if none)."""
    amounts = ("gross_amount", "discount_amount", "net_amount")
    for name in amounts:
        if name not in orders.columns:
            orders = orders.withColumn(name, F.lit(0).cast(MONEY))
    sums = lines.groupBy("order_id").agg(*[F.sum(a).cast(MONEY).alias(a) for a in amounts])
    return update_from(orders, sums, ["order_id"])


def status_from_evidence(
    orders: DataFrame, moves: DataFrame, shipments: DataFrame, invoices: DataFrame
) -> DataFrame:
    """Order status re-derived from what exists for the order.

    Paid invoice, any invoice, shipment, reservation, nothing: paid, invoiced,
    fulfilled, confirmed, draft. A cancelled order stays cancelled.
    """
    reserved = (
        moves.where("move_type = 'sale_reservation'").groupBy("reference_number").agg(F.lit(True).alias("__reserved"))
    )
    sent = shipments.groupBy("order_id").agg(F.lit(True).alias("__sent"))
    billed = invoices.groupBy("order_id").agg(F.bool_or(F.col("invoice_status") == "paid").alias("__paid"))
    derived = (
        F.when(F.col("order_status") == "cancelled", "cancelled")
        .when(F.col("__paid"), "paid")
        .when(F.col("__paid").isNotNull(), "invoiced")
        .when(F.col("__sent"), "fulfilled")
        .when(F.col("__reserved"), "confirmed")
        .otherwise("draft")
    )
    return (
        orders.select("order_id", "order_number", "order_status")
        .join(reserved.withColumnRenamed("reference_number", "order_number"), "order_number", "left")
        .join(sent, "order_id", "left")
        .join(billed, "order_id", "left")
        .select("order_id", "order_status", derived.alias("derived_status"))
    )


def illegal_transitions(status_log: DataFrame) -> DataFrame:
    """Rows of a status log (order_id, changed_on, sequence, status) that no legal change leads to.

    The first row of an order must be a draft.
    """
    seen = neighbour_values(status_log, ["order_id"], ["changed_on"], ["sequence"], ["status"])
    before, now = F.col("previous_status"), F.col("status")
    legal = before.isNull() & (now == "draft")
    for source, target in LEGAL_TRANSITIONS:
        legal = legal | ((before == source) & (now == target))
    return seen.where(~F.coalesce(legal, F.lit(False)))


def price_matrix(pairs: DataFrame, products: DataFrame, channels: DataFrame) -> DataFrame:
    """List price times the channel's factor for the given (product, channel) pairs, however many channels there are."""
    code = F.col("channel_code")
    factor = F.lit(OTHER_PRICE_FACTOR)
    for name, value in PRICE_FACTORS.items():
        factor = F.when(code == name, value).otherwise(factor)
    # pairs are more than products and may come from an explode, which the optimizer takes to keep the size of its input: not to be broadcast
    asked = pairs.select("product_id", "channel_id").hint("merge")
    priced = asked.join(products.select("product_id", "list_price"), "product_id")
    return priced.join(channels.select("channel_id", "channel_code"), "channel_id").select(
        "product_id", "channel_id", "channel_code",
        round_money(F.col("list_price") * factor.cast("decimal(4,2)")).alias("unit_price"),
    )


def refund_amount(net: Column, sold: Column, returned: Column) -> Column:
    """Net of the line in proportion to the returned quantity, rounded once."""
    return exact_ratio((net * returned).cast("decimal(31,5)"), sold, 2)


def validate_returns(
    claims: DataFrame, lines: DataFrame, orders: DataFrame, earlier: DataFrame | None = None
) -> DataFrame:
    """Return claims in (date, id) order with refund and reject reason.

    claims: return_id, order_line_id, return_date, return_reason, quantity.
    `earlier` holds stored returns; approved and refunded ones already use up
    the sold quantity. A refused claim uses up nothing.
    """
    sold = lines.select(
        "order_line_id", "order_id", "product_id", "warehouse_id",
        F.col("quantity").alias("sold_quantity"), F.col("net_amount").alias("__net"),
    )
    heads = orders.select("order_id", "customer_id", "order_status", "order_date")
    joined = claims.join(sold, "order_line_id", "left").join(heads, "order_id", "left")
    if earlier is not None:
        used = (
            earlier.where(F.col("return_status").isin("approved", "refunded"))
            .groupBy("order_line_id")
            .agg(F.sum("quantity").alias("__used"))
        )
        joined = joined.join(used, "order_line_id", "left")
    else:
        joined = joined.withColumn("__used", F.lit(0).cast(QUANTITY))
    reason = first_failure(
        (F.col("quantity").isNull(), "missing_quantity"),
        (F.col("quantity") <= 0, "quantity_not_positive"),
        (F.col("sold_quantity").isNull(), "unknown_order_line"),
        (F.col("return_date").isNull(), "missing_date"),
        (~F.coalesce(F.col("order_status").isin("fulfilled", "invoiced", "paid"), F.lit(False)), "order_not_delivered"),
        (F.col("return_date") < F.col("order_date"), "before_order_date"),
    )
    # read once for the refused and three times for the open claims: written, not joined again
    checked = cut_lineage(
        joined.select(
            *claims.columns, "order_id", "product_id", "warehouse_id", "sold_quantity", "__net", "customer_id", "__used",
            reason.alias("__reason"),
        )
    )
    open_ = checked.where("__reason IS NULL")
    settled = accept_in_order(
        open_, ["order_line_id"], ["return_date"], ["return_id"],
        amount=F.col("quantity").cast(QUANTITY),
        limit=(F.col("sold_quantity") - F.coalesce("__used", F.lit(0))).cast(QUANTITY),
    ).withColumn("__reason", F.when(~F.col("accepted"), "exceeds_sold_quantity")).drop("accepted")
    refund = refund_amount(F.col("__net"), F.col("sold_quantity"), F.col("quantity"))
    return checked.where("__reason IS NOT NULL").unionByName(settled).select(
        "return_id", "order_id", "order_line_id", "customer_id", "product_id", "warehouse_id",
        "return_date", "return_reason", "quantity",
        F.when(F.col("__reason").isNull(), refund).alias("refund_amount"),
        F.when(F.col("__reason").isNull(), "approved").otherwise("rejected").alias("return_status"),
        F.col("__reason").alias("reject_reason"),
    )
