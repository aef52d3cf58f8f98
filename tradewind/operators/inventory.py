"""Stock: availability, replenishment, reservation, ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions import QUANTITY, round_money, totals_before, totals_by_key
from tradewind.operators.commerce import first_failure
from tradewind.operators.greedy import accept_groups_in_order
from tradewind.sources.tables import deal, insert_if_absent

STOCK_KEY = ["warehouse_id", "product_id"]


def available_qty(balances: DataFrame, keys: DataFrame) -> DataFrame:
    """On-hand less reserved for the asked keys; NULL for a key without balance."""
    free = balances.select(*STOCK_KEY, (F.col("on_hand_qty") - F.col("reserved_qty")).alias("available_qty"))
    return keys.join(free, STOCK_KEY, "left")


def ensure_balances(balances: DataFrame, keys: DataFrame, tasks: int | None = None) -> DataFrame:
    """Balances with a zero row for every asked key that had none; with `tasks`, keys are dealt over that many tasks."""
    zero = F.lit(0).cast(QUANTITY)
    blank = keys.select(
        *STOCK_KEY, zero.alias("on_hand_qty"), zero.alias("reserved_qty"), zero.alias("reorder_point")
    )
    return insert_if_absent(balances.select(*blank.columns), blank, STOCK_KEY, tasks)


def replenish(
    balances: DataFrame, products: DataFrame, receipt_date: Column, min_available: int = 300, replenish_qty: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """(balances after, receipt moves): every balance short of `min_available` receives `replenish_qty`."""
    if min_available < 0:
        raise ValueError("minimum available quantity cannot be negative")
    if replenish_qty <= 0:
        raise ValueError("replenishment quantity must be positive")
    costs = products.select("product_id", "standard_cost")
    short = (F.col("on_hand_qty") - F.col("reserved_qty") < min_available) & F.col("standard_cost").isNotNull()
    priced = balances.join(costs, "product_id", "left").withColumn("__short", short)
    extra = F.when(F.col("__short"), replenish_qty).otherwise(0).cast(QUANTITY)
    after = priced.select(
        *[(F.col(c) + extra).cast(QUANTITY).alias(c) if c == "on_hand_qty" else F.col(c) for c in balances.columns]
    )
    quantity = F.lit(replenish_qty).cast(QUANTITY)
    moves = priced.where("__short").select(
        *STOCK_KEY,
        F.lit("purchase_receipt").alias("move_type"),
        receipt_date.alias("move_date"),
        quantity.alias("quantity"),
        F.col("standard_cost").alias("unit_cost"),
        round_money(quantity * F.col("standard_cost")).alias("move_value"),
        F.concat_ws("-", F.lit("AUTO-REPLENISH"), F.date_format(receipt_date, "yyyyMMdd"), *STOCK_KEY).alias("reference_number"),
    )
    return after, moves


def order_demand(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Quantity asked per (order, warehouse, product)."""
    heads = orders.select("order_id", "order_date")
    asked = lines.groupBy("order_id", *STOCK_KEY).agg(F.sum("quantity").alias("quantity"))
    return asked.join(heads, "order_id")


def atp_prefix(orders: DataFrame, lines: DataFrame, balances: DataFrame) -> DataFrame:
    """Demand added up per stock key in order sequence against what is available; flags each shortfall."""
    running = totals_before(
        order_demand(orders, lines), STOCK_KEY, ["order_date"], ["order_id"], {"__before": F.col("quantity")}
    )
    free = balances.select(*STOCK_KEY, (F.col("on_hand_qty") - F.col("reserved_qty")).alias("available_qty"))
    needed = F.col("__before") + F.col("quantity")
    short = F.coalesce(needed > F.col("available_qty"), F.lit(True))
    return running.join(free, STOCK_KEY, "left").select(
        "order_id", "order_date", *STOCK_KEY, "quantity",
        needed.alias("cumulative_demand"), "available_qty", short.alias("is_short"),
    )


def reserve_orders(orders: DataFrame, lines: DataFrame, balances: DataFrame) -> DataFrame:
    """(order_id, reject_reason) of confirming orders in (date, id) order.

    An order is confirmed only when every line fits what the earlier confirmed
    orders left; otherwise it takes nothing.
    """
    free = balances.select(*STOCK_KEY, (F.col("on_hand_qty") - F.col("reserved_qty")).alias("available_qty"))
    demand = order_demand(orders, lines).join(free, STOCK_KEY, "left")
    served = accept_groups_in_order(demand, "order_id", STOCK_KEY, ["order_date"], "quantity", "available_qty")
    reason = first_failure(
        (F.col("accepted").isNull(), "no_order_lines"),
        (F.col("order_date").isNull(), "missing_date"),
        (~F.col("accepted"), "insufficient_stock"),
    )
    return orders.select("order_id", "order_date").join(served, "order_id", "left").select("order_id", reason.alias("reject_reason"))


def reservation_moves(outcome: DataFrame, orders: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Reservation moves of the confirmed orders."""
    confirmed = outcome.where("reject_reason IS NULL").select("order_id")
    heads = orders.select("order_id", "order_number", "order_date").join(confirmed, "order_id", "left_semi")
    return sale_moves(lines.join(heads, "order_id"), products, "sale_reservation", F.col("order_date"))


def sale_moves(lines: DataFrame, products: DataFrame, move_type: str, move_date: Column) -> DataFrame:
    """Negative moves, one per line, valued at standard cost."""
    costs = products.select("product_id", "standard_cost")
    return lines.join(costs, "product_id").select(
        *STOCK_KEY, "order_line_id",
        F.lit(move_type).alias("move_type"),
        move_date.alias("move_date"),
        (-F.col("quantity")).cast(QUANTITY).alias("quantity"),
        F.col("standard_cost").alias("unit_cost"),
        round_money(-F.col("quantity") * F.col("standard_cost")).alias("move_value"),
        F.col("order_number").alias("reference_number"),
    )


def on_hand_effect() -> Column:
    """Reservations do not touch stock on hand; every other move counts as signed."""
    return F.when(F.col("move_type") == "sale_reservation", 0).otherwise(F.col("quantity"))


def reserved_effect() -> Column:
    """A (negative) reservation raises what is reserved, a (negative) delivery lowers it."""
    quantity, kind = F.col("quantity"), F.col("move_type")
    return F.when(kind == "sale_reservation", -quantity).when(kind == "sale_delivery", quantity).otherwise(0)


def replay_ledger(opening: DataFrame, moves: DataFrame, tasks: int | None = None) -> DataFrame:
    """Balances from opening balances plus all moves; with `tasks`, keys are dealt over that many tasks."""
    moves = deal(moves.select(*STOCK_KEY, "move_type", "quantity"), tasks, STOCK_KEY)
    sums = moves.groupBy(*STOCK_KEY).agg(
        F.sum(on_hand_effect()).alias("__hand"), F.sum(reserved_effect()).alias("__held"), F.count("*").alias("__moves")
    )
    start = deal(opening.select(*STOCK_KEY, "on_hand_qty", "reserved_qty"), tasks, STOCK_KEY)
    zero = F.lit(0)
    add = lambda a, b: (F.coalesce(F.col(a), zero) + F.coalesce(F.col(b), zero)).cast("decimal(28,3)")
    return start.join(sums, STOCK_KEY, "full").select(
        *STOCK_KEY,
        add("on_hand_qty", "__hand").alias("on_hand_qty"),
        add("reserved_qty", "__held").alias("reserved_qty"),
        F.coalesce("__moves", zero).alias("move_count"),
    )


def ledger_running(opening: DataFrame, moves: DataFrame) -> DataFrame:
    """On-hand and reserved before and after each move, with a flag for negative stock."""
    running = totals_by_key(
        moves.select("stock_move_id", *STOCK_KEY, "move_type", "move_date", "quantity"),
        STOCK_KEY, ["move_date"], ["stock_move_id"],
        {"__hand": on_hand_effect(), "__held": reserved_effect()},
    )
    start = opening.select(*STOCK_KEY, "on_hand_qty", "reserved_qty")
    wide = "decimal(28,3)"
    hand = (F.coalesce("on_hand_qty", F.lit(0)) + F.col("__hand")).cast(wide)
    held = (F.coalesce("reserved_qty", F.lit(0)) + F.col("__held")).cast(wide)
    out = running.join(start, STOCK_KEY, "left").select(
        "stock_move_id", *STOCK_KEY, "move_type", "move_date", "quantity",
        hand.alias("on_hand_before"), held.alias("reserved_before"),
    )
    after_hand = (F.col("on_hand_before") + on_hand_effect()).cast(wide)
    after_held = (F.col("reserved_before") + reserved_effect()).cast(wide)
    bad = (F.col("on_hand_after") < 0) | (F.col("reserved_after") < 0) | (F.col("reserved_after") > F.col("on_hand_after"))
    return out.withColumns({"on_hand_after": after_hand, "reserved_after": after_held}).withColumn("is_invalid", bad)


def deliver_check(opening: DataFrame, moves: DataFrame) -> DataFrame:
    """Deliveries with the rule they break: enough must be reserved and on hand before the move."""
    needed = -F.col("quantity")
    reason = first_failure(
        (needed <= 0, "quantity_not_positive"),
        ((F.col("reserved_before") < needed) | (F.col("on_hand_before") < needed), "not_enough_reserved_or_on_hand"),
    )
    return ledger_running(opening, moves).where("move_type = 'sale_delivery'").select(
        "stock_move_id", *STOCK_KEY, "move_date", needed.cast(QUANTITY).alias("quantity"),
        "on_hand_before", "reserved_before", reason.alias("reject_reason"),
    )


def move_value(moves: DataFrame, products: DataFrame, by: Sequence[str] = ("move_type",)) -> DataFrame:
    """Signed quantity times standard cost, summed per group."""
    costs = products.select("product_id", "standard_cost")
    value = round_money(F.col("quantity") * F.col("standard_cost"))
    return (
        moves.join(costs, "product_id")
        .groupBy(*by)
        .agg(F.count("*").alias("moves"), F.sum("quantity").alias("quantity"), F.sum(value).alias("move_value"))
    )


def lot_rows(
    grid: DataFrame, products: DataFrame, warehouses: DataFrame, made: Column, quantity: str
) -> DataFrame:
    """One lot per (warehouse, product) of `grid`; it expires a shelf life after manufacture."""
    items = products.select("product_id", "sku", "shelf_life_days")
    places = warehouses.select("warehouse_id", "warehouse_code")
    batch = F.date_format("manufacturing_date", "yyyyMM")
    return (
        grid.withColumn("manufacturing_date", made)
        .join(items, "product_id")
        .join(places, "warehouse_id")
        .select(
            F.concat_ws("-", F.lit("LOT"), "sku", "warehouse_code", batch).alias("lot_number"),
            "product_id", "warehouse_id", "manufacturing_date",
            F.date_add("manufacturing_date", F.col("shelf_life_days")).alias("expiration_date"),
            F.lit(quantity).cast(QUANTITY).alias("quantity_on_hand"),
        )
    )


def stock_rows(pairs: DataFrame, on_hand: Column, reorder_point: str = "80") -> DataFrame:
    """Opening balances for given (warehouse, product) pairs."""
    return pairs.select(
        *STOCK_KEY,
        on_hand.cast(QUANTITY).alias("on_hand_qty"),
        F.lit(0).cast(QUANTITY).alias("reserved_qty"),
        F.lit(reorder_point).cast(QUANTITY).alias("reorder_point"),
    )
