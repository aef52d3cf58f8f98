"""Deeper analyses: targets, suppliers, baskets, churn, delivery failures, demand, lots, fill rate, customers.

Windows here run over rows that an aggregate has already reduced to at most one
per key and calendar day; cubes and rollups run over such reduced rows too.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions import exact_ratio, neighbour_values
from tradewind.session import stage_table
from tradewind.sources.tables import deal

WIDE = "decimal(20,0)"


def _share(part: str, whole: str, scale: int = 4) -> Column:
    return exact_ratio(f"cast({part} as {WIDE})", f"cast({whole} as {WIDE})", scale)


def target_vs_actual(targets: DataFrame, actuals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attainment per key; a key on one side only stays with the other side empty.

    targets: keys, target_amount. actuals: keys, net_amount (any grain).
    """
    keys = list(keys)
    wanted = targets.groupBy(*keys).agg(F.sum("target_amount").alias("target_amount"))
    reached = actuals.groupBy(*keys).agg(F.sum("net_amount").alias("actual_amount"))
    return wanted.join(reached, keys, "full").select(
        *keys, "target_amount", "actual_amount",
        (F.coalesce("actual_amount", F.lit(0)) - F.coalesce("target_amount", F.lit(0))).alias("variance"),
        exact_ratio(F.coalesce("actual_amount", F.lit(0)), "target_amount", 4).alias("attainment"),
    )


def supplier_performance(receipts: DataFrame) -> DataFrame:
    """Per supplier: mean purchase price, lead time, on-time and fill rate.

    receipts: supplier_id, ordered_qty, received_qty, amount, ordered_on, promised_on, received_on (NULL: open).
    """
    lead = F.datediff("received_on", "ordered_on")
    on_time = F.coalesce(F.col("received_on") <= F.col("promised_on"), F.lit(False))
    sums = receipts.groupBy("supplier_id").agg(
        F.count("*").alias("order_lines"),
        F.sum("ordered_qty").alias("ordered_qty"),
        F.sum("received_qty").alias("received_qty"),
        F.sum("amount").alias("amount"),
        F.sum(lead).alias("lead_days"),
        F.count(lead).alias("received_lines"),
        F.count_if(on_time).alias("on_time_lines"),
    )
    return sums.select(
        "supplier_id", "order_lines", "ordered_qty", "received_qty",
        exact_ratio("amount", "ordered_qty", 2).alias("avg_purchase_price"),
        _share("lead_days", "received_lines", 2).alias("avg_lead_days"),
        _share("on_time_lines", "order_lines").alias("on_time_rate"),
        exact_ratio("received_qty", "ordered_qty", 4).alias("fill_rate"),
    )


BASKET_BLOCK = 500


def market_basket(lines: DataFrame, item: str, min_support: str) -> DataFrame:
    """Pairs of items bought together in at least a `min_support` share of the orders.

    A pair can only be that frequent if both its items are, so infrequent items
    leave first. The baskets are written once and read by every step. A basket of
    more than `BASKET_BLOCK` items is cut into blocks of items that meet two by
    two, each two under a join key of their own, and pair counts are combined
    inside the join's own tasks before anything is shuffled.
    """
    baskets = stage_table(lines.select("order_id", F.col(item).alias("item")).distinct(), "baskets")
    orders = baskets.select("order_id").distinct().agg(F.count("*").alias("n")).scalar()
    threshold = F.greatest(F.ceil(orders * F.lit(min_support).cast("decimal(12,10)")), F.lit(1))
    frequent = baskets.groupBy("item").agg(F.count("*").alias("orders_with")).where(F.col("orders_with") >= threshold)
    kept = baskets.join(frequent.select("item"), "item", "left_semi")
    blocks = kept.groupBy("order_id").agg(F.ceil(F.count("*") / BASKET_BLOCK).cast("int").alias("blocks"))
    kept = kept.join(blocks, "order_id").withColumn("own", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = kept.select("order_id", F.col("item").alias("item_a"), F.col("own").alias("block_a"), every.alias("block_b"))
    right = kept.select("order_id", F.col("item").alias("item_b"), every.alias("block_a"), F.col("own").alias("block_b"))
    pairs = (
        left.join(right, ["order_id", "block_a", "block_b"])
        .where("item_a < item_b")
        .groupBy("item_a", "item_b")
        .agg(F.count("*").alias("together"))
        .where(F.col("together") >= threshold)
    )
    a = frequent.select(F.col("item").alias("item_a"), F.col("orders_with").alias("orders_a"))
    b = frequent.select(F.col("item").alias("item_b"), F.col("orders_with").alias("orders_b"))
    wide = lambda c: c.cast(WIDE)
    return (
        pairs.join(a, "item_a")
        .join(b, "item_b")
        .select(
            "item_a", "item_b", "together",
            exact_ratio(wide(F.col("together")), wide(orders), 6).alias("support"),
            _share("together", "orders_a").alias("confidence_ab"),
            _share("together", "orders_b").alias("confidence_ba"),
            exact_ratio(
                F.col("together").cast("decimal(14,0)") * orders.cast("decimal(12,0)"),
                F.col("orders_a").cast("decimal(14,0)") * F.col("orders_b").cast("decimal(12,0)"),
                4,
            ).alias("lift"),
        )
    )


def item_sets(lines: DataFrame, item: str, min_support: str, max_size: int = 4) -> tuple[list[DataFrame], Column]:
    """Sets of one to `max_size` items bought together in at least a `min_support` share of the orders.

    Level by level: `items` (ascending) and `together` per size, and the number of orders. A set of k items can only
    be that frequent if all its subsets are, so level k is made of two sets of level k - 1 in one order that
    share all but their last item, and only of those whose other subsets are frequent too. What is joined
    is keyed by (order, shared items): an item that stands in a third of all orders is spread
    over them, and orders leave as soon as they hold no frequent set of a level. Baskets of very many frequent
    items cost their pairs; raise the support for those.
    """
    baskets = stage_table(lines.select("order_id", F.col(item).alias("item")).where("item IS NOT NULL").distinct(), "baskets")
    orders = baskets.select("order_id").distinct().agg(F.count("*").alias("n")).scalar()
    threshold = F.greatest(F.ceil(orders * F.lit(min_support).cast("decimal(12,10)")), F.lit(1))

    def frequent(found: DataFrame) -> DataFrame:
        return stage_table(found.groupBy("items").agg(F.count("*").alias("together")).where(F.col("together") >= threshold), "item-sets")

    held = baskets.select("order_id", F.array("item").alias("items"))
    levels = [frequent(held)]
    for size in range(2, max_size + 1):
        known = levels[-1].select("items")
        shared = F.slice("items", 1, size - 2) if size > 2 else F.array().cast(held.schema["items"].dataType)
        last = F.element_at("items", -1)

        def pairs(sets: DataFrame, *keys: str) -> DataFrame:
            left = sets.select(*keys, shared.alias("shared"), last.alias("a"))
            right = sets.select(*keys, shared.alias("shared"), last.alias("b"))
            joined = left.join(right, [*keys, "shared"]).where("a < b")
            return joined.select(*keys, F.concat("shared", F.array("a", "b")).alias("items"))

        kept = held.join(known, "items", "left_semi")
        if size == 2:
            found = pairs(kept, "order_id")
        else:
            # candidates: all subsets without one item are frequent
            asked = pairs(known)
            subsets = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda k: F.filter("items", lambda x, i: i != k - 1))
            parts = asked.withColumn("__subset", F.explode(subsets)).join(known.withColumnRenamed("items", "__subset"), "__subset", "left_semi")
            candidates = stage_table(parts.groupBy("items").agg(F.count("*").alias("n")).where(F.col("n") == size).select("items"), "candidates")
            found = pairs(kept, "order_id").join(candidates, "items", "left_semi")
        held = stage_table(found, "held-sets")
        level = frequent(held)
        if level.isEmpty():
            break
        levels.append(level)
    return levels, orders


def basket_rules(lines: DataFrame, item: str, min_support: str, max_size: int = 4) -> DataFrame:
    """Rules `if all of these, then that`: `items` on the left (one or more, joined by commas), `consequent`, and their measures."""
    levels, orders = item_sets(lines, item, min_support, max_size)
    all_sets = reduce(DataFrame.unionByName, levels)
    split = all_sets.where("size(items) > 1").select("items", "together", F.explode("items").alias("consequent"))
    split = split.withColumn("left", F.filter("items", lambda x: x != F.col("consequent")))
    given = all_sets.select(F.col("items").alias("left"), F.col("together").alias("with_left"))
    single = levels[0].select(F.col("items")[0].alias("consequent"), F.col("together").alias("with_consequent"))
    wide = lambda c: c.cast(WIDE)
    return split.join(given, "left").join(single, "consequent").select(
        F.array_join("left", ",").alias("items"), "consequent", "together",
        exact_ratio(wide(F.col("together")), wide(orders), 6).alias("support"),
        _share("together", "with_left").alias("confidence"),
        exact_ratio(
            F.col("together").cast("decimal(14,0)") * orders.cast("decimal(12,0)"),
            F.col("with_left").cast("decimal(14,0)") * F.col("with_consequent").cast("decimal(12,0)"), 4,
        ).alias("lift"),
    )


def purchase_cycle(orders: DataFrame, as_of: Column) -> DataFrame:
    """Mean days between order days per customer, and who has been silent too long for that cycle.

    The gaps of a customer add up to last day less first day, so no row needs
    its neighbour. At risk: silence above 2.25 cycles (45 days on a 20-day cycle).
    """
    days = orders.select("customer_id", "order_date").distinct()
    per = days.groupBy("customer_id").agg(
        F.count("*").alias("order_days"), F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")
    )
    span, gaps = F.datediff("last_day", "first_day"), F.col("order_days") - 1
    silence = F.datediff(as_of, F.col("last_day"))
    status = F.when(gaps == 0, "UNKNOWN").when(silence * gaps * 4 > span * 9, "AT_RISK").otherwise("ACTIVE")
    return per.select(
        "customer_id", "order_days", "first_day", "last_day",
        exact_ratio(span.cast(WIDE), gaps.cast(WIDE), 2).alias("avg_cycle_days"),
        silence.alias("days_silent"),
        status.alias("churn_status"),
    )


def failed_delivery_rates(attempts: DataFrame, shipments: DataFrame, orders: DataFrame, customers: DataFrame, carriers: DataFrame) -> DataFrame:
    """Failed and returned attempts by carrier, region and cash on delivery, with every subtotal.

    The finest groups are counted first; the cube then works on those few rows.
    """
    sent = shipments.select("shipment_id", "order_id", "carrier_id")
    heads = orders.select("order_id", "customer_id")
    homes = customers.select("customer_id", "region")
    names = carriers.select("carrier_id", "carrier_code")
    fine = (
        attempts.withColumn("is_cod", F.col("cod_amount") > 0)
        .join(sent, "shipment_id")
        .join(heads, "order_id")
        .join(homes, "customer_id")
        .join(names, "carrier_id")
        .groupBy("carrier_code", "region", "is_cod")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col("attempt_status") == "failed").alias("f"),
            F.count_if(F.col("attempt_status") == "returned").alias("r"),
        )
    )
    cubed = fine.cube("carrier_code", "region", "is_cod").agg(
        F.grouping_id().alias("grouping"),
        F.sum("n").alias("attempts"), F.sum("f").alias("failed"), F.sum("r").alias("returned"),
    )
    return cubed.select(
        "carrier_code", "region", "is_cod", "grouping", "attempts", "failed", "returned",
        _share("failed", "attempts").alias("failed_rate"), _share("returned", "attempts").alias("returned_rate"),
    )


def sales_velocity(sales: DataFrame, days: int = 28, spike_factor: int = 3, service_factor: float = 1.65, lead_days: int = 7) -> DataFrame:
    """Per product and sales day: demand of the `days` days before, spike flag, safety stock.

    Days without a sale count as zero. Safety stock is service factor times the
    standard deviation of daily demand times the root of the lead time.
    """
    daily = sales.groupBy("product_key", "date_key").agg(F.sum("quantity").alias("quantity"))
    day_no = F.datediff("date_key", F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy("product_key").orderBy("__day").rangeBetween(-days, -1)
    demand = F.coalesce(F.sum("quantity").over(before), F.lit(0)).cast("decimal(28,3)")
    squares = F.coalesce(F.sum(F.col("quantity").cast("double") * F.col("quantity").cast("double")).over(before), F.lit(0.0))
    seen = daily.withColumn("__day", day_no).withColumns({"demand": demand, "squares": squares})
    total = F.col("demand").cast("double")
    variance = F.greatest((F.col("squares") - total * total / F.lit(float(days))) / F.lit(float(days - 1)), F.lit(0.0))
    return seen.select(
        "product_key", "date_key", "quantity",
        F.col("demand").alias("demand_before"),
        exact_ratio("demand", F.lit(days).cast("decimal(4,0)"), 3).alias("daily_velocity"),
        ((F.col("demand") > 0) & (F.col("quantity") * days > F.col("demand") * spike_factor)).alias("is_spike"),
        (F.lit(service_factor) * F.sqrt(variance) * F.sqrt(F.lit(float(lead_days)))).alias("safety_stock"),
    )


def expiring_lots(lots: DataFrame, as_of: Column) -> DataFrame:
    """Lots and quantity per warehouse and time left."""
    left = F.datediff("expiration_date", as_of)
    bucket = (
        F.when(left < 0, "EXPIRED").when(left <= 30, "WITHIN_30").when(left <= 90, "WITHIN_90").otherwise("LATER")
    )
    return (
        lots.withColumn("expiry_bucket", bucket)
        .groupBy("warehouse_id", "expiry_bucket")
        .agg(
            F.count("*").alias("lots"),
            F.sum("quantity_on_hand").alias("quantity"),
            F.min("expiration_date").alias("next_expiration"),
        )
    )


def fill_rate(lines: DataFrame, shipments: DataFrame, by: Sequence[str]) -> DataFrame:
    """Delivered over ordered quantity, the worst groups first when sorted by it."""
    sent = shipments.where("shipment_status = 'delivered'").select("order_id", F.lit(True).alias("__sent"))
    delivered = F.sum(F.when(F.col("__sent"), F.col("quantity")).otherwise(0))
    sums = lines.join(sent, "order_id", "left").groupBy(*by).agg(
        F.sum("quantity").alias("ordered_qty"), delivered.cast("decimal(28,3)").alias("delivered_qty")
    )
    return sums.select("*", exact_ratio("delivered_qty", "ordered_qty", 4).alias("fill_rate"))


def customer_360(sales: DataFrame, customers: DataFrame, channels: Sequence[tuple[int, str]]) -> DataFrame:
    """One row per buying customer: revenue per channel and how many channels it uses."""
    pivot = [
        F.coalesce(F.sum(F.when(F.col("channel_key") == key, F.col("net_amount"))), F.lit(0)).alias(f"net_{code.lower()}")
        for key, code in channels
    ]
    per = sales.groupBy("customer_key").agg(
        *pivot,
        F.sum("net_amount").alias("net_total"),
        F.size(F.collect_set(F.when(F.col("channel_key").isin(*[k for k, _ in channels]), F.col("channel_key")))).alias("channels_used"),
        F.max("date_key").alias("last_order_date"),
    )
    names = customers.select("customer_key", "customer_code", "segment_code")
    return per.join(names, "customer_key").select(
        "customer_code", "segment_code", *[f"net_{code.lower()}" for _, code in channels], "net_total", "channels_used",
        (F.col("channels_used") > 1).alias("is_omnichannel"), "last_order_date",
    )


def slow_movers(sales: DataFrame, products: DataFrame, limit: int = 20) -> DataFrame:
    """Products that sold least, never sold ones included."""
    sold = sales.groupBy("product_key").agg(F.sum("quantity").alias("sold"), F.max("date_key").alias("last_sold_on"))
    units = F.coalesce("sold", F.lit(0)).cast("decimal(28,3)")
    return (
        products.select("product_key", "sku", "product_name")
        .join(sold, "product_key", "left")
        .select("sku", "product_name", units.alias("units_sold"), "last_sold_on")
        .orderBy("units_sold", "sku")
        .limit(limit)
    )


def ops_marts(moves: DataFrame, shipments: DataFrame) -> DataFrame:
    """Per month: inbound, outbound and returned quantity, shipments, on-time rate, cost per shipment."""
    kind, quantity = F.col("move_type"), F.col("quantity")
    stock = moves.groupBy(F.trunc("move_date", "MM").alias("month")).agg(
        F.sum(F.when(kind == "purchase_receipt", quantity).otherwise(0)).alias("inbound_qty"),
        F.sum(F.when(kind == "sale_delivery", -quantity).otherwise(0)).alias("outbound_qty"),
        F.sum(F.when(kind == "return_receipt", quantity).otherwise(0)).alias("returned_qty"),
    )
    sent = shipments.groupBy(F.trunc("actual_ship_date", "MM").alias("month")).agg(
        F.count("*").alias("shipments"),
        F.count_if("is_on_time_delivery").alias("on_time"),
        F.sum("shipping_fee").alias("shipping_cost"),
    )
    return stock.join(sent, "month", "full").select(
        "month", "inbound_qty", "outbound_qty", "returned_qty", "shipments",
        _share("on_time", "shipments").alias("on_time_rate"),
        "shipping_cost",
        exact_ratio("shipping_cost", F.col("shipments").cast(WIDE), 2).alias("cost_per_shipment"),
    )


def multi_warehouse_stock(sources: dict[str, DataFrame], tasks: int | None = None) -> DataFrame:
    """Stock per product over all warehouses and source systems (product_id, warehouse_id, on_hand_qty).

    With `tasks`, products are dealt over that many tasks, and their places are added up there.
    """
    parts = [df.select(F.lit(name).alias("source_system"), "product_id", "warehouse_id", "on_hand_qty") for name, df in sources.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    per_place = deal(rows, tasks, ["product_id"]).groupBy("source_system", "product_id", "warehouse_id").agg(F.sum("on_hand_qty").alias("qty"))
    return per_place.groupBy("source_system", "product_id").agg(
        F.sum("qty").alias("on_hand_qty"), F.count("*").alias("warehouses"), F.max("qty").alias("largest_warehouse_qty")
    )


def order_journey(status_log: DataFrame, sla_days: int) -> DataFrame:
    """Time in each state, and whether it broke the SLA; the current state has no end."""
    seen = neighbour_values(
        status_log, ["order_id"], ["changed_on"], ["sequence"], ["status", "changed_on"], side="next"
    )
    spent = F.datediff("next_changed_on", "changed_on")
    return seen.select(
        "order_id", "sequence", "status", "changed_on", "next_status",
        spent.alias("days_in_state"), F.coalesce(spent > sla_days, F.lit(False)).alias("is_late"),
    )


def calendar_drilldown(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders and revenue by year, quarter and month with subtotals, over per-day totals."""
    daily = sales.groupBy("date_key", "sales_order_key").agg(F.sum("net_amount").alias("net")).groupBy("date_key").agg(
        F.count("*").alias("orders"), F.sum("net").alias("net")
    )
    calendar = dates.select("date_key", "year", "quarter", "month")
    return (
        daily.join(calendar, "date_key")
        .rollup("year", "quarter", "month")
        .agg(F.grouping_id().alias("grouping"), F.sum("orders").alias("orders"), F.sum("net").alias("net_revenue"))
    )
