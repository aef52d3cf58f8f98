"""Stream operators whose state is kept and bounded: duplicates, order and payment pairs, running stock.

Every operator has a watermark: the newest event time seen, less the stated delay
(of several inputs, the oldest such mark). State behind the watermark is removed, so
its size follows the delay and not the length of the stream. Of duplicates and pairs it lies
in RocksDB and in the checkpoint, and no batch reads what earlier batches wrote; of stock
it is a table that each batch reads and writes anew.

A row that comes behind the watermark is late. The engine drops late rows silently;
here they are written aside (`run.drain_beside`), so that every input row is either
counted or kept. A row without event time is late at once.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.operators.inventory import STOCK_KEY, on_hand_effect
from tradewind.streaming.run import Drained, drain_beside, drain_with_state, on_time


def first_of_each(events: DataFrame, path: str, delay: str, key: str = "event_id", time: str = "event_time") -> Drained:
    """One row per event whose retries come within `delay` of it, whatever the time that a retry states.

    An id is forgotten once the watermark has passed the time of its first copy by `delay`. Copies behind
    the watermark are aside. Of the copies that one batch holds any may be the one that stays, so
    columns other than the event's own (the time of a retry) may come from any of those.
    """
    timed = on_time(events, time).withWatermark(time, delay)
    return drain_beside(timed.dropDuplicatesWithinWatermark([key]), {"events": (events, time, delay)}, path)


def pay_within(
    orders: DataFrame, payments: DataFrame, path: str, order_time: str, payment_time: str, key: str, within: str, delay: str
) -> Drained:
    """Orders with their payments up to `within` after them; an order without one comes alone once none can come any more."""
    left = on_time(orders, order_time).withWatermark(order_time, delay)
    renamed = payments.withColumnRenamed(key, f"__{key}")
    right = on_time(renamed, payment_time).withWatermark(payment_time, delay)
    pairs = left.join(right, _paid_in_time(order_time, payment_time, key, within), "leftOuter").drop(f"__{key}")
    return drain_beside(pairs, {"orders": (orders, order_time, delay), "payments": (payments, payment_time, delay)}, path)


def _paid_in_time(order_time: str, payment_time: str, key: str, within: str) -> Column:
    return (
        (F.col(key) == F.col(f"__{key}"))
        & (F.col(payment_time) >= F.col(order_time))
        & (F.col(payment_time) <= F.col(order_time) + F.expr(f"INTERVAL {within}"))
    )


def settle_late_payments(
    drained: Drained, orders: DataFrame, payments: DataFrame, order_time: str, payment_time: str, key: str, within: str
) -> DataFrame:
    """What `pay_within` found, corrected for the rows that came late; `orders` and `payments` are the stored tables.

    Late orders meet all payments and late payments all orders, by key, in one batch; without
    late rows nothing is read. So the rows are those of any other order of arrival. `key` is unique among orders.
    """
    late_orders, late_payments = drained.late["orders"], drained.late["payments"]
    found = drained.rows
    if late_orders.isEmpty() and late_payments.isEmpty():
        return found
    columns, paid = found.columns, F.col(payment_time).isNotNull()
    meets = _paid_in_time(order_time, payment_time, key, within)
    others = orders.join(late_orders.select(key), key, "left_anti").select(*orders.columns)
    of = lambda rows: rows.withColumnRenamed(key, f"__{key}")
    extra = others.join(of(late_payments), meets).drop(f"__{key}")
    whole = late_orders.join(of(payments), meets, "left").drop(f"__{key}")
    over = F.col(order_time) + F.expr(f"INTERVAL {within}") < F.timestamp_millis(F.lit(drained.watermark_ms()))
    still = found.where(~paid).join(extra.select(key), key, "left_anti")
    return (
        found.where(paid).select(*columns).unionByName(still.select(*columns)).unionByName(extra.select(*columns))
        .unionByName(whole.where(paid | over).select(*columns))
    )


_QTY, _WIDE = "decimal(18,3)", "decimal(28,3)"


def _levels(known: DataFrame, moves: DataFrame, idle: timedelta) -> DataFrame:
    """Each move, and each known level, with what its key has after it; `known` holds one row per key."""
    limit = F.lit(idle // timedelta(microseconds=1))
    held = known.select(
        *STOCK_KEY, F.lit(True).alias("known"), F.lit("").alias("move_id"), "moved", F.col("on_hand").alias("change"), F.lit(None).cast(_QTY).alias("opening_qty"), "moves"
    )
    rows = held.unionByName(moves.select(*STOCK_KEY, F.lit(False).alias("known"), "move_id", "moved", "change", "opening_qty", F.lit(1).cast("bigint").alias("moves")))
    order = Window.partitionBy(*STOCK_KEY).orderBy(F.desc("known"), "moved", "move_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    # a late state row may lie behind its moves: the newest time counts
    last = F.max("moved").over(order.rowsBetween(Window.unboundedPreceding, -1))
    timed = rows.withColumn("last", last).withColumn("opens", F.col("last").isNull() | (F.col("moved") - F.col("last") > limit))
    size = F.coalesce("change", F.lit(0)) + F.when(F.col("opens"), F.coalesce("opening_qty", F.lit(0))).otherwise(0)
    summed = timed.withColumn("size", size.cast(_WIDE)).withColumns({
        "all_hand": F.sum("size").over(so_far), "all_moves": F.sum("moves").over(so_far), "newest": F.greatest("last", "moved"),
    })
    # what the key had added up before it was opened the last time
    opened = F.last(F.when(F.col("opens"), F.struct((F.col("all_hand") - F.col("size")).alias("hand"), (F.col("all_moves") - F.col("moves")).alias("moves"))), True)
    based = summed.withColumns({"base": opened.over(so_far), "closes": F.lead("opens").over(order)})
    return based.select(
        *STOCK_KEY, "known", "moved", "newest", "change", "closes",
        (F.col("all_hand") - F.col("base.hand")).cast(_WIDE).alias("on_hand"), (F.col("all_moves") - F.col("base.moves")).alias("moves"),
    )


def stock_events(moves: DataFrame, path: str, delay: str, idle: timedelta, time: str = "moved_at") -> Drained:
    """Stock on hand as it moves: a row `negative` when a move takes a (warehouse, product) below zero, and a
    row `settled` with its last quantity when it has not moved for longer than `idle`.

    `moves`: warehouse_id, product_id, move_id, move_type, quantity, `time`, and `opening_qty`, from which a key
    starts when it has no state. A settled key leaves the state. Moves count in the order of their
    arrival, those of one batch in the order of their time, so batches in time order give the
    same rows wherever they are cut. Late moves are aside and belong to the next stock-taking.

    The state is a table, one row per key that is not settled: a batch meets it in windows of the key and
    writes it anew beside its rows, so all keys go through one sort and none through a call of its own.
    """
    kinds = {f.name: f.dataType.simpleString() for f in moves.select(*STOCK_KEY).schema}
    keys = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    state_ddl = f"{keys}, moved bigint, on_hand {_WIDE}, moves bigint"
    limit = idle // timedelta(microseconds=1)
    # the first millisecond at which a key has been idle for too long
    expiry = lambda moved: F.expr(f"({moved} + {limit} - pmod({moved} + {limit}, 1000)) div 1000 + 1")
    row = lambda kind, at: F.struct(*STOCK_KEY, F.lit(kind).alias("kind"), F.timestamp_micros(at).alias("at"), "on_hand", "moves")

    def step(batch: DataFrame, state: DataFrame | None, watermark: int) -> DataFrame:
        spark = batch.sparkSession
        known = spark.createDataFrame([], state_ddl) if state is None else state
        sized = batch.select(
            *STOCK_KEY, F.col("move_id").cast("string").alias("move_id"), F.unix_micros(time).alias("moved"),
            on_hand_effect().cast(_QTY).alias("change"), F.col("opening_qty").cast(_QTY).alias("opening_qty"),
        )
        before = F.col("on_hand") - F.coalesce("change", F.lit(0))
        gone = F.coalesce("closes", F.col("closes").isNull() & (expiry("newest") <= watermark))
        crossed = ~F.col("known") & (before >= 0) & (F.col("on_hand") < 0)
        held = F.struct(*STOCK_KEY, F.col("newest").alias("moved"), "on_hand", "moves")
        out = F.array_compact(F.array(F.when(crossed, row("negative", "moved")), F.when(gone, row("settled", "newest"))))
        return _levels(known, sized, idle).select(out.alias("found"), F.when(F.col("closes").isNull() & ~gone, held).alias("state"))

    def expired(state: DataFrame, watermark: int) -> DataFrame:
        return state.where(expiry("moved") <= watermark).select(row("settled", "moved").alias("r")).select("r.*")

    result_ddl = f"{keys}, kind string, at timestamp, on_hand {_WIDE}, moves bigint"
    return drain_with_state(moves, path, time, delay, step, state_ddl, result_ddl, expired)
