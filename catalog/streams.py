"""Stream queries, each run to the end of what is available."""

from __future__ import annotations

import os
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from catalog.query import Query
from tradewind.sources.bindings import Canonical, event_view
from tradewind.streaming import events as ev, metrics, run, stateful


def _stream(c: Canonical, table: str) -> DataFrame:
    # a pattern, because the table may be one file or a folder of files
    return run.read_stream(c.spark, f"{c.folder}/{table}.parque[t]", c.raw(table).schema)


def _events(c: Canonical) -> DataFrame:
    return event_view(_stream(c, "events"))


def _messages(c: Canonical) -> DataFrame:
    """Events as JSON text; some are cut off, some carry an unknown version or type."""
    version = F.when(F.col("event_id") % 53 == 1, 9).otherwise(1)
    kind = F.when(F.col("event_id") % 59 == 2, "teleport").otherwise(F.col("event_type"))
    body = F.to_json(
        F.struct(
            "event_id", kind.alias("event_type"), "event_time", "user_id", "source_system", "value", version.alias("schema_version")
        )
    )
    return _events(c).select(F.when(F.col("event_id") % 50 == 0, F.substring(body, 1, 25)).otherwise(body).alias("value"))


def _envelope(c: Canonical) -> DataFrame:
    checked = run.drain_append(ev.parse_envelope(_messages(c)), run.new_run(c.spark, "envelope"))
    return checked.groupBy("reject_reason", "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))


_REASON = """CASE WHEN event_id % 50 = 0 THEN 'malformed' WHEN event_id % 53 = 1 THEN 'unknown_version' WHEN event_id % 59 = 2 THEN 'unknown_type' END"""


def _distinct(c: Canonical) -> DataFrame:
    """Some events are sent three times, each time with the time of sending; a retry may be a month late."""
    repeated = _events(c).withColumn(
        "copy", F.explode(F.when(F.col("event_id") % 5 == 0, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1))))
    )
    sent = (F.col("event_time") + F.make_dt_interval(hours=F.col("copy") - 1)).alias("event_time")
    return stateful.first_of_each(repeated.select("event_id", "event_type", sent, "value"), run.new_run(c.spark, "distinct"), "31 DAYS").rows


def _tumbling(c: Canonical) -> DataFrame:
    return metrics.running_windows(_events(c), run.new_run(c.spark, "tumbling"), "1 hour")


def _sliding(c: Canonical) -> DataFrame:
    return metrics.running_windows(_events(c), run.new_run(c.spark, "sliding"), "2 hours", "1 hour")


def _sessions(c: Canonical) -> DataFrame:
    return metrics.running_sessions(_events(c), run.new_run(c.spark, "sessions"), "6 hours", "user_id")


def _dead(c: Canonical) -> DataFrame:
    good, dead = ev.split_dead_letters(ev.parse_envelope(_messages(c)), run.new_run(c.spark, "dead"))
    return good.groupBy(F.lit("good").alias("side")).agg(F.count("*").alias("events")).unionByName(
        dead.groupBy(F.col("reject_reason").alias("side")).agg(F.count("*").alias("events"))
    )


def _late(c: Canonical) -> DataFrame:
    """Two deliveries of the event table: the second brings the rest, partly long overdue."""
    path = run.new_run(c.spark, "late")
    inbox = os.path.join(path, "inbox")
    raw = c.raw("events")
    first = (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("event_id") % 10 != 0)
    marked = None
    for part in (raw.where(first), raw.where(~first)):
        part.write.mode("append").parquet(inbox)
        stream = event_view(run.read_stream(c.spark, inbox, raw.schema))
        marked = ev.route_late(stream, path, F.expr("INTERVAL 1 DAY"))
    return marked.groupBy("is_late", "event_type").agg(F.count("*").alias("events"))


def _moves(raw: DataFrame) -> DataFrame:
    """Each line as a delivery, and as a return receipt when it came back."""
    moves = F.array_compact(F.array(*_move_list()))
    return raw.select(
        F.col("l_suppkey").alias("warehouse_id"), F.col("l_partkey").alias("product_id"), F.explode(moves).alias("m")
    ).select("warehouse_id", "product_id", "m.*")


def _move_list() -> list[Column]:
    sold = -F.col("l_quantity").cast("decimal(18,3)")
    back = F.ceil(F.col("l_quantity") / 2).cast("decimal(18,3)")
    return [
        F.struct(F.lit("sale_delivery").alias("move_type"), sold.alias("quantity")),
        F.when(F.col("l_returnflag") == "R", F.struct(F.lit("return_receipt").alias("move_type"), back.alias("quantity"))),
    ]


def _stock(c: Canonical) -> DataFrame:
    return run.drain_updates(
        metrics.running_stock(_moves(_stream(c, "lineitem"))), run.new_run(c.spark, "stock"), ["warehouse_id", "product_id"]
    )


def _timed_moves(raw: DataFrame) -> DataFrame:
    """The moves of each line with their time: a return comes ten days after its delivery."""
    back = F.when(F.col("m.move_type") == "return_receipt", 10).otherwise(0)
    kept = raw.withColumn("line", F.struct("l_orderkey", "l_linenumber", "l_shipdate"))
    sold, came = _move_list()
    moved = kept.select(
        F.col("l_suppkey").alias("warehouse_id"), F.col("l_partkey").alias("product_id"), "line", F.explode(F.array_compact(F.array(sold, came))).alias("m")
    )
    return moved.select(
        "warehouse_id", "product_id", F.concat_ws("-", "line.l_orderkey", "line.l_linenumber", "m.move_type").alias("move_id"), "m.*",
        (F.col("line.l_shipdate").cast("timestamp") + F.make_dt_interval(days=back)).alias("moved_at"),
        (F.col("product_id") % 30 + 20).alias("opening_qty"),
    )


def _stock_events(c: Canonical) -> DataFrame:
    moves = _timed_moves(_stream(c, "lineitem"))
    return stateful.stock_events(moves, run.new_run(c.spark, "stock-events"), "10 DAYS", timedelta(days=300)).rows


def _orders_and_payments(orders: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Orders, and their lines as payments on delivery."""
    return (
        orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("timestamp").alias("ordered_at")),
        lines.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_shipdate").cast("timestamp").alias("paid_at"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        ),
    )


def _paid(c: Canonical) -> DataFrame:
    """Payments within thirty days of their order, and orders that have none."""
    terms = ("ordered_at", "paid_at", "order_id", "30 DAYS")
    orders, paid = _orders_and_payments(_stream(c, "orders"), _stream(c, "lineitem"))
    found = stateful.pay_within(orders, paid, run.new_run(c.spark, "join"), *terms, delay="36 HOURS")
    return stateful.settle_late_payments(found, *_orders_and_payments(c.raw("orders"), c.raw("lineitem")), *terms)


def _parity(c: Canonical) -> DataFrame:
    keys = ["window_start", "event_type"]
    batch = metrics.windowed_metrics(c.events, "1 hour")
    return metrics.parity(batch, _tumbling(c), keys, "value")


_TUMBLING = "SELECT date_trunc('hour', event_time) AS window_start, event_type, count(*) AS events, sum(value) AS value FROM event_rows GROUP BY ALL"


_TIMED_MOVES = """SELECT l_suppkey AS warehouse_id, l_partkey AS product_id, l_orderkey || '-' || l_linenumber || '-sale_delivery' AS move_id,
    l_shipdate AS moved_at, -CAST(l_quantity AS DECIMAL(18,3)) AS change FROM lineitem
    UNION ALL SELECT l_suppkey, l_partkey, l_orderkey || '-' || l_linenumber || '-return_receipt', l_shipdate + INTERVAL 10 DAY,
    CAST(ceil(l_quantity / 2) AS DECIMAL(18,3)) FROM lineitem WHERE l_returnflag = 'R'"""


def _times(df: DataFrame, *columns: str) -> DataFrame:
    """Times as whole seconds, the same number in any time zone setting of the check."""
    return df.withColumns({name: F.date_format(name, "yyyy-MM-dd HH:mm:ss") for name in columns})


QUERIES: dict[str, Query] = {
    "k01_event_envelope": Query(
        _envelope, "reject_reason:s event_type:s events:i value:n",
        f"""SELECT reason AS reject_reason, kind AS event_type, count(*) AS events, sum(value) AS value FROM
        (SELECT {_REASON} AS reason, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 59 = 2 THEN 'teleport' ELSE event_type END AS kind,
        CASE WHEN event_id % 50 <> 0 THEN value END AS value FROM event_rows) GROUP BY ALL""",
    ),
    "k02_idempotent_events": Query(
        _distinct, "event_id:i event_type:s value:n", "SELECT event_id, event_type, value FROM event_rows"
    ),
    "k03_tumbling_metrics": Query(
        lambda c: _times(_tumbling(c), "window_start"), "window_start:s event_type:s events:i value:n",
        f"SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, events, value FROM ({_TUMBLING})",
    ),
    "k03_sliding_metrics": Query(
        lambda c: _times(_sliding(c), "window_start"), "window_start:s event_type:s events:i value:n",
        """SELECT strftime(date_trunc('hour', event_time) - to_hours(h), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS events, sum(value) AS value
        FROM event_rows, (VALUES (0), (1)) AS hs(h) GROUP BY ALL""",
    ),
    "k03_session_metrics": Query(
        lambda c: _times(_sessions(c), "session_start"), "user_id:i session_start:s events:i value:n is_open:b",
        """SELECT user_id, strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS events, sum(value) AS value,
        max(event_time) + INTERVAL 6 HOUR > (SELECT max(event_time) FROM event_rows) AS is_open FROM
        (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM
        (SELECT *, CASE WHEN event_time < lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM event_rows))
        GROUP BY user_id, session_no""",
    ),
    "k04_dead_letter": Query(
        _dead, "side:s events:i",
        f"SELECT coalesce({_REASON}, 'good') AS side, count(*) AS events FROM event_rows GROUP BY ALL",
    ),
    "k05_late_data": Query(
        _late, "is_late:b event_type:s events:i",
        """SELECT NOT first AND event_time < (SELECT max(event_time) FROM event_rows WHERE event_time < TIMESTAMP '2024-01-20' AND event_id % 10 <> 0) - INTERVAL 1 DAY AS is_late,
        event_type, count(*) AS events FROM (SELECT *, event_time < TIMESTAMP '2024-01-20' AND event_id % 10 <> 0 AS first FROM event_rows) GROUP BY ALL""",
    ),
    "k06_running_stock": Query(
        _stock, "warehouse_id:i product_id:i on_hand_change:n moves:i",
        """SELECT l_suppkey AS warehouse_id, l_partkey AS product_id, sum(CASE WHEN l_returnflag = 'R' THEN ceil(l_quantity / 2) ELSE 0 END - l_quantity) AS on_hand_change,
        count(*) + count(*) FILTER (WHERE l_returnflag = 'R') AS moves FROM lineitem GROUP BY ALL""",
    ),
    "k07_order_payment_join": Query(
        lambda c: _paid(c).where("paid_at IS NOT NULL").withColumns({"ordered_on": F.col("ordered_at").cast("date"), "paid_on": F.col("paid_at").cast("date")}),
        "order_id:i line_no:i ordered_on:d paid_on:d amount:n",
        """SELECT o_orderkey AS order_id, l_linenumber AS line_no, CAST(o_orderdate AS DATE) AS ordered_on, CAST(l_shipdate AS DATE) AS paid_on,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY""",
    ),
    "k07_unpaid_orders": Query(
        lambda c: _paid(c).where("paid_at IS NULL").withColumn("ordered_on", F.col("ordered_at").cast("date")), "order_id:i ordered_on:d",
        """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS ordered_on FROM orders
        WHERE o_orderdate + INTERVAL 30 DAY < (SELECT least(max(o_orderdate), (SELECT max(l_shipdate) FROM lineitem)) FROM orders) - INTERVAL 36 HOUR
        AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 30 DAY)""",
    ),
    "k06_stock_events": Query(
        lambda c: _stock_events(c).withColumn("happened_on", F.col("at").cast("date")), "warehouse_id:i product_id:i kind:s happened_on:d on_hand:n moves:i",
        f"""SELECT * FROM (WITH m AS ({_TIMED_MOVES}),
        gaps AS (SELECT *, CASE WHEN moved_at - lag(moved_at) OVER w <= INTERVAL 300 DAY THEN 0 ELSE 1 END AS opens, lead(moved_at) OVER w AS next_at
            FROM m WINDOW w AS (PARTITION BY warehouse_id, product_id ORDER BY moved_at, move_id)),
        runs AS (SELECT *, sum(opens) OVER (PARTITION BY warehouse_id, product_id ORDER BY moved_at, move_id ROWS UNBOUNDED PRECEDING) AS run FROM gaps),
        sums AS (SELECT *, product_id % 30 + 20 + sum(change) OVER w AS on_hand, count(*) OVER w AS moves FROM runs
            WINDOW w AS (PARTITION BY warehouse_id, product_id, run ORDER BY moved_at, move_id ROWS UNBOUNDED PRECEDING))
        SELECT warehouse_id, product_id, 'negative' AS kind, CAST(moved_at AS DATE) AS happened_on, on_hand, moves FROM sums WHERE on_hand < 0 AND on_hand - change >= 0
        UNION ALL SELECT warehouse_id, product_id, 'settled', CAST(moved_at AS DATE), on_hand, moves FROM sums
        WHERE next_at - moved_at > INTERVAL 300 DAY OR (next_at IS NULL AND moved_at + INTERVAL 300 DAY < (SELECT max(moved_at) FROM m) - INTERVAL 10 DAY))""",
    ),
    "k08_batch_stream_parity": Query(
        lambda c: _times(_parity(c), "window_start"), "window_start:s event_type:s batch_value:n stream_value:n is_equal:b",
        f"""SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, a.value AS batch_value, b.value AS stream_value,
        a.value IS NOT DISTINCT FROM b.value AS is_equal FROM ({_TUMBLING}) a FULL JOIN
        (SELECT make_timestamp(CAST(floor(epoch_us(event_time) / 3600000000) AS BIGINT) * 3600000000) AS window_start, event_type, sum(value) AS value
        FROM event_rows GROUP BY ALL) b USING (window_start, event_type)""",
    ),
}
