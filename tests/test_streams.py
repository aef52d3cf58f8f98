"""Stream queries with the input cut into files out of time order, and bounded state with files in time order, one file per batch."""

import math
from datetime import datetime, timedelta

import duckdb
import pytest

from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tradewind.streaming import run, stateful

SMALL = "/root/testdata/sf0.001"
ALL_BATCHES = [q for q in queries() if q.startswith("k0") and q not in ("k05_late_data", "k06_stock_events")]


@pytest.fixture(scope="module")
def cut(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("cut")
    for table, key in (("events", "event_id"), ("orders", "o_orderkey"), ("lineitem", "l_linenumber")):
        # dealt by a hash, so every file covers the whole time and rows of one order lie apart
        spark.read.parquet(f"{SMALL}/{table}.parquet").repartition(5, key).write.parquet(str(folder / f"{table}.parquet"))
        assert len(list((folder / f"{table}.parquet").glob("part-*"))) >= 4
    return str(folder)


def plain(row, columns, order):
    values = [row[i] for i in order]
    return tuple(None if isinstance(v, float) and math.isnan(v) else float(v) if type(v).__name__ == "Decimal" else v for v in values)


@pytest.mark.parametrize("name", ALL_BATCHES)
def test_any_batch_cut_gives_the_same_rows(spark, cut, monkeypatch, name):
    monkeypatch.setattr(run, "FILES_PER_BATCH", 1)
    df = queries()[name](spark, cut)
    con = duckdb.connect()
    for table in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    for table in ("region", "nation", "customer", "supplier", "part", "documents"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = sorted((plain(r, columns, sorted(range(len(columns)), key=lambda i: columns[i])) for r in result.fetchall()), key=repr)
    got = sorted((plain(r, df.columns, sorted(range(len(df.columns)), key=lambda i: df.columns[i])) for r in df.collect()), key=repr)
    assert sorted(columns) == sorted(df.columns) and got == want and len(got) > 0


# bounded state: files in time order, one file per batch

def deliver(df, files, column, path):
    """Append the rows in time order, as so many files."""
    rows = df.orderBy(column).collect()
    size = max(-(-len(rows) // files), 1)
    for at in range(0, max(len(rows), 1), size):
        df.sparkSession.createDataFrame(rows[at:at + size], df.schema).coalesce(1).write.mode("append").parquet(path)


def at(day, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=day, hours=hour)


def sent_events(spark):
    """400 events, each sent up to three times within 40 hours, each time with another time."""
    rows = [(i, at(i // 10, i % 10 + 20 * k), i * 1.5) for i in range(400) for k in range(1 + i % 3)]
    return spark.createDataFrame(rows, "event_id bigint, event_time timestamp, value double")


@pytest.mark.parametrize("files", [1, 2, 7])
def test_one_row_per_event_whatever_the_time_of_its_retries(spark, tmp_path, files):
    events = sent_events(spark)
    deliver(events, files, "event_time", str(tmp_path / "in"))
    found = stateful.first_of_each(run.read_stream(spark, str(tmp_path / "in"), events.schema, 1), str(tmp_path / "out"), "2 DAYS")
    assert sorted((r.event_id, r.value) for r in found.rows.collect()) == [(i, i * 1.5) for i in range(400)]
    assert found.late["events"].isEmpty()
    # ids of two days before the watermark, and of the days of one file; nothing of the days before
    assert max(found.state_rows()) <= 10 * (2 * 2 + 2 + 40 // files + 1) and found.state_rows()[-1] <= 10 * (2 * 2 + 2)


def test_events_behind_the_watermark_are_aside(spark, tmp_path):
    events = sent_events(spark)
    inbox = str(tmp_path / "in")
    deliver(events, 4, "event_time", inbox)
    overdue = spark.createDataFrame([(1000, at(1), 0.0), (5, at(0, 5), 7.5), (1001, None, 0.0)], events.schema)
    for part in (overdue, spark.createDataFrame([(2000, at(45), 1.0)], events.schema)):
        part.coalesce(1).write.mode("append").parquet(inbox)
    found = stateful.first_of_each(run.read_stream(spark, inbox, events.schema, 1), str(tmp_path / "out"), "2 DAYS")
    assert {r.event_id for r in found.rows.collect()} == {*range(400), 2000}
    assert sorted(r.event_id for r in found.late["events"].collect()) == [5, 1000, 1001]


def test_a_stopped_run_goes_on_from_its_checkpoint(spark, tmp_path):
    events = sent_events(spark)
    inbox, path = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (events.where("event_time < '2024-01-20'"), events.where("event_time >= '2024-01-20'")):
        deliver(part, 3, "event_time", inbox)
        found = stateful.first_of_each(run.read_stream(spark, inbox, events.schema, 1), path, "2 DAYS")
    assert sorted(r.event_id for r in found.rows.collect()) == list(range(400)) and found.late["events"].isEmpty()


TERMS = ("ordered_at", "paid_at", "order_id", "4 DAYS")


def orders_and_payments(spark):
    orders = spark.createDataFrame([(i, at(i // 10)) for i in range(300)], "order_id bigint, ordered_at timestamp")
    # some have two payments, some one, some one that comes too late, some none
    paid = [(i, at(i // 10 + i % 7, 3 * k), k) for i in range(300) for k in range(i % 3)]
    return orders, spark.createDataFrame(paid, "order_id bigint, paid_at timestamp, part int")


def paid_by_hand(orders, payments, watermark):
    out = set()
    of = {}
    for p in payments.collect():
        of.setdefault(p.order_id, []).append(p)
    for o in orders.collect():
        fit = [p for p in of.get(o.order_id, []) if o.ordered_at <= p.paid_at <= o.ordered_at + timedelta(days=4)]
        out |= {(o.order_id, p.part) for p in fit}
        if not fit and o.ordered_at + timedelta(days=4) < watermark:
            out.add((o.order_id, None))
    return out


@pytest.mark.parametrize("files", [1, 2, 7])
def test_paid_and_unpaid_orders_with_bounded_state(spark, tmp_path, files):
    orders, payments = orders_and_payments(spark)
    for name, df, time in (("o", orders, "ordered_at"), ("p", payments, "paid_at")):
        deliver(df, files, time, str(tmp_path / name))
    streams = [run.read_stream(spark, str(tmp_path / name), df.schema, 1) for name, df in (("o", orders), ("p", payments))]
    found = stateful.pay_within(*streams, str(tmp_path / "out"), *TERMS, delay="36 HOURS")
    got = [(r.order_id, r.part) for r in found.rows.collect()]
    newest = min(orders.agg(F.max("ordered_at")).first()[0], payments.agg(F.max("paid_at")).first()[0])
    assert len(got) == len(set(got)) and set(got) == paid_by_hand(orders, payments, newest - timedelta(hours=36))
    # both sides of some days before the watermark and of one file
    assert found.state_rows()[-1] <= 20 * 9 and (files < 7 or max(found.state_rows()) <= 20 * (9 + 2 * 30 // files))


def test_late_orders_and_payments_are_settled_from_the_tables(spark, tmp_path):
    orders, payments = orders_and_payments(spark)
    for name, df in (("o", orders), ("p", payments)):
        df.repartition(5, "order_id").write.parquet(str(tmp_path / name))
    streams = [run.read_stream(spark, str(tmp_path / name), df.schema, 1) for name, df in (("o", orders), ("p", payments))]
    found = stateful.pay_within(*streams, str(tmp_path / "out"), *TERMS, delay="36 HOURS")
    assert not found.late["orders"].isEmpty() and not found.late["payments"].isEmpty()
    got = [(r.order_id, r.part) for r in stateful.settle_late_payments(found, orders, payments, *TERMS).collect()]
    watermark = datetime(1970, 1, 1) + timedelta(milliseconds=found.watermark_ms())
    assert len(got) == len(set(got)) and set(got) == paid_by_hand(orders, payments, watermark)


def stock_moves(spark):
    rows = [
        (w, p, f"{n:04d}", "purchase_receipt" if n % 4 == 0 else "sale_delivery", 11.0 if n % 4 == 0 else -5.0, 10.0, at(n // 20, n % 20))
        for n in range(600) for w, p in [(n % 3, n % 7)] if not (p == 3 and 5 <= n // 20 < 15) and not (p == 4 and n // 20 > 12)
    ]
    return spark.createDataFrame(rows, "warehouse_id bigint, product_id bigint, move_id string, move_type string, quantity double, opening_qty double, moved_at timestamp")


def stock_by_hand(moves, idle, watermark):
    out, held = [], {}
    for m in sorted(moves.collect(), key=lambda m: (m.moved_at, m.move_id)):
        key = (m.warehouse_id, m.product_id)
        now = held.get(key)
        if now and m.moved_at - now[1] > idle:
            out.append((*key, "settled", now[1], now[0], now[2]))
            now = None
        before, moves_before = (now[0], now[2]) if now else (m.opening_qty, 0)
        held[key] = (before + m.quantity, m.moved_at, moves_before + 1)
        if before >= 0 > before + m.quantity:
            out.append((*key, "negative", m.moved_at, before + m.quantity, moves_before + 1))
    return out + [(*key, "settled", t, q, n) for key, (q, t, n) in held.items() if t + idle < watermark], len(held)


@pytest.mark.parametrize("files", [1, 2, 7])
def test_stock_below_zero_and_idle_keys(spark, tmp_path, files):
    moves, idle = stock_moves(spark), timedelta(days=4)
    inbox = str(tmp_path / "in")
    deliver(moves, files, "moved_at", inbox)
    found = stateful.stock_events(run.read_stream(spark, inbox, moves.schema, 1), str(tmp_path / "out"), "1 DAYS", idle)
    got = sorted((r.warehouse_id, r.product_id, r.kind, r.at, float(r.on_hand), r.moves) for r in found.rows.collect())
    want, keys = stock_by_hand(moves, idle, moves.agg(F.max("moved_at")).first()[0] - timedelta(days=1))
    assert got == sorted(want) and {r[2] for r in got} == {"negative", "settled"} and found.late["moves"].isEmpty()
    assert found.state_rows()[-1] < 2 * keys  # idle keys have left, with their timers


def test_stock_goes_on_after_a_stop(spark, tmp_path):
    moves, idle = stock_moves(spark), timedelta(days=4)
    for at_day in ("2024-01-11", "2024-03-01"):
        part = moves.where(F.col("moved_at") < at_day) if at_day == "2024-01-11" else moves.where("moved_at >= '2024-01-11'")
        deliver(part, 2, "moved_at", str(tmp_path / "in"))
        found = stateful.stock_events(run.read_stream(spark, str(tmp_path / "in"), moves.schema, 1), str(tmp_path / "out"), "1 DAYS", idle)
    got = sorted((r.warehouse_id, r.product_id, r.kind, r.at, float(r.on_hand), r.moves) for r in found.rows.collect())
    assert got == sorted(stock_by_hand(moves, idle, moves.agg(F.max("moved_at")).first()[0] - timedelta(days=1))[0])


def test_stock_of_many_keys_is_a_table(spark, tmp_path):
    """Twenty thousand keys over five batches, some moves late: the state is written anew, and only the last two are kept."""
    moves = spark.range(100_000).select(
        (F.col("id") % 20_000).alias("warehouse_id"), F.lit(1).cast("bigint").alias("product_id"), F.col("id").cast("string").alias("move_id"),
        F.lit("sale_delivery").alias("move_type"), F.lit(-4.0).alias("quantity"), F.lit(10.0).alias("opening_qty"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days=F.expr("int(id div 20000)"))).alias("moved_at"),
    )
    inbox, out = str(tmp_path / "in"), tmp_path / "out"
    deliver(moves, 5, "moved_at", inbox)
    moves.where("id < 7").withColumn("move_id", F.lit("late")).coalesce(1).write.mode("append").parquet(inbox)
    found = stateful.stock_events(run.read_stream(spark, inbox, moves.schema, 1), str(out), "1 DAYS", timedelta(days=2))
    assert [tuple(r) for r in found.rows.groupBy("kind", "at", "on_hand", "moves").count().collect()] == [("negative", at(2), -2, 3, 20_000)]
    assert found.late["moves"].count() == 7
    assert found.state_rows()[-1] == 20_000 and len(list(out.glob("batches/batch_id=*/part=state"))) <= 2


def test_empty_streams(spark, tmp_path):
    orders, payments = orders_and_payments(spark)
    for name, df in (("o", orders), ("p", payments)):
        df.limit(0).write.parquet(str(tmp_path / name))
    streams = [run.read_stream(spark, str(tmp_path / name), df.schema) for name, df in (("o", orders), ("p", payments))]
    found = stateful.pay_within(*streams, str(tmp_path / "out"), *TERMS, delay="36 HOURS")
    assert found.rows.count() == 0 and stateful.settle_late_payments(found, orders.limit(0), payments.limit(0), *TERMS).count() == 0
