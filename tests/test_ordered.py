"""Chunked running totals, neighbours, and first-come decisions against plain sequential loops."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import Window, functions as F

from tradewind.functions import exact_ratio, neighbour_values, occurrence_number, totals_before
from tradewind.operators import greedy, inventory
from tradewind.operators.greedy import accept_groups_in_order, accept_in_order
from tradewind.sources.bindings import Canonical

START = date(2026, 1, 1)


def items(spark, seed, n, keys, days, top):
    rng = random.Random(seed)
    # a third of the rows on one hot key
    rows = [(i, 0 if rng.random() < 0.33 else rng.randrange(keys), START + timedelta(days=rng.randrange(days)), D(rng.randrange(1, top))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id int, key int, day date, amount decimal(18,2)")


def test_totals_equal_a_window(spark):
    _, df = items(spark, 1, 2000, 20, 15, 50)
    df = df.withColumn("block", F.call_function("div", "id", F.lit(100)))
    w = Window.partitionBy("key").orderBy("day", "block", "id").rowsBetween(Window.unboundedPreceding, -1)
    for levels in (["day"], ["day", "block"]):
        got = totals_before(df, ["key"], levels, ["block", "id"], {"t": F.col("amount"), "n": F.lit(1)})
        want = got.withColumn("wt", F.coalesce(F.sum("amount").over(w), F.lit(0))).withColumn("wn", F.count("*").over(w))
        assert want.where("t <> wt OR n <> wn").count() == 0 and want.count() == 2000
    numbered = occurrence_number(df, ["key"], ["day"], ["id"], "position")
    w2 = Window.partitionBy("key").orderBy("day", "id")
    assert numbered.withColumn("p", F.row_number().over(w2)).where("p <> position").count() == 0


def test_neighbours_equal_lag_and_lead(spark):
    _, df = items(spark, 2, 1500, 20, 15, 50)
    w = Window.partitionBy("key").orderBy("day", "id")
    for side, step in (("previous", F.lag), ("next", F.lead)):
        got = neighbour_values(df, ["key"], ["day"], ["id"], ["id", "amount"], side).withColumn("want", step("id").over(w))
        assert got.where(~F.col("want").eqNullSafe(F.col(f"{side}_id"))).count() == 0 and got.count() == 1500


def test_ratio_ties(spark):
    df = spark.createDataFrame([(D("74.375"), D(1)), (D("-74.375"), D(1)), (D(1), D(3)), (D(1), D(0))], "a decimal(18,3), b decimal(18,3)")
    for got in (exact_ratio("a", "b", 2), exact_ratio(F.col("a"), F.col("b"), 2)):
        assert [r[0] for r in df.select(got).collect()] == [D("74.38"), D("-74.38"), D("0.33"), None]


def test_accept_in_order(spark):
    rows, df = items(spark, 3, 600, 12, 30, 40)
    limit = {k: 60 * (k + 1) for k in range(12)}
    df = df.withColumn("cap", (F.col("key") + 1) * 60)
    got = accept_in_order(df, ["key"], ["day"], ["id"], F.col("amount"), F.col("cap").cast("decimal(18,2)"))
    used, want = defaultdict(int), {}
    for i, key, day, amount in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = used[key] + amount <= limit[key]
        used[key] += amount if want[i] else 0
    assert {r.id: r.accepted for r in got.collect()} == want
    assert 0 < sum(want.values()) < len(want)


def test_small_keys_take_no_rounds(spark, monkeypatch):
    """Items of small keys are moved once; a key with too many items is settled beside them, by the rounds."""
    rows, df = items(spark, 4, 240, 24, 30, 40)

    def decide():
        got = accept_in_order(df, ["key"], ["day"], ["id"], F.col("amount"), F.lit(70).cast("decimal(18,2)"))
        return {r.id: r.accepted for r in got.collect()}

    used, want = defaultdict(int), {}
    for i, key, day, amount in sorted(rows, key=lambda r: (r[2], r[0])):
        want[i] = used[key] + amount <= 70
        used[key] += amount if want[i] else 0
    sizes = sorted(Counter(key for _, key, _, _ in rows).values())
    with monkeypatch.context() as few:
        few.setattr(greedy, "FEW_ITEMS", sizes[len(sizes) // 2])
        assert sizes[0] < sizes[-1] and decide() == want
    monkeypatch.setattr(greedy, "in_chunks", lambda *a: pytest.fail("rounds for small keys"))
    assert decide() == want and 0 < sum(want.values()) < len(want)


def test_unknown_items_are_refused_and_use_nothing(spark):
    rows = [
        (1, 1, START, D("3.0004")), (2, 1, START + timedelta(days=1), D("3.0004")), (3, None, START, D(9)), (4, None, START, D(9)),
        (5, 1, None, D(1)), (6, 1, START, None), (7, 1, START + timedelta(days=2), D("3.0001")), (8, 2, START, D(5)),
    ]
    df = spark.createDataFrame(rows, "id int, key int, day date, amount decimal(18,4)")
    got = accept_in_order(df, ["key"], ["day"], ["id"], F.col("amount"), F.lit(D("6.0005")).cast("decimal(18,4)")).collect()
    assert {r.id: r.accepted for r in got} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: True, 8: True}


def test_one_hot_moment(spark):
    """All rows on one key and day: totals, neighbours and decisions, without a Python worker."""
    n = 60_000
    df = spark.range(n).select(
        F.col("id"), F.lit(7).alias("key"), F.lit(START).alias("day"), (F.col("id") % 5 + 1).cast("decimal(18,2)").alias("amount")
    ).repartition(6)
    got = totals_before(df, ["key"], ["day"], ["id"], {"t": F.col("amount")})
    assert got.agg(F.count("*"), F.max("t"), F.min("t")).first()[:] == (n, 3 * n - 5, 0)
    lagged = neighbour_values(df, ["key"], ["day"], ["id"], ["id"])
    assert lagged.where("previous_id = id - 1").count() == n - 1
    decided = accept_in_order(df, ["key"], ["day"], ["id"], F.col("amount"), F.lit(1000).cast("decimal(18,2)"))
    used, want = 0, []
    for i in range(n):
        if used + i % 5 + 1 <= 1000:
            used += i % 5 + 1
            want.append(i)
    assert sorted(r.id for r in decided.where("accepted").select("id").collect()) == want
    assert "Arrow" not in decided._jdf.queryExecution().toString()


def test_rows_without_key_or_date_are_kept(spark):
    rows = [(1, None, START, D(1)), (2, None, START, D(2)), (3, 5, None, D(3)), (4, 5, START, D(4)), (5, None, None, D(5))]
    df = spark.createDataFrame(rows, "id int, key int, day date, amount decimal(18,2)")
    got = {r.id: r.t for r in totals_before(df, ["key"], ["day"], ["id"], {"t": F.col("amount")}).collect()}
    assert got == {5: 0, 1: 5, 2: 6, 3: 0, 4: 3}
    near = {r.id: r.previous_id for r in neighbour_values(df, ["key"], ["day"], ["id"], ["id"]).collect()}
    assert near == {5: None, 1: 5, 2: 1, 3: None, 4: 3}
    demand = spark.createDataFrame([(1, None, 1, D(5), D(6)), (2, START, 1, D(5), D(6)), (3, START, 1, D(5), D(6))], "grp int, day date, key int, quantity decimal(18,3), free decimal(18,3)")
    served = accept_groups_in_order(demand, "grp", ["key"], ["day"], "quantity", "free").collect()
    assert {r.grp: r.accepted for r in served} == {1: False, 2: True, 3: False}


def test_accept_groups_in_order(spark):
    rng = random.Random(4)
    demand = [
        (g, START + timedelta(days=rng.randrange(20)), k, rng.randrange(1, 9))
        for g in range(150) for k in rng.sample(range(25), rng.randrange(1, 5))
    ]
    day = {}
    demand = [(g, day.setdefault(g, d), k, q) for g, d, k, q in demand]
    stock = {k: 12 + 3 * k for k in range(24)}  # key 24 has no stock row
    rows = [(g, d, k, D(q), D(stock[k]) if k in stock else None) for g, d, k, q in demand]
    df = spark.createDataFrame(rows, "grp int, day date, key int, quantity decimal(18,3), free decimal(18,3)")
    got = {r.grp: r.accepted for r in accept_groups_in_order(df, "grp", ["key"], ["day"], "quantity", "free").collect()}
    left, want = dict(stock), {}
    for g in sorted(day, key=lambda g: (day[g], g)):
        lines = [(k, q) for gg, _, k, q in demand if gg == g]
        want[g] = all(k in left and left[k] >= q for k, q in lines)
        if want[g]:
            for k, q in lines:
                left[k] -= q
    assert got == want and 0 < sum(want.values()) < len(want)


def test_reservation_of_the_given_tables(spark):
    c = Canonical(spark, "/root/testdata/sf0.001")
    orders = c.sales_orders.where("order_status <> 'cancelled'")
    got = {r.order_id: r.reject_reason for r in inventory.reserve_orders(orders, c.sales_order_lines, c.stock_balances).collect()}
    stock = {(r.warehouse_id, r.product_id): r.on_hand_qty - r.reserved_qty for r in c.stock_balances.collect()}
    demand = defaultdict(lambda: defaultdict(int))
    for r in c.sales_order_lines.select("order_id", "warehouse_id", "product_id", "quantity").collect():
        demand[r.order_id][(r.warehouse_id, r.product_id)] += r.quantity
    want = {}
    for r in sorted(orders.select("order_date", "order_id").collect()):
        asked = demand.get(r.order_id)
        if not asked:
            want[r.order_id] = "no_order_lines"
        elif all(stock[k] >= q for k, q in asked.items()):
            want[r.order_id] = None
            for k, q in asked.items():
                stock[k] -= q
        else:
            want[r.order_id] = "insufficient_stock"
    assert got == want


def test_maxima_equal_a_window(spark):
    from tradewind.functions import in_chunks, maxima_in_chunks

    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"),
        F.col("id").alias("place"), (F.xxhash64("id") % 1000).alias("v"),
    ).repartition(6)
    got = maxima_in_chunks(in_chunks(rows, ["k", "place"]), ["k"], ["place"], F.col("v"), "top").select("k", "place", "top")
    before = Window.partitionBy("k").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.select("k", "place", F.max("v").over(before).alias("top"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == 3000


def test_only_keys_in_several_chunks_are_carried_over(spark):
    """A hot key and a hot NULL key among single rows: only those two meet other chunks, and all totals are those of a plain walk."""
    from tradewind.functions import prefix

    rows = [(None if n % 3 == 0 else 7 if n % 3 == 1 else 1000 + n, n, n % 5) for n in range(6000)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    chunked = prefix.in_chunks(df.repartition(4), ["k", "t"])
    chunks = {}
    for r in chunked.collect():
        chunks.setdefault(r.k, set()).add(r[prefix.CHUNK])
    several = {k for k, own in chunks.items() if len(own) > 1}
    spread = prefix._spread(chunked, ["k"])
    assert {r.k for r in spread.select("k").distinct().collect()} == several
    got = {r.t: (r.k, r.before) for r in prefix.totals_in_chunks(chunked, ["k"], ["t"], {"before": F.col("v")}).collect()}
    seen, want = {}, {}
    for k, n, v in rows:
        want[n] = (k, seen.get(k, 0))
        seen[k] = seen.get(k, 0) + v
    assert got == want


def test_moves_of_the_ledger_move_once(spark, monkeypatch):
    """Small keys go by key through one exchange, also for the opening balance; large ones through chunks, with the same totals."""
    from tradewind.functions import prefix

    rng = random.Random(9)
    keys = [(1, 1), (1, 2), (2, 1), (None, 1), (3, None)]
    moves = [(f"m{n:04}", *rng.choice(keys), rng.choice(["sale_reservation", "sale_delivery", "receipt"]), START + timedelta(days=rng.randrange(9)), D(rng.randrange(-9, 9))) for n in range(400)]
    moves += [(f"hot{n:04}", 7, 7, "sale_delivery", START, D(-1)) for n in range(300)] + [("none", 1, 1, "receipt", None, None)]
    ledger = spark.createDataFrame(moves, "stock_move_id string, warehouse_id bigint, product_id bigint, move_type string, move_date date, quantity decimal(18,3)")
    opening = spark.createDataFrame([(1, 1, D(5), D(1)), (1, 2, D(7), D(2)), (1, 2, D(8), D(3)), (7, 7, D(9), D(0)), (None, 1, D(4), D(4))], "warehouse_id bigint, product_id bigint, on_hand_qty decimal(18,3), reserved_qty decimal(18,3)")
    want, seen, opened = [], defaultdict(lambda: [0, 0]), [tuple(r) for r in opening.collect()]
    for m, w, p, kind, day, q in sorted(moves, key=lambda r: (r[4] is not None, r[4] or START, r[0])):
        for ow, op, hand, held in opened:
            if (ow, op) == (w, p) and None not in (w, p):
                want.append((m, hand + seen[w, p][0], held + seen[w, p][1]))
        if None in (w, p) or (w, p) not in {(1, 1), (1, 2), (7, 7)}:
            want.append((m, *seen[w, p]))
        seen[w, p][0] += 0 if kind == "sale_reservation" else q or 0
        seen[w, p][1] += {"sale_reservation": -(q or 0), "sale_delivery": q or 0}.get(kind, 0)
    for large in (1_000_000, 150):
        monkeypatch.setattr(prefix, "LARGE_KEY", large)
        got = inventory.ledger_running(opening, ledger)
        assert sorted((r.stock_move_id, r.on_hand_before, r.reserved_before) for r in got.collect()) == sorted(want)
        if large > 400:
            plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert plan.count("Exchange hashpartitioning(warehouse_id") <= 2
