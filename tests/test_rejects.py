"""Each rule refuses what it must, with its reason."""

import random
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.seed import Seed
from tradewind.operators import commerce, finance, inventory, logistics, quality, scenarios


@pytest.fixture(scope="module")
def seed(spark):
    return Seed(spark)


def reasons(df, key):
    return {r[key]: r.reject_reason for r in df.collect()}


def test_orders(seed, spark):
    asked = spark.createDataFrame(
        [(1, 1, 1, 9), (2, 9, 1, 1), (3, 1, 9, 1), (4, 1, 1, 1)], "order_id int, customer_id int, channel_id int, branch_id int"
    )
    got = commerce.validate_orders(asked, seed.customers, seed.sales_channels, seed.branches)
    assert reasons(got, "order_id") == {1: "invalid_branch", 2: "invalid_customer", 3: "invalid_channel", 4: None}


def test_lines(seed, spark):
    money = lambda x: None if x is None else D(x)
    cases = [
        (1, 1, 1, "0", None, "0", None, "quantity_not_positive"),
        (2, 9, 1, "1", None, "0", None, "unknown_order"),
        (3, 1, 9, "1", None, "0", None, "invalid_product"),
        (4, 1, 1, "1", "-1", "0", None, "negative_price"),
        (5, 1, 1, "1", None, "0", 3, "invalid_promotion"),  # promotion of another channel
        (6, 1, 1, "1", None, "10001", None, "invalid_discount"),
        (7, 1, 1, "1", None, "0", 1, None),
        (8, 1, 1, "1", None, "5", 3, "invalid_promotion"),  # a manual discount does not save it
    ]
    asked = spark.createDataFrame(
        [(i, o, p, 1, D(q), money(u), D(d), pr) for i, o, p, q, u, d, pr, _ in cases],
        "order_line_id int, order_id int, product_id int, warehouse_id int, quantity decimal(18,3), unit_price decimal(18,2), "
        "discount_amount decimal(18,2), promotion_id int",
    )
    got = commerce.price_lines(asked, seed.drafts, seed.products, seed.price_lists, seed.promotions)
    assert reasons(got, "order_line_id") == {c[0]: c[-1] for c in cases}
    closed = commerce.price_lines(asked.where("order_line_id = 7"), seed.confirmed, seed.products, seed.price_lists, seed.promotions)
    assert reasons(closed, "order_line_id") == {7: "order_not_open"}


def test_price_choice(spark):
    prices = spark.createDataFrame(
        [(1, 1, 1, date(2026, 1, 1), date(2026, 12, 31), D(10), True), (2, 1, 1, date(2026, 7, 1), date(2026, 12, 31), D(9), True),
         (3, 1, 1, date(2026, 7, 1), date(2026, 12, 31), D(8), True), (4, 1, 1, date(2026, 8, 1), date(2026, 8, 31), D(7), False)],
        "price_list_id int, product_id int, channel_id int, valid_from date, valid_to date, unit_price decimal(18,2), is_active boolean",
    )
    lines = spark.createDataFrame(
        [(1, 1, 1, date(2026, 3, 1), None, D(11)), (2, 1, 1, date(2026, 8, 5), None, D(11)), (3, 1, 2, date(2026, 8, 5), None, D(11)),
         (4, 1, 1, date(2027, 1, 1), None, D(11)), (5, 1, 1, date(2026, 8, 5), D(3), D(11))],
        "order_line_id int, product_id int, channel_id int, order_date date, unit_price decimal(18,2), list_price decimal(18,2)",
    )
    got = {r.order_line_id: r.resolved_price for r in commerce.resolve_price(lines, prices).collect()}
    assert got == {1: 10, 2: 8, 3: 11, 4: 11, 5: 3}


def test_stock_shortage(seed, spark):
    lines = seed.sales_order_lines.withColumn("quantity", F.when(F.col("order_line_id") == 1, 100000).otherwise(F.col("quantity")).cast("decimal(18,3)"))
    got = inventory.reserve_orders(seed.sales_orders, lines, seed.stock_balances)
    assert reasons(got, "order_id") == {1: "insufficient_stock", 2: None}
    unknown = seed.sales_order_lines.withColumn("warehouse_id", F.when(F.col("order_id") == 2, 9).otherwise(F.col("warehouse_id")))
    assert reasons(inventory.reserve_orders(seed.sales_orders, unknown, seed.stock_balances), "order_id") == {1: None, 2: "insufficient_stock"}
    none = inventory.reserve_orders(seed.sales_orders, seed.sales_order_lines.where("order_id = 1"), seed.stock_balances)
    assert reasons(none, "order_id") == {1: None, 2: "no_order_lines"}


def test_attempts(seed, spark):
    asked = spark.createDataFrame(
        [(1, 1, date(2026, 8, 1), "delivered", D(0)), (2, 1, date(2026, 8, 2), "lost", D(0)), (3, 1, date(2026, 8, 2), "failed", D(-1)),
         (4, 9, date(2026, 8, 2), "failed", D(0)), (5, 1, date(2026, 8, 6), "failed", D(0)), (6, 1, date(2026, 8, 5), "rescheduled", D(0))],
        "delivery_attempt_id bigint, shipment_id int, attempt_date date, attempt_status string, cod_amount decimal(18,2)",
    )
    checked = logistics.validate_attempts(asked, seed.shipments)
    assert reasons(checked, "delivery_attempt_id") == {
        1: "before_planned_ship_date", 2: "invalid_status", 3: "negative_cod", 4: "unknown_shipment", 5: None, 6: None}
    good = checked.where("reject_reason IS NULL")
    assert {r.delivery_attempt_id: r.attempt_number for r in logistics.number_attempts(good).collect()} == {5: 1, 6: 2}
    after = {r.shipment_id: (r.shipment_status, r.actual_delivery_date, r.attempts) for r in logistics.fold_attempts(seed.shipments, good).collect()}
    assert after == {1: ("in_transit", date(2026, 8, 3), 2), 2: ("delivered", date(2026, 8, 5), 0)}


def test_invoices_and_payments(seed, spark):
    early = spark.createDataFrame([(1, date(2026, 7, 1), 15)], "order_id int, invoice_date date, due_days int")
    nothing = seed.invoices.limit(0)
    assert reasons(finance.derive_invoices(early, seed.confirmed, nothing), "order_id") == {1: "before_order_date"}
    again = finance.derive_invoices(seed.invoice_requests, seed.confirmed, seed.invoices.where("order_id = 1"))
    assert reasons(again, "order_id") == {1: "already_invoiced", 2: None}
    drafts = finance.derive_invoices(seed.invoice_requests, seed.sales_orders, nothing)
    assert set(reasons(drafts, "order_id").values()) == {"order_not_billable"}
    paid = spark.createDataFrame(
        [("a", 1, date(2026, 8, 3), "cash", D(213841)), ("b", 1, date(2026, 8, 4), "cash", D(213840)), ("c", 1, date(2026, 8, 5), "cash", D(1)),
         ("d", 1, date(2026, 8, 1), "cash", D(1)), ("e", 1, date(2026, 8, 5), "cash", D(0)), ("f", 9, date(2026, 8, 5), "cash", D(5))],
        "payment_id string, invoice_id int, payment_date date, payment_method string, amount_paid decimal(18,2)",
    )
    settled = finance.settle_payments(paid, seed.invoices)
    assert reasons(settled, "payment_id") == {
        "a": "exceeds_outstanding", "b": None, "c": "exceeds_outstanding", "d": "before_invoice_date", "e": "amount_not_positive", "f": "unknown_invoice"}
    status = {r.invoice_id: (r.invoice_status, r.order_is_paid) for r in finance.invoice_status(seed.invoices, settled).collect()}
    assert status == {1: ("paid", True), 2: ("open", False)}


def test_returns(seed, spark):
    delivered = seed.sales_orders.withColumn("order_status", F.when(F.col("order_id") == 1, "fulfilled").otherwise("confirmed"))
    claims = spark.createDataFrame(
        [("a", 2, date(2026, 8, 9), "x", D(6)), ("b", 2, date(2026, 8, 10), "x", D(3)), ("c", 2, date(2026, 8, 11), "x", D(3)),
         ("d", 2, date(2026, 8, 12), "x", D(2)), ("e", 2, date(2026, 7, 1), "x", D(1)), ("f", 3, date(2026, 8, 9), "x", D(1)), ("g", 9, date(2026, 8, 9), "x", D(1))],
        "return_id string, order_line_id int, return_date date, return_reason string, quantity decimal(18,3)",
    )
    got = commerce.validate_returns(claims, seed.sales_order_lines, delivered)
    assert reasons(got, "return_id") == {
        "a": "exceeds_sold_quantity", "b": None, "c": "exceeds_sold_quantity", "d": None, "e": "before_order_date", "f": "order_not_delivered",
        "g": "unknown_order_line"}
    assert {r.return_id: r.refund_amount for r in got.where("reject_reason IS NULL").collect()} == {"b": 54000, "d": 36000}
    earlier = spark.createDataFrame([(2, D(4), "refunded"), (2, D(9), "rejected")], "order_line_id int, quantity decimal(18,3), return_status string")
    less = commerce.validate_returns(claims, seed.sales_order_lines, delivered, earlier)
    assert reasons(less, "return_id")["b"] == "exceeds_sold_quantity"


def test_lot_rule(spark):
    lots = spark.createDataFrame(
        [("L1", date(2026, 1, 1), date(2025, 1, 1), D(1)), ("L2", date(2026, 1, 1), date(2027, 1, 1), D(1))],
        "lot_number string, manufacturing_date date, expiration_date date, quantity_on_hand decimal(18,3)",
    )
    good, bad = quality.split_rows("stock_lots", lots)
    assert [r.lot_number for r in good.collect()] == ["L2"]
    assert [(r.lot_number, r.failed_rules) for r in bad.collect()] == [("L1", ["expiry_after_manufacture"])]


def test_arguments(seed):
    today = F.current_date()
    with pytest.raises(ValueError):
        inventory.replenish(seed.stock_balances, seed.products, today, min_available=-1)
    with pytest.raises(ValueError):
        inventory.replenish(seed.stock_balances, seed.products, today, replenish_qty=0)


def test_whole_chain(seed, spark):
    """Both orders are invoiced, since their payments are partial; paid in full they end as paid."""
    claims = spark.createDataFrame(
        [("r1", 1, date(2026, 8, 9), "damaged", D(5)), ("r2", 1, date(2026, 8, 10), "damaged", D(8)), ("r3", 3, date(2026, 8, 10), "damaged", D(1))],
        "return_id string, order_line_id int, return_date date, return_reason string, quantity decimal(18,3)",
    )
    out = scenarios.apply_scenario(seed.requests, seed.line_requests, seed.fulfilments, seed.invoice_requests, seed.payment_requests, seed, claims)
    assert {r.order_id: r.order_status for r in out["orders"].collect()} == {1: "invoiced", 2: "invoiced"}
    assert {r.order_id: r.invoice_status for r in out["invoices"].collect()} == {1: "partial", 2: "partial"}
    assert [(r.shipment_id, r.attempt_number, r.attempt_status, r.cod_amount) for r in out["attempts"].orderBy("shipment_id").collect()] == [
        (1, 1, "delivered", 0), (2, 1, "delivered", 0)]
    kinds = {r.move_type: (r.n, r.quantity) for r in out["moves"].groupBy("move_type").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity")).collect()}
    assert kinds == {"sale_reservation": (4, -87), "sale_delivery": (4, -87), "return_receipt": (2, 6)}
    assert {r.return_id: r.return_status for r in out["returns"].collect()} == {"r1": "approved", "r2": "rejected", "r3": "approved"}

    due = [("p1", 1, date(2026, 8, 3), "cash", D(213840)), ("p2", 2, date(2026, 8, 5), "cash", D(1))]
    paid = spark.createDataFrame(due, "payment_id string, invoice_id int, payment_date date, payment_method string, amount_paid decimal(18,2)")
    out = scenarios.apply_scenario(seed.requests, seed.line_requests, seed.fulfilments.limit(0), seed.invoice_requests.where("order_id = 1"), paid, seed)
    assert {r.order_id: r.order_status for r in out["orders"].collect()} == {1: "paid", 2: "confirmed"}
    assert {r.payment_id: r.reject_reason for r in out["payments"].collect()} == {"p1": None, "p2": "unknown_invoice"}


def test_attempts_go_on_after_stored_ones(spark):
    ddl = "delivery_attempt_id int, shipment_id int"
    new = spark.createDataFrame([(5, 1), (7, 1), (6, 2)], ddl)
    stored = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 9, 1)], ddl + ", attempt_number int")
    got = {r.delivery_attempt_id: r.attempt_number for r in logistics.number_attempts(new, stored).collect()}
    assert got == {5: 3, 7: 4, 6: 1}


def test_one_product_with_many_price_ranges(spark):
    """Ten thousand ranges of one product, open ends and ties, against a plain search."""
    rng = random.Random(5)
    day = lambda n: date(2020, 1, 1) + timedelta(days=n)
    ranges = [(i, 1, 1, day(a := rng.randrange(2000)), day(a + rng.randrange(400)), D(i), rng.random() < 0.9) for i in range(10_000)]
    ranges += [(20_000, 1, 1, day(5), date(9999, 12, 31), D(7), True), (20_001, 1, 1, day(5), date(9999, 12, 31), D(8), True), (20_002, 2, 1, day(9), day(3), D(9), True)]
    prices = spark.createDataFrame(ranges, "price_list_id int, product_id int, channel_id int, valid_from date, valid_to date, unit_price decimal(18,2), is_active boolean")
    asked = [(k, 1 + k % 2, 1, day(rng.randrange(3000)), None, D(-1)) for k in range(300)] + [(900, 1, None, day(1), None, D(-1)), (901, 1, 1, None, None, D(-1)), (902, 1, 1, day(9), D(3), D(-1))]
    lines = spark.createDataFrame(asked, "id int, product_id int, channel_id int, order_date date, unit_price decimal(18,2), list_price decimal(18,2)")
    got = {r.id: r.resolved_price for r in commerce.resolve_price(lines, prices).collect()}
    for i, product, channel, on, given, fallback in asked:
        valid = [(f, n, p) for n, pr, ch, f, t, p, ok in ranges if ok and pr == product and ch == channel and on and f <= on <= t]
        assert got[i] == (given if given is not None else max(valid)[2] if valid else fallback), i
    assert len(got) == len(asked)


def test_a_price_range_is_not_repeated_along_its_length(spark):
    """Ranges of any length come once or twice, in buckets that hold all their days."""
    first, lengths = date(1995, 1, 1), [1, 2, 8, 9, 184, 365, 512, 513, 5000, 700_000]
    ranges = spark.createDataFrame(
        [(n, first + timedelta(days=7 * n), first + timedelta(days=7 * n + length - 1)) for n, length in enumerate(lengths)] + [(99, first, date(1994, 1, 1)), (98, None, first)],
        "id int, valid_from date, valid_to date",
    )
    cut = commerce.cut_ranges(ranges).collect()
    assert {r.id for r in cut} == set(range(len(lengths)))
    for n, length in enumerate(lengths):
        own = [r for r in cut if r.id == n]
        assert len(own) <= 2 and own[0]["__width"] >= length
        days = [(r.valid_from - date(1970, 1, 1)).days for r in own[:1]] + [(own[0].valid_to - date(1970, 1, 1)).days]
        assert {day // own[0]["__width"] for day in days} == {r["__bucket"] for r in own}
