"""Results of the small business against values worked out by hand."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.seed import Seed
from tradewind.operators import commerce, finance, inventory, products, serving
from tradewind.plans.warehouse import Warehouse
from tradewind.sources import bindings


@pytest.fixture(scope="module")
def seed(spark):
    return Seed(spark)


@pytest.fixture(scope="module")
def house(seed):
    return Warehouse(seed, F.lit("2026-08-13").cast("date"))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_lines(seed, house):
    got = rows(house.fact_sales_order_lines, "sales_order_line_key", "unit_price", "gross_amount", "discount_amount", "net_amount",
               "estimated_cost", "gross_margin_amount", "gross_margin_rate")
    want = [
        (1, 10000, 120000, 12000, 108000, 54000, 54000, D("0.5000")),
        (2, 18000, 90000, 0, 90000, 35000, 55000, D("0.6111")),
        (3, 10000, 500000, 25000, 475000, 240000, 235000, D("0.4947")),
        (4, 20000, 400000, 20000, 380000, 180000, 200000, D("0.5263")),
    ]
    assert got == want


def test_totals_and_invoices(seed):
    assert rows(seed.sales_orders, "order_id", "gross_amount", "discount_amount", "net_amount") == [
        (1, 210000, 12000, 198000), (2, 900000, 45000, 855000)]
    status = finance.invoice_status(seed.invoices, seed.payments)
    assert rows(status, "invoice_id", "net_amount", "amount_paid", "invoice_status", "order_is_paid") == [
        (1, 213840, 100000, "partial", False), (2, 923400, 300000, "partial", False)]
    check = finance.invoice_reconcile(seed.invoices, finance.derive_invoice_lines(seed.invoices, seed.sales_order_lines))
    assert rows(check, "order_id", "header_tax", "difference") == [(1, 15840, 0), (2, 68400, 0)]
    assert rows(seed.invoices, "invoice_id", "due_date") == [(1, date(2026, 8, 17)), (2, date(2026, 9, 3))]


def test_shipments(house):
    got = rows(house.fact_logistics_shipments, "sales_order_key", "planned_ship_date", "planned_delivery_date", "actual_ship_date",
               "actual_delivery_date", "shipping_fee", "fulfillment_lead_days", "delivery_lead_days", "is_on_time_delivery")
    day = lambda n: date(2026, 8, n)
    assert got == [
        (1, day(2), day(3), day(2), day(3), 35000, 1, 2, True),
        (2, day(3), day(5), day(4), day(5), 120000, 2, 3, True),
    ]
    assert rows(house.mart_logistics_performance, "carrier_code", "shipments", "avg_fulfillment_lead_days", "avg_delivery_lead_days",
                "on_time_delivery_rate", "shipping_fee") == [("B2B_FREIGHT", 1, 2, 3, 1, 120000), ("EXPRESS", 1, 1, 2, 1, 35000)]


def test_marts(house):
    kpi = house.mart_dashboard_kpis.collect()
    assert [tuple(r) for r in kpi] == [(2, 1053000, 544000, D("0.5166"), 263250, 87)]
    assert rows(house.mart_daily_sales, "date_key", "orders", "net_revenue", "units_sold", "gross_margin") == [
        (date(2026, 8, 1), 1, 198000, 17, 109000), (date(2026, 8, 2), 1, 855000, 70, 435000)]
    channels = serving.sales_by_channel(house.mart_sales_by_channel).collect()
    assert [(r.channel_code, r.net_revenue) for r in channels] == [("B2B", 855000), ("WEB", 198000)]
    top = serving.top_products(house.mart_top_products).collect()
    assert [(r.sku[:7], r.net_revenue) for r in top] == [("TEA-PEA", 475000), ("JUI-ORA", 380000), ("TEA-LEM", 108000), ("BIS-OAT", 90000)]
    assert rows(serving.channel_share(house.mart_sales_by_channel), "channel_code", "revenue_share_pct") == [("B2B", D("81.20")), ("WEB", D("18.80"))]


def test_stock(house):
    alerts = house.mart_inventory_alerts.collect()
    assert len(alerts) == 15 and {r.stock_status for r in alerts} == {"HEALTHY"}
    assert {r.sku for r in alerts if r.shelf_life_status == "SHORT_SHELF_LIFE"} == {"JUI-ORA-500"}
    first = serving.inventory_alerts(house.mart_inventory_alerts).collect()
    assert len(first) == 10 and {r.warehouse_code for r in first[:5]} == {"WH-DN"}
    sold = house.fact_inventory_balance.where("quantity_sold_14d > 0")
    got = rows(sold, "warehouse_key", "product_key", "avg_daily_sales_14d", "days_of_inventory")
    # stock as seeded: no delivery has been booked on these balances
    assert got == [(1, 1, D("0.857"), D("583.33")), (1, 4, D("0.357"), D("1400.00")), (2, 2, D("3.571"), D("196.00")), (2, 3, D("1.429"), D("490.00"))]
    assert house.fact_inventory_balance.where("days_of_inventory IS NULL").count() == 11


def test_stock_after_delivery(seed):
    after = inventory.replay_ledger(seed.stock_balances, seed.moves())
    balances = after.withColumn("reorder_point", F.lit(80).cast("decimal(18,3)"))
    seed2 = type("T", (), {**seed.__dict__, "stock_balances": balances})
    got = rows(Warehouse(seed2).fact_inventory_balance.where("quantity_sold_14d > 0"), "warehouse_key", "product_key", "available_qty", "days_of_inventory")
    assert got == [(1, 1, 488, D("569.33")), (1, 4, 495, D("1386.00")), (2, 2, 650, D("182.00")), (2, 3, 680, D("476.00"))]


def test_stock_keys_are_dealt_by_number(seed, spark, tmp_path, monkeypatch):
    """Tasks of stock keys grow with the lines, and dealt keys give the same balances."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(bindings, "LINES_PER_TASK", 2)
    line = "id AS l_orderkey, id % 7 AS l_partkey, id % 3 AS l_suppkey, 1 AS l_linenumber, 5.0 AS l_quantity, 9.0 AS l_extendedprice, 0.1 AS l_discount, 'N' AS l_returnflag"
    spark.range(62).selectExpr(*line.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(6).selectExpr("id AS p_partkey", "id + 1 AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    c = bindings.Canonical(spark, str(tmp_path))
    assert c.line_tasks == 31 and "31), REPARTITION_BY_NUM" in plan(c.stock_balances)
    assert rows(c.stock_balances, "warehouse_id", "product_id", "on_hand_qty") == sorted((w, p, (p + 1) * 10) for w in range(3) for p in range(6))
    asked = spark.createDataFrame([(1, 1), (1, 1), (77, 1)], "warehouse_id int, product_id int")
    for plain, dealt in (
        (inventory.replay_ledger(seed.stock_balances, seed.moves()), inventory.replay_ledger(seed.stock_balances, seed.moves(), 13)),
        (inventory.ensure_balances(seed.stock_balances, asked), inventory.ensure_balances(seed.stock_balances, asked, 13)),
    ):
        assert "13), REPARTITION_BY_NUM" in plan(dealt) and rows(plain, *plain.columns) == rows(dealt, *plain.columns)
    stock = {"A": seed.stock_balances, "B": seed.stock_balances.where("product_id > 1")}
    plain, dealt = products.multi_warehouse_stock(stock), products.multi_warehouse_stock(stock, 13)
    assert "13), REPARTITION_BY_NUM" in plan(dealt) and rows(plain, *plain.columns) == rows(dealt, *plain.columns)


def test_rfm(seed, house):
    assert rows(house.mart_customer_rfm, "customer_code", "recency_days", "frequency_orders", "monetary_value", "customer_status") == [
        ("CUS-00001", 12, 1, 198000, "ACTIVE"), ("CUS-00003", 11, 1, 855000, "ACTIVE")]
    later = Warehouse(seed, F.lit("2026-09-20").cast("date")).mart_customer_rfm
    assert {r.customer_status for r in later.collect()} == {"AT_RISK"}


def test_dates(house):
    days = house.dim_date.orderBy("date_key").collect()
    assert len(days) == 13 and days[0].day_name == "Sat" and days[0].month_name == "Aug"
    assert sum(d.is_weekend for d in days) == 4


def test_empty_input(seed):
    empty = type("T", (), {**seed.__dict__, "sales_orders": seed.sales_orders.limit(0), "sales_order_lines": seed.sales_order_lines.limit(0)})
    house = Warehouse(empty, F.lit("2026-08-13").cast("date"))
    assert [tuple(r) for r in house.mart_dashboard_kpis.collect()] == [(0, 0, 0, 0, 0, 0)]
    assert house.dim_date.count() == 0 and house.mart_daily_sales.count() == 0
    assert house.fact_inventory_balance.where("quantity_sold_14d = 0 AND days_of_inventory IS NULL").count() == 15


def test_ledger(seed):
    moves = seed.moves()
    assert moves.count() == 8 and moves.agg(F.sum("quantity")).first()[0] == -174
    effects = moves.agg(F.sum(inventory.on_hand_effect()), F.sum(inventory.reserved_effect())).first()
    assert tuple(effects) == (-87, 0)
    assert inventory.ledger_running(seed.stock_balances, moves).where("is_invalid").count() == 0
    assert inventory.deliver_check(seed.stock_balances, moves).where("reject_reason IS NOT NULL").count() == 0
    _, receipts = inventory.replenish(seed.stock_balances, seed.products, F.lit("2026-08-01").cast("date"))
    assert receipts.count() == 0  # 300 is not below 300


def test_evidence(seed):
    got = commerce.status_from_evidence(seed.sales_orders, seed.moves(), seed.shipments, seed.invoices.limit(1))
    assert sorted(r.derived_status for r in got.collect()) == ["fulfilled", "invoiced"]


def test_margin_of_zero_net(seed, spark):
    free = seed.sales_order_lines.withColumn("net_amount", F.lit(0).cast("decimal(18,2)"))
    fact = Warehouse(type("T", (), {**seed.__dict__, "sales_order_lines": free})).fact_sales_order_lines
    assert {r.gross_margin_rate for r in fact.collect()} == {0}
