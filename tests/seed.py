"""A small, fixed business: masters and two orders, whose results are known by hand."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from tradewind import contracts
from tradewind.operators import commerce, finance, inventory, logistics


class Seed:
    def __init__(self, spark):
        self.spark = spark
        make = lambda rows, ddl: spark.createDataFrame(rows, ddl)
        # fixed values: masters
        self.branches = make(
            [(1, 1, "HN", "Ha Noi", "Ha Noi", "North", True), (2, 1, "HCM", "Ho Chi Minh City", "Ho Chi Minh City", "South", True),
             (3, 1, "DN", "Da Nang", "Da Nang", "Central", True)],
            "branch_id int, company_id int, branch_code string, branch_name string, city string, region string, is_active boolean",
        )
        self.warehouses = make(
            [(1, 1, 1, "WH-HN", "Ha Noi Warehouse", "Ha Noi"), (2, 1, 2, "WH-HCM", "Ho Chi Minh City Warehouse", "Ho Chi Minh City"),
             (3, 1, 3, "WH-DN", "Da Nang Warehouse", "Da Nang")],
            "warehouse_id int, company_id int, branch_id int, warehouse_code string, warehouse_name string, city string",
        )
        self.sales_channels = make(
            [(1, "STORE", "Retail Store", "offline", True), (2, "WEB", "Website", "online", True), (3, "MKT", "Marketplace", "online", True),
             (4, "B2B", "B2B Sales", "direct_sales", True), (5, "SOCIAL", "Social Commerce", "online", True)],
            "channel_id int, channel_code string, channel_name string, channel_type string, is_active boolean",
        )
        # one carrier per service level
        self.carriers = make(
            [(i, level.upper(), f"Carrier {i}", level, True) for i, level in enumerate(contracts.DOMAINS["carriers", "service_level"], 1)],
            "carrier_id int, carrier_code string, carrier_name string, service_level string, is_active boolean",
        )
        self.customer_segments = make([(i, f"SEG-{i}", f"Segment {i}") for i in range(1, 6)], "segment_id int, segment_code string, segment_name string")
        self.customers = make(
            [(i, i, f"CUS-{i:05}", f"Customer {i}", "business" if i > 2 else "individual", f"City {i}", f"Region {i}", True) for i in range(1, 5)],
            "customer_id int, segment_id int, customer_code string, customer_name string, customer_type string, city string, region string, is_active boolean",
        )
        self.product_categories = make(
            [(1, None, "BEVERAGE", "Beverages", 1), (2, 1, "TEA", "Tea", 2), (3, 1, "JUICE", "Juice", 2), (4, None, "SNACK", "Snacks", 1),
             (5, 4, "BISCUIT", "Biscuits", 2)],
            "category_id int, parent_category_id int, category_code string, category_name string, level int",
        )
        # fixed values of the worked results: sku, cost, list price, shelf life
        fixed = [("TEA-LEM-330", 4500, 10000, 365), ("TEA-PEA-330", 4800, 11000, 365), ("JUI-ORA-500", 9000, 21000, 180),
                 ("BIS-OAT-120", 7000, 18000, 270), ("BIS-CHO-120", 7600, 19000, 270)]
        self.products = make(
            [(i, (2, 2, 3, 5, 5)[i - 1], sku, f"Product {i}", "OWN", "each", D(cost), D(price), days, True)
             for i, (sku, cost, price, days) in enumerate(fixed, 1)],
            "product_id int, category_id int, sku string, product_name string, brand string, unit_of_measure string, "
            "standard_cost decimal(18,2), list_price decimal(18,2), shelf_life_days int, is_active boolean",
        )
        year = [F.lit("2026-01-01").cast("date").alias("valid_from"), F.lit("2026-12-31").cast("date").alias("valid_to")]
        self.price_lists = commerce.price_matrix(
            self.products.select("product_id", F.explode(F.array(*map(F.lit, range(1, 6)))).alias("channel_id")), self.products, self.sales_channels
        ).select(
            (F.col("product_id") * 10 + F.col("channel_id")).alias("price_list_id"), "product_id", "channel_id", *year, "unit_price",
            F.lit(True).alias("is_active"),
        )
        august = (date(2026, 8, 1), date(2026, 8, 31))
        # fixed values of the worked results: ten percent in channel 2, five percent in channel 4
        self.promotions = make(
            [(1, "TEN", 2, *august, "percent", D(10), True), (2, "FLAT", 3, *august, "fixed_amount", D(5000), True), (3, "FIVE", 4, *august, "percent", D(5), True)],
            "promotion_id int, promotion_code string, channel_id int, start_date date, end_date date, discount_type string, "
            "discount_value decimal(18,2), is_active boolean",
        )
        self.stock_balances = make(
            [(w, p, D(q), D(0), D(80)) for w, q in ((1, 500), (2, 700), (3, 300)) for p in range(1, 6)],
            "warehouse_id int, product_id int, on_hand_qty decimal(18,3), reserved_qty decimal(18,3), reorder_point decimal(18,3)",
        )
        # fixed values: the two orders
        self.requests = make(
            [(1, 1, 2, 1, "SO-1", date(2026, 8, 1)), (2, 3, 4, 2, "SO-2", date(2026, 8, 2))],
            "order_id int, customer_id int, channel_id int, branch_id int, order_number string, order_date date",
        )
        self.line_requests = make(
            [(1, 1, 1, 1, D(12), None, D(0), 1), (2, 1, 4, 1, D(5), None, D(0), None),
             (3, 2, 2, 2, D(50), D(10000), D(0), 3), (4, 2, 3, 2, D(20), D(20000), D(20000), None)],
            "order_line_id int, order_id int, product_id int, warehouse_id int, quantity decimal(18,3), unit_price decimal(18,2), "
            "discount_amount decimal(18,2), promotion_id int",
        )
        self.fulfilments = make([(1, date(2026, 8, 2), 2), (2, date(2026, 8, 4), 4)], "order_id int, fulfillment_date date, carrier_id int")
        self.invoice_requests = make([(1, date(2026, 8, 2), 15), (2, date(2026, 8, 4), 30)], "order_id int, invoice_date date, due_days int")
        self.payment_requests = make(
            [("p1", 1, date(2026, 8, 3), "e_wallet", D(100000)), ("p2", 2, date(2026, 8, 5), "bank_transfer", D(300000))],
            "payment_id string, invoice_id int, payment_date date, payment_method string, amount_paid decimal(18,2)",
        )
        # the chain
        checked = commerce.validate_orders(self.requests, self.customers, self.sales_channels, self.branches)
        self.drafts = checked.where("reject_reason IS NULL").drop("reject_reason").withColumn("order_status", F.lit("draft"))
        priced = commerce.price_lines(self.line_requests, self.drafts, self.products, self.price_lists, self.promotions)
        self.sales_order_lines = priced.where("reject_reason IS NULL").drop("reject_reason")
        self.sales_orders = commerce.order_totals(self.drafts, self.sales_order_lines)
        self.confirmed = self.sales_orders.withColumn("order_status", F.lit("confirmed"))
        sent = logistics.derive_shipments(self.confirmed, self.sales_order_lines, self.carriers, self.fulfilments)
        self.shipments = sent.where("reject_reason IS NULL").withColumn("shipment_id", F.col("order_id"))
        bills = finance.derive_invoices(self.invoice_requests, self.confirmed, self.requests.select("order_id").limit(0))
        self.invoices = bills.where("reject_reason IS NULL").drop("reject_reason").withColumn("invoice_id", F.col("order_id"))
        self.payments = finance.settle_payments(self.payment_requests, self.invoices).withColumn("payment_status", F.lit("paid"))

    def moves(self):
        heads = self.sales_orders.select("order_id", "order_number", "order_date")
        lines = self.sales_order_lines.join(heads, "order_id").join(self.fulfilments, "order_id")
        reserved = inventory.sale_moves(lines, self.products, "sale_reservation", F.col("order_date"))
        delivered = inventory.sale_moves(lines, self.products, "sale_delivery", F.col("fulfillment_date"))
        return reserved.unionByName(delivered).withColumn("stock_move_id", F.concat_ws("-", "move_type", "order_line_id"))
