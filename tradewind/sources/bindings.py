"""The given tables expressed as the canonical model.

Only projections, joins and small arithmetic; no id needs a window or a sort.
A line has no unique number of its own, so its id is the text of its natural
columns, which costs no shuffle and stays the same on every read.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tradewind.functions import MONEY, QUANTITY, round_money
from tradewind.session import estimate_sizes, stage_table
from tradewind.sources.tables import inline_values

# fixed values: sales channels (id, code, name, type)
CHANNELS = [
    (1, "STORE", "Retail Store", "offline"),
    (2, "WEB", "Website", "online"),
    (3, "MKT", "Marketplace", "online"),
    (4, "B2B", "B2B Sales", "direct_sales"),
    (5, "SOCIAL", "Social Commerce", "online"),
]

# fixed values: categories (id, parent, code, name, level)
CATEGORIES = [
    (1, None, "CORE", "Core range", 1),
    (2, 1, "ECONOMY", "Economy", 2),
    (3, 1, "LARGE", "Large", 2),
    (4, 1, "MEDIUM", "Medium", 2),
    (5, 1, "SMALL", "Small", 2),
    (6, 1, "STANDARD", "Standard", 2),
    (7, None, "PROMO", "Promotional", 1),
]

# fixed values: segments (id, code, name)
SEGMENTS = [
    (1, "AUTOMOBILE", "Automobile"),
    (2, "BUILDING", "Building"),
    (3, "FURNITURE", "Furniture"),
    (4, "HOUSEHOLD", "Household"),
    (5, "MACHINERY", "Machinery"),
]

# fixed value: so many order lines are behind the rows of one task, where rows are dealt by number
LINES_PER_TASK = 250_000

_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def _id(c: str) -> Column:
    return F.col(c).cast("bigint")


def _lookup(column: str, pairs: list[tuple[str, int]]) -> Column:
    out = F.when(F.col(column) == pairs[0][0], pairs[0][1])
    for code, value in pairs[1:]:
        out = out.when(F.col(column) == code, value)
    return out


class Canonical:
    """Lazy canonical tables over one folder of the given Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        estimate_sizes(spark)

    def raw(self, name: str) -> DataFrame:
        """Scan of a given table; the schema is read from the file footers once per session."""
        path = f"{self.folder}/{name}.parquet"
        key = (self.spark.sparkContext.applicationId, path)
        if key not in _SCHEMAS:
            _SCHEMAS[key] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[key]).parquet(path)

    @cached_property
    def line_tasks(self) -> int:
        """Over how many tasks stock keys are dealt; it grows with the lines, which are counted from the file footers.

        Partitions sized by their bytes would hold millions of such short rows, several times as large in memory.
        """
        return max(self.spark.sparkContext.defaultParallelism, -(-self.raw("lineitem").count() // LINES_PER_TASK))

    def with_lines_staged(self) -> Canonical:
        """Write the order lines once, with the costs of their products; every table derived from them then reads the copy.

        A line has a list with one cost per row of its product, so all lines stay, and no later table meets the products again.
        """
        costs = self.products.groupBy("product_id").agg(F.collect_list(F.struct("standard_cost")).alias("__costs"))
        columns = self._lines_only.columns
        staged = stage_table(self._lines_only.join(costs, "product_id", "left").select(*columns, "__costs"), "lines")
        self.__dict__["_lines_only"] = staged.select(*columns)
        self.__dict__["_lines_costed"] = staged.withColumn("__cost", F.explode("__costs")).select(*columns, "__cost.standard_cost")
        return self

    def _inline(self, rows: list[tuple], ddl: list[tuple[str, T.DataType]]) -> DataFrame:
        return inline_values(self.spark, rows, T.StructType([T.StructField(n, t) for n, t in ddl]))

    # masters -------------------------------------------------------------

    @cached_property
    def companies(self) -> DataFrame:
        text = T.StringType()
        columns = [("company_id", T.LongType()), ("company_code", text), ("company_name", text),
                   ("country", text), ("currency", text), ("is_active", T.BooleanType())]
        return self._inline([(1, "MAIN", "Main Company", "Vietnam", "VND", True)], columns)

    @cached_property
    def sales_channels(self) -> DataFrame:
        text = T.StringType()
        columns = [("channel_id", T.LongType()), ("channel_code", text), ("channel_name", text), ("channel_type", text)]
        return self._inline(CHANNELS, columns).withColumn("is_active", F.col("channel_id") != 5)

    @cached_property
    def carriers(self) -> DataFrame:
        """One carrier per nation; the service level goes by its number."""
        level = F.get(F.array(F.lit("standard"), F.lit("same_day"), F.lit("b2b_freight"), F.lit("express")), (F.col("n_nationkey") % 4).cast("int"))
        return self.raw("nation").select(
            (_id("n_nationkey") + 1).alias("carrier_id"),
            F.concat(F.lit("CAR-"), "n_nationkey").alias("carrier_code"),
            F.concat("n_name", F.lit(" Lines")).alias("carrier_name"),
            level.alias("service_level"),
            F.lit(True).alias("is_active"),
        )

    @cached_property
    def customer_segments(self) -> DataFrame:
        columns = [("segment_id", T.LongType()), ("segment_code", T.StringType()), ("segment_name", T.StringType())]
        return self._inline(SEGMENTS, columns).withColumn("description", F.lit(None).cast("string"))

    @cached_property
    def product_categories(self) -> DataFrame:
        columns = [("category_id", T.LongType()), ("parent_category_id", T.LongType()), ("category_code", T.StringType()),
                   ("category_name", T.StringType()), ("level", T.IntegerType())]
        return self._inline(CATEGORIES, columns).withColumn("is_active", F.lit(True))

    @cached_property
    def promotions(self) -> DataFrame:
        """One promotion per region, each in a channel and a stretch of time of its own."""
        number = F.col("r_regionkey").cast("int")
        start = F.date_add(F.lit("1995-07-01").cast("date"), number * 150)
        percent = number % 2 == 0
        return self.raw("region").select(
            (_id("r_regionkey") + 1).alias("promotion_id"),
            F.concat(F.lit("PRO-"), "r_regionkey").alias("promotion_code"),
            F.concat("r_name", F.lit(" offer")).alias("promotion_name"),
            (_id("r_regionkey") % 5 + 1).alias("channel_id"),
            start.alias("start_date"),
            F.date_add(start, 700).alias("end_date"),
            F.when(percent, "percent").otherwise("fixed_amount").alias("discount_type"),
            F.when(percent, 4 + 3 * number).otherwise(700 + 150 * number).cast(MONEY).alias("discount_value"),
            F.lit(0).cast(MONEY).alias("budget_amount"),
            F.lit(True).alias("is_active"),
        )

    @cached_property
    def _places(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
            _id("n_nationkey").alias("branch_id"), F.col("n_name").alias("city"), F.col("r_name").alias("region")
        )

    @cached_property
    def branches(self) -> DataFrame:
        return self._places.select(
            "branch_id",
            F.lit(1).cast("bigint").alias("company_id"),
            F.concat(F.lit("BR-"), "branch_id").alias("branch_code"),
            F.col("city").alias("branch_name"),
            "city",
            "region",
            (F.col("branch_id") % 10 != 9).alias("is_active"),
        )

    @cached_property
    def warehouses(self) -> DataFrame:
        places = self._places.select("branch_id", "city")
        return (
            self.raw("supplier")
            .select(_id("s_suppkey").alias("warehouse_id"), _id("s_nationkey").alias("branch_id"), F.col("s_name").alias("warehouse_name"))
            .join(places, "branch_id", "left")
            .select(
                "warehouse_id",
                F.lit(1).cast("bigint").alias("company_id"),
                "branch_id",
                F.concat(F.lit("WH-"), "warehouse_id").alias("warehouse_code"),
                "warehouse_name",
                "city",
                F.lit(True).alias("is_active"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        segment = _lookup("c_mktsegment", [(code, key) for key, code, _ in SEGMENTS])
        return (
            self.raw("customer")
            .select(
                _id("c_custkey").alias("customer_id"),
                segment.cast("bigint").alias("segment_id"),
                F.concat(F.lit("CUS-"), "c_custkey").alias("customer_code"),
                F.col("c_name").alias("customer_name"),
                F.when(F.col("c_custkey") % 2 == 0, "individual").otherwise("business").alias("customer_type"),
                _id("c_nationkey").alias("branch_id"),
                (F.col("c_acctbal") >= 0).alias("is_active"),
            )
            .join(self._places, "branch_id", "left")
            .select("customer_id", "segment_id", "customer_code", "customer_name", "customer_type", "city", "region", "is_active")
        )

    @cached_property
    def products(self) -> DataFrame:
        category = _lookup("p_type", [(code, key) for key, _, code, _, _ in CATEGORIES])
        price = F.col("p_retailprice").cast(MONEY)
        life = F.when(F.col("p_size") % 4 == 0, 90).when(F.col("p_size") % 4 == 1, 180).when(F.col("p_size") % 4 == 2, 365)
        return self.raw("part").select(
            _id("p_partkey").alias("product_id"),
            category.cast("bigint").alias("category_id"),
            F.concat(F.lit("P-"), "p_partkey").alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("brand"),
            F.lit("each").alias("unit_of_measure"),
            round_money(price * F.lit("0.50").cast("decimal(3,2)")).alias("standard_cost"),
            price.alias("list_price"),
            life.alias("shelf_life_days"),
            (F.col("p_partkey") % 97 != 0).alias("is_active"),
        )

    @cached_property
    def price_lists(self) -> DataFrame:
        """One price per product, channel and year, and a cheaper second half on every third product."""
        from tradewind.operators.commerce import price_matrix

        sold_in = F.explode(F.array(*[F.lit(channel).cast("bigint") for channel, *_ in CHANNELS]))
        base = price_matrix(self.products.select("product_id", sold_in.alias("channel_id")), self.products, self.sales_channels)
        spans = (
            base.withColumn("year", F.explode(F.sequence(F.lit(1995), F.lit(2001))))
            .where((F.col("year") != 2001) | (F.col("product_id") % 7 != 0))
            .withColumn("half", F.explode(F.when(F.col("product_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        )
        slot = ((F.col("product_id") * 5 + F.col("channel_id") - 1) * 7 + F.col("year") - 1995) * 2 + F.col("half")
        cheaper = round_money(F.col("unit_price") * F.lit("0.95").cast("decimal(3,2)"))
        return spans.select(
            slot.alias("price_list_id"),
            "product_id",
            "channel_id",
            F.when(F.col("half") == 1, F.make_date("year", F.lit(7), F.lit(1))).otherwise(F.make_date("year", F.lit(1), F.lit(1))).alias("valid_from"),
            F.make_date("year", F.lit(12), F.lit(31)).alias("valid_to"),
            F.when(F.col("half") == 1, cheaper).otherwise(F.col("unit_price")).alias("unit_price"),
            F.lit("VND").alias("currency"),
            F.lit(True).alias("is_active"),
        )

    # transactions ---------------------------------------------------------

    @cached_property
    def sales_orders(self) -> DataFrame:
        """Order headers; their totals come from `commerce.order_totals`."""
        status = (
            F.when(F.col("o_orderkey") % 50 == 0, "cancelled")
            .when(F.col("o_orderstatus") == "F", "paid")
            .when(F.col("o_orderstatus") == "P", "fulfilled")
            .otherwise("confirmed")
        )
        return self.raw("orders").select(
            _id("o_orderkey").alias("order_id"),
            F.lit(1).cast("bigint").alias("company_id"),
            (F.col("o_custkey") % 25).cast("bigint").alias("branch_id"),
            _id("o_custkey").alias("customer_id"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("channel_id"),
            F.concat(F.lit("SO-"), "o_orderkey").alias("order_number"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            status.alias("order_status"),
            F.lit("VND").alias("currency"),
        )

    @cached_property
    def _lines_only(self) -> DataFrame:
        gross = F.col("l_extendedprice").cast(MONEY)
        cents = (gross * 100).cast("bigint")
        discount = round_money(gross * F.abs("l_discount").cast("decimal(4,2)"))
        quantity = F.col("l_quantity").cast(QUANTITY)
        return self.raw("lineitem").select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents).alias("order_line_id"),
            _id("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            _id("l_partkey").alias("product_id"),
            _id("l_suppkey").alias("warehouse_id"),
            F.nullif(F.col("l_linenumber") % 6, F.lit(0)).cast("bigint").alias("promotion_id"),
            quantity.alias("quantity"),
            gross.alias("gross_amount"),
            discount.alias("discount_amount"),
            (gross - discount).cast(MONEY).alias("net_amount"),
            F.col("l_returnflag").alias("return_flag"),
        )

    @cached_property
    def _lines_costed(self) -> DataFrame:
        """The lines of known products, with `standard_cost`."""
        return self._lines_only.join(self.products.select("product_id", "standard_cost"), "product_id")

    @cached_property
    def sales_order_lines(self) -> DataFrame:
        price = F.round(F.col("gross_amount") / F.col("quantity"), 2).cast(MONEY)
        return self._lines_costed.select(
            "order_line_id", "order_id", "line_no", "product_id", "warehouse_id", "promotion_id", "quantity",
            price.alias("unit_price"),
            "discount_amount", "gross_amount", "net_amount",
            round_money(F.col("quantity") * F.col("standard_cost")).alias("estimated_cost"),
            "return_flag",
        )

    @cached_property
    def stock_balances(self) -> DataFrame:
        on_hand = (F.col("p_size") * 10).cast(QUANTITY)
        sizes = self.raw("part").select(_id("p_partkey").alias("product_id"), "p_size")
        return (
            self._lines_only.select("warehouse_id", "product_id")
            .repartition(self.line_tasks, "warehouse_id", "product_id")
            .distinct()
            .join(sizes, "product_id")
            .select(
                "warehouse_id", "product_id",
                on_hand.alias("on_hand_qty"),
                F.least(on_hand, F.lit(40).cast(QUANTITY)).alias("reserved_qty"),
                F.lit(80).cast(QUANTITY).alias("reorder_point"),
            )
        )

    @cached_property
    def stock_lots(self) -> DataFrame:
        from tradewind.operators.inventory import lot_rows

        grid = self.stock_balances.select("warehouse_id", "product_id")
        made = F.date_add(F.lit("1995-01-01").cast("date"), ((F.col("product_id") * 7 + F.col("warehouse_id")) % 2400).cast("int"))
        return lot_rows(grid, self.products.where("shelf_life_days IS NOT NULL"), self.warehouses, made, "100")

    @cached_property
    def fulfilment_requests(self) -> DataFrame:
        """When and by which carrier an order was sent."""
        return self.sales_orders.where(F.col("order_status").isin("paid", "fulfilled")).select(
            "order_id",
            F.date_add("order_date", (F.col("order_id") % 4 + 1).cast("int")).alias("fulfillment_date"),
            (F.col("order_id") % 25 + 1).alias("carrier_id"),
        )

    @cached_property
    def shipments(self) -> DataFrame:
        from tradewind.operators.logistics import derive_shipments

        sent = derive_shipments(
            self.sales_orders, self._lines_only, self.carriers, self.fulfilment_requests,
            sendable=("paid", "fulfilled"), keep=("order_status",),
        )
        open_ = F.col("order_status") == "fulfilled"
        return sent.where("reject_reason IS NULL").select(
            F.col("order_id").alias("shipment_id"),
            "order_id", "warehouse_id", "carrier_id",
            F.concat(F.lit("SHP-"), "order_id").alias("shipment_number"),
            "planned_ship_date", "actual_ship_date", "planned_delivery_date",
            F.when(~open_, F.col("actual_delivery_date")).alias("actual_delivery_date"),
            F.when(open_, "in_transit").otherwise("delivered").alias("shipment_status"),
            "shipping_fee",
        )

    @cached_property
    def attempt_requests(self) -> DataFrame:
        """One to three attempts per shipment; some break a rule."""
        path = (
            F.when(F.col("shipment_id") % 100 == 4, "lost")
            .when(F.col("shipment_id") % 4 == 0, "delivered")
            .when(F.col("shipment_id") % 4 == 1, "failed,delivered")
            .when(F.col("shipment_id") % 4 == 2, "rescheduled,failed,delivered")
            .otherwise("failed,returned")
        )
        early = F.when(F.col("shipment_id") % 8 == 1, 1).otherwise(0)
        return (
            self.shipments.select("shipment_id", "planned_ship_date", F.posexplode(F.split(path, ",")).alias("pos", "attempt_status"))
            .select(
                (F.col("shipment_id") * 10 + F.col("pos")).alias("delivery_attempt_id"),
                "shipment_id",
                F.date_add("planned_ship_date", (F.col("pos") - early).cast("int")).alias("attempt_date"),
                "attempt_status",
                F.when(F.col("attempt_status").isin("failed", "returned"), "customer absent").alias("failure_reason"),
                F.when(F.col("shipment_id") % 40 == 8, -1).otherwise(F.col("shipment_id") % 3 * 10000).cast(MONEY).alias("cod_amount"),
            )
        )

    @cached_property
    def delivery_attempts(self) -> DataFrame:
        """The attempt that came with each delivered shipment, and the accepted later ones, numbered after it."""
        from tradewind.operators import logistics

        checked = logistics.validate_attempts(self.attempt_requests, self.shipments)
        recorded = checked.where("reject_reason IS NULL").drop("reject_reason")
        first = logistics.first_attempts(self.shipments.where("shipment_status = 'delivered'"))
        first = first.withColumn("delivery_attempt_id", F.col("shipment_id") * 10 - 1)
        return first.unionByName(logistics.number_attempts(recorded, first))

    @cached_property
    def invoice_lines(self) -> DataFrame:
        from tradewind.operators.finance import derive_invoice_lines

        lines = derive_invoice_lines(self.invoices, self.sales_order_lines)
        return lines.select(F.concat(F.lit("IL-"), "order_line_id").alias("invoice_line_id"), F.col("order_id").alias("invoice_id"), "*")

    @cached_property
    def returns(self) -> DataFrame:
        """The accepted return claims."""
        from tradewind.operators.commerce import validate_returns

        checked = validate_returns(self.return_claims, self._lines_only, self.sales_orders)
        return checked.where("reject_reason IS NULL").drop("reject_reason", "warehouse_id")

    @cached_property
    def invoices(self) -> DataFrame:
        """One open invoice per paid order, dated the day after the order."""
        net = F.sum("net_amount").cast(MONEY)
        sums = self._lines_only.groupBy("order_id").agg(
            F.sum("gross_amount").cast(MONEY).alias("gross_amount"),
            F.sum("discount_amount").cast(MONEY).alias("discount_amount"),
            net.alias("net"),
        )
        tax = round_money(F.col("net") * F.lit("0.08").cast("decimal(3,2)"))
        heads = self.sales_orders.where("order_status = 'paid'").select("order_id", "customer_id", "order_date")
        return heads.join(sums, "order_id").select(
            F.col("order_id").alias("invoice_id"),
            "order_id", "customer_id",
            F.concat(F.lit("INV-"), "order_id").alias("invoice_number"),
            F.date_add("order_date", 1).alias("invoice_date"),
            F.date_add("order_date", 16).alias("due_date"),
            F.lit("open").alias("invoice_status"),
            "gross_amount",
            tax.alias("tax_amount"),
            "discount_amount",
            (F.col("net") + tax).cast(MONEY).alias("net_amount"),
            F.lit(0).cast(MONEY).alias("amount_paid"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """One payment per line of a paid order, asked at 1.2 times its net, so some exceed the invoice."""
        heads = self.sales_orders.where("order_status = 'paid'").select("order_id", "customer_id", "order_date")
        method = F.element_at(
            F.array(*[F.lit(m) for m in ("bank_transfer", "cash", "card", "e_wallet")]), (F.col("line_no") % 4 + 1).cast("int")
        )
        return self._lines_only.join(heads, "order_id").select(
            F.col("order_line_id").alias("payment_id"),
            F.col("order_id").alias("invoice_id"),
            "customer_id",
            F.date_add("order_date", F.col("line_no") - 1).alias("payment_date"),
            method.alias("payment_method"),
            F.when(F.col("return_flag") == "R", "reversed").otherwise("paid").alias("payment_status"),
            round_money(F.col("net_amount") * F.lit("1.2").cast("decimal(2,1)")).alias("amount_paid"),
            F.concat(F.lit("PAY-"), "order_line_id").alias("transaction_reference"),
        )

    @cached_property
    def return_claims(self) -> DataFrame:
        """Three claims per returned line: half, half, and one piece."""
        half = F.ceil(F.col("quantity") / 2).cast(QUANTITY)
        dates = self.sales_orders.select("order_id", "order_date")
        return (
            self._lines_only.where("return_flag = 'R'")
            .join(dates, "order_id")
            .withColumn("claim_no", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
            .select(
                F.concat_ws("-", "order_line_id", "claim_no").alias("return_id"),
                "order_line_id",
                F.date_add("order_date", F.when(F.col("line_no") == 7, F.lit(-1)).otherwise(F.col("claim_no") * 10)).alias("return_date"),
                F.lit("damaged").alias("return_reason"),
                F.when(F.col("claim_no") == 3, F.lit(1).cast(QUANTITY)).otherwise(half).alias("quantity"),
            )
        )

    @cached_property
    def stock_moves(self) -> DataFrame:
        """Receipts, reservations, deliveries and return receipts in one signed ledger."""
        costs = self.products.select("product_id", "standard_cost")
        heads = self.sales_orders.where("order_status <> 'cancelled'").select("order_id", "order_date", "order_status")
        sent = F.col("order_status").isin("paid", "fulfilled")
        back = sent & (F.col("return_flag") == "R")
        kinds = F.array_compact(
            F.array(
                F.lit("sale_reservation"),
                F.when(sent, "sale_delivery"),
                F.when(back, "return_receipt"),
            )
        )
        kind = F.col("move_type")
        sold = (
            self._lines_costed.join(heads, "order_id")
            .withColumn("move_type", F.explode(kinds))
            .select(
                F.concat_ws("-", F.substring("move_type", 1, 6), "order_line_id").alias("stock_move_id"),
                "warehouse_id", "product_id", "order_line_id", "move_type",
                F.date_add(
                    "order_date",
                    F.when(kind == "sale_reservation", F.lit(0)).when(kind == "sale_delivery", (F.col("order_id") % 4 + 1).cast("int")).otherwise(F.lit(10)),
                ).alias("move_date"),
                F.when(kind == "return_receipt", F.ceil(F.col("quantity") / 2).cast(QUANTITY)).otherwise(-F.col("quantity")).cast(QUANTITY).alias("quantity"),
                F.concat(F.lit("SO-"), "order_id").alias("reference_number"),
                "standard_cost",
            )
        )
        received = self.stock_balances.join(costs, "product_id").select(
            F.concat_ws("-", F.lit("purcha"), "warehouse_id", "product_id").alias("stock_move_id"),
            "warehouse_id", "product_id",
            F.lit(None).cast("string").alias("order_line_id"),
            F.lit("purchase_receipt").alias("move_type"),
            F.lit("1994-12-31").cast("date").alias("move_date"),
            F.lit(100).cast(QUANTITY).alias("quantity"),
            F.lit("RECEIPT").alias("reference_number"),
            "standard_cost",
        )
        return received.unionByName(sold).select(
            "stock_move_id", "warehouse_id", "product_id", "order_line_id", "move_type", "move_date", "quantity",
            F.col("standard_cost").alias("unit_cost"),
            round_money(F.col("quantity") * F.col("standard_cost")).alias("move_value"),
            "reference_number",
        )

    @cached_property
    def events(self) -> DataFrame:
        return event_view(self.raw("events"))

    @cached_property
    def run_events(self) -> DataFrame:
        """Pipeline runs read from the event log: ten pipelines, an error event is a failed run."""
        return self.raw("events").select(
            F.col("event_id").alias("run_id"),
            F.concat(F.lit("pipeline-"), F.col("user_id") % 10).alias("pipeline_name"),
            F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
            F.col("event_type").alias("source_system"),
            F.col("ts").cast("timestamp").alias("completed_at"),
            F.round(F.col("value") * 1000).cast("bigint").alias("duration_ms"),
            (F.col("user_id") + 1).cast("bigint").alias("row_count"),
        )


def event_view(raw: DataFrame) -> DataFrame:
    """Event envelope over the event table, for batch and stream alike."""
    return raw.select(
        F.col("event_id"),
        F.col("event_type"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("user_id"),
        F.lit("app").alias("source_system"),
        F.get_json_object("props", "$.k").cast("int").alias("key"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.lit(1).alias("schema_version"),
    )
