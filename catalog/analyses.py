"""Business data products."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base_sql import ratio
from catalog.query import Query
from catalog.rules import STATUS_LOG, _good_attempts, status_log
from catalog.star import AS_OF, warehouse
from tradewind.operators import health, history, inventory, products
from tradewind.sources.bindings import CHANNELS, Canonical


def _as_of():
    return F.lit(AS_OF).cast("date")


def _monthly_sales(c: Canonical):
    sales = warehouse(c).fact_sales_order_lines
    return sales.select("channel_key", "branch_id", F.trunc("date_key", "MM").alias("month"), "net_amount")


def _target_vs_actual(c: Canonical):
    """The target of a month is the same month a year before, plus ten percent."""
    sales = _monthly_sales(c)
    keys = ["channel_key", "branch_id", "month"]
    before = sales.groupBy(*keys).agg(F.sum("net_amount").alias("n"))
    targets = before.select(
        "channel_key", "branch_id", F.add_months("month", 12).alias("month"),
        F.round(F.col("n") * F.lit("1.10").cast("decimal(3,2)"), 2).cast("decimal(24,2)").alias("target_amount"),
    )
    return products.target_vs_actual(targets, sales, keys)


_MONTHLY = "(SELECT channel_key, branch_id, CAST(date_trunc('month', date_key) AS DATE) AS month, sum(net_amount) AS n FROM fact_sales GROUP BY ALL)"


def _receipts(c: Canonical):
    """Each line as a purchase from its supplier; promised after 180 days, received when the line is closed."""
    heads = c.sales_orders.select("order_id", "order_date")
    raw = c.raw("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("decimal(18,3)").alias("ordered_qty"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_linestatus").alias("state"), F.col("l_shipdate").cast("date").alias("shipped_on"),
    )
    closed = (F.col("state") == "F") & (F.col("shipped_on") >= F.col("order_date"))
    return raw.join(heads, "order_id").select(
        "supplier_id", "ordered_qty", "amount",
        F.when(closed, F.col("ordered_qty")).otherwise(0).cast("decimal(18,3)").alias("received_qty"),
        F.col("order_date").alias("ordered_on"),
        F.date_add("order_date", 180).alias("promised_on"),
        F.when(closed, F.col("shipped_on")).alias("received_on"),
    )


_RECEIPTS = """(SELECT l_suppkey AS supplier_id, CAST(l_quantity AS DECIMAL(18,3)) AS ordered_qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    l_linestatus = 'F' AND CAST(l_shipdate AS DATE) >= order_date AS closed, CAST(l_shipdate AS DATE) - order_date AS lead
    FROM lineitem JOIN sales_orders ON order_id = l_orderkey)"""


def _basket(item: str, support: str):
    def build(c: Canonical):
        items = c.products.select("product_id", "sku", "brand")
        return products.market_basket(c.sales_order_lines.join(items, "product_id"), item, support)

    body = f"""(WITH b AS (SELECT DISTINCT order_id, {item} AS item FROM sales_order_lines l JOIN products p ON p.product_id = l.product_id),
      n AS (SELECT count(DISTINCT order_id) AS n, greatest(ceil(count(DISTINCT order_id) * {support}), 1) AS need FROM b),
      f AS (SELECT item, count(*) AS k FROM b GROUP BY item),
      pairs AS (SELECT x.item AS item_a, y.item AS item_b, count(*) AS together FROM b x JOIN b y ON x.order_id = y.order_id AND x.item < y.item
        GROUP BY ALL HAVING count(*) >= (SELECT need FROM n))
      SELECT item_a, item_b, together, {ratio('together', 'n', 6)} AS support, {ratio('together', 'fa.k', 4)} AS confidence_ab,
        {ratio('together', 'fb.k', 4)} AS confidence_ba, {ratio('together * n', 'fa.k * fb.k', 4)} AS lift
      FROM pairs JOIN f fa ON fa.item = item_a JOIN f fb ON fb.item = item_b, n)"""
    return Query(build, "item_a:s item_b:s together:i support:n confidence_ab:n confidence_ba:n lift:n", f"SELECT * FROM {body}")


def _rules(item: str, support: str, size: int):
    def build(c: Canonical):
        items = c.products.select("product_id", "sku", "brand")
        return products.basket_rules(c.sales_order_lines.join(items, "product_id"), item, support, size)

    joins, sets = "b x1", []
    for k in range(1, size + 1):
        if k > 1:
            joins += f" JOIN b x{k} ON x{k}.order_id = x1.order_id AND x{k}.item > x{k - 1}.item"
        names = ", ".join(f"x{j}.item" for j in range(1, k + 1))
        sets.append(f"SELECT [{names}] AS items, count(*) AS together FROM {joins} GROUP BY ALL HAVING count(*) >= (SELECT need FROM n)")
    body = f"""(WITH b AS (SELECT DISTINCT order_id, {item} AS item FROM sales_order_lines l JOIN products p ON p.product_id = l.product_id),
      n AS (SELECT count(DISTINCT order_id) AS n, greatest(ceil(count(DISTINCT order_id) * {support}), 1) AS need FROM b),
      s AS ({' UNION ALL '.join(sets)}),
      r AS (SELECT together, consequent, list_filter(items, lambda x: x <> consequent) AS lhs FROM (SELECT *, unnest(items) AS consequent FROM s WHERE len(items) > 1))
      SELECT array_to_string(lhs, ',') AS items, consequent, r.together, {ratio('r.together', 'n', 6)} AS support, {ratio('r.together', 'g.together', 4)} AS confidence,
        {ratio('r.together * n', 'g.together * f.together', 4)} AS lift
      FROM r JOIN s g ON g.items = lhs JOIN s f ON f.items = [consequent], n)"""
    return Query(build, "items:s consequent:s together:i support:n confidence:n lift:n", f"SELECT * FROM {body}")


def _versions(c: Canonical):
    """Each order tells the channel its customer uses from that day on."""
    return history.scd2_build(c.sales_orders, "customer_id", "order_date", "order_id", ["channel_id"])


_DAILY_CHANNEL = "(SELECT customer_id, order_date AS valid_from, arg_max(channel_id, order_id) AS channel_id FROM sales_orders GROUP BY ALL)"
_VERSIONS = f"""(SELECT customer_id, channel_id, valid_from, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS valid_to
    FROM (SELECT *, lag(channel_id) OVER (PARTITION BY customer_id ORDER BY valid_from) AS before FROM {_DAILY_CHANNEL})
    WHERE before IS NULL OR before <> channel_id)"""


def _point_in_time(c: Canonical):
    # a claim or payment later than the order meets the version of its own day
    facts = c.sales_orders.select("order_id", "customer_id", F.date_add("order_date", (F.col("order_id") % 400).cast("int")).alias("paid_on"))
    return history.point_in_time_join(facts, _versions(c), "customer_id", "paid_on", ["channel_id"])


QUERIES: dict[str, Query] = {
    "b01_target_vs_actual": Query(
        _target_vs_actual,
        "channel_key:i branch_id:i month:d target_amount:n actual_amount:n variance:n attainment:n",
        f"""SELECT *, coalesce(actual_amount, 0) - coalesce(target_amount, 0) AS variance,
        {ratio('coalesce(actual_amount, 0)', 'target_amount', 4)} AS attainment FROM
        (SELECT coalesce(a.channel_key, t.channel_key) AS channel_key, coalesce(a.branch_id, t.branch_id) AS branch_id,
        coalesce(a.month, t.month) AS month, round(t.n * 1.10, 2) AS target_amount, a.n AS actual_amount FROM {_MONTHLY} a
        FULL JOIN (SELECT channel_key, branch_id, CAST(month + INTERVAL 12 MONTH AS DATE) AS month, n FROM {_MONTHLY}) t
        ON t.channel_key = a.channel_key AND t.branch_id = a.branch_id AND t.month = a.month)""",
    ),
    "b02_supplier_performance": Query(
        lambda c: products.supplier_performance(_receipts(c)),
        "supplier_id:i order_lines:i ordered_qty:n received_qty:n avg_purchase_price:n avg_lead_days:n on_time_rate:n fill_rate:n",
        f"""SELECT *, {ratio('amount', 'ordered_qty', 2)} AS avg_purchase_price, {ratio('lead_days', 'received_lines', 2)} AS avg_lead_days,
        {ratio('on_time', 'order_lines', 4)} AS on_time_rate, {ratio('received_qty', 'ordered_qty', 4)} AS fill_rate FROM
        (SELECT supplier_id, count(*) AS order_lines, sum(ordered_qty) AS ordered_qty, sum(CASE WHEN closed THEN ordered_qty ELSE 0 END) AS received_qty,
        sum(amount) AS amount, sum(CASE WHEN closed THEN lead END) AS lead_days, count(*) FILTER (WHERE closed) AS received_lines,
        count(*) FILTER (WHERE closed AND lead <= 180) AS on_time FROM {_RECEIPTS} GROUP BY supplier_id)""",
    ),
    "b03_market_basket_brand": _basket("brand", "0.01"),
    "b03_market_basket_sku": _basket("sku", "0.0002"),
    "b03_basket_rules": _rules("brand", "0.001", 4),
    "b04_purchase_cycle_churn": Query(
        lambda c: products.purchase_cycle(c.sales_orders, _as_of()),
        "customer_id:i order_days:i first_day:d last_day:d avg_cycle_days:n days_silent:i churn_status:s",
        f"""SELECT *, {ratio('(last_day - first_day)', '(order_days - 1)', 2)} AS avg_cycle_days, DATE '{AS_OF}' - last_day AS days_silent,
        CASE WHEN order_days = 1 THEN 'UNKNOWN' WHEN (DATE '{AS_OF}' - last_day) * (order_days - 1) * 4 > (last_day - first_day) * 9 THEN 'AT_RISK'
        ELSE 'ACTIVE' END AS churn_status FROM (SELECT customer_id, count(DISTINCT order_date) AS order_days, min(order_date) AS first_day,
        max(order_date) AS last_day FROM sales_orders GROUP BY customer_id)""",
    ),
    "b05_failed_delivery_rates": Query(
        lambda c: products.failed_delivery_rates(_good_attempts(c), c.shipments, c.sales_orders, c.customers, c.carriers),
        "carrier_code:s region:s is_cod:b grouping:i attempts:i failed:i returned:i failed_rate:n returned_rate:n",
        f"""SELECT *, {ratio('failed', 'attempts', 4)} AS failed_rate, {ratio('returned', 'attempts', 4)} AS returned_rate FROM
        (SELECT carrier_code, region, cod_amount > 0 AS is_cod, grouping(carrier_code, region, cod_amount > 0) AS grouping, count(*) AS attempts,
        count(*) FILTER (WHERE attempt_status = 'failed') AS failed, count(*) FILTER (WHERE attempt_status = 'returned') AS returned
        FROM recorded_attempts a JOIN shipments s ON s.shipment_id = a.shipment_id JOIN sales_orders o ON o.order_id = s.order_id
        JOIN customers c ON c.customer_id = o.customer_id JOIN carriers k ON k.carrier_id = s.carrier_id
        GROUP BY CUBE (carrier_code, region, cod_amount > 0))""",
    ),
    "b06_sales_velocity_safety_stock": Query(
        lambda c: products.sales_velocity(warehouse(c).fact_sales_order_lines).withColumn("safety_stock", F.floor(F.col("safety_stock") * 1000 + 0.5) / 1000),
        "product_key:i date_key:d quantity:n demand_before:n daily_velocity:n is_spike:b safety_stock:n",
        f"""SELECT *, {ratio('demand_before', '28', 3)} AS daily_velocity, demand_before > 0 AND quantity * 28 > demand_before * 3 AS is_spike,
        floor(CAST(1.65 AS DOUBLE) * sqrt(greatest((squares - CAST(demand_before AS DOUBLE) * CAST(demand_before AS DOUBLE) / CAST(28 AS DOUBLE)) / CAST(27 AS DOUBLE), CAST(0 AS DOUBLE)))
          * sqrt(CAST(7 AS DOUBLE)) * 1000 + 0.5) / 1000 AS safety_stock FROM
        (SELECT product_key, date_key, quantity, coalesce(sum(quantity) OVER w, 0) AS demand_before,
        coalesce(sum(CAST(quantity AS DOUBLE) * CAST(quantity AS DOUBLE)) OVER w, 0) AS squares
        FROM (SELECT product_key, date_key, sum(quantity) AS quantity FROM fact_sales GROUP BY ALL)
        WINDOW w AS (PARTITION BY product_key ORDER BY date_key RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))""",
    ),
    "b07_expiring_lots": Query(
        lambda c: products.expiring_lots(c.stock_lots, _as_of()),
        "warehouse_id:i expiry_bucket:s lots:i quantity:n next_expiration:d",
        f"""SELECT warehouse_id, CASE WHEN expiration_date < DATE '{AS_OF}' THEN 'EXPIRED' WHEN expiration_date - DATE '{AS_OF}' <= 30 THEN 'WITHIN_30'
        WHEN expiration_date - DATE '{AS_OF}' <= 90 THEN 'WITHIN_90' ELSE 'LATER' END AS expiry_bucket, count(*) AS lots,
        sum(quantity_on_hand) AS quantity, min(expiration_date) AS next_expiration FROM stock_lots GROUP BY ALL""",
    ),
    "b08_fill_rate": Query(
        lambda c: products.fill_rate(c.sales_order_lines, c.shipments, ["warehouse_id"]),
        "warehouse_id:i ordered_qty:n delivered_qty:n fill_rate:n",
        f"""SELECT *, {ratio('delivered_qty', 'ordered_qty', 4)} AS fill_rate FROM (SELECT l.warehouse_id, sum(quantity) AS ordered_qty,
        sum(CASE WHEN s.order_id IS NOT NULL THEN quantity ELSE 0 END) AS delivered_qty FROM sales_order_lines l
        LEFT JOIN (SELECT * FROM shipments WHERE shipment_status = 'delivered') s ON s.order_id = l.order_id GROUP BY l.warehouse_id)""",
    ),
    "b09_customer_360": Query(
        lambda c: products.customer_360(warehouse(c).fact_sales_order_lines, warehouse(c).dim_customer, [(k, code) for k, code, _, _ in CHANNELS]),
        "customer_code:s segment_code:s net_store:n net_web:n net_mkt:n net_b2b:n net_social:n net_total:n channels_used:i is_omnichannel:b last_order_date:d",
        """SELECT customer_code, segment_code, coalesce(sum(net_amount) FILTER (WHERE channel_key = 1), 0) AS net_store,
        coalesce(sum(net_amount) FILTER (WHERE channel_key = 2), 0) AS net_web, coalesce(sum(net_amount) FILTER (WHERE channel_key = 3), 0) AS net_mkt,
        coalesce(sum(net_amount) FILTER (WHERE channel_key = 4), 0) AS net_b2b, coalesce(sum(net_amount) FILTER (WHERE channel_key = 5), 0) AS net_social,
        sum(net_amount) AS net_total, count(DISTINCT channel_key) AS channels_used, count(DISTINCT channel_key) > 1 AS is_omnichannel,
        max(date_key) AS last_order_date FROM fact_sales f JOIN dim_customer c ON c.customer_key = f.customer_key GROUP BY customer_code, segment_code""",
    ),
    "b10_slow_movers": Query(
        lambda c: products.slow_movers(warehouse(c).fact_sales_order_lines, warehouse(c).dim_product),
        "sku:s product_name:s units_sold:n last_sold_on:d",
        """SELECT sku, product_name, coalesce(sum(quantity), 0) AS units_sold, max(date_key) AS last_sold_on FROM dim_product p
        LEFT JOIN fact_sales f ON f.product_key = p.product_key GROUP BY sku, product_name ORDER BY units_sold, sku LIMIT 20""",
    ),
    "b11_reconciliation": Query(
        lambda c: health.reconcile(
            c.payments.select("invoice_id", F.col("amount_paid").alias("amount")),
            c.invoices.select("invoice_id", F.col("net_amount").alias("amount")),
            ["invoice_id"], "amount", "100",
        ),
        "invoice_id:i left_total:n right_total:n difference:n status:s",
        """SELECT i.invoice_id, p.t AS left_total, i.net_amount AS right_total, p.t - i.net_amount AS difference,
        CASE WHEN abs(p.t - i.net_amount) <= 100 THEN 'match' ELSE 'differs' END AS status FROM invoices i
        JOIN (SELECT invoice_id, sum(amount_paid) AS t FROM payments GROUP BY invoice_id) p ON p.invoice_id = i.invoice_id""",
    ),
    "b12_ops_marts": Query(
        lambda c: products.ops_marts(c.stock_moves, warehouse(c).fact_logistics_shipments),
        "month:d inbound_qty:n outbound_qty:n returned_qty:n shipments:i on_time_rate:n shipping_cost:n cost_per_shipment:n",
        f"""SELECT *, {ratio('on_time', 'shipments', 4)} AS on_time_rate, {ratio('shipping_cost', 'shipments', 2)} AS cost_per_shipment FROM
        (SELECT coalesce(a.month, b.month) AS month, inbound_qty, outbound_qty, returned_qty, shipments, on_time, shipping_cost FROM
        (SELECT CAST(date_trunc('month', move_date) AS DATE) AS month, sum(CASE WHEN move_type = 'purchase_receipt' THEN quantity ELSE 0 END) AS inbound_qty,
        sum(CASE WHEN move_type = 'sale_delivery' THEN -quantity ELSE 0 END) AS outbound_qty,
        sum(CASE WHEN move_type = 'return_receipt' THEN quantity ELSE 0 END) AS returned_qty FROM stock_moves GROUP BY 1) a FULL JOIN
        (SELECT CAST(date_trunc('month', actual_ship_date) AS DATE) AS month, count(*) AS shipments, count(*) FILTER (WHERE is_on_time_delivery) AS on_time,
        sum(shipping_fee) AS shipping_cost FROM fact_shipments GROUP BY 1) b ON a.month = b.month)""",
    ),
    "b13_multi_warehouse_stock": Query(
        lambda c: products.multi_warehouse_stock(
            {"ERP": c.stock_balances, "WMS": inventory.replay_ledger(c.stock_balances, c.stock_moves, c.line_tasks)}, c.line_tasks
        ),
        "source_system:s product_id:i on_hand_qty:n warehouses:i largest_warehouse_qty:n",
        """SELECT 'ERP' AS source_system, product_id, sum(on_hand_qty) AS on_hand_qty, count(*) AS warehouses, max(on_hand_qty) AS largest_warehouse_qty
        FROM stock_balances GROUP BY product_id UNION ALL SELECT 'WMS', product_id, sum(q), count(*), max(q) FROM
        (SELECT b.product_id, b.warehouse_id, b.on_hand_qty + sum(CASE WHEN move_type = 'sale_reservation' THEN 0 ELSE quantity END) AS q
        FROM stock_balances b JOIN stock_moves m ON m.warehouse_id = b.warehouse_id AND m.product_id = b.product_id
        GROUP BY b.product_id, b.warehouse_id, b.on_hand_qty) GROUP BY product_id""",
    ),
    "b14_order_journey": Query(
        lambda c: products.order_journey(status_log(c), 1),
        "order_id:i sequence:i status:s changed_on:d next_status:s days_in_state:i is_late:b",
        f"""SELECT *, coalesce(days_in_state > 1, FALSE) AS is_late FROM (SELECT *, lead(status) OVER w AS next_status,
        lead(changed_on) OVER w - changed_on AS days_in_state FROM {STATUS_LOG} WINDOW w AS (PARTITION BY order_id ORDER BY changed_on, sequence))""",
    ),
    "b15_calendar_drilldown": Query(
        lambda c: products.calendar_drilldown(warehouse(c).fact_sales_order_lines, warehouse(c).dim_date),
        "year:i quarter:i month:i grouping:i orders:i net_revenue:n",
        """SELECT year, quarter, month, grouping(year, quarter, month) AS grouping, count(DISTINCT sales_order_key) AS orders, sum(net_amount) AS net_revenue
        FROM (SELECT year(date_key) AS year, quarter(date_key) AS quarter, month(date_key) AS month, sales_order_key, net_amount FROM fact_sales)
        GROUP BY ROLLUP (year, quarter, month)""",
    ),
    "x04_scd2_build": Query(
        _versions, "customer_id:i channel_id:i valid_from:d valid_to:d is_current:b",
        f"SELECT *, valid_to IS NULL AS is_current FROM {_VERSIONS}",
    ),
    "x04_scd1_build": Query(
        lambda c: history.scd1_build(c.sales_orders, "customer_id", ["order_date", "order_id"], ["channel_id", "order_status"]),
        "customer_id:i channel_id:i order_status:s",
        """SELECT customer_id, arg_max(channel_id, (order_date, order_id)) AS channel_id, arg_max(order_status, (order_date, order_id)) AS order_status
        FROM sales_orders GROUP BY customer_id""",
    ),
    "x05_scd2_point_in_time": Query(
        _point_in_time, "order_id:i customer_id:i paid_on:d channel_id:i",
        f"""SELECT f.*, v.channel_id FROM (SELECT order_id, customer_id, order_date + CAST(order_id % 400 AS INTEGER) AS paid_on FROM sales_orders) f
        LEFT JOIN {_VERSIONS} v ON v.customer_id = f.customer_id AND paid_on >= valid_from AND (valid_to IS NULL OR paid_on < valid_to)""",
    ),
}
