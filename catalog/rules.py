"""Business rules: commerce, inventory, logistics, finance."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base_sql import TABLES, ratio
from catalog.query import Query
from tradewind.functions import MONEY, QUANTITY
from tradewind.operators import commerce, finance, inventory, logistics
from tradewind.sources.bindings import Canonical

# --- order requests: some name a customer, channel or branch that does not exist or is not active


def _order_requests(c: Canonical):
    return c.sales_orders.select(
        "order_id",
        F.when(F.col("order_id") % 41 == 0, F.col("customer_id") + 10**9).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(F.col("order_id") % 43 == 0, F.lit(9).cast("bigint")).otherwise(F.col("channel_id")).alias("channel_id"),
        "branch_id", "order_date",
    )


_ORDER_CHECK = """SELECT r.*, company_id, CASE WHEN b.branch_id IS NULL THEN 'invalid_branch'
    WHEN c.customer_id IS NULL THEN 'invalid_customer' WHEN h.channel_id IS NULL THEN 'invalid_channel' END AS reject_reason FROM
    (SELECT order_id, CASE WHEN order_id % 41 = 0 THEN customer_id + 1000000000 ELSE customer_id END AS customer_id,
     CASE WHEN order_id % 43 = 0 THEN 9 ELSE channel_id END AS channel_id, branch_id, order_date FROM sales_orders) r
    LEFT JOIN (SELECT * FROM branches WHERE is_active) b ON b.branch_id = r.branch_id
    LEFT JOIN (SELECT * FROM customers WHERE is_active) c ON c.customer_id = r.customer_id
    LEFT JOIN (SELECT * FROM sales_channels WHERE is_active) h ON h.channel_id = r.channel_id"""

# --- line requests (an inactive product has no list price): a manual price on every fifth product, a manual discount on every third warehouse


def _line_requests(c: Canonical):
    lines = c.sales_order_lines
    return lines.select(
        "order_line_id", "order_id", "product_id", "warehouse_id",
        F.when(F.col("quantity") == 13, F.lit(0).cast(QUANTITY)).otherwise(F.col("quantity")).alias("quantity"),
        F.when(F.col("product_id") % 5 == 0, F.col("unit_price")).alias("unit_price"),
        F.when(F.col("warehouse_id") % 3 == 0, F.col("discount_amount")).otherwise(0).cast(MONEY).alias("discount_amount"),
        "promotion_id",
    )


def _orders_taken(c: Canonical):
    """Orders as they were before confirmation, cancelled ones apart."""
    status = F.when(F.col("order_status") == "cancelled", "cancelled").otherwise("draft")
    return c.sales_orders.withColumn("order_status", status)


def _sold_pairs(c):
    heads = c.sales_orders.select("order_id", "channel_id")
    return c.sales_order_lines.select("order_id", "product_id").join(heads, "order_id").select("product_id", "channel_id").distinct()


def _priced(c: Canonical):
    return commerce.price_lines(_line_requests(c), _orders_taken(c), c.products, c.price_lists, c.promotions)


def _line_context(c: Canonical):
    heads = c.sales_orders.select("order_id", "channel_id", "order_date")
    items = c.products.where("is_active").select("product_id", "list_price")
    return _line_requests(c).join(items, "product_id", "left").join(heads, "order_id")


_LINE_REQUESTS = """(SELECT order_line_id, l.order_id, l.product_id, warehouse_id, CASE WHEN quantity = 13 THEN 0 ELSE quantity END AS quantity,
    CASE WHEN l.product_id % 5 = 0 THEN l.unit_price END AS manual_price,
    CASE WHEN warehouse_id % 3 = 0 THEN l.discount_amount ELSE 0 END AS manual_discount, l.promotion_id,
    channel_id, order_date, CASE WHEN order_status = 'cancelled' THEN 'cancelled' ELSE 'draft' END AS order_status,
    p.list_price, p.standard_cost, p.is_active
    FROM sales_order_lines l JOIN sales_orders o ON o.order_id = l.order_id JOIN products p ON p.product_id = l.product_id)"""

_LISTED = f"""(SELECT q.*, coalesce(manual_price, listed, CASE WHEN is_active THEN list_price END) AS price FROM (
    SELECT r.*, x.listed FROM {_LINE_REQUESTS} r LEFT JOIN (
      SELECT r.order_line_id, arg_max(pl.unit_price, (pl.valid_from, pl.price_list_id)) AS listed
      FROM {_LINE_REQUESTS} r JOIN price_lists pl ON pl.product_id = r.product_id AND pl.channel_id = r.channel_id
      AND r.order_date BETWEEN pl.valid_from AND pl.valid_to GROUP BY r.order_line_id) x ON x.order_line_id = r.order_line_id) q)"""

_PROMOTED = f"""(SELECT z.*, CAST(quantity * price AS DECIMAL(30,5)) AS gross, p.discount_type, p.discount_value,
    CASE WHEN z.promotion_id IS NULL THEN NULL ELSE coalesce(p.channel_id = z.channel_id AND z.order_date BETWEEN p.start_date AND p.end_date, FALSE) END AS promotion_valid
    FROM {_LISTED} z LEFT JOIN promotions p ON p.promotion_id = z.promotion_id)"""

# percent of gross with one exact rounding: gross has five digits, the percentage two
_EXACT_PERCENT = "CAST((CAST(gross * 100000 AS HUGEINT) * CAST(discount_value * 100 AS HUGEINT) + 5000000) // 10000000 AS DECIMAL(30,0)) / 100"
_DISCOUNTED = f"""(SELECT *, CASE WHEN manual_discount <> 0 THEN CAST(manual_discount AS DOUBLE) WHEN discount_type = 'percent'
    THEN CAST({_EXACT_PERCENT} AS DOUBLE) WHEN discount_type IS NOT NULL THEN CAST(least(gross, discount_value) AS DOUBLE)
    ELSE CAST(manual_discount AS DOUBLE) END AS discount FROM {_PROMOTED})"""

_PRICED = f"""(SELECT order_line_id, order_id, product_id, warehouse_id, promotion_id, quantity, price AS unit_price,
    CAST(discount AS DECIMAL(18,2)) AS discount_amount, CAST(round(gross, 2) AS DECIMAL(18,2)) AS gross_amount,
    CAST(round(gross, 2) AS DECIMAL(18,2)) - CAST(discount AS DECIMAL(18,2)) AS net_amount,
    CASE WHEN is_active THEN round(quantity * standard_cost, 2) END AS estimated_cost,
    CASE WHEN quantity <= 0 THEN 'quantity_not_positive' WHEN order_status <> 'draft' THEN 'order_not_open'
    WHEN NOT is_active THEN 'invalid_product' WHEN price < 0 THEN 'negative_price' WHEN NOT promotion_valid THEN 'invalid_promotion'
    WHEN discount < 0 OR discount > gross THEN 'invalid_discount' END AS reject_reason FROM {_DISCOUNTED})"""

# --- status history: an order walks its path; every 37th order skips the confirmation


def _status_log(c: Canonical):
    path = (
        F.when(F.col("order_id") % 37 == 0, "draft,fulfilled")
        .when(F.col("order_status") == "paid", "draft,confirmed,fulfilled,invoiced,paid")
        .when(F.col("order_status") == "fulfilled", "draft,confirmed,fulfilled")
        .when(F.col("order_status") == "confirmed", "draft,confirmed")
        .otherwise("draft,cancelled")
    )
    return c.sales_orders.select("order_id", "order_date", F.posexplode(F.split(path, ",")).alias("sequence", "status")).select(
        "order_id",
        F.date_add("order_date", (F.col("sequence") * (F.col("order_id") % 3)).cast("int")).alias("changed_on"),
        "sequence", "status",
    )


STATUS_LOG = """(SELECT order_id, order_date + CAST(sequence * (order_id % 3) AS INTEGER) AS changed_on, sequence, status FROM (
    SELECT order_id, order_date, unnest(range(len(path))) AS sequence, unnest(path) AS status FROM (
    SELECT *, CASE WHEN order_id % 37 = 0 THEN ['draft', 'fulfilled'] WHEN order_status = 'paid' THEN ['draft', 'confirmed', 'fulfilled', 'invoiced', 'paid']
    WHEN order_status = 'fulfilled' THEN ['draft', 'confirmed', 'fulfilled'] WHEN order_status = 'confirmed' THEN ['draft', 'confirmed']
    ELSE ['draft', 'cancelled'] END AS path FROM sales_orders)))"""

status_log = _status_log

# --- returns


def _returns(c: Canonical):
    return commerce.validate_returns(c.return_claims, c.sales_order_lines, c.sales_orders)


# three claims per line, so the rule can be written out: each claim sees what the accepted earlier ones took
_CLAIM_BASE = """(SELECT c.return_id, l.order_id, c.order_line_id, o.customer_id, l.product_id, l.warehouse_id, c.return_date, c.return_reason, c.quantity,
    l.quantity AS sold, l.net_amount, CASE WHEN order_status NOT IN ('fulfilled', 'invoiced', 'paid') THEN 'order_not_delivered'
    WHEN c.return_date < o.order_date THEN 'before_order_date' END AS early,
    row_number() OVER (PARTITION BY c.order_line_id ORDER BY c.return_date, c.return_id) AS n,
    lag(c.quantity, 1) OVER (PARTITION BY c.order_line_id ORDER BY c.return_date, c.return_id) AS q1,
    lag(c.quantity, 2) OVER (PARTITION BY c.order_line_id ORDER BY c.return_date, c.return_id) AS q2
    FROM return_claims c JOIN sales_order_lines l ON l.order_line_id = c.order_line_id JOIN sales_orders o ON o.order_id = l.order_id)"""
_CLAIMS = f"""(SELECT *, CASE n WHEN 1 THEN 0 WHEN 2 THEN CASE WHEN q1 <= sold THEN q1 ELSE 0 END
    ELSE CASE WHEN q2 <= sold THEN q2 ELSE 0 END + CASE WHEN q1 <= sold - CASE WHEN q2 <= sold THEN q2 ELSE 0 END THEN q1 ELSE 0 END END AS used
    FROM {_CLAIM_BASE})"""
_RETURNS = f"""(SELECT *, coalesce(early, CASE WHEN quantity > sold - used THEN 'exceeds_sold_quantity' END) AS reject_reason FROM {_CLAIMS})"""

TABLES["returns"] = f"""SELECT return_id, order_id, order_line_id, customer_id, product_id, return_date, return_reason, quantity,
    {ratio('net_amount * quantity', 'sold', 2)} AS refund_amount, 'approved' AS return_status FROM {_RETURNS} WHERE reject_reason IS NULL"""

# --- demand on stock: every order that was not cancelled


def _wanted(c: Canonical):
    return c.sales_orders.where("order_status <> 'cancelled'")


def _reserved(c: Canonical):
    return inventory.reserve_orders(_wanted(c), c.sales_order_lines, c.stock_balances)


_DEMAND = """(SELECT l.order_id, order_date, warehouse_id, product_id, sum(quantity) AS quantity FROM sales_order_lines l
    JOIN sales_orders o ON o.order_id = l.order_id WHERE order_status <> 'cancelled' GROUP BY ALL)"""

# which order is served depends on every earlier one over several stock keys: an order is decided once all earlier ones
# on its contested keys are, and the decided ones are kept by key of the recursion
_SERVED = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT d.order_id, order_date, [d.warehouse_id, d.product_id] AS key, quantity, on_hand_qty - reserved_qty AS free
      FROM {_DEMAND} d LEFT JOIN stock_balances b ON b.warehouse_id = d.warehouse_id AND b.product_id = d.product_id),
    contested AS (SELECT key FROM d GROUP BY key HAVING any_value(free) IS NULL OR sum(quantity) > any_value(free)),
    hard AS MATERIALIZED (SELECT d.* FROM d SEMI JOIN contested USING (key)),
    before AS MATERIALIZED (SELECT h.order_id, h.key, h.quantity, h.free, x.order_id AS earlier, x.quantity AS taken
      FROM hard h LEFT JOIN hard x ON x.key = h.key AND (x.order_date, x.order_id) < (h.order_date, h.order_id)),
    verdicts(order_id, ok) USING KEY (order_id) AS (
      SELECT order_id, bool_and(quantity <= coalesce(free, -1)) FROM before GROUP BY order_id HAVING count(earlier) = 0
      UNION
      SELECT order_id, bool_and(need <= coalesce(free, -1)) FROM (
        SELECT b.order_id, b.key, any_value(b.free) AS free, any_value(b.quantity) + coalesce(sum(b.taken) FILTER (WHERE s.ok), 0) AS need,
        count(b.earlier) = count(s.order_id) AS known
        FROM before b LEFT JOIN recurring.verdicts s ON s.order_id = b.earlier LEFT JOIN recurring.verdicts own ON own.order_id = b.order_id
        WHERE own.order_id IS NULL GROUP BY b.order_id, b.key)
      GROUP BY order_id HAVING bool_and(known))
    SELECT o.order_id, CASE WHEN s.order_id IS NULL THEN 'no_order_lines' WHEN NOT coalesce(ok, TRUE) THEN 'insufficient_stock' END AS reject_reason
    FROM sales_orders o LEFT JOIN (SELECT DISTINCT order_id FROM d) s ON s.order_id = o.order_id LEFT JOIN verdicts v ON v.order_id = o.order_id
    WHERE order_status <> 'cancelled'"""

_HAND = "CASE WHEN move_type = 'sale_reservation' THEN 0 ELSE quantity END"
_HELD = "CASE move_type WHEN 'sale_reservation' THEN -quantity WHEN 'sale_delivery' THEN quantity ELSE 0 END"
_RUNNING = f"""(SELECT *, on_hand_after < 0 OR reserved_after < 0 OR reserved_after > on_hand_after AS is_invalid FROM (
    SELECT stock_move_id, m.warehouse_id, m.product_id, move_type, move_date, quantity,
    on_hand_qty + sum({_HAND}) OVER w - {_HAND} AS on_hand_before, reserved_qty + sum({_HELD}) OVER w - {_HELD} AS reserved_before,
    on_hand_qty + sum({_HAND}) OVER w AS on_hand_after, reserved_qty + sum({_HELD}) OVER w AS reserved_after
    FROM stock_moves m JOIN stock_balances b ON b.warehouse_id = m.warehouse_id AND b.product_id = m.product_id
    WINDOW w AS (PARTITION BY m.warehouse_id, m.product_id ORDER BY move_date, stock_move_id ROWS UNBOUNDED PRECEDING)))"""


def _invoice_requests(c: Canonical):
    return c.sales_orders.select(
        "order_id",
        F.date_add("order_date", (F.col("order_id") % 3 - 1).cast("int")).alias("invoice_date"),
        F.when(F.col("channel_id") == 4, 30).otherwise(15).alias("due_days"),
    )


def _derived_invoices(c: Canonical):
    heads = commerce.order_totals(c.sales_orders, c.sales_order_lines)
    existing = c.sales_orders.where("order_id % 11 = 0").select("order_id")
    return finance.derive_invoices(_invoice_requests(c), heads, existing)


_NEW_INVOICES = """(SELECT order_id, customer_id, order_date + CAST(order_id % 3 - 1 AS INTEGER) AS invoice_date,
    order_date + CAST(order_id % 3 - 1 + CASE WHEN channel_id = 4 THEN 30 ELSE 15 END AS INTEGER) AS due_date, 'open' AS invoice_status,
    gross_amount, round(net_amount * 0.08, 2) AS tax_amount, discount_amount, net_amount + round(net_amount * 0.08, 2) AS net_amount, 0 AS amount_paid,
    CASE WHEN order_status NOT IN ('confirmed', 'fulfilled') THEN 'order_not_billable' WHEN order_id % 11 = 0 THEN 'already_invoiced'
    WHEN order_id % 3 = 0 THEN 'before_order_date' END AS reject_reason FROM order_heads)"""


def _invoice_lines(c: Canonical):
    return finance.derive_invoice_lines(c.invoices, c.sales_order_lines)


_INVOICE_LINES = """(SELECT l.order_id, order_line_id, product_id, quantity, unit_price, l.gross_amount, round(l.net_amount * 0.08, 2) AS tax_amount,
    l.net_amount + round(l.net_amount * 0.08, 2) AS net_amount FROM sales_order_lines l JOIN invoices i ON i.order_id = l.order_id)"""


def _settled(c: Canonical):
    return finance.settle_payments(c.payments, c.invoices)


# first come, first served along the payments of each invoice, as a recursive walk
_SETTLED_CTE = """ordered AS (SELECT p.payment_id, p.invoice_id, i.order_id, i.customer_id, payment_date, payment_method, p.amount_paid, i.net_amount,
    CASE WHEN p.amount_paid <= 0 THEN 'amount_not_positive' WHEN payment_date < invoice_date THEN 'before_invoice_date' END AS early,
    row_number() OVER (PARTITION BY p.invoice_id, CASE WHEN p.amount_paid <= 0 OR payment_date < invoice_date THEN 1 ELSE 0 END
      ORDER BY payment_date, p.payment_id) AS n FROM payments p JOIN invoices i ON i.invoice_id = p.invoice_id),
  walk AS (SELECT payment_id, invoice_id, n, amount_paid <= net_amount AS fits,
    CAST(CASE WHEN amount_paid <= net_amount THEN amount_paid ELSE 0 END AS DECIMAL(38,2)) AS used FROM ordered WHERE n = 1 AND early IS NULL
    UNION ALL SELECT o.payment_id, o.invoice_id, o.n, used + o.amount_paid <= net_amount,
    CAST(used + CASE WHEN used + o.amount_paid <= net_amount THEN o.amount_paid ELSE 0 END AS DECIMAL(38,2))
    FROM walk w JOIN ordered o ON o.invoice_id = w.invoice_id AND o.n = w.n + 1 AND o.early IS NULL),
  settled AS (SELECT o.*, coalesce(early, CASE WHEN NOT fits THEN 'exceeds_outstanding' END) AS reject_reason
    FROM ordered o LEFT JOIN walk w ON w.payment_id = o.payment_id)"""


_LINE_COLUMNS = (
    "order_line_id:s order_id:i product_id:i warehouse_id:i promotion_id:i quantity:n unit_price:n discount_amount:n "
    "gross_amount:n net_amount:n estimated_cost:n reject_reason:s"
)
_INVOICE_COLUMNS = (
    "order_id:i customer_id:i invoice_date:d due_date:d invoice_status:s gross_amount:n tax_amount:n discount_amount:n "
    "net_amount:n amount_paid:n reject_reason:s"
)

QUERIES: dict[str, Query] = {
    "c01_validate_orders": Query(
        lambda c: commerce.validate_orders(_order_requests(c), c.customers, c.sales_channels, c.branches),
        "order_id:i customer_id:i channel_id:i branch_id:i order_date:d company_id:i reject_reason:s",
        _ORDER_CHECK,
    ),
    "c02_resolve_price": Query(
        lambda c: commerce.resolve_price(_line_context(c), c.price_lists),
        "order_line_id:s product_id:i channel_id:i order_date:d resolved_price:n",
        f"SELECT *, price AS resolved_price FROM {_LISTED}",
    ),
    "c03_check_promotion": Query(
        lambda c: commerce.check_promotion(_line_context(c), c.promotions),
        "order_line_id:s promotion_id:i channel_id:i order_date:d promotion_valid:b",
        f"SELECT * FROM {_PROMOTED}",
    ),
    "c04_compute_discount": Query(
        lambda c: _priced(c).select("order_line_id", "gross_amount", "discount_amount"),
        "order_line_id:s gross_amount:n discount_amount:n",
        f"SELECT * FROM {_PRICED}",
    ),
    "c05_price_lines": Query(_priced, _LINE_COLUMNS, f"SELECT * FROM {_PRICED}"),
    "c06_order_totals": Query(
        lambda c: commerce.order_totals(c.sales_orders, c.sales_order_lines),
        "order_id:i order_number:s order_date:d order_status:s gross_amount:n discount_amount:n net_amount:n",
        "SELECT * FROM order_heads",
    ),
    "c07_status_from_evidence": Query(
        lambda c: commerce.status_from_evidence(c.sales_orders, c.stock_moves, c.shipments, c.invoices),
        "order_id:i order_status:s derived_status:s",
        """SELECT o.order_id, order_status, CASE WHEN order_status = 'cancelled' THEN 'cancelled' WHEN i.order_id IS NOT NULL THEN 'invoiced'
        WHEN s.order_id IS NOT NULL THEN 'fulfilled' WHEN x.order_id IS NOT NULL THEN 'confirmed' ELSE 'draft' END AS derived_status
        FROM sales_orders o LEFT JOIN invoices i ON i.order_id = o.order_id LEFT JOIN shipments s ON s.order_id = o.order_id
        LEFT JOIN order_sums x ON x.order_id = o.order_id""",
    ),
    "c07_illegal_transitions": Query(
        lambda c: commerce.illegal_transitions(_status_log(c)),
        "order_id:i changed_on:d sequence:i status:s previous_status:s",
        f"""SELECT * FROM (SELECT *, lag(status) OVER (PARTITION BY order_id ORDER BY changed_on, sequence) AS previous_status FROM {STATUS_LOG})
        WHERE NOT ((previous_status IS NULL AND status = 'draft') OR coalesce((previous_status, status) IN
        (('draft', 'confirmed'), ('confirmed', 'fulfilled'), ('confirmed', 'invoiced'), ('fulfilled', 'invoiced'), ('invoiced', 'paid')), FALSE))""",
    ),
    "c08_price_matrix": Query(
        lambda c: commerce.price_matrix(_sold_pairs(c), c.products, c.sales_channels),
        "product_id:i channel_id:i channel_code:s unit_price:n",
        """SELECT * FROM price_matrix SEMI JOIN (SELECT product_id, channel_id FROM sales_order_lines JOIN sales_orders USING (order_id))
        USING (product_id, channel_id)""",
    ),
    "c09_validate_returns": Query(
        _returns,
        "return_id:s order_id:i order_line_id:s customer_id:i product_id:i warehouse_id:i return_date:d return_reason:s "
        "quantity:n return_status:s reject_reason:s",
        f"SELECT *, CASE WHEN reject_reason IS NULL THEN 'approved' ELSE 'rejected' END AS return_status FROM {_RETURNS}",
    ),
    "c10_refund_amount": Query(
        lambda c: _returns(c).where("reject_reason IS NULL"),
        "return_id:s quantity:n refund_amount:n",
        f"SELECT *, {ratio('net_amount * quantity', 'sold', 2)} AS refund_amount FROM {_RETURNS} WHERE reject_reason IS NULL",
    ),
    "i01_available_qty": Query(
        lambda c: inventory.available_qty(c.stock_balances, c.sales_order_lines.select("order_line_id", "warehouse_id", (F.col("product_id") + F.col("line_no") % 2).alias("product_id"))),
        "order_line_id:s warehouse_id:i product_id:i available_qty:n",
        """SELECT order_line_id, l.warehouse_id, l.product_id + l.line_no % 2 AS product_id, on_hand_qty - reserved_qty AS available_qty FROM sales_order_lines l
        LEFT JOIN stock_balances b ON b.warehouse_id = l.warehouse_id AND b.product_id = l.product_id + l.line_no % 2""",
    ),
    "i02_ensure_balances": Query(
        lambda c: inventory.ensure_balances(c.stock_balances, c.sales_order_lines.select("warehouse_id", (F.col("product_id") + F.col("line_no") % 2).alias("product_id")), c.line_tasks),
        "warehouse_id:i product_id:i on_hand_qty:n reserved_qty:n reorder_point:n",
        """SELECT * FROM stock_balances UNION ALL SELECT DISTINCT warehouse_id, product_id + line_no % 2, 0, 0, 0 FROM sales_order_lines l
        WHERE NOT EXISTS (SELECT 1 FROM stock_balances b WHERE b.warehouse_id = l.warehouse_id AND b.product_id = l.product_id + l.line_no % 2)""",
    ),
    "i03_replenish_balances": Query(
        lambda c: inventory.replenish(c.stock_balances, c.products, F.lit("2001-08-02").cast("date"))[0],
        "warehouse_id:i product_id:i on_hand_qty:n reserved_qty:n",
        """SELECT warehouse_id, product_id, on_hand_qty + CASE WHEN on_hand_qty - reserved_qty < 300 THEN 1000 ELSE 0 END AS on_hand_qty,
        reserved_qty FROM stock_balances""",
    ),
    "i03_replenish_moves": Query(
        lambda c: inventory.replenish(c.stock_balances, c.products, F.lit("2001-08-02").cast("date"))[1],
        "warehouse_id:i product_id:i move_type:s move_date:d quantity:n unit_cost:n move_value:n reference_number:s",
        """SELECT warehouse_id, b.product_id, 'purchase_receipt' AS move_type, DATE '2001-08-02' AS move_date, 1000 AS quantity,
        standard_cost AS unit_cost, 1000 * standard_cost AS move_value, 'AUTO-REPLENISH-20010802-' || warehouse_id || '-' || b.product_id AS reference_number
        FROM stock_balances b JOIN products p ON p.product_id = b.product_id WHERE on_hand_qty - reserved_qty < 300""",
    ),
    "i04_atp_prefix": Query(
        lambda c: inventory.atp_prefix(_wanted(c), c.sales_order_lines, c.stock_balances),
        "order_id:i order_date:d warehouse_id:i product_id:i quantity:n cumulative_demand:n available_qty:n is_short:b",
        f"""SELECT *, cumulative_demand > available_qty AS is_short FROM (SELECT d.*, on_hand_qty - reserved_qty AS available_qty,
        sum(quantity) OVER (PARTITION BY d.warehouse_id, d.product_id ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING) AS cumulative_demand
        FROM {_DEMAND} d JOIN stock_balances b ON b.warehouse_id = d.warehouse_id AND b.product_id = d.product_id)""",
    ),
    "i05_reserve_orders": Query(_reserved, "order_id:i reject_reason:s", f"SELECT * FROM ({_SERVED})"),
    "i06_replay_ledger": Query(
        lambda c: inventory.replay_ledger(c.stock_balances, c.stock_moves, c.line_tasks),
        "warehouse_id:i product_id:i on_hand_qty:n reserved_qty:n move_count:i",
        f"""SELECT b.warehouse_id, b.product_id, on_hand_qty + coalesce(sum({_HAND}), 0) AS on_hand_qty,
        reserved_qty + coalesce(sum({_HELD}), 0) AS reserved_qty, count(m.stock_move_id) AS move_count
        FROM stock_balances b LEFT JOIN stock_moves m ON m.warehouse_id = b.warehouse_id AND m.product_id = b.product_id
        GROUP BY b.warehouse_id, b.product_id, on_hand_qty, reserved_qty""",
    ),
    "i07_ledger_running": Query(
        lambda c: inventory.ledger_running(c.stock_balances, c.stock_moves),
        "stock_move_id:s warehouse_id:i product_id:i move_type:s move_date:d quantity:n on_hand_before:n reserved_before:n "
        "on_hand_after:n reserved_after:n is_invalid:b",
        f"SELECT * FROM {_RUNNING}",
    ),
    "i08_deliver_check": Query(
        lambda c: inventory.deliver_check(c.stock_balances, c.stock_moves),
        "stock_move_id:s warehouse_id:i product_id:i move_date:d quantity:n on_hand_before:n reserved_before:n reject_reason:s",
        f"""SELECT stock_move_id, warehouse_id, product_id, move_date, -quantity AS quantity, on_hand_before, reserved_before,
        CASE WHEN reserved_before < -quantity OR on_hand_before < -quantity THEN 'not_enough_reserved_or_on_hand' END AS reject_reason
        FROM {_RUNNING} WHERE move_type = 'sale_delivery'""",
    ),
    "i09_move_value": Query(
        lambda c: inventory.move_value(c.stock_moves, c.products),
        "move_type:s moves:i quantity:n move_value:n",
        "SELECT move_type, count(*) AS moves, sum(quantity) AS quantity, sum(move_value) AS move_value FROM stock_moves GROUP BY move_type",
    ),
    "i10_lot_grid": Query(
        lambda c: c.stock_lots,
        "lot_number:s product_id:i warehouse_id:i manufacturing_date:d expiration_date:d quantity_on_hand:n",
        "SELECT * FROM stock_lots",
    ),
    "i10_stock_grid": Query(
        lambda c: inventory.stock_rows(
            c.sales_order_lines.select("warehouse_id", "product_id").distinct(),
            F.when(F.col("warehouse_id") % 3 == 0, 500).when(F.col("warehouse_id") % 3 == 1, 700).otherwise(300),
        ),
        "warehouse_id:i product_id:i on_hand_qty:n reserved_qty:n reorder_point:n",
        """SELECT DISTINCT warehouse_id, product_id, CASE warehouse_id % 3 WHEN 0 THEN 500 WHEN 1 THEN 700 ELSE 300 END AS on_hand_qty,
        0 AS reserved_qty, 80 AS reorder_point FROM sales_order_lines""",
    ),
    "l01_derive_shipment": Query(
        lambda c: logistics.derive_shipments(
            c.sales_orders, c.sales_order_lines, c.carriers,
            c.sales_orders.select(
                "order_id",
                F.date_add("order_date", (F.col("order_id") % 4 + 1).cast("int")).alias("fulfillment_date"),
                (F.col("order_id") % 26 + 1).alias("carrier_id"),
            ),
        ),
        "order_id:i warehouse_id:i carrier_id:i planned_ship_date:d actual_ship_date:d planned_delivery_date:d "
        "actual_delivery_date:d shipment_status:s shipping_fee:n reject_reason:s",
        """SELECT o.order_id, s.warehouse_id, o.order_id % 26 + 1 AS carrier_id, order_date + 1 AS planned_ship_date,
        order_date + CAST(o.order_id % 4 + 1 AS INTEGER) AS actual_ship_date,
        order_date + CASE service_level WHEN 'same_day' THEN 1 WHEN 'express' THEN 2 ELSE 3 END AS planned_delivery_date,
        order_date + CAST(o.order_id % 4 + 1 AS INTEGER) + CASE service_level WHEN 'same_day' THEN 0 ELSE 1 END AS actual_delivery_date,
        'delivered' AS shipment_status,
        CASE service_level WHEN 'same_day' THEN 45000 WHEN 'express' THEN 35000 WHEN 'b2b_freight' THEN 120000 ELSE 25000 END AS shipping_fee,
        CASE WHEN order_status <> 'confirmed' THEN 'order_not_confirmed' WHEN service_level IS NULL THEN 'invalid_carrier'
        WHEN s.warehouse_id IS NULL THEN 'no_order_lines' END AS reject_reason
        FROM sales_orders o LEFT JOIN order_sums s ON s.order_id = o.order_id LEFT JOIN carriers c ON c.carrier_id = o.order_id % 26 + 1""",
    ),
    "l02_shipping_fee": Query(
        lambda c: c.shipments.groupBy("carrier_id").agg(F.count("*").alias("shipments"), F.sum("shipping_fee").alias("shipping_fee")),
        "carrier_id:i shipments:i shipping_fee:n",
        """SELECT carrier_id, count(*) AS shipments, sum(CASE service_level WHEN 'same_day' THEN 45000 WHEN 'express' THEN 35000 WHEN 'b2b_freight' THEN 120000 ELSE 25000 END) AS shipping_fee
        FROM shipments JOIN carriers USING (carrier_id) GROUP BY carrier_id""",
    ),
    "l03_number_attempts": Query(
        lambda c: c.delivery_attempts,
        "delivery_attempt_id:i shipment_id:i attempt_date:d attempt_status:s attempt_number:i",
        "SELECT * FROM delivery_attempts",
    ),
    "l04_validate_attempts": Query(
        lambda c: logistics.validate_attempts(c.attempt_requests, c.shipments),
        "delivery_attempt_id:i shipment_id:i attempt_date:d attempt_status:s cod_amount:n reject_reason:s",
        "SELECT * FROM attempt_checks",
    ),
    "l05_fold_attempts": Query(
        lambda c: logistics.fold_attempts(c.shipments, _good_attempts(c)),
        "shipment_id:i shipment_status:s actual_delivery_date:d attempts:i",
        """SELECT s.shipment_id, CASE WHEN last_status = 'rescheduled' THEN 'in_transit' ELSE coalesce(last_status, shipment_status) END AS shipment_status,
        coalesce(last_day, actual_delivery_date) AS actual_delivery_date, coalesce(n, 0) AS attempts FROM shipments s LEFT JOIN
        (SELECT shipment_id, arg_max(attempt_status, delivery_attempt_id) AS last_status, count(*) AS n,
        arg_max(attempt_date, delivery_attempt_id) FILTER (WHERE attempt_status = 'delivered') AS last_day FROM recorded_attempts GROUP BY shipment_id) a
        ON a.shipment_id = s.shipment_id""",
    ),
    "f05_invoice_reconcile": Query(
        lambda c: finance.invoice_reconcile(c.invoices, _invoice_lines(c)),
        "order_id:i header_tax:n line_tax:n difference:n",
        f"""SELECT i.order_id, i.tax_amount AS header_tax, sum(x.tax_amount) AS line_tax, i.tax_amount - sum(x.tax_amount) AS difference
        FROM invoices i JOIN {_INVOICE_LINES} x ON x.order_id = i.order_id GROUP BY i.order_id, i.tax_amount""",
    ),
    "f06_derive_invoices": Query(_derived_invoices, _INVOICE_COLUMNS, f"SELECT * FROM {_NEW_INVOICES}"),
    "f07_derive_invoice_lines": Query(
        _invoice_lines,
        "order_id:i order_line_id:s product_id:i quantity:n unit_price:n gross_amount:n tax_amount:n net_amount:n",
        f"SELECT * FROM {_INVOICE_LINES}",
    ),
    "f08_settle_payments": Query(
        _settled,
        "payment_id:s invoice_id:i order_id:i customer_id:i payment_date:d payment_method:s amount_paid:n reject_reason:s",
        f"SELECT * FROM (WITH RECURSIVE {_SETTLED_CTE} SELECT * FROM settled)",
    ),
    "f09_invoice_status": Query(
        lambda c: finance.invoice_status(c.invoices, _settled(c)),
        "invoice_id:i order_id:i net_amount:n amount_paid:n invoice_status:s order_is_paid:b",
        f"""SELECT * FROM (WITH RECURSIVE {_SETTLED_CTE}, booked AS (SELECT invoice_id, sum(amount_paid) AS paid FROM settled WHERE reject_reason IS NULL GROUP BY invoice_id)
        SELECT i.invoice_id, i.order_id, i.net_amount, coalesce(paid, 0) AS amount_paid,
        CASE WHEN paid IS NULL THEN 'open' WHEN paid = i.net_amount THEN 'paid' ELSE 'partial' END AS invoice_status,
        coalesce(paid = i.net_amount, FALSE) AS order_is_paid FROM invoices i LEFT JOIN booked b ON b.invoice_id = i.invoice_id)""",
    ),
}


def _good_attempts(c: Canonical):
    return logistics.validate_attempts(c.attempt_requests, c.shipments).where("reject_reason IS NULL").drop("reject_reason")
