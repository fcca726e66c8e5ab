"""Registered marketplace queries with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import commerce as C
from marquee.operators import quality as Q
from marquee.sources.adapters import view, with_views

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _v(spark, sf, name):
    return view(spark, sf, name)


@register("product_page", with_views("products") + """,
f AS (SELECT * FROM products WHERE status = 'ACTIVE' AND category = 'STANDARD')
SELECT p.*, t.total FROM (SELECT * FROM f ORDER BY product_id LIMIT 20 OFFSET 40) p,
     (SELECT COUNT(*) AS total FROM f) t""")
def q_product_page(spark, sf):
    return C.product_page(_v(spark, sf, "products"), number=2, size=20, status="ACTIVE", category="STANDARD")


def _rules_sql(rules: dict[str, str], source: str) -> str:
    counts = ",\n    ".join(f"COUNT(CASE WHEN NOT COALESCE({rule}, FALSE) THEN 1 END) AS {name}" for name, rule in rules.items())
    return f"""
SELECT rule, failed, rows FROM (SELECT COUNT(*) AS rows,
    {counts}
  FROM {source}) UNPIVOT (failed FOR rule IN ({", ".join(rules)}))"""


@register("product_page_deep", with_views("products") + """
SELECT p.*, t.total FROM (SELECT * FROM products ORDER BY product_id LIMIT 7 OFFSET 700) p, (SELECT COUNT(*) AS total FROM products) t""")
def q_product_page_deep(spark, sf):
    """O3 on page 100 of the whole catalogue."""
    return C.product_page(_v(spark, sf, "products"), number=100, size=7)


@register("product_rules", with_views("catalogue_drafts") + _rules_sql({
    "name_length": "length(name) BETWEEN 1 AND 255", "description_length": "description IS NULL OR length(description) <= 4000",
    "price_min": "price >= 0.01", "stock_nonnegative": "stock >= 0", "category_length": "length(category) BETWEEN 1 AND 100",
    "status_domain": "status IN ('ACTIVE','INACTIVE','ARCHIVED')"}, "catalogue_drafts"))
def q_product_rules(spark, sf):
    return Q.rule_counts(_v(spark, sf, "catalogue_drafts"), Q.product_rules())


@register("promo_windows", with_views("promo_drafts") + """
SELECT code, valid_from, valid_until, valid_until > valid_from AS window_ok FROM promo_drafts""")
def q_promo_windows(spark, sf):
    """V5."""
    return Q.promo_window_ok(_v(spark, sf, "promo_drafts"))


@register("booking_id_form", with_views("booking_ids") + """
SELECT order_id, booking_id, regexp_full_match(booking_id, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}') AS booking_id_is_uuid FROM booking_ids""")
def q_booking_id_form(spark, sf):
    """V10."""
    return Q.uuid_check(_v(spark, sf, "booking_ids"), "booking_id")


@register("soft_delete", with_views("dated_products", "delete_requests") + """
SELECT product_id, CASE WHEN hit THEN 'ARCHIVED' ELSE status END AS status, price,
       CASE WHEN hit AND status <> 'ARCHIVED' THEN TIMESTAMP '1999-01-01' ELSE updated_at END AS updated_at
FROM (SELECT p.*, p.product_id IN (SELECT product_id FROM delete_requests) AS hit FROM dated_products p)""")
def q_soft_delete(spark, sf):
    """Archived products stay; only changed rows get a new time."""
    return C.soft_delete(_v(spark, sf, "dated_products"), _v(spark, sf, "delete_requests"), F.lit("1999-01-01").cast("timestamp_ntz"))


@register("catalogue_changes", with_views("dated_products", "catalogue_changes") + """
SELECT product_id, status, price, updated_at FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY updated_at DESC, src DESC, status DESC, price DESC) AS rn
  FROM (SELECT *, 0 AS src FROM dated_products UNION ALL SELECT *, 1 FROM catalogue_changes)) WHERE rn = 1""")
def q_catalogue_changes(spark, sf):
    """Inserts and updates; the newest row of a product wins."""
    return C.apply_changes(_v(spark, sf, "dated_products"), _v(spark, sf, "catalogue_changes"))


@register("ownership_audit", with_views("order_actions", "order_owners") + """
SELECT a.object_id, a.actor_id, a.role, o.owner_id FROM order_actions a LEFT JOIN order_owners o USING (object_id)
WHERE a.actor_id IS DISTINCT FROM o.owner_id AND a.role <> 'ADMIN'""")
def q_ownership_audit(spark, sf):
    """J9."""
    return C.ownership_violations(_v(spark, sf, "order_actions"), _v(spark, sf, "order_owners"))


@register("order_nested", with_views("shop_orders", "order_items") + """
SELECT o.order_id, o.user_id, o.status,
       to_json(list({'line_no': i.line_no, 'product_id': i.product_id, 'supplier_id': i.supplier_id,
                     'quantity': i.quantity}
                    ORDER BY i.line_no, i.product_id, i.supplier_id, i.quantity)) AS items
FROM shop_orders o JOIN order_items i USING (order_id)
GROUP BY o.order_id, o.user_id, o.status""")
def q_order_nested(spark, sf):
    n = C.orders_nested(_v(spark, sf, "shop_orders"), _v(spark, sf, "order_items"))
    return n.withColumn("items", F.to_json("items"))


_LINES = """,
lines AS (
  SELECT i.*, p.status AS product_status, p.stock, p.price,
         CASE WHEN p.status IS NULL THEN 'PRODUCT_NOT_FOUND'
              WHEN p.status <> 'ACTIVE' THEN 'PRODUCT_INACTIVE'
              WHEN p.stock < SUM(i.quantity) OVER (PARTITION BY i.order_id, i.product_id ORDER BY i.line_no) THEN 'INSUFFICIENT_STOCK' END AS line_code
  FROM order_items i LEFT JOIN products p USING (product_id))"""

_FIRST_FAIL = ("['PRODUCT_NOT_FOUND', 'PRODUCT_INACTIVE', 'INSUFFICIENT_STOCK'][CAST(MIN(CASE "
               "WHEN line_code = 'PRODUCT_NOT_FOUND' THEN line_no * 4 + 1 "
               "WHEN line_code = 'PRODUCT_INACTIVE' THEN line_no * 4 + 2 "
               "WHEN line_code = 'INSUFFICIENT_STOCK' THEN line_no * 4 + 3 END) % 4 AS INT)]")


@register("stock_verdict", with_views("products", "order_items") + _LINES + f"""
SELECT order_id, COUNT(*) AS lines, COALESCE({_FIRST_FAIL}, 'OK') AS code
FROM lines GROUP BY order_id""")
def q_stock_verdict(spark, sf):
    return C.stock_verdict(_v(spark, sf, "order_items"), _v(spark, sf, "products"))


_PROMO_FAIL = """CASE WHEN pr.code IS NULL OR NOT pr.active OR pr.current_uses >= pr.max_uses THEN 'PROMO_CODE_INVALID'
      WHEN NOT (pr.valid_from <= {now} AND {now} <= pr.valid_until) THEN 'PROMO_CODE_INVALID'
      WHEN {sub} < pr.min_order_amount THEN 'PROMO_CODE_MIN_AMOUNT' END"""

_DISC = """CASE WHEN pr.discount_type = 'PERCENTAGE' THEN
        CASE WHEN round_even({sub} * pr.discount_value * 0.01, 2) > {sub} * 0.70 THEN 0.00
             ELSE round_even({sub} * pr.discount_value * 0.01, 2) END
      ELSE LEAST(pr.discount_value, {sub}) END"""

_PRICED = with_views("shop_orders", "products", "order_items") + ", " + C.promo_values_sql() + _LINES + f""",
sub AS (SELECT order_id, CAST(SUM(price * quantity) AS DECIMAL(18,2)) AS subtotal,
               {_FIRST_FAIL} AS stock_code FROM lines GROUP BY order_id),
j0 AS (SELECT o.order_id, o.user_id, o.status, o.created_at, o.promo_code, s.subtotal, s.stock_code, pr.*,
        CASE WHEN s.stock_code IS NOT NULL THEN s.stock_code
             WHEN o.promo_code IS NULL THEN 'OK'
             ELSE COALESCE({_PROMO_FAIL.format(now='o.created_at', sub='s.subtotal')}, 'OK') END AS other_verdict,
        CASE WHEN o.promo_code IS NULL THEN 0.00 ELSE {_DISC.format(sub='s.subtotal')} END AS disc
      FROM shop_orders o JOIN sub s USING (order_id) LEFT JOIN promos pr ON o.promo_code = pr.code),
j AS (SELECT *, CASE WHEN other_verdict = 'OK' AND promo_code IS NOT NULL AND
               SUM(CASE WHEN other_verdict = 'OK' THEN 1 ELSE 0 END) OVER (PARTITION BY promo_code ORDER BY created_at, order_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) > max_uses - current_uses
             THEN 'PROMO_CODE_INVALID' ELSE other_verdict END AS verdict FROM j0),
priced AS (
  SELECT order_id, user_id, verdict AS code,
       CASE WHEN verdict = 'OK' THEN subtotal END AS subtotal,
       CAST(CASE WHEN verdict = 'OK' THEN disc END AS DECIMAL(18,2)) AS discount,
       CAST(CASE WHEN verdict = 'OK' THEN subtotal - disc END AS DECIMAL(18,2)) AS total,
       CASE WHEN verdict = 'OK' AND promo_code IS NOT NULL THEN promo_code END AS applied_promo
  FROM j)"""


@register("order_pricing", _PRICED + "\nSELECT * FROM priced")
def q_order_pricing(spark, sf):
    return C.order_pricing(_v(spark, sf, "shop_orders"), _v(spark, sf, "order_items"),
                           _v(spark, sf, "products"), C.promo_table(spark))


_REPRICED = _PRICED + f""",
cur AS (SELECT o.order_id, o.status, o.created_at, p.applied_promo
        FROM shop_orders o JOIN priced p USING (order_id) WHERE p.code = 'OK'),
old_qty AS (SELECT order_id, product_id, SUM(quantity) AS old_qty FROM order_items GROUP BY order_id, product_id),
nl AS (
  SELECT n.*, p.price,
         CASE WHEN p.status IS NULL THEN 'PRODUCT_NOT_FOUND'
              WHEN p.status <> 'ACTIVE' THEN 'PRODUCT_INACTIVE'
              WHEN p.stock + COALESCE(q.old_qty, 0) < SUM(n.quantity) OVER (PARTITION BY n.order_id, n.product_id ORDER BY n.line_no) THEN 'INSUFFICIENT_STOCK' END AS line_code
  FROM (SELECT * FROM order_items WHERE returnflag <> 'R') n
  LEFT JOIN products p USING (product_id)
  LEFT JOIN old_qty q USING (order_id, product_id)),
nsub AS (SELECT order_id, CAST(SUM(price * quantity) AS DECIMAL(18,2)) AS subtotal,
                {_FIRST_FAIL} AS stock_code FROM nl GROUP BY order_id),
r AS (
  SELECT c.order_id, c.status, c.applied_promo, s.subtotal, s.stock_code,
    c.applied_promo IS NOT NULL AND ({_PROMO_FAIL.format(now='c.created_at', sub='s.subtotal')}) IS NULL AS kept,
    {_DISC.format(sub='s.subtotal')} AS pdisc,
    CASE WHEN c.status <> 'CREATED' THEN 'INVALID_STATE_TRANSITION'
         WHEN s.subtotal IS NULL THEN 'VALIDATION_ERROR'
         WHEN s.stock_code IS NOT NULL THEN s.stock_code ELSE 'OK' END AS verdict
  FROM cur c LEFT JOIN nsub s USING (order_id) LEFT JOIN promos pr ON c.applied_promo = pr.code),
repriced AS (SELECT order_id, verdict AS code,
  CASE WHEN verdict = 'OK' THEN subtotal END AS new_subtotal,
  CAST(CASE WHEN verdict = 'OK' THEN CASE WHEN kept THEN pdisc ELSE 0.00 END END AS DECIMAL(18,2)) AS new_discount,
  CAST(CASE WHEN verdict = 'OK' THEN subtotal - CASE WHEN kept THEN pdisc ELSE 0.00 END END AS DECIMAL(18,2)) AS new_total,
  CASE WHEN verdict = 'OK' THEN kept END AS promo_kept,
  CASE WHEN verdict = 'OK' AND applied_promo IS NOT NULL AND NOT kept THEN -1
       WHEN verdict = 'OK' THEN 0 END AS uses_delta
FROM r)"""


@register("order_repricing", _REPRICED + "\nSELECT * FROM repriced")
def q_order_repricing(spark, sf):
    items = _v(spark, sf, "order_items")
    return C.order_repricing(_v(spark, sf, "shop_orders"), items, items.where("returnflag <> 'R'"),
                             _v(spark, sf, "products"), C.promo_table(spark))


@register("open_orders_semi", with_views("shop_orders") + """
SELECT c_custkey AS user_id, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM shop_orders o WHERE o.user_id = c.c_custkey
              AND o.status IN ('CREATED', 'PAYMENT_PENDING'))""")
def q_open_orders_semi(spark, sf):
    users = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").alias("user_id"), "c_name")
    return C.users_with_open_order(users, _v(spark, sf, "shop_orders"))


_DECIDED = """,
asked AS (SELECT order_id, MIN(CASE WHEN action = 'UPDATE' THEN ts END) AS upd, MIN(CASE WHEN action = 'CANCEL' THEN ts END) AS can
          FROM (SELECT * FROM update_requests UNION ALL SELECT * FROM cancel_requests) GROUP BY order_id),
decided AS (SELECT order_id, cancelled, upd IS NOT NULL AND status = 'CREATED' AND (NOT cancelled OR upd <= can) AS updated
  FROM (SELECT o.order_id, o.status, upd, can, can IS NOT NULL AND o.status IN ('CREATED', 'PAYMENT_PENDING') AS cancelled
        FROM shop_orders o JOIN asked USING (order_id)))"""


def _actions(spark, sf):
    return _v(spark, sf, "update_requests").unionByName(_v(spark, sf, "cancel_requests"))


@register("stock_restored", with_views("shop_orders", "order_items", "products", "update_requests", "cancel_requests") + _DECIDED + """,
back AS (SELECT product_id, quantity FROM order_items JOIN decided USING (order_id) WHERE updated OR cancelled
         UNION ALL SELECT product_id, quantity FROM order_items JOIN decided USING (order_id) WHERE updated AND cancelled AND returnflag <> 'R')
SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS restored FROM back WHERE product_id IN (SELECT product_id FROM products) GROUP BY product_id""")
def q_stock_restored(spark, sf):
    """A18 from a log of update and cancel requests; an update leaves out the lines flagged R."""
    items = _v(spark, sf, "order_items")
    return C.stock_restored(_v(spark, sf, "shop_orders"), _actions(spark, sf), items, items.where("returnflag <> 'R'"), _v(spark, sf, "products"))


@register("stock_ledger", with_views("shop_orders", "order_items", "products") + """,
entries AS (
  SELECT i.product_id, o.created_at AS ts, 'RESERVE' AS kind, i.order_id, i.line_no, i.supplier_id,
         -i.quantity AS delta, o.order_id IS NOT NULL AS counts
  FROM order_items i LEFT JOIN shop_orders o USING (order_id)
  UNION ALL
  SELECT product_id, shipdate, 'RESTORE', order_id, line_no, supplier_id, quantity, true
  FROM order_items WHERE returnflag = 'R'),
moved AS (SELECT *, SUM(CASE WHEN counts THEN CAST(delta AS BIGINT) ELSE 0 END) OVER (PARTITION BY product_id
            ORDER BY ts NULLS FIRST, kind, order_id, line_no, supplier_id, delta
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM entries)
SELECT e.product_id, e.ts, e.kind, e.order_id, e.line_no, e.supplier_id, e.delta,
       CASE WHEN counts THEN p.stock + total END AS balance,
       CASE WHEN NOT counts THEN 'UNKNOWN_ORDER' WHEN p.product_id IS NULL THEN 'UNKNOWN_PRODUCT' END AS unmatched,
       CASE WHEN counts THEN p.stock + total < 0 END AS below_zero
FROM moved e LEFT JOIN products p USING (product_id)""")
def q_stock_ledger(spark, sf):
    return C.stock_ledger(_v(spark, sf, "order_items"), _v(spark, sf, "shop_orders"), _v(spark, sf, "products"))


_REQUESTS = ", " + with_views("update_requests", "cancel_requests")[len("WITH "):]


@register("promo_uses", _REPRICED + _REQUESTS + _DECIDED + """,
uses AS (SELECT p.applied_promo AS promo_code, COALESCE(d.updated AND r.uses_delta = -1, FALSE) AS lost, COALESCE(d.cancelled, FALSE) AS cancelled
         FROM priced p LEFT JOIN decided d USING (order_id) LEFT JOIN repriced r USING (order_id) WHERE p.applied_promo IS NOT NULL)
SELECT promo_code, COUNT(*) AS applications, COUNT(CASE WHEN lost THEN 1 END) AS losses, COUNT(CASE WHEN cancelled AND NOT lost THEN 1 END) AS releases,
       COUNT(*) - COUNT(CASE WHEN lost THEN 1 END) - COUNT(CASE WHEN cancelled AND NOT lost THEN 1 END) AS net_uses
FROM uses GROUP BY promo_code""")
def q_promo_uses(spark, sf):
    """A19 from the pricing and repricing verdicts and a log of update and cancel requests."""
    orders, items, products, promos = _v(spark, sf, "shop_orders"), _v(spark, sf, "order_items"), _v(spark, sf, "products"), C.promo_table(spark)
    priced = C.order_pricing(orders, items, products, promos)
    repriced = C.order_repricing(orders, items, items.where("returnflag <> 'R'"), products, promos)
    return C.promo_uses(priced, repriced, orders, _actions(spark, sf))


@register("rate_limit", with_views("operations") + """
SELECT op_id, user_id, operation_type, created_at,
       COUNT(*) OVER (PARTITION BY user_id, operation_type ORDER BY epoch_us(created_at)
                      RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) > 1 AS limited
FROM operations""")
def q_rate_limit(spark, sf):
    return C.rate_limit(_v(spark, sf, "operations"), window_minutes=60)


@register("last_operation", with_views("operations") + """
SELECT user_id, operation_type, arg_max(op_id, (created_at, op_id)) AS last_op_id, MAX(created_at) AS last_at
FROM operations GROUP BY user_id, operation_type""")
def q_last_operation(spark, sf):
    return C.last_operation(_v(spark, sf, "operations"))


_HIST_COLS_L = [
    "CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS order_key",
    "ts", "event_id AS step_id",
    "CASE event_type WHEN 'signup' THEN 'CREATED' WHEN 'view' THEN 'PAYMENT_PENDING' "
    "WHEN 'click' THEN 'PAID' WHEN 'purchase' THEN 'SHIPPED' WHEN 'error' THEN 'CANCELED' END AS status",
]
def _history_df(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").selectExpr(*_HIST_COLS_L)


def _transitions_sql():
    vals = ", ".join(f"('{a}', '{b}')" for a, b in C.TRANSITIONS)
    return f"transitions AS (SELECT * FROM (VALUES {vals}) AS t(from_status, to_status))"


@register("status_transitions", "WITH history AS (SELECT " + ", ".join(_HIST_COLS_L) + " FROM events), "
          + _transitions_sql() + """
SELECT h.order_key, h.ts, h.step_id, h.from_status, h.status AS to_status,
       (t.from_status IS NOT NULL) AS allowed
FROM (SELECT *, LAG(status) OVER (PARTITION BY order_key ORDER BY ts, step_id) AS from_status FROM history) h
LEFT JOIN transitions t ON t.from_status = h.from_status AND t.to_status = h.status
WHERE h.from_status IS NOT NULL""")
def q_status_transitions(spark, sf):
    tr = spark.createDataFrame(C.TRANSITIONS, "from_status string, to_status string")
    return C.status_history_check(_history_df(spark, sf), tr)


@register("order_request_rules", with_views("order_drafts", "item_drafts") + """
SELECT o.order_id, o.promo_code, COUNT(i.order_id) AS n_items,
  concat_ws(',',
    CASE WHEN NOT (COUNT(i.order_id) BETWEEN 1 AND 50) THEN 'items_count' END,
    CASE WHEN bool_or(i.order_id IS NOT NULL AND (i.quantity IS NULL OR i.quantity < 1 OR i.quantity > 999)) THEN 'quantity_range' END,
    CASE WHEN NOT (o.promo_code IS NULL OR regexp_matches(o.promo_code, '^[A-Z0-9_]{4,20}$'))
         THEN 'promo_pattern' END) AS reasons
FROM order_drafts o LEFT JOIN item_drafts i USING (order_id)
GROUP BY o.order_id, o.promo_code""")
def q_order_request_rules(spark, sf):
    v = Q.order_request_rules(_v(spark, sf, "order_drafts"), _v(spark, sf, "item_drafts"))
    return v.withColumn("reasons", F.array_join("reasons", ","))


@register("line_totals", with_views("order_items", "products") + """
SELECT i.order_id, i.line_no, i.product_id, i.supplier_id, i.quantity, i.quantity > 0 AS quantity_ok,
       ROUND(CAST(i.quantity AS DECIMAL(10,0)) * p.price, 2) AS total
FROM order_items i JOIN products p USING (product_id)""")
def q_line_totals(spark, sf):
    j = _v(spark, sf, "order_items").join(_v(spark, sf, "products").select("product_id", "price"), "product_id")
    return Q.line_total(j).select("order_id", "line_no", "product_id", "supplier_id", "quantity",
                                  "quantity_ok", "total")
