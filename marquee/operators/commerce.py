"""Marketplace operators: catalogue, pricing, stock, promo, rate limit
(P3, P5, P6, P10, P11, J5-J9, A16-A20, W3, W4, W6, O3, O6, H3-H5).

The reference does this per request inside a transaction; here each rule is
a projection over a table of orders/lines, so a whole day of requests is one
plan.  Lines meet products through an equi-join (Spark picks broadcast only
when the catalogue's measured size is under the threshold); all per-order
results come from a group-by over lines.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.ranking import page, page_index
from marquee.functions.windows import count_in_range, look_back, running_totals

MONEY = "decimal(18,2)"
OPEN_STATUSES = ("CREATED", "PAYMENT_PENDING")

# ---------------------------------------------------------------------------
# The promo code table used with the order mapping (10 codes,
# picked by o_orderkey % 12; see SURVEY §7.3).  Columns: code, discount_type,
# discount_value, min_order_amount, max_uses, current_uses, valid_from,
# valid_until, active.
# ---------------------------------------------------------------------------
_ALWAYS = ("1990-01-01 00:00:00", "2030-12-31 23:59:59")
PROMOS = [
    ("SAVE10", "PERCENTAGE", "10.00", "5.00", 50, 0, *_ALWAYS, True),
    ("HALFOFF", "PERCENTAGE", "50.00", "100.00", 1000, 10, "1996-01-01 00:00:00", "1998-12-31 23:59:59", True),
    ("OVER71", "PERCENTAGE", "71.00", "0.00", 1000, 0, *_ALWAYS, True),
    ("EDGE70", "PERCENTAGE", "70.00", "0.00", 1000, 0, *_ALWAYS, True),
    ("FLAT150", "FIXED_AMOUNT", "150.00", "0.00", 1000, 0, *_ALWAYS, True),
    ("FLATMAX", "FIXED_AMOUNT", "999999.00", "0.00", 1000, 0, *_ALWAYS, True),
    ("USEDUP", "PERCENTAGE", "5.00", "0.00", 3, 3, *_ALWAYS, True),
    ("PAUSED", "PERCENTAGE", "15.00", "0.00", 1000, 0, *_ALWAYS, False),
    ("OLDPROMO", "FIXED_AMOUNT", "20.00", "0.00", 1000, 0, "1990-01-01 00:00:00", "1996-06-30 23:59:59", True),
    ("MIN1M", "PERCENTAGE", "20.00", "1000000.00", 1000, 0, *_ALWAYS, True),
]

PROMO_SCHEMA = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("discount_type", T.StringType()),
    T.StructField("discount_value", T.DecimalType(12, 2)),
    T.StructField("min_order_amount", T.DecimalType(12, 2)),
    T.StructField("max_uses", T.IntegerType()),
    T.StructField("current_uses", T.IntegerType()),
    T.StructField("valid_from", T.TimestampNTZType()),
    T.StructField("valid_until", T.TimestampNTZType()),
    T.StructField("active", T.BooleanType()),
])

# Allowed order status transitions of the marketplace.
TRANSITIONS = [
    ("CREATED", "PAYMENT_PENDING"), ("PAYMENT_PENDING", "PAID"), ("PAID", "SHIPPED"),
    ("SHIPPED", "COMPLETED"), ("CREATED", "CANCELED"), ("PAYMENT_PENDING", "CANCELED"),
]


def promo_table(spark: SparkSession) -> DataFrame:
    """The promo codes as an inline VALUES relation: Catalyst knows its size,
    so its own broadcast threshold decides the join strategy."""
    vals = ", ".join(
        f"('{c}', '{t}', CAST({v} AS DECIMAL(12,2)), CAST({m} AS DECIMAL(12,2)), {mx}, {cu}, "
        f"TIMESTAMP_NTZ '{a}', TIMESTAMP_NTZ '{b}', {str(act).upper()})"
        for c, t, v, m, mx, cu, a, b, act in PROMOS)
    return spark.sql(f"SELECT * FROM VALUES {vals} AS t({', '.join(PROMO_SCHEMA.fieldNames())})")


def promo_values_sql() -> str:
    """The same table as a DuckDB CTE."""
    vals = ",\n  ".join(
        f"('{c}', '{t}', CAST({v} AS DECIMAL(12,2)), CAST({m} AS DECIMAL(12,2)), {mx}, {cu}, "
        f"TIMESTAMP '{a}', TIMESTAMP '{b}', {str(act).upper()})"
        for c, t, v, m, mx, cu, a, b, act in PROMOS)
    return ("promos AS (SELECT * FROM (VALUES\n  " + vals + "\n) AS t(code, discount_type, discount_value, "
            "min_order_amount, max_uses, current_uses, valid_from, valid_until, active))")


# ---------------------------------------------------------------------------
# Catalogue
# ---------------------------------------------------------------------------

def product_listing(products: DataFrame, status=None, category=None) -> DataFrame:
    """Optional status and category filters."""
    if status is not None:
        products = products.where(F.col("status") == status)
    if category is not None:
        products = products.where(F.col("category") == category)
    return products


def product_page(products: DataFrame, number: int, size: int, status=None, category=None) -> DataFrame:
    """P3 + O3 + A20: page ``number`` (from 0) ordered by id (added for
    determinism) with the filtered total beside each row.  The page comes from
    an index of ranges, so a deep page sorts no more rows than the first one;
    keep ``ranking.page_index`` to serve many pages."""
    index = page_index(product_listing(products, status, category), [F.col("product_id")])
    return page(index, number * size, size).drop("position").withColumn("total", F.lit(index.total).cast("long"))


def soft_delete(products: DataFrame, ids: DataFrame, now_col=None) -> DataFrame:
    """P5 + P6: ARCHIVE the listed ids (a batch of delete requests), refresh
    updated_at on changed rows only."""
    now = now_col if now_col is not None else F.current_timestamp()
    hit = ids.select(F.col("product_id")).distinct().withColumn("__hit", F.lit(True))
    j = products.join(hit, "product_id", "left")
    changed = F.col("__hit").isNotNull() & (F.col("status") != "ARCHIVED")
    out = j
    if "updated_at" in products.columns:  # decided on the old status
        out = out.withColumn("updated_at", F.when(changed, now).otherwise(F.col("updated_at")))
    out = out.withColumn("status", F.when(F.col("__hit").isNotNull(), F.lit("ARCHIVED")).otherwise(F.col("status")))
    return out.drop("__hit")


def apply_changes(current: DataFrame, changes: DataFrame, key: str = "product_id",
                  ts: str = "updated_at") -> DataFrame:
    """Inserts and full-row updates from a change table: the newest row
    per key wins (ties: the change over the current row).  A ``max_by``
    aggregate, reduced map-side however many changes one key gets."""
    u = (current.withColumn("__src", F.lit(0))
         .unionByName(changes.withColumn("__src", F.lit(1)), allowMissingColumns=True))
    rest = [c for c in u.columns if c not in (key, "__src")]
    # changes of one time are told apart by their content, so reruns agree
    return (u.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(ts), F.col("__src"), *rest)).alias("__row"))
            .select(key, *[F.col(f"__row.{c}").alias(c) for c in rest]))


# ---------------------------------------------------------------------------
# Orders: lines, stock verdict, pricing
# ---------------------------------------------------------------------------

def _money_sum(price: str = "price", qty: str = "quantity") -> F.Column:
    """Exact sum of price x quantity.  Summing in integer cents keeps the
    aggregate buffer a long (a decimal sum wider than 18 digits falls back to
    BigDecimal arithmetic per row)."""
    cents = F.sum((F.col(price) * 100).cast("long") * F.col(qty))
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def priced_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    """Each line with its product's status, stock and price; the line's
    verdict against the stock snapshot (NULL = fine).  Lines of an order that
    name the same product use up the stock in line order."""
    p = products.select("product_id", F.col("status").alias("product_status"), "stock", "price")
    j = items.join(p, "product_id", "left")
    code = (F.when(F.col("product_status").isNull(), "PRODUCT_NOT_FOUND")
            .when(F.col("product_status") != "ACTIVE", "PRODUCT_INACTIVE")
            .when(F.col("stock") < _taken_so_far(), "INSUFFICIENT_STOCK"))
    return j.withColumn("line_code", code)


def _taken_so_far() -> F.Column:
    """Quantity of a product in an order's lines up to this one."""
    w = Window.partitionBy("order_id", "product_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return F.sum("quantity").over(w)


# Line verdicts in rule order (the first failing rule of a line).
LINE_CODES = ("PRODUCT_NOT_FOUND", "PRODUCT_INACTIVE", "INSUFFICIENT_STOCK")


def _first_failure() -> F.Column:
    """Verdict of the first failing line: lowest line number, then rule order.
    Encoded as one long (line_no * 4 + rule) so the aggregate stays a hash
    aggregate with a fixed-width buffer."""
    rule = F.col("line_code")
    for i, c in enumerate(LINE_CODES, 1):
        rule = F.when(F.col("line_code") == c, F.lit(i)) if i == 1 else rule.when(F.col("line_code") == c, F.lit(i))
    r = F.min(F.col("line_no").cast("long") * 4 + rule) % 4
    out = None
    for i, c in enumerate(LINE_CODES, 1):
        out = F.when(r == i, F.lit(c)) if out is None else out.when(r == i, F.lit(c))
    return out


def stock_verdict(items: DataFrame, products: DataFrame) -> DataFrame:
    """H5: per order, the first failing line's code in line order, or OK."""
    pl = priced_lines(items, products)
    return (pl.groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.coalesce(_first_failure(), F.lit("OK")).alias("code")))


def order_subtotals(items: DataFrame, products: DataFrame) -> DataFrame:
    """A16 + H5: per order subtotal at snapshot prices and stock verdict."""
    pl = priced_lines(items, products)
    return (pl.groupBy("order_id")
            .agg(_money_sum().alias("subtotal"),
                 _first_failure().alias("stock_code")))


def promo_discount(subtotal: F.Column) -> F.Column:
    """Discount of a valid promo (Q13, Q14): percentage quantized half-even
    and dropped to 0 above 70 % of the subtotal; fixed amount capped."""
    pct = F.bround(subtotal * F.col("discount_value") * F.lit(Decimal("0.01")), 2)
    return (F.when(F.col("discount_type") == "PERCENTAGE",
                   F.when(pct > subtotal * F.lit(Decimal("0.70")), F.lit(Decimal("0.00"))).otherwise(pct))
            .otherwise(F.least(F.col("discount_value"), subtotal)))


def promo_code_check(subtotal: F.Column, now: F.Column) -> F.Column:
    """Promo verdict (Q15): unknown, inactive, exhausted or outside its
    closed window -> PROMO_CODE_INVALID; under the minimum -> MIN_AMOUNT."""
    return (F.when(F.col("code").isNull() | ~F.col("active") | (F.col("current_uses") >= F.col("max_uses")),
                   "PROMO_CODE_INVALID")
            .when(~((F.col("valid_from") <= now) & (now <= F.col("valid_until"))), "PROMO_CODE_INVALID")
            .when(subtotal < F.col("min_order_amount"), "PROMO_CODE_MIN_AMOUNT"))


def order_pricing(orders: DataFrame, items: DataFrame, products: DataFrame, promos: DataFrame) -> DataFrame:
    """H3: subtotal, discount, total and the first failing rule per order.

    Orders that pass every other rule take a code's remaining uses in order of
    (created_at, order_id); those beyond ``max_uses`` are refused.  Only the
    orders that can still be within a limit are ranked: each task keeps the
    first ones of a code, as many as the largest limit, before the shuffle."""
    sub = order_subtotals(items, products)
    o = orders.join(sub, "order_id").join(promos, F.col("promo_code") == F.col("code"), "left")
    s = F.col("subtotal")
    passes = (F.when(F.col("stock_code").isNotNull(), F.col("stock_code"))
              .when(F.col("promo_code").isNull(), "OK")
              .otherwise(F.coalesce(promo_code_check(s, F.col("created_at")), F.lit("OK"))))
    o = o.withColumn("__code", passes)
    most = promos.agg(F.max(F.col("max_uses") - F.col("current_uses"))).first()[0] or 0  # one number of the promo table
    w = Window.partitionBy("promo_code").orderBy("created_at", "order_id")
    served = (o.where((F.col("__code") == "OK") & F.col("promo_code").isNotNull())
              .select("promo_code", "created_at", "order_id", (F.col("max_uses") - F.col("current_uses")).alias("__uses"))
              .withColumn("__nth", F.row_number().over(w)).where(F.col("__nth") <= int(most)).where("__nth <= __uses")
              .select("order_id", F.lit(True).alias("__served")))
    o = o.join(served, "order_id", "left")
    code = (F.when((F.col("__code") == "OK") & F.col("promo_code").isNotNull() & F.col("__served").isNull(), "PROMO_CODE_INVALID")
            .otherwise(F.col("__code")))
    ok = code == "OK"
    disc = F.when(F.col("promo_code").isNull(), F.lit(Decimal("0.00"))).otherwise(promo_discount(s))
    return o.select(
        "order_id", "user_id", code.alias("code"),
        F.when(ok, s).alias("subtotal"),
        F.when(ok, disc).cast(MONEY).alias("discount"),
        F.when(ok, s - disc).cast(MONEY).alias("total"),
        F.when(ok & F.col("promo_code").isNotNull(), F.col("promo_code")).alias("applied_promo"),
    )


def order_repricing(orders: DataFrame, items: DataFrame, new_items: DataFrame, products: DataFrame,
                    promos: DataFrame) -> DataFrame:
    """H4: update of CREATED orders to ``new_items``.  Old quantities go back
    to stock first; the order's existing promo is re-resolved without a new
    use; a promo that now fails is removed and its use count lowered (Q16)."""
    priced = order_pricing(orders, items, products, promos).where("code = 'OK'")
    cur = (orders.select("order_id", "status", "created_at")
           .join(priced.select("order_id", "applied_promo"), "order_id"))
    old_qty = items.groupBy("order_id", "product_id").agg(F.sum("quantity").alias("old_qty"))
    p = products.select("product_id", F.col("status").alias("product_status"), "stock", "price")
    nl = (new_items.join(p, "product_id", "left")
          .join(old_qty, ["order_id", "product_id"], "left")
          .withColumn("stock", F.col("stock") + F.coalesce(F.col("old_qty"), F.lit(0))))
    nl = nl.withColumn("line_code",
                       F.when(F.col("product_status").isNull(), "PRODUCT_NOT_FOUND")
                       .when(F.col("product_status") != "ACTIVE", "PRODUCT_INACTIVE")
                       .when(F.col("stock") < _taken_so_far(), "INSUFFICIENT_STOCK"))
    sub = nl.groupBy("order_id").agg(
        _money_sum().alias("subtotal"),
        _first_failure().alias("stock_code"))
    j = (cur.join(sub, "order_id", "left")
         .join(promos, F.col("applied_promo") == F.col("code"), "left"))
    s = F.col("subtotal")
    promo_fail = promo_code_check(s, F.col("created_at"))
    has_promo = F.col("applied_promo").isNotNull()
    kept = has_promo & promo_fail.isNull()
    code = (F.when(F.col("status") != "CREATED", "INVALID_STATE_TRANSITION")
            .when(s.isNull(), "VALIDATION_ERROR")
            .when(F.col("stock_code").isNotNull(), F.col("stock_code"))
            .otherwise("OK"))
    ok = code == "OK"
    disc = F.when(kept, promo_discount(s)).otherwise(F.lit(Decimal("0.00")))
    return j.select(
        "order_id", code.alias("code"),
        F.when(ok, s).alias("new_subtotal"),
        F.when(ok, disc).cast(MONEY).alias("new_discount"),
        F.when(ok, s - disc).cast(MONEY).alias("new_total"),
        F.when(ok, kept).alias("promo_kept"),
        F.when(ok & has_promo & ~kept, F.lit(-1)).when(ok, F.lit(0)).alias("uses_delta"),
    )


def orders_nested(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Each order with its items as a sorted array (bounded: an order
    holds at most 50 items by rule V4)."""
    it = items.groupBy("order_id").agg(F.sort_array(F.collect_list(
        F.struct("line_no", "product_id", "supplier_id", "quantity"))).alias("items"))
    return orders.select("order_id", "user_id", "status").join(it, "order_id")


def users_with_open_order(users: DataFrame, orders: DataFrame, open_=True) -> DataFrame:
    """Users having (``open_``) or lacking an order in an open status."""
    o = orders.where(F.col("status").isin(*OPEN_STATUSES)).select("user_id")
    return users.join(o, "user_id", "left_semi" if open_ else "left_anti")


def order_decisions(orders: DataFrame, actions: DataFrame) -> DataFrame:
    """What a log of requests (``order_id, action, ts``; UPDATE or CANCEL) comes
    to per order: order_id, updated, cancelled.

    An order can be updated while CREATED and cancelled while it is open, once
    each; an update asked for after the cancel is refused."""
    asked = actions.groupBy("order_id").agg(F.min(F.when(F.col("action") == "UPDATE", F.col("ts"))).alias("upd"),
                                            F.min(F.when(F.col("action") == "CANCEL", F.col("ts"))).alias("can"))
    j = orders.select("order_id", "status").join(asked, "order_id")
    cancelled = F.col("can").isNotNull() & F.col("status").isin(*OPEN_STATUSES)
    updated = F.col("upd").isNotNull() & (F.col("status") == "CREATED") & (~cancelled | (F.col("upd") <= F.col("can")))
    return j.select("order_id", updated.alias("updated"), cancelled.alias("cancelled"))


def stock_restored(orders: DataFrame, actions: DataFrame, items: DataFrame, new_items: DataFrame, products: DataFrame) -> DataFrame:
    """Stock given back per product: an update gives back all the lines
    the order had, a cancel those it has by then (``new_items`` after an
    update).  Lines of unknown products give nothing back."""
    d = order_decisions(orders, actions)
    old = items.join(d.where("updated OR cancelled").select("order_id"), "order_id", "left_semi")
    new = new_items.join(d.where("updated AND cancelled").select("order_id"), "order_id", "left_semi")
    back = old.select("product_id", "quantity").unionByName(new.select("product_id", "quantity"))
    return (back.join(products.select("product_id"), "product_id", "left_semi")
            .groupBy("product_id").agg(F.sum("quantity").cast("long").alias("restored")))


def stock_ledger(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Running stock per product over reserve entries (order time, -qty)
    and restore entries (returned lines at ship time, +qty), starting from
    the catalogue stock; flags entries that take stock below zero.  Each line
    is read once and gives its one or two entries; the running sum is cut by
    ranges of (product, time), so a hot product is not one task.

    ``unmatched`` says why an entry has no balance: UNKNOWN_PRODUCT, or
    UNKNOWN_ORDER (its time is unknown too, so it moves no other balance)."""
    o = orders.select("order_id", "created_at", F.lit(True).alias("__known"))
    line = items.join(o, "order_id", "left")
    when = line.select(F.coalesce("created_at", "shipdate").alias("t")).schema["t"].dataType
    entry = lambda ts, kind, delta, known: F.struct(
        F.col(ts).cast(when).alias("ts"), F.lit(kind).alias("kind"), delta.alias("delta"), F.coalesce(known, F.lit(False)).alias("counts"))
    both = F.array_compact(F.array(entry("created_at", "RESERVE", -F.col("quantity"), F.col("__known")),
                                   F.when(F.col("returnflag") == "R", entry("shipdate", "RESTORE", F.col("quantity"), F.lit(True)))))
    entries = line.select("product_id", "order_id", "line_no", "supplier_id", F.inline(both))
    order = [F.col(c) for c in ("ts", "kind", "order_id", "line_no", "supplier_id", "delta")]
    r = running_totals(entries, ["product_id"], order, {"moved": F.when(F.col("counts"), F.col("delta")).otherwise(0).cast("long")})
    p = products.select("product_id", F.col("stock").alias("__stock"), F.lit(True).alias("__listed"))
    unmatched = F.when(~F.col("counts"), "UNKNOWN_ORDER").when(F.col("__listed").isNull(), "UNKNOWN_PRODUCT")
    return (r.join(p, "product_id", "left").withColumn("unmatched", unmatched)
            .select("product_id", "ts", "kind", "order_id", "line_no", "supplier_id", "delta",
                    F.when(F.col("unmatched").isNull(), (F.col("__stock") + F.col("moved")).cast("long")).alias("balance"), "unmatched")
            .withColumn("below_zero", F.col("balance") < 0))


def promo_uses(priced: DataFrame, repriced: DataFrame, orders: DataFrame, actions: DataFrame) -> DataFrame:
    """Signed use counts per code: +1 when an order first takes a code
    (``priced``, H3), -1 when its update loses it (``repriced``, H4), -1 when
    an order that still holds one is cancelled."""
    taken = priced.where("applied_promo IS NOT NULL").select("order_id", F.col("applied_promo").alias("promo_code"))
    lost = repriced.where("uses_delta = -1").select("order_id", F.lit(True).alias("drops"))
    j = (taken.join(order_decisions(orders, actions), "order_id", "left").join(lost, "order_id", "left")
         .withColumn("lost", F.coalesce(F.col("updated") & F.col("drops"), F.lit(False)))
         .withColumn("released", F.coalesce(F.col("cancelled"), F.lit(False)) & ~F.col("lost")))
    return (j.groupBy("promo_code")
            .agg(F.count(F.lit(1)).alias("applications"), F.count_if("lost").alias("losses"), F.count_if("released").alias("releases"))
            .withColumn("net_uses", F.col("applications") - F.col("losses") - F.col("releases")))


def rate_limit(ops: DataFrame, window_minutes: int = 1) -> DataFrame:
    """An accepted operation is limited when another one of the same user
    and type lies in the preceding ``window_minutes`` (inclusive, Q17).
    Time-bucketed with a halo, so one busy user spreads over many tasks."""
    width = window_minutes * 60 * 1_000_000
    micros = F.unix_micros(F.col("created_at").cast("timestamp"))
    c = count_in_range(ops, ["user_id", "operation_type"], micros, width,
                       bucket_us=max(width, 86_400_000_000), out="__n")
    return c.select("op_id", "user_id", "operation_type", "created_at",
                    (F.col("__n") > 1).alias("limited"))


def last_operation(ops: DataFrame) -> DataFrame:
    """Newest operation per (user, type) via max_by (no sort)."""
    key = F.struct("created_at", "op_id")
    return (ops.groupBy("user_id", "operation_type")
            .agg(F.max_by("op_id", key).alias("last_op_id"), F.max("created_at").alias("last_at")))


def status_history_check(history: DataFrame, transitions: DataFrame) -> DataFrame:
    """Each status change with the status before it in the order's own
    history, and whether the pair is an allowed transition.  The step before
    comes from ``look_back``, which covers long histories in pieces.  A step
    whose own or earlier status is null is no transition and not listed."""
    steps = look_back(history, ["order_key"], [F.col("ts"), F.col("step_id")], F.struct("status"), 1)
    h = steps.where(F.size("past") > 0).withColumn("from_status", F.col("past")[0]["status"]).where("from_status IS NOT NULL")
    t = transitions.select(F.col("from_status"), F.col("to_status").alias("status"),
                           F.lit(True).alias("allowed"))
    return (h.join(t, ["from_status", "status"], "left")
            .select("order_key", "ts", "step_id", "from_status", F.col("status").alias("to_status"),
                    F.coalesce(F.col("allowed"), F.lit(False)).alias("allowed")))


def ownership_violations(actions: DataFrame, owners: DataFrame, exempt_roles=("ADMIN",)) -> DataFrame:
    """Actions by someone other than the owner (``<=>`` keeps NULL owners
    as violations), admins exempt."""
    j = actions.join(owners, "object_id", "left")
    return j.where(~F.col("owner_id").eqNullSafe(F.col("actor_id")) & ~F.col("role").isin(*exempt_roles))
