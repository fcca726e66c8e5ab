"""Registered flight and data-quality queries with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import commerce as C
from marquee.operators import flights as FL
from marquee.operators import quality as Q
from marquee.sources.adapters import view, with_views
from marquee.sources.tables import table

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("flight_search", with_views("flights") + """
SELECT * FROM flights WHERE origin_iata = 'SVO' AND destination_iata = 'LED' AND flight_status = 'SCHEDULED'""")
def q_flight_search(spark, sf):
    return FL.flight_search(view(spark, sf, "flights"), "SVO", "LED")


@register("booking_cost", with_views("seat_requests", "flights") + """
SELECT r.flight_id, r.booking_ref, r.seats,
       CAST(CAST(r.seats AS DECIMAL(10,0)) * f.ticket_price AS DECIMAL(12,2)) AS total_cost
FROM seat_requests r JOIN flights f USING (flight_id)""")
def q_booking_cost(spark, sf):
    return FL.booking_cost(view(spark, sf, "seat_requests"), view(spark, sf, "flights"))


@register("booking_reconcile", with_views("order_items", bookings="recorded_bookings") + """,
rsv AS (SELECT CAST(order_id AS VARCHAR) AS booking_ref,
               CASE WHEN MAX(returnflag) = 'R' AND MIN(returnflag) <> 'A' THEN 'RELEASED' ELSE 'ACTIVE' END AS rsv_status
        FROM order_items GROUP BY order_id)
SELECT COALESCE(b.booking_ref, r.booking_ref) AS booking_ref, b.booking_status, r.rsv_status,
  CASE WHEN b.booking_status IS NULL AND r.rsv_status = 'ACTIVE' THEN 'ORPHAN_HOLD'
       WHEN b.booking_status IS NULL THEN 'RELEASED_NO_BOOKING'
       WHEN b.booking_status = 'CONFIRMED' AND r.rsv_status IS NULL THEN 'CONFIRMED_WITHOUT_HOLD'
       WHEN b.booking_status = 'CONFIRMED' AND r.rsv_status = 'ACTIVE' THEN 'OK'
       WHEN b.booking_status = 'CONFIRMED' THEN 'CONFIRMED_BUT_RELEASED'
       WHEN r.rsv_status = 'ACTIVE' THEN 'CANCELLED_BUT_ACTIVE'
       WHEN r.rsv_status IS NULL THEN 'CANCELLED_WITHOUT_HOLD'
       ELSE 'OK' END AS verdict
FROM bookings b FULL OUTER JOIN rsv r ON b.booking_ref = r.booking_ref""")
def q_booking_reconcile(spark, sf):
    rsv = FL.reservations_from_lines(view(spark, sf, "order_items"))
    return FL.booking_reconcile(view(spark, sf, "recorded_bookings"), rsv)


@register("bookings_newest", with_views("bookings") + """
SELECT customer_id, booking_id, created_at, booking_status,
       ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY created_at DESC, booking_id DESC) AS position
FROM bookings""")
def q_bookings_newest(spark, sf):
    return FL.bookings_newest(view(spark, sf, "bookings"))


_FOLD_COLS = ("flight_id", "booking_ref", "seats", "req_ts", "order_id", "line_no", "supplier_id", "kind")


def _fold_sql(requests_cte: str) -> str:
    cols = ", ".join(f"r.{c}" for c in _FOLD_COLS)
    return f"""WITH RECURSIVE {requests_cte},
req AS (
  SELECT r.*, f.total_seats AS cap,
         ROW_NUMBER() OVER (PARTITION BY r.flight_id ORDER BY r.req_ts, r.order_id, r.line_no, r.supplier_id,
                            r.seats, r.extendedprice, r.kind, r.booking_ref) AS rn
  FROM reqs r JOIN flights f USING (flight_id)),
fold AS (
  SELECT flight_id, CAST(0 AS BIGINT) AS rn, CAST(MAX(cap) AS BIGINT) AS seats_left,
         CAST([] AS STRUCT(ref VARCHAR, q BIGINT)[]) AS held, CAST(NULL AS VARCHAR) AS status
  FROM req GROUP BY flight_id
  UNION ALL
  SELECT r.flight_id, r.rn,
    CASE WHEN r.kind = 'RELEASE' THEN f.seats_left + COALESCE(list_filter(f.held, lambda x: x.ref = r.booking_ref)[1].q, 0)
         WHEN len(list_filter(f.held, lambda x: x.ref = r.booking_ref)) > 0 THEN f.seats_left
         WHEN f.seats_left >= r.seats THEN f.seats_left - r.seats ELSE f.seats_left END,
    CASE WHEN r.kind = 'RELEASE' THEN list_filter(f.held, lambda x: x.ref <> r.booking_ref)
         WHEN len(list_filter(f.held, lambda x: x.ref = r.booking_ref)) > 0 THEN f.held
         WHEN f.seats_left >= r.seats THEN list_append(f.held, {{'ref': r.booking_ref, 'q': CAST(r.seats AS BIGINT)}})
         ELSE f.held END,
    CASE WHEN r.kind = 'RELEASE' THEN
              CASE WHEN len(list_filter(f.held, lambda x: x.ref = r.booking_ref)) > 0 THEN 'RELEASED' ELSE 'NOT_HELD' END
         WHEN len(list_filter(f.held, lambda x: x.ref = r.booking_ref)) > 0 THEN 'DUPLICATE'
         WHEN f.seats_left >= r.seats THEN 'ACCEPTED' ELSE 'REJECTED' END
  FROM fold f JOIN req r ON r.flight_id = f.flight_id AND r.rn = f.rn + 1)
SELECT {cols}, f.status, f.seats_left
FROM fold f JOIN req r ON r.flight_id = f.flight_id AND r.rn = f.rn
UNION ALL
SELECT {cols}, 'NOT_FOUND', NULL FROM reqs r LEFT JOIN flights f USING (flight_id) WHERE f.total_seats IS NULL"""


def _admission_cols(df):
    return df.select(*_FOLD_COLS, "status", "seats_left")


@register("seat_admission", _fold_sql(
    with_views("seat_requests", "flights")[len("WITH "):]
    + ", reqs AS (SELECT *, 'RESERVE' AS kind FROM seat_requests)"))
def q_seat_admission(spark, sf):
    return _admission_cols(FL.seat_admission(view(spark, sf, "seat_requests"), view(spark, sf, "flights")))


@register("seat_admission_hot", _fold_sql("""reqs AS (
  SELECT l_linenumber AS flight_id, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS booking_ref, CAST(l_quantity AS INT) AS seats,
         l_shipdate AS req_ts, l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS supplier_id, l_extendedprice AS extendedprice,
         'RESERVE' AS kind FROM lineitem),
flights AS (SELECT r_regionkey AS flight_id, 1000 + 500 * r_regionkey AS total_seats FROM region)"""))
def q_seat_admission_hot(spark, sf):
    """H1 with few flights that take very many requests each, and requests of flights that do not exist."""
    req = table(spark, sf, "lineitem").selectExpr(
        "l_linenumber AS flight_id", "CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) AS booking_ref", "CAST(l_quantity AS INT) AS seats",
        "l_shipdate AS req_ts", "l_orderkey AS order_id", "l_linenumber AS line_no", "l_suppkey AS supplier_id", "l_extendedprice AS extendedprice")
    flights = table(spark, sf, "region").selectExpr("r_regionkey AS flight_id", "1000 + 500 * r_regionkey AS total_seats")
    return _admission_cols(FL.seat_admission(req, flights))


def _with_releases(req):
    """Reservations plus a release one day after ship for every returned line."""
    res = req.withColumn("kind", F.lit("RESERVE"))
    rel = (req.where(F.col("returnflag") == "R")
           .withColumn("req_ts", F.col("req_ts") + F.expr("INTERVAL 1 DAY"))
           .withColumn("kind", F.lit("RELEASE")))
    return res.unionByName(rel).drop("returnflag")


def _requests_with_flag(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("returnflag"),
                                             F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
                                             F.col("l_suppkey"), F.col("l_quantity"), F.col("l_shipdate"),
                                             F.col("l_extendedprice"))
    from marquee.sources.adapters import VIEWS
    cols = [f"{e} AS {n}" for n, e in VIEWS["seat_requests"]["cols"]] + ["returnflag"]
    return li.selectExpr(*cols)


@register("seat_release", _fold_sql(
    with_views("flights")[len("WITH "):]
    + ", sr AS (SELECT CAST(l_partkey AS BIGINT) AS flight_id, "
      "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) AS booking_ref, "
      "CAST(l_quantity AS INT) AS seats, l_shipdate AS req_ts, l_orderkey AS order_id, l_linenumber AS line_no, "
      "l_suppkey AS supplier_id, l_extendedprice AS extendedprice, l_returnflag AS returnflag FROM lineitem), "
      "reqs AS (SELECT * EXCLUDE (returnflag), 'RESERVE' AS kind FROM sr UNION ALL BY NAME "
      "SELECT * EXCLUDE (returnflag, req_ts), req_ts + INTERVAL 1 DAY AS req_ts, 'RELEASE' AS kind FROM sr "
      "WHERE returnflag = 'R')"))
def q_seat_release(spark, sf):
    return _admission_cols(FL.seat_admission(_with_releases(_requests_with_flag(spark, sf)),
                                             view(spark, sf, "flights")))


@register("duplicate_keys", with_views("seat_requests", "flights") + ", " + C.promo_values_sql() + """
SELECT 'seat_requests.booking_ref' AS check_name, booking_ref AS key, COUNT(*) AS copies
FROM seat_requests GROUP BY booking_ref HAVING COUNT(*) > 1
UNION ALL
SELECT 'flights.flight_number_day', flight_number || '@' || CAST(CAST(departs_at AS DATE) AS VARCHAR), COUNT(*)
FROM flights GROUP BY flight_number, CAST(departs_at AS DATE) HAVING COUNT(*) > 1
UNION ALL
SELECT 'promo_codes.code', code, COUNT(*) FROM promos GROUP BY code HAVING COUNT(*) > 1
UNION ALL
SELECT 'users.username', 'nation' || CAST(c_nationkey AS VARCHAR) || '_' || lower(c_mktsegment), COUNT(*) FROM customer
GROUP BY c_nationkey, lower(c_mktsegment) HAVING COUNT(*) > 1
UNION ALL
SELECT 'metrics.key', CAST(day AS VARCHAR) || '@' || name || '@{}', COUNT(*) FROM (
  SELECT CAST(ts AS DATE) AS day, 'events_' || event_type AS name, EXTRACT(HOUR FROM ts) AS run FROM events GROUP BY ALL)
GROUP BY day, name HAVING COUNT(*) > 1""")
def q_duplicate_keys(spark, sf):
    """V7 over the unique keys of the mapped tables: booking reference,
    (flight number, UTC day), promo code, username, metric key."""
    checks = [
        ("seat_requests.booking_ref", view(spark, sf, "seat_requests"), [F.col("booking_ref")]),
        ("flights.flight_number_day", view(spark, sf, "flights"),
         [F.col("flight_number"), F.to_date("departs_at").cast("string")]),
        ("promo_codes.code", C.promo_table(spark), [F.col("code")]),
        ("users.username", table(spark, sf, "customer").selectExpr("concat('nation', c_nationkey, '_', lower(c_mktsegment)) AS username"), [F.col("username")]),
        # hourly runs that each wrote a day's count again
        ("metrics.key", table(spark, sf, "events").selectExpr("to_date(ts) AS day", "concat('events_', event_type) AS name", "hour(ts) AS run").distinct(),
         [F.col("day").cast("string"), F.col("name"), F.lit("{}")]),
    ]
    out = None
    for name, df, key in checks:
        k = df.select(F.concat_ws("@", *key).alias("key"))
        d = Q.duplicate_keys(k, ["key"]).select(F.lit(name).alias("check_name"), "key", "copies")
        out = d if out is None else out.unionByName(d)
    return out


_FK = [
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
]


@register("fk_orphans", with_views("shop_orders", "seat_requests", "flights") + ", " + C.promo_values_sql() + "\n"
          + "\nUNION ALL\n".join(
              f"SELECT '{n}' AS check_name, COUNT(*) AS orphans FROM {c} WHERE {ck} IS NOT NULL "
              f"AND {ck} NOT IN (SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)" for n, c, ck, p, pk in _FK)
          + """
UNION ALL
SELECT 'shop_orders.promo_code->promo_codes', COUNT(*) FROM shop_orders WHERE promo_code IS NOT NULL
  AND promo_code NOT IN (SELECT code FROM promos)
UNION ALL
SELECT 'seat_requests.flight_id->flights', COUNT(*) FROM seat_requests
  WHERE flight_id NOT IN (SELECT flight_id FROM flights)""")
def q_fk_orphans(spark, sf):
    """V8: child rows whose key has no parent, one count per relation."""
    pairs = [(n, table(spark, sf, c).select(ck), table(spark, sf, p), ck, pk) for n, c, ck, p, pk in _FK]
    pairs += [
        ("shop_orders.promo_code->promo_codes", view(spark, sf, "shop_orders").select("promo_code"),
         C.promo_table(spark), "promo_code", "code"),
        ("seat_requests.flight_id->flights", view(spark, sf, "seat_requests").select("flight_id"),
         view(spark, sf, "flights"), "flight_id", "flight_id"),
    ]
    out = None
    for n, child, parent, ck, pk in pairs:
        o = Q.orphans(child, parent, ck, pk)
        d = o.agg(F.count(F.lit(1)).alias("orphans")).select(F.lit(n).alias("check_name"), "orphans")
        out = d if out is None else out.unionByName(d)
    return out


@register("flight_rules", with_views("flight_drafts", "reservation_drafts") + """
SELECT rule, failed, rows FROM (
  SELECT COUNT(*) AS rows,
    COUNT(CASE WHEN NOT COALESCE(total_seats > 0, FALSE) THEN 1 END) AS total_positive,
    COUNT(CASE WHEN NOT COALESCE(available_seats BETWEEN 0 AND total_seats, FALSE) THEN 1 END) AS available_in_range,
    COUNT(CASE WHEN NOT COALESCE(ticket_price > 0, FALSE) THEN 1 END) AS price_positive
  FROM flight_drafts)
UNPIVOT (failed FOR rule IN (total_positive, available_in_range, price_positive))
UNION ALL
SELECT rule, failed, rows FROM (
  SELECT COUNT(*) AS rows, COUNT(CASE WHEN NOT COALESCE(seats_held > 0, FALSE) THEN 1 END) AS seats_held_positive,
    COUNT(CASE WHEN NOT COALESCE(length(booking_ref) >= 1, FALSE) THEN 1 END) AS has_booking_ref FROM reservation_drafts)
UNPIVOT (failed FOR rule IN (seats_held_positive, has_booking_ref))""")
def q_flight_rules(spark, sf):
    """V9 over flights and reservations."""
    return (Q.rule_counts(view(spark, sf, "flight_drafts"), Q.seat_rules())
            .unionByName(Q.rule_counts(view(spark, sf, "reservation_drafts"), Q.reservation_rules())))
