"""Domain views over the given tables.

Each view is a list of ``(column, SQL expression)`` pairs over one base
table.  The same expressions feed ``DataFrame.selectExpr`` on the Spark
side and a CTE in the DuckDB oracle, so both engines see one mapping.  The
few functions whose names differ between the two dialects are written as
``{placeholders}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.sources.tables import table

# bodies of several shapes: scalars of every type, arrays, nested objects, a
# secret that is a number or an object, a list on top
_BODY = ("CASE event_type WHEN 'click' THEN '[{\"password\": ' || CAST(user_id AS STRING) || '}, true, null, 1.50]' "
         "WHEN 'purchase' THEN '{\"id\":' || CAST(event_id AS STRING) || ',\"items\":[1,\"two\",{\"n\":null}],\"user\":{\"name\":\"u\",\"password_hash\":\"h' "
         "|| CAST(user_id AS STRING) || '\"},\"paid\":true}' "
         "WHEN 'error' THEN '{\"password\":{\"old\":\"a\",\"new\":[\"b\"]},\"note\":\"say password: x\"}' "
         "ELSE '{\"username\":\"user' || CAST(user_id AS STRING) || '\",\"password\":\"pw' "
         "|| CAST(event_id AS STRING) || '\",\"note\":\"' || event_type || '\"}' END")

_MD5 = "md5(CAST(event_id AS STRING))"
_UUID = " || '-' || ".join(f"substr({_MD5}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
# one event as a client sends it; by its value an event is malformed in one way or another
_WIRE = (f"""'{{{{' || CASE WHEN event_type = 'click' THEN '' WHEN value >= 5 AND value < 10 THEN '"event_id":"not-a-uuid",'
 ELSE '"event_id":"' || {_UUID} || '",' END
 || '"user_id":"' || CASE WHEN value >= 35 AND value < 40 THEN '' ELSE 'u' || CAST(user_id AS STRING) END
 || '","movie_id":"m' || CAST({{json_k}} AS STRING)
 || '","event_type":"' || CASE WHEN value >= 10 AND value < 15 THEN 'NOT_EXIST' ELSE {{type}} END
 || '","timestamp":' || CASE WHEN value >= 30 AND value < 35 THEN '0' WHEN value >= 40 AND value < 45 THEN '"soon"' ELSE CAST({{millis}} AS STRING) END
 || ',"device_type":"' || CASE WHEN value >= 15 AND value < 20 THEN 'WATCH' ELSE {{device}} END
 || '","session_id":"' || CASE WHEN value >= 20 AND value < 25 THEN '' ELSE 's' || CAST(user_id AS STRING) END
 || '","progress_seconds":' || CASE WHEN value >= 25 AND value < 30 THEN '-3' WHEN event_type = 'signup' THEN 'null' ELSE CAST(CAST(floor(value) AS INT) AS STRING) END
 || CASE WHEN value < 5 THEN '' ELSE '}}}}' END""")

DIALECT = {
    "spark": {
        "json_k": "get_json_object(props, '$.k')",
        "millis": "unix_millis(CAST(ts AS TIMESTAMP))",
        "body": _BODY,
        "uuid": _UUID.replace("event_id", "o_orderkey"),
        "departs": "CAST(date_add(DATE '2026-04-01', CAST(p_partkey % 30 AS INT)) AS TIMESTAMP_NTZ)"
                   " + make_dt_interval(0, CAST(p_partkey % 24 AS INT), 0, 0)",
    },
    "duckdb": {
        "json_k": "json_extract_string(props, '$.k')",
        "millis": "(epoch_us(ts) // 1000)",
        "body": _BODY,
        "uuid": _UUID.replace("event_id", "o_orderkey"),
        "departs": "CAST(DATE '2026-04-01' + CAST(p_partkey % 30 AS INT) AS TIMESTAMP)"
                   " + to_hours(CAST(p_partkey % 24 AS INT))",
    },
}

# ---------------------------------------------------------------------------
# Event type and device domains of the movie event schema, the
# type mapping from the generated `events` table, and the device order.
# ---------------------------------------------------------------------------
EVENT_TYPES = ("VIEW_STARTED", "VIEW_FINISHED", "VIEW_PAUSED", "VIEW_RESUMED",
               "LIKED", "SEARCHED")
DEVICE_TYPES = ("MOBILE", "DESKTOP", "TV", "TABLET")

_TYPE_MAP = ("CASE event_type WHEN 'view' THEN 'VIEW_STARTED' "
             "WHEN 'purchase' THEN 'VIEW_FINISHED' WHEN 'error' THEN 'VIEW_PAUSED' "
             "WHEN 'click' THEN 'LIKED' WHEN 'signup' THEN 'SEARCHED' END")
_DEVICE = ("CASE user_id % 4 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' "
           "WHEN 2 THEN 'TV' ELSE 'TABLET' END")
_DAY = "CAST(ts AS DATE)"
_BOOKING = [
    ("booking_id", "o_orderkey"),
    ("booking_ref", "CAST(o_orderkey AS STRING)"),
    ("customer_id", "o_custkey"),
    ("booking_status", "CASE WHEN o_orderstatus = 'F' THEN 'CANCELLED' ELSE 'CONFIRMED' END"),
    ("created_at", "o_orderdate"),
]

VIEWS: dict[str, dict] = {
    # movie events (input of V1, P1, all of §2.6 events part)
    "movie_events": {
        "base": "events",
        "cols": [
            ("event_id", "event_id"),
            ("user_id", "user_id"),
            ("movie_id", "CAST({json_k} AS BIGINT)"),
            ("event_type", _TYPE_MAP),
            ("event_time", "ts"),
            ("event_date", _DAY),
            ("device_type", _DEVICE),
            ("session_id", f"CAST(user_id AS STRING) || '-' || CAST({_DAY} AS STRING)"),
            ("progress_seconds",
             "CASE WHEN event_type IN ('view', 'purchase', 'error') "
             "THEN CAST(floor(value) AS INT) END"),
        ],
    },
    # the same events as clients send them, JSON lines of which some are malformed
    "wire_events": {
        "base": "events",
        "cols": [("payload", _WIRE.replace("{type}", _TYPE_MAP).replace("{device}", _DEVICE))],
    },
    # marketplace catalogue
    "products": {
        "base": "part",
        "cols": [
            ("product_id", "p_partkey"),
            ("name", "p_name"),
            ("price", "CAST(p_retailprice AS DECIMAL(12,2))"),
            ("stock", "p_size * 10"),
            ("category", "p_type"),
            ("status", "CASE p_partkey % 10 WHEN 0 THEN 'ARCHIVED' "
                       "WHEN 1 THEN 'INACTIVE' ELSE 'ACTIVE' END"),
        ],
    },
    # submissions to the catalogue, promo codes, orders and flights before
    # their rules are checked: each breaks some rule by a property of its row
    "catalogue_drafts": {
        "base": "part",
        "cols": [
            ("product_id", "p_partkey"),
            ("name", "CASE WHEN p_size = 1 THEN '' ELSE p_name END"),
            ("description", "CASE WHEN p_size < 10 THEN NULL ELSE repeat(p_name, p_size * 12) END"),
            ("price", "CAST(p_retailprice - 905 AS DECIMAL(12,2))"),
            ("stock", "p_size * 10 - 25"),
            ("category", "repeat(p_type, 1 + p_size % 15)"),
            ("status", "CASE p_size WHEN 7 THEN 'DRAFT' WHEN 8 THEN NULL ELSE 'ACTIVE' END"),
        ],
    },
    "promo_drafts": {
        "base": "lineitem",
        "cols": [
            ("code", "l_returnflag || '_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING)"),
            ("valid_from", "l_shipdate"),
            ("valid_until", "CASE WHEN l_quantity = 25 THEN NULL WHEN l_quantity < 20 THEN l_shipdate - INTERVAL 1 DAY "
                            "WHEN l_quantity < 25 THEN l_shipdate ELSE l_shipdate + INTERVAL 30 DAY END"),
        ],
    },
    "order_drafts": {
        "base": "orders",
        "cols": [("order_id", "o_orderkey"), ("promo_code", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE replace(o_orderpriority, '-', '_') END")],
    },
    "item_drafts": {"base": "lineitem", "cols": [("order_id", "l_orderkey"), ("quantity", "CAST(l_quantity * 21 - 40 AS INT)")]},
    "flight_drafts": {
        "base": "part",
        "cols": [
            ("flight_id", "p_partkey"),
            ("total_seats", "p_size * 5 - 10"),
            ("available_seats", "CAST(floor(p_retailprice - 905) AS INT)"),
            ("ticket_price", "CAST(p_retailprice - 902 AS DECIMAL(10,2))"),
        ],
    },
    "reservation_drafts": {
        "base": "lineitem",
        "cols": [("booking_ref", "CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_orderkey AS STRING) END"), ("seats_held", "CAST(l_quantity - 3 AS INT)")],
    },
    "booking_ids": {
        "base": "orders",
        "cols": [("order_id", "o_orderkey"),
                 ("booking_id", "CASE o_orderpriority WHEN '5-LOW' THEN md5(CAST(o_orderkey AS STRING)) WHEN '1-URGENT' THEN upper({uuid}) ELSE {uuid} END")],
    },
    # requests to change orders: updates by urgency, cancels by price
    "update_requests": {
        "base": "orders", "where": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
        "cols": [("order_id", "o_orderkey"), ("action", "'UPDATE'"), ("ts", "o_orderdate + INTERVAL 4 DAY")],
    },
    "cancel_requests": {
        "base": "orders", "where": "o_totalprice > 150000",
        "cols": [("order_id", "o_orderkey"), ("action", "'CANCEL'"),
                 ("ts", "CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 2 DAY ELSE o_orderdate + INTERVAL 9 DAY END")],
    },
    # the catalogue with its times, deletion requests and changes to it
    "dated_products": {
        "base": "part",
        "cols": [("product_id", "p_partkey"), ("status", "CASE WHEN p_partkey % 10 = 0 THEN 'ARCHIVED' ELSE 'ACTIVE' END"),
                 ("price", "CAST(p_retailprice AS DECIMAL(12,2))"), ("updated_at", "TIMESTAMP '1997-01-01 00:00:00'")],
    },
    "delete_requests": {"base": "lineitem", "where": "l_returnflag = 'R' AND l_quantity > 45", "cols": [("product_id", "l_partkey")]},
    "catalogue_changes": {
        "base": "lineitem",
        "cols": [("product_id", "l_partkey + 100"), ("status", "CASE WHEN l_linestatus = 'F' THEN 'INACTIVE' ELSE 'ACTIVE' END"),
                 ("price", "CAST(l_quantity * 3 AS DECIMAL(12,2))"), ("updated_at", "l_shipdate")],
    },
    # who acted on which order
    "order_actions": {
        "base": "lineitem",
        "cols": [("object_id", "l_orderkey"), ("actor_id", "CASE WHEN l_returnflag = 'N' THEN l_orderkey % 100 ELSE l_suppkey END"),
                 ("role", "CASE WHEN l_linenumber = 1 THEN 'ADMIN' ELSE 'USER' END")],
    },
    "order_owners": {"base": "orders", "cols": [("object_id", "o_orderkey"), ("owner_id", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey % 100 END")]},
    # marketplace orders; promo code picked by o_orderkey % 12 (10 codes,
    # then none, then an unknown code)
    "shop_orders": {
        "base": "orders",
        "cols": [
            ("order_id", "o_orderkey"),
            ("user_id", "o_custkey"),
            ("status", "CASE o_orderstatus WHEN 'O' THEN 'CREATED' "
                       "WHEN 'P' THEN 'PAYMENT_PENDING' WHEN 'F' THEN 'COMPLETED' END"),
            ("created_at", "o_orderdate"),
            ("promo_code",
             "CASE o_orderkey % 12 WHEN 0 THEN 'SAVE10' WHEN 1 THEN 'HALFOFF' "
             "WHEN 2 THEN 'OVER71' WHEN 3 THEN 'EDGE70' WHEN 4 THEN 'FLAT150' "
             "WHEN 5 THEN 'FLATMAX' WHEN 6 THEN 'USEDUP' WHEN 7 THEN 'PAUSED' "
             "WHEN 8 THEN 'OLDPROMO' WHEN 9 THEN 'MIN1M' WHEN 11 THEN 'NOSUCHCODE' END"),
        ],
    },
    # order lines; (order, line) is not unique in the data, so a line is
    # identified by (order_id, line_no, product_id, supplier_id) and never
    # used as a join key
    "order_items": {
        "base": "lineitem",
        "cols": [
            ("order_id", "l_orderkey"),
            ("line_no", "l_linenumber"),
            ("product_id", "l_partkey"),
            ("supplier_id", "l_suppkey"),
            ("quantity", "CAST(l_quantity AS INT)"),
            ("returnflag", "l_returnflag"),
            ("shipdate", "l_shipdate"),
        ],
    },
    # user operations (rate limit log): click -> CREATE_ORDER, purchase -> UPDATE_ORDER
    "operations": {
        "base": "events",
        "where": "event_type IN ('click', 'purchase')",
        "cols": [
            ("op_id", "event_id"),
            ("user_id", "user_id"),
            ("operation_type", "CASE event_type WHEN 'click' THEN 'CREATE_ORDER' "
                               "ELSE 'UPDATE_ORDER' END"),
            ("created_at", "ts"),
        ],
    },
    # flights over parts
    "flights": {
        "base": "part",
        "cols": [
            ("flight_id", "p_partkey"),
            ("flight_number", "'MQ' || CAST(p_partkey AS STRING)"),
            ("airline", "p_brand"),
            ("origin_iata", "CASE p_partkey % 4 WHEN 0 THEN 'SVO' WHEN 1 THEN 'VKO' "
                            "WHEN 2 THEN 'LED' ELSE 'AER' END"),
            ("destination_iata", "CASE p_partkey % 3 WHEN 0 THEN 'LED' "
                                 "WHEN 1 THEN 'AER' ELSE 'DME' END"),
            ("departs_at", "{departs}"),
            ("total_seats", "p_size * 5"),
            ("ticket_price", "CAST(p_retailprice AS DECIMAL(10,2))"),
            ("flight_status", "CASE p_partkey % 20 WHEN 0 THEN 'CANCELLED' "
                              "WHEN 1 THEN 'DEPARTED' ELSE 'SCHEDULED' END"),
        ],
    },
    # seat requests over order lines, replayed in ship order
    "seat_requests": {
        "base": "lineitem",
        "cols": [
            ("flight_id", "l_partkey"),
            ("booking_ref", "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
                            " || '-' || CAST(l_partkey AS STRING)"),
            ("seats", "CAST(l_quantity AS INT)"),
            ("req_ts", "l_shipdate"),
            ("order_id", "l_orderkey"),
            ("line_no", "l_linenumber"),
            ("supplier_id", "l_suppkey"),
            ("extendedprice", "l_extendedprice"),
        ],
    },
    # bookings over orders
    "bookings": {
        "base": "orders",
        "cols": _BOOKING,
    },
    # bookings as booking_reconcile sees them: an order in process (status P)
    # may hold seats and has no booking yet
    "recorded_bookings": {
        "base": "orders",
        "where": "o_orderstatus IS DISTINCT FROM 'P'",
        "cols": _BOOKING,
    },
    # notification attempts over events: one notification per
    # (user, tier, day); each event is one attempt on it
    "attempts": {
        "base": "events",
        "cols": [
            ("notif_id", "CAST(user_id AS STRING) || '-' || "
                         "CASE event_type WHEN 'purchase' THEN 'transactional' "
                         "WHEN 'signup' THEN 'service' ELSE 'marketing' END"
                         f" || '-' || CAST({_DAY} AS STRING)"),
            ("attempt_id", "event_id"),
            ("user_id", "user_id"),
            ("tier", "CASE event_type WHEN 'purchase' THEN 'transactional' "
                     "WHEN 'signup' THEN 'service' ELSE 'marketing' END"),
            ("channel", "CASE event_id % 3 WHEN 0 THEN 'push' WHEN 1 THEN 'sms' ELSE 'email' END"),
            ("status", "CASE WHEN event_type = 'error' THEN 'CHANNEL_FAILED' ELSE 'DELIVERED' END"),
            ("ts", "ts"),
            ("latency_s", "value"),
        ],
    },
    # steps of notifications over events: one notification per (user, tier,
    # day, seventh of the ids); each event is one step of it
    "notification_steps": {
        "base": "events",
        "cols": [
            ("notif_id", f"CAST(user_id AS STRING) || '-' || CAST({_DAY} AS STRING) || '-' || CAST(event_id % 7 AS STRING)"),
            ("user_id", "user_id"),
            ("tier", "CASE event_id % 7 WHEN 0 THEN 'transactional' WHEN 1 THEN 'service' ELSE 'marketing' END"),
            ("step_id", "event_id"),
            ("step", "CASE event_type WHEN 'signup' THEN 'REQUESTED' WHEN 'purchase' THEN 'DELIVERED' "
                     "WHEN 'error' THEN 'CHANNEL_FAILED' WHEN 'view' THEN 'CHANNEL_FAILED' ELSE 'DISPATCHED' END"),
            ("channel", "CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 3 = 0 THEN 'push' WHEN event_id % 3 = 1 THEN 'sms' ELSE 'email' END"),
            ("ts", "ts"),
        ],
    },
    # user notification preferences over customers
    "preferences": {
        "base": "customer",
        "cols": [
            ("user_id", "c_custkey"),
            ("preferred_channel", "CASE c_custkey % 4 WHEN 0 THEN 'push' WHEN 1 THEN 'sms' "
                                  "WHEN 2 THEN 'email' END"),
            ("opt_out_service", "c_custkey % 5 = 0"),
            ("opt_out_marketing", "c_custkey % 3 = 0"),
        ],
    },
    # logged request bodies over events: compact JSON, every 11th cut short
    "request_bodies": {
        "base": "events",
        "cols": [
            ("request_id", "event_id"),
            ("body", "CASE WHEN event_id % 11 = 0 THEN substr(" + "{body}" + ", 1, 20) ELSE {body} END"),
        ],
    },
    # receipts from the app as silent_drops sees them: none came in for what
    # was sent between 03:00 and 04:00
    "receipts": {
        "base": "events",
        "where": "EXTRACT(HOUR FROM ts) IS DISTINCT FROM 3",
        "cols": [("attempt_id", "event_id"), ("shown_at", "ts")],
    },
    # request log over events (endpoint = type)
    "request_log": {
        "base": "events",
        "cols": [
            ("request_id", "event_id"),
            ("endpoint", "'/' || event_type"),
            ("method", "CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END"),
            ("status_code", "CASE WHEN event_type = 'error' THEN 500 WHEN value > 150 THEN 429 ELSE 200 END"),
            ("duration_ms", "CAST(floor(value) AS INT)"),
            ("user_id", "user_id"),
            ("ts", "ts"),
        ],
    },
}


def _exprs(view: str, dialect: str) -> list[str]:
    sub = DIALECT[dialect]
    return [f"{expr.format(**sub)} AS {name}" for name, expr in VIEWS[view]["cols"]]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The domain view ``name`` as a lazy DataFrame."""
    spec = VIEWS[name]
    df = table(spark, sf_dir, spec["base"])
    if "where" in spec:
        df = df.where(spec["where"])
    return df.selectExpr(*_exprs(name, "spark"))


def cte(name: str, alias: str | None = None) -> str:
    """``name AS (SELECT ...)`` for a DuckDB WITH clause (under ``alias`` if given)."""
    spec = VIEWS[name]
    where = f" WHERE {spec['where']}" if "where" in spec else ""
    cols = ", ".join(_exprs(name, "duckdb"))
    return f"{alias or name} AS (SELECT {cols} FROM {spec['base']}{where})"


def with_views(*names: str, **renamed: str) -> str:
    """A WITH clause of views; ``renamed`` gives a view another name in the statement."""
    return "WITH " + ",\n".join([*(cte(n) for n in names), *(cte(n, a) for a, n in renamed.items())])
