"""Whole-input checks that do not go through the oracle's views."""

import datetime as dt
import os
import re
import sys
from collections import defaultdict

from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL

sys.path.insert(0, ROOT)
from marquee.operators import commerce as C  # noqa: E402
from marquee.operators import flights as FL  # noqa: E402
from marquee.plans import registry  # noqa: E402
from marquee.sources.adapters import VIEWS  # noqa: E402
from marquee.sources.tables import table  # noqa: E402
from marquee.streaming.seats import seat_admission_stream  # noqa: E402


def test_bookings_newest_covers_every_order(spark):
    lists = defaultdict(list)
    for r in table(spark, SF_SMALL, "orders").select("o_custkey", "o_orderdate", "o_orderkey").collect():
        lists[r[0]].append((r[1], r[2]))
    want = {(c, k, i) for c, rows in lists.items() for i, (_, k) in enumerate(sorted(rows, reverse=True), 1)}
    got = [(r.customer_id, r.booking_id, r.position)
           for r in registry.queries()["bookings_newest"](spark, SF_SMALL).collect()]
    assert len(got) == len(want) and set(got) == want


def test_no_view_is_thinned_by_an_id():
    assert not [n for n, v in VIEWS.items() if re.search(r"key\s*%|_id\s*%|mod\(", v.get("where", ""))]


def test_gaps_of_reconcile_and_drops_remain(spark):
    verdicts = {r[0] for r in registry.queries()["booking_reconcile"](spark, SF_SMALL).select("verdict").collect()}
    assert {"ORPHAN_HOLD", "OK"} <= verdicts
    t = registry.queries()["silent_drops"](spark, SF_SMALL).agg(F.sum("no_receipt"), F.sum("acked")).first()
    assert 0 < t[0] < t[1]


REQUESTS = "flight_id long, booking_ref string, seats int, req_ts timestamp, kind string"


def _requests(spark):
    t = dt.datetime(2026, 4, 1)
    rows = [(f, ref, q, t + dt.timedelta(hours=i), kind) for i, (f, ref, q, kind) in enumerate([
        (1, "a", 4, "RESERVE"), (9, "b", 1, "RESERVE"), (None, "c", 2, "RESERVE"), (1, "d", 7, "RESERVE"),
        (9, "b", 1, "RELEASE"), (2, "e", 1, "RESERVE"), (1, "a", 4, "RELEASE")])]
    want = {("a", "RESERVE", "ACCEPTED", 6), ("b", "RESERVE", "NOT_FOUND", None), ("c", "RESERVE", "NOT_FOUND", None),
            ("d", "RESERVE", "REJECTED", 6), ("b", "RELEASE", "NOT_FOUND", None), ("e", "RESERVE", "NOT_FOUND", None),
            ("a", "RELEASE", "RELEASED", 10)}
    flights = spark.createDataFrame([(1, 10), (2, None)], "flight_id long, total_seats int")
    return spark.createDataFrame(rows, REQUESTS), flights, want


def test_requests_of_unknown_flights_are_answered(spark):
    r, flights, want = _requests(spark)
    for more in ({}, {"fold_rows": 1}, {"fold_rows": 2}):
        got = FL.seat_admission(r, flights, **more).select("booking_ref", "kind", "status", "seats_left").collect()
        assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_stream_answers_requests_of_unknown_flights(spark, tmp_root):
    r, flights, want = _requests(spark)
    r.coalesce(1).write.parquet(os.path.join(tmp_root, "in"))
    q = (seat_admission_stream(spark.readStream.schema(r.schema).parquet(os.path.join(tmp_root, "in")), flights)
         .writeStream.format("memory").queryName("seats_unknown").outputMode("append")
         .option("checkpointLocation", os.path.join(tmp_root, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT booking_ref, kind, status, seats_left FROM seats_unknown").collect()
    assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_ledger_keeps_entries_of_unknown_orders_and_products(spark):
    d = lambda n: dt.date(2026, 4, n)
    items = spark.createDataFrame([(1, 1, 5, 1, 30, "N", d(9)), (1, 2, 7, 1, 2, "R", d(8)), (8, 1, 5, 1, 3, "R", d(7)), (None, 1, 7, 1, 1, "N", d(6)),
                                   (1, 3, None, 1, 4, "N", d(5))],
                                  "order_id long, line_no int, product_id long, supplier_id long, quantity int, returnflag string, shipdate date")
    orders = spark.createDataFrame([(1, d(1))], "order_id long, created_at date")
    products = spark.createDataFrame([(5, 20)], "product_id long, stock int")
    got = {(r.product_id, r.ts, r.kind, r.order_id, r.delta, r.balance, r.unmatched, r.below_zero)
           for r in C.stock_ledger(items, orders, products).collect()}
    assert got == {(5, d(1), "RESERVE", 1, -30, -10, None, True), (5, d(7), "RESTORE", 8, 3, -7, None, True),
                   (7, d(1), "RESERVE", 1, -2, None, "UNKNOWN_PRODUCT", None), (7, d(8), "RESTORE", 1, 2, None, "UNKNOWN_PRODUCT", None),
                   (None, d(1), "RESERVE", 1, -4, None, "UNKNOWN_PRODUCT", None),
                   (5, None, "RESERVE", 8, -3, None, "UNKNOWN_ORDER", None), (7, None, "RESERVE", None, -1, None, "UNKNOWN_ORDER", None)}


def test_wire_messages_are_parsed_once(spark):
    """A filter on the rules does not parse a message again for each field that they use."""
    from marquee.operators import quality as Q
    from marquee.streaming import ingest as I
    lines = spark.createDataFrame([('{"event_id":"","user_id":"u","timestamp":"soon"}',), ('{"user_id":"",',), ("",), (None,), ("[1]",)], "value string")
    ok, bad = Q.split_valid(I.validated(I.parse_wire(lines)))
    for frame in (ok, bad.select("payload", "reasons")):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    got = {bytes(r.payload).decode() if r.payload is not None else None: r.reasons for r in bad.collect()}
    assert got == {x: ["unparsable"] for (x,) in lines.collect()} and ok.count() == 0
