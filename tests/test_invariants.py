"""Invariants over the sf0.01 tables and unit checks of
the operators that have no registered query."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as E
from marquee.functions.scalars import is_uuid
from marquee.operators import commerce as C
from marquee.operators import delivery as D
from marquee.operators import quality as Q
from marquee.sources.adapters import view
from marquee.sources.lookup import lookup
from marquee.streaming.ingest import to_kafka_records

SF = "/root/testdata/sf0.01"


def test_retention_invariants(spark):
    rows = E.queries()["retention_long"](spark, SF).collect()
    assert rows
    for r in rows:
        assert r["returned"] <= r["cohort_total"]
        if r["day_offset"] == 0:
            assert r["returned"] == r["cohort_total"]
    for r in E.queries()["retention_matrix"](spark, SF).collect():
        assert r["day_0"] == 100.0


def test_device_counts_sum_to_events(spark):
    total = sum(r["cnt"] for r in E.queries()["device_distribution"](spark, SF).collect())
    assert total == spark.read.parquet(f"{SF}/events.parquet").count()


def test_admission_never_exceeds_capacity(spark):
    adm = E.queries()["seat_admission"](spark, SF)
    held = adm.where("status = 'ACCEPTED'").groupBy("flight_id").agg(F.sum("seats").alias("held"),
                                                                   F.min("seats_left").alias("min_left"))
    cap = view(spark, SF, "flights").select("flight_id", "total_seats")
    bad = held.join(cap, "flight_id").where((F.col("held") > F.col("total_seats")) | (F.col("min_left") < 0))
    assert bad.count() == 0
    # seats_left after each request = capacity - accepted so far (no releases here)
    assert adm.where("seats_left < 0").count() == 0


def test_release_returns_seats_once(spark):
    rel = E.queries()["seat_release"](spark, SF)
    assert rel.where("kind = 'RELEASE' AND status NOT IN ('RELEASED', 'NOT_HELD')").count() == 0
    cap = view(spark, SF, "flights").select("flight_id", "total_seats")
    assert rel.join(cap, "flight_id").where(F.col("seats_left") > F.col("total_seats")).count() == 0


def test_lookup_point_and_batch(spark):
    p = view(spark, SF, "products")
    assert lookup(p, "product_id", 5).count() == 1
    assert lookup(p, "product_id", -1).count() == 0  # not found = empty
    ids = spark.createDataFrame([(1,), (2,), (999999,)], "product_id long")
    assert lookup(p, "product_id", ids).count() == 2


def test_order_request_rules(spark):
    orders = spark.createDataFrame([(1, "SAVE10"), (2, None), (3, "bad code"), (4, "OK_CODE"), (5, None)], "order_id long, promo_code string")
    items = spark.createDataFrame([(1, 1), (3, 1000), (5, None), (5, 2), *[(4, 5)] * 51], "order_id long, quantity int")
    got = {r["order_id"]: (r["n_items"], r["reasons"]) for r in Q.order_request_rules(orders, items).collect()}
    assert got == {1: (1, []), 2: (0, ["items_count"]), 3: (1, ["quantity_range", "promo_pattern"]), 4: (51, ["items_count"]), 5: (2, ["quantity_range"])}


def test_restored_stock_and_uses_follow_the_requests(spark):
    import datetime as dt
    day = lambda n: dt.datetime(2024, 1, n)
    orders = spark.createDataFrame([(i, s) for i, s in enumerate(["CREATED"] * 5 + ["PAYMENT_PENDING"] * 2 + ["COMPLETED"] * 2)], "order_id long, status string")
    actions = spark.createDataFrame([(0, "CANCEL", day(2)), (0, "CANCEL", day(3)), (1, "UPDATE", day(2)), (2, "UPDATE", day(2)), (2, "CANCEL", day(3)),
                                     (3, "CANCEL", day(2)), (3, "UPDATE", day(3)), (5, "UPDATE", day(1)), (6, "CANCEL", day(1)), (7, "CANCEL", day(1)), (99, "CANCEL", day(1))],
                                    "order_id long, action string, ts timestamp_ntz")
    d = {r.order_id: (r.updated, r.cancelled) for r in C.order_decisions(orders, actions).collect()}
    assert d == {0: (False, True), 1: (True, False), 2: (True, True), 3: (False, True), 5: (False, False), 6: (False, True), 7: (False, False)}
    items = spark.createDataFrame([(o, p, 10 ** o) for o in range(8) for p in (1, 77)], "order_id long, product_id long, quantity long")
    new = spark.createDataFrame([(2, 1, 3), (1, 1, 5)], "order_id long, product_id long, quantity long")
    back = C.stock_restored(orders, actions, items, new, spark.createDataFrame([(1,), (2,)], "product_id long")).collect()
    assert [tuple(r) for r in back] == [(1, 1 + 10 + 100 + 1000 + 10 ** 6 + 3)]
    priced = spark.createDataFrame([(o, "SAVE10") for o in range(8)] + [(8, None)], "order_id long, applied_promo string")
    repriced = spark.createDataFrame([(1, -1), (2, -1), (3, -1), (0, 0)], "order_id long, uses_delta int")
    assert [tuple(r) for r in C.promo_uses(priced, repriced, orders, actions).collect()] == [("SAVE10", 8, 2, 3, 3)]


def test_a_deep_page_reads_one_range(spark):
    from marquee.functions.ranking import page, page_index
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("product_id"), F.lit("x").alias("name"))
    index = page_index(df, [F.col("product_id")], ranges=50)
    for offset, size in ((0, 20), (4321, 20), (4990, 20), (5000, 20), (95, 230)):
        got = page(index, offset, size)
        assert [r.product_id for r in got.orderBy("position").collect()] == list(range(offset, min(offset + size, 5000)))
        assert got.columns == ["product_id", "name", "position"] and index.total == 5000
    touched = page(index, 4321, 20)
    assert touched.select("position").count() == 20 and index.ranges_of(4321, 20).count() <= 2


def test_promo_window_and_line_total(spark):
    p = C.promo_table(spark)
    assert Q.promo_window_ok(p).where("NOT window_ok").count() == 0
    df = spark.createDataFrame([(2, Decimal("499.99")), (0, Decimal("1.00"))], "quantity int, price decimal(12,2)")
    rows = Q.line_total(df).collect()
    assert rows[0]["total"] == Decimal("999.98") and rows[0]["quantity_ok"]
    assert not rows[1]["quantity_ok"]


def test_uuid_check(spark):
    df = spark.createDataFrame([("123e4567-e89b-12d3-a456-426614174000",), ("not-a-uuid",)], "id string")
    assert [r[0] for r in df.select(is_uuid("id")).collect()] == [True, False]


def test_soft_delete_and_changes(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    prods = spark.createDataFrame([(1, "ACTIVE", t0), (2, "ACTIVE", t0), (3, "ARCHIVED", t0)],
                                  "product_id long, status string, updated_at timestamp")
    ids = spark.createDataFrame([(2,), (3,)], "product_id long")
    out = {r["product_id"]: (r["status"], r["updated_at"] == t0)
           for r in C.soft_delete(prods, ids, F.lit(t1).cast("timestamp")).collect()}
    assert out == {1: ("ACTIVE", True), 2: ("ARCHIVED", False), 3: ("ARCHIVED", True)}
    changes = spark.createDataFrame([(1, "INACTIVE", t1), (4, "ACTIVE", t1)], prods.schema)
    got = {r["product_id"]: r["status"] for r in C.apply_changes(prods, changes).collect()}
    assert got == {1: "INACTIVE", 2: "ACTIVE", 3: "ARCHIVED", 4: "ACTIVE"}


def test_ownership_violations(spark):
    owners = spark.createDataFrame([(1, "u1"), (2, None)], "object_id long, owner_id string")
    acts = spark.createDataFrame([(1, "u1", "USER"), (1, "u2", "USER"), (1, "a", "ADMIN"), (2, "u1", "USER")],
                                 "object_id long, actor_id string, role string")
    v = C.ownership_violations(acts, owners).select("object_id", "actor_id").collect()
    assert sorted(map(tuple, v)) == [(1, "u2"), (2, "u1")]


def test_dead_letters_and_tier_routing(spark):
    states = E.queries()["delivery_state"](spark, SF)
    dl = D.dead_letters(states)
    assert dl.where("state <> 'EXHAUSTED'").count() == 0
    att = view(spark, SF, "attempts")
    routed = D.route_by_tier(att)
    assert sum(df.count() for df in routed.values()) == att.count()


def test_kafka_records_keyed_by_user(spark):
    ev = view(spark, "/root/testdata/sf0.001", "movie_events")
    rec = to_kafka_records(ev).limit(5).collect()
    assert all(r["key"] is not None and len(r["headers"]) == 2 for r in rec)


def test_seat_admission_in_tiny_slices_equals_whole_batches(spark):
    """Carrying the state over very small slices of real requests (with
    repeated refs and releases) gives the same labels as whole batches."""
    from marquee.operators import flights as FL
    from marquee.plans.flights_queries import _requests_with_flag, _with_releases
    sf = "/root/testdata/sf0.001"
    cols = ["flight_id", "booking_ref", "seats", "req_ts", "order_id", "line_no", "supplier_id", "kind",
            "status", "seats_left"]
    fl = view(spark, sf, "flights")
    for req in (view(spark, sf, "seat_requests"), _with_releases(_requests_with_flag(spark, sf))):
        a = FL.seat_admission(req, fl).select(*cols)
        b = FL.seat_admission(req, fl, fold_rows=2).select(*cols)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
