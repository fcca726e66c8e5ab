"""Hand-made edge rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marquee.functions.windows import count_in_range, running_totals
from marquee.operators import commerce as C
from marquee.operators import delivery as D
from marquee.operators import flights as FL
from marquee.operators import metrics as M
from marquee.operators import quality as Q
from marquee.operators import retention as R
from marquee.operators import stores as ST

EV_SCHEMA = ("event_id long, user_id long, movie_id long, event_type string, event_time timestamp_ntz, "
             "event_date date, device_type string, session_id string, progress_seconds int")
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def ev(spark, rows):
    """rows: (event_id, user, movie, type, day offset, progress)."""
    out = []
    for i, (eid, u, m, t, off, p) in enumerate(rows):
        ts = T0 + dt.timedelta(days=off, seconds=i)
        out.append((eid, u, m, t, ts, ts.date(), "TV", f"{u}-{ts.date()}", p))
    return spark.createDataFrame(out, EV_SCHEMA)


def test_empty_day_metrics(spark):
    from marquee.plans.daily import empty_day_metrics
    rows = {r["metric_name"]: (r["metric_value"], r["extra"]) for r in empty_day_metrics(spark, "2024-01-05").collect()}
    assert rows == {"dau": (0.0, "{}"), "avg_watch_seconds": (0.0, "{}"),
                    "view_conversion": (0.0, '{"ends":0,"starts":0}')}


def test_zero_starts(spark):
    e = ev(spark, [(1, 1, 1, "VIEW_FINISHED", 0, 10)])
    assert M.conversion_daily(e).collect()[0]["metric_value"] == 0.0
    assert M.conversion_series(e).collect()[0]["conversion"] is None


def test_top_n_tie_broken_by_id(spark):
    e = ev(spark, [(1, 1, 20, "VIEW_STARTED", 0, 0), (2, 2, 20, "VIEW_STARTED", 0, 0),
                   (3, 1, 10, "VIEW_STARTED", 0, 0), (4, 2, 10, "VIEW_STARTED", 0, 0)])
    top = [(r["movie_id"], r["rank_pos"]) for r in M.top_movies_daily(e).orderBy("rank_pos").collect()]
    assert top == [(10, 1), (20, 2)]


def test_null_progress_ignored(spark):
    e = ev(spark, [(1, 1, 1, "VIEW_FINISHED", 0, None), (2, 1, 1, "VIEW_FINISHED", 0, 90)])
    assert M.avg_watch_daily(e).collect()[0]["avg_watch_seconds"] == 90.0


def test_duplicate_event_counts_twice_unless_deduped(spark):
    e = ev(spark, [(7, 1, 1, "VIEW_STARTED", 0, 0), (7, 1, 1, "VIEW_STARTED", 0, 0)])
    assert M.movie_views(e).collect()[0]["view_count"] == 2
    assert M.dau_daily(e).collect()[0]["dau"] == 1
    assert M.movie_views(e.dropDuplicates(["event_id"])).collect()[0]["view_count"] == 1


def test_late_event_counted_on_its_day(spark):
    # arrival order does not matter: the row carries its own event_date
    e = ev(spark, [(1, 1, 1, "VIEW_STARTED", 1, 0), (2, 2, 1, "VIEW_STARTED", 0, 0)])
    got = {r["event_date"]: r["dau"] for r in M.dau_daily(e).collect()}
    assert got == {dt.date(2024, 1, 1): 1, dt.date(2024, 1, 2): 1}


def test_retention_example(spark):
    e = ev(spark, [(1, 1, 1, "LIKED", 0, None), (2, 1, 1, "LIKED", 1, None), (3, 1, 1, "LIKED", 7, None),
                   (4, 2, 1, "LIKED", 0, None), (5, 2, 1, "LIKED", 8, None)])
    got = {(r["day_offset"]): (r["cohort_total"], r["returned"]) for r in R.retention_long(e).collect()}
    assert got == {0: (2, 2), 1: (2, 1), 7: (2, 1)}
    m = R.retention_matrix(e).collect()[0]
    assert (m["day_0"], m["day_1"], m["day_7"], m["day_2"]) == (100.0, 50.0, 50.0, 0.0)


def test_session_counts(spark):
    e = ev(spark, [(i, 5, 1, t, 0, p) for i, (t, p) in enumerate(
        [("VIEW_STARTED", 0), ("VIEW_PAUSED", 15), ("VIEW_RESUMED", 15), ("VIEW_FINISHED", 90)])])
    assert M.session_counts(e).collect()[0]["events"] == 4


def test_invalid_event_quarantined(spark):
    raw = spark.createDataFrame(
        [("", "tester_007", "test_film", "NOT_EXIST", 0, "MOBILE", "s", None),
         ("0123abcd-0000-4000-8000-0123456789AB", "tester_007", "test_film", "VIEW_STARTED", 1_700_000_000_000, "DESKTOP", "s", 0)],
        "event_id string, user_id string, movie_id string, event_type string, timestamp long, "
        "device_type string, session_id string, progress_seconds int")
    v = Q.validate_events(Q.normalise_raw(raw))
    rows = {r["event_type"]: (r["valid"], r["reasons"], r["event_id"]) for r in v.collect()}
    assert rows["NOT_EXIST"][0] is False and rows["NOT_EXIST"][1] == ["bad_event_type"]
    assert rows["NOT_EXIST"][2]  # an id was filled in for the empty one
    assert rows["VIEW_STARTED"] == (True, [], "0123abcd-0000-4000-8000-0123456789AB")


def test_event_id_must_be_a_uuid(spark):
    ids = ["not-a-uuid", "0123abcd-0000-4000-8000-0123456789a", "0123abcd000040008000-0123456789ab", "0123abcd-0000-4000-8000-0123456789ab"]
    raw = spark.createDataFrame([(i, "u", "m", "LIKED", 1, "TV", "s", None) for i in ids],
                                "event_id string, user_id string, movie_id string, event_type string, timestamp long, "
                                "device_type string, session_id string, progress_seconds int")
    got = {r["event_id"]: r["reasons"] for r in Q.validate_events(Q.normalise_raw(raw)).collect()}
    assert got == {i: [] if n == 3 else ["bad_event_id"] for n, i in enumerate(ids)}


def test_masking_keeps_types_at_every_depth(spark):
    from marquee.operators.logs import mask_bodies
    deep = "[" * 20 + "]" * 20
    cases = [
        ('{"a":1.50,"password":"x","b":[1,null,{"password_hash":{"k":["y"]}}],"c":true}', '{"a":1.50,"password":"***","b":[1,null,{"password_hash":"***"}],"c":true}'),
        ('[{"password" : 12}, "password", {"xpassword":"k"}]', '[{"password":"***"}, "password", {"xpassword":"k"}]'),
        (r'{"t":"say \"password\": no","password":"a\"b, \\"}', r'{"t":"say \"password\": no","password":"***"}'),
        (r'{"pass\u0077ord":"x","a":2}', '{"a":2,"password":"***"}'),
        ('{"password":{"a":{"b":[{"c":"d"}]}}}', '{"password":"***"}'), ('{"password":' + deep + "}", None),
        ('{"password":null,"n":-3e5}', '{"password":"***","n":-3e5}'), ('{"password":"***"}', '{"password":"***"}'),
        ("7", "7"), ('"password"', '"password"'), ('{"a":', None), ("", None), (None, None), ('{"a":"' + "x" * 100000 + '","password":"' + "y" * 100000 + '"}', None),
    ]
    cases[-1] = (cases[-1][0], cases[-1][0].replace("y" * 100000, "***"))
    got = mask_bodies(spark.createDataFrame([(i, b) for i, (b, _) in enumerate(cases)], "i int, body string")).orderBy("i").collect()
    for r, (_, want) in zip(got, cases):
        assert r["masked_body"] == want, (r["body"][:80], r["masked_body"])


def _promo_order(spark, subtotal, code):
    orders = spark.createDataFrame([(1, 1, "CREATED", dt.datetime(2000, 1, 1), code)],
                                   "order_id long, user_id long, status string, created_at timestamp_ntz, promo_code string")
    items = spark.createDataFrame([(1, 1, 1, 1, 1)], "order_id long, line_no int, product_id long, supplier_id long, quantity int")
    products = spark.createDataFrame([(1, Decimal(subtotal), 100, "ACTIVE")],
                                     "product_id long, price decimal(12,2), stock int, status string")
    return C.order_pricing(orders, items, products, C.promo_table(spark)).collect()[0]


def test_promo_edges(spark):
    assert _promo_order(spark, "100.00", "EDGE70")["discount"] == Decimal("70.00")
    assert _promo_order(spark, "100.00", "OVER71")["discount"] == Decimal("0.00")
    assert _promo_order(spark, "100.00", "FLAT150")["discount"] == Decimal("100.00")
    assert _promo_order(spark, "100.00", "FLAT150")["total"] == Decimal("0.00")
    assert _promo_order(spark, "100.00", "USEDUP")["code"] == "PROMO_CODE_INVALID"
    assert _promo_order(spark, "100.00", "MIN1M")["code"] == "PROMO_CODE_MIN_AMOUNT"


def test_half_even_quantize(spark):
    df = spark.createDataFrame([(Decimal("0.50"),), (Decimal("1.50"),)], "s decimal(18,2)")
    got = [r[0] for r in df.select(F.bround(F.col("s") * F.lit(Decimal("1.00")) * F.lit(Decimal("0.01")), 2)).collect()]
    assert got == [Decimal("0.00"), Decimal("0.02")]


def test_worked_marketplace_flow(spark):
    # Widget 9.99 x 2 with SAVE10 -> subtotal 19.98, discount 2.00, total 17.98
    orders = spark.createDataFrame([(1, 1, "CREATED", dt.datetime(2026, 3, 1), "SAVE10")],
                                   "order_id long, user_id long, status string, created_at timestamp_ntz, promo_code string")
    items = spark.createDataFrame([(1, 1, 1, 1, 2)], "order_id long, line_no int, product_id long, supplier_id long, quantity int")
    products = spark.createDataFrame([(1, Decimal("9.99"), 100, "ACTIVE")],
                                     "product_id long, price decimal(12,2), stock int, status string")
    r = C.order_pricing(orders, items, products, C.promo_table(spark)).collect()[0]
    assert (r["subtotal"], r["discount"], r["total"]) == (Decimal("19.98"), Decimal("2.00"), Decimal("17.98"))


def test_promo_window_closed_both_ends(spark):
    for ts in (dt.datetime(1996, 1, 1, 0, 0, 0), dt.datetime(1998, 12, 31, 23, 59, 59)):
        orders = spark.createDataFrame([(1, 1, "CREATED", ts, "HALFOFF")],
                                       "order_id long, user_id long, status string, created_at timestamp_ntz, promo_code string")
        items = spark.createDataFrame([(1, 1, 1, 1, 1)], "order_id long, line_no int, product_id long, supplier_id long, quantity int")
        products = spark.createDataFrame([(1, Decimal("200.00"), 100, "ACTIVE")],
                                         "product_id long, price decimal(12,2), stock int, status string")
        assert C.order_pricing(orders, items, products, C.promo_table(spark)).collect()[0]["code"] == "OK"


def test_rate_limit_60_61_seconds(spark):
    t = dt.datetime(2024, 1, 1, 23, 59, 30)  # crosses the day bucket boundary
    ops = spark.createDataFrame(
        [(1, 1, "CREATE_ORDER", t), (2, 1, "CREATE_ORDER", t + dt.timedelta(seconds=60)),
         (3, 1, "CREATE_ORDER", t + dt.timedelta(seconds=121))],
        "op_id long, user_id long, operation_type string, created_at timestamp_ntz")
    got = {r["op_id"]: r["limited"] for r in C.rate_limit(ops, window_minutes=1).collect()}
    assert got == {1: False, 2: True, 3: False}


def _flight(spark, cap):
    return spark.createDataFrame([(1, cap)], "flight_id long, total_seats int")


def _reqs(spark, rows):
    data = [(1, ref, q, T0 + dt.timedelta(hours=i), kind) for i, (ref, q, kind) in enumerate(rows)]
    return spark.createDataFrame(data, "flight_id long, booking_ref string, seats int, req_ts timestamp_ntz, kind string")


def _statuses(df):
    return [r["status"] for r in df.orderBy("req_ts").collect()]


def test_seat_fold(spark):
    r = _reqs(spark, [("a", 4, "RESERVE"), ("b", 5, "RESERVE"), ("c", 3, "RESERVE"), ("d", 1, "RESERVE")])
    assert _statuses(FL.seat_admission(r, _flight(spark, 10))) == ["ACCEPTED", "ACCEPTED", "REJECTED", "ACCEPTED"]


def test_seat_fold_carries_its_state_over_batches(spark):
    rows = [(f"r{i}", 1 + i % 3, "RESERVE") for i in range(40)] + [("r3", 1, "RESERVE")]
    r = _reqs(spark, rows)
    one = _statuses(FL.seat_admission(r, _flight(spark, 30)))
    many = _statuses(FL.seat_admission(r, _flight(spark, 30), fold_rows=3))
    assert one == many == _statuses(FL.seat_admission(r, _flight(spark, 30), fold_rows=1))
    assert one[-1] == "DUPLICATE"


def test_requests_without_a_positive_seat_count(spark):
    r = _reqs(spark, [("a", 0, "RESERVE"), ("b", -3, "RESERVE"), ("c", None, "RESERVE"), ("a", 1, "RELEASE"), ("d", 10, "RESERVE")])
    assert _statuses(FL.seat_admission(r, _flight(spark, 10))) == ["INVALID", "INVALID", "INVALID", "NOT_HELD", "ACCEPTED"]


def test_idempotent_request_and_retry_after_rejection(spark):
    r = _reqs(spark, [("x", 2, "RESERVE"), ("x", 2, "RESERVE")])
    assert _statuses(FL.seat_admission(r, _flight(spark, 10))) == ["ACCEPTED", "DUPLICATE"]
    # free 3: a asks 5 (reject); h releases 3 -> 6 free; a asks 5 again (accept)
    r = _reqs(spark, [("h", 7, "RESERVE"), ("a", 5, "RESERVE"), ("h", 7, "RELEASE"), ("a", 5, "RESERVE")])
    got = _statuses(FL.seat_admission(r, _flight(spark, 10), fold_rows=1))
    assert got == ["ACCEPTED", "REJECTED", "RELEASED", "ACCEPTED"]


def test_provider_health_window(spark):
    def calls(statuses):
        return spark.createDataFrame(
            [(i, "sms", s, T0 + dt.timedelta(minutes=i)) for i, s in enumerate(statuses)],
            "attempt_id long, channel string, status string, ts timestamp_ntz")
    ten = ["DELIVERED"] * 5 + ["CHANNEL_FAILED"] * 5
    assert D.provider_health(calls(ten)).where("unhealthy").count() == 1
    nine = ["CHANNEL_FAILED"] * 9
    assert D.provider_health(calls(nine)).where("unhealthy").count() == 0


def test_next_channel_chain(spark):
    df = spark.createDataFrame([("sms", ["sms"]), (None, ["push"]), ("email", ["push", "sms", "email"])],
                               "pref string, failed array<string>")
    got = [r[0] for r in df.select(D.next_channel(F.col("pref"), F.col("failed"))).collect()]
    assert got == ["push", "sms", None]


def test_running_totals_equal_plain_window(spark):
    from pyspark.sql import Window
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id"),
                                 (F.col("id") * 7 % 11).alias("v"))
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    ref = sorted(map(tuple, df.withColumn("run", F.sum("v").over(w)).select("k", "id", "run").collect()))
    for ranges in (1, 3, 40):  # a key in one range, in several, in many
        r = running_totals(df, ["k"], [F.col("id")], {"run": F.col("v")}, ranges=ranges)
        assert sorted(map(tuple, r.select("k", "id", "run").collect())) == ref


def test_count_in_range_equal_plain_window(spark):
    from pyspark.sql import Window
    df = spark.range(300).select((F.col("id") % 2).alias("k"), (F.col("id") * 13 % 997).alias("t"))
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-50, 0)
    ref = sorted(map(tuple, df.withColumn("n", F.count(F.lit(1)).over(w)).collect()))
    for hot_rows in (0, 10_000):  # every key hot (range-wide buckets) / none hot
        c = count_in_range(df, ["k"], F.col("t"), 50, 120, out="n", hot_rows=hot_rows)
        assert sorted(map(tuple, c.collect())) == ref


def test_upsert_q9_and_latest(spark):
    run1 = spark.createDataFrame([(dt.date(2024, 1, 1), "view_conversion", 1.0, '{"ends":2,"starts":2}',
                                   dt.datetime(2024, 1, 1, 12))],
                                 "metric_date date, metric_name string, metric_value double, extra string, updated_at timestamp_ntz")
    run2 = spark.createDataFrame([(dt.date(2024, 1, 1), "view_conversion", 0.6666, '{"ends":2,"starts":3}',
                                   dt.datetime(2024, 1, 2, 1))], run1.schema)
    store = ST.merge_rows(run1, run2, ST.METRIC_KEY, "updated_at")
    assert store.count() == 2
    latest = ST.latest_metrics(store).collect()
    assert len(latest) == 1 and latest[0]["extra"] == '{"ends":2,"starts":3}' and latest[0]["versions"] == 2
