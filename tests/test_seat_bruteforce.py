"""Seat admission against a plain sequential replay on random request
streams (repeated refs, releases, several flights), with tiny slices so the
state is carried over many of them."""

import datetime as dt
import random

from marquee.operators import flights as FL

T0 = dt.datetime(2024, 1, 1)


def replay(cap, reqs):
    """Sequential reference: one flight, requests in order."""
    s, holding, held, out = cap, set(), {}, []
    for ref, q, kind in reqs:
        if kind == "RELEASE":
            if ref in holding:
                s += held[ref]
                holding.discard(ref)
                out.append(("RELEASED", s))
            else:
                out.append(("NOT_HELD", s))
        elif ref in holding:
            out.append(("DUPLICATE", s))
        elif s >= q:
            s -= q
            holding.add(ref)
            held[ref] = q
            out.append(("ACCEPTED", s))
        else:
            out.append(("REJECTED", s))
    return out


def test_random_streams_match_sequential_replay(spark):
    rng = random.Random(7)
    rows, flights, expected = [], [], {}
    for fid in range(1, 5):
        cap = rng.randint(3, 15)
        flights.append((fid, cap))
        reqs = []
        for i in range(rng.randint(5, 40)):
            ref = f"f{fid}-r{rng.randint(0, 8)}"
            kind = "RELEASE" if rng.random() < 0.2 else "RESERVE"
            reqs.append((ref, rng.randint(1, 6), kind))
        for i, (ref, q, kind) in enumerate(reqs):
            ts = T0 + dt.timedelta(hours=3 * i)  # several days: many day buckets
            rows.append((fid, ref, q, ts, i, kind))
        for i, r in enumerate(replay(cap, reqs)):
            expected[(fid, i)] = r
    req = spark.createDataFrame(rows, "flight_id long, booking_ref string, seats int, req_ts timestamp_ntz, "
                                      "order_id long, kind string")
    fl = spark.createDataFrame(flights, "flight_id long, total_seats int")
    for kw in ({}, {"fold_rows": 3}, {"fold_rows": 1}):
        got = {(r["flight_id"], r["order_id"]): (r["status"], r["seats_left"])
               for r in FL.seat_admission(req, fl, **kw).collect()}
        assert got == expected, kw


def test_a_busy_flight_is_decided_in_slices(spark):
    """No task sorts more of a flight than a slice; its state, holds and releases go on from slice to slice."""
    rng = random.Random(3)
    rows, expected = [], {}
    for fid, cap, n in ((1, 60, 300), (2, 9, 120), (3, 5, 7), (None, 0, 6), (8, 0, 90)):
        reqs = [(f"r{rng.randint(0, 40)}", rng.randint(1, 6), "RELEASE" if rng.random() < 0.3 else "RESERVE") for _ in range(n)]
        rows += [(fid, ref, q, T0 + dt.timedelta(hours=3 * i), i, kind, "x") for i, (ref, q, kind) in enumerate(reqs)]
        answers = replay(cap, reqs) if fid in (1, 2, 3) else [("NOT_FOUND", None)] * n
        expected.update({(fid, i): a for i, a in enumerate(answers)})
    rng.shuffle(rows)
    req = spark.createDataFrame(rows, "flight_id long, booking_ref string, seats int, req_ts timestamp_ntz, order_id long, kind string, note string")
    fl = spark.createDataFrame([(1, 60), (2, 9), (3, 5), (4, 7), (8, None)], "flight_id long, total_seats int")
    for kw in ({"slice_rows": 110}, {"slice_rows": 60, "fold_rows": 5}):
        out = FL.seat_admission(req, fl, **kw)
        assert out.columns == [*req.columns, "status", "seats_left"]
        got = [((r["flight_id"], r["order_id"]), (r["status"], r["seats_left"])) for r in out.collect()]
        assert len(got) == len(rows) and dict(got) == expected, kw
    # without releases: the kind is a constant that is never null
    only = req.where("kind = 'RESERVE'").drop("kind")
    cols = ["flight_id", "order_id", "status", "seats_left"]
    assert set(FL.seat_admission(only, fl, slice_rows=90).select(*cols).collect()) == set(FL.seat_admission(only, fl).select(*cols).collect())
