"""Flight search, seat admission and booking checks.

Seat admission (H1/H2) is a greedy fold per flight: requests in order, a
request is accepted while enough seats remain, rejected ones consume nothing,
a booking reference already holding seats is a no-op, and a release returns
a hold's seats once.  A running sum cannot express it (rejections depend on
the state).  There is one plan for every size: requests are dealt by flight
and sorted by (flight, request order) on the JVM, and a single pass over the
sorted Arrow batches carries the state from batch to batch.  The state is one
flight's free seats and its holds, bounded by the aircraft (a hold has at least
one seat), never by the number of requests.  A flight's requests are
decided one after another, as the rules demand; flights run in parallel.
No task sorts more than a slice of a flight: one with more requests is cut into
ranges of the request order, and its state goes on from slice to slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.ranking import deal, positions
from marquee.functions.staging import staged
from marquee.session import scratch_path

REQ_ORDER = ["req_ts", "order_id", "line_no", "supplier_id", "seats", "extendedprice"]


def flight_search(flights: DataFrame, origin: str, destination: str, date=None) -> DataFrame:
    """SCHEDULED flights on a route, optionally on a UTC day (Q21: no
    order is promised; callers sort).  ``to_date(departs_at) = d`` becomes a
    range on ``departs_at`` that Parquet can skip on."""
    f = flights.where((F.col("origin_iata") == origin) & (F.col("destination_iata") == destination)
                      & (F.col("flight_status") == "SCHEDULED"))
    if date is not None:
        f = f.where(F.to_date("departs_at") == F.lit(date).cast("date"))
    return f


def booking_cost(requests: DataFrame, flights: DataFrame) -> DataFrame:
    """total = seats x the flight's current price; no flight, no booking."""
    f = flights.select("flight_id", "ticket_price")
    return (requests.join(f, "flight_id")
            .select("flight_id", "booking_ref", "seats",
                    (F.col("seats").cast("decimal(10,0)") * F.col("ticket_price"))
                    .cast("decimal(12,2)").alias("total_cost")))


def reservations_from_lines(lines: DataFrame) -> DataFrame:
    """Reservation per order (J11 mapping): RELEASED when the order has a
    returned line and no accepted one, else ACTIVE."""
    return (lines.groupBy("order_id")
            .agg(F.max("returnflag").alias("mx"), F.min("returnflag").alias("mn"))
            .select(F.col("order_id").cast("string").alias("booking_ref"),
                    F.when((F.col("mx") == "R") & (F.col("mn") != "A"), "RELEASED")
                    .otherwise("ACTIVE").alias("rsv_status")))


def booking_reconcile(bookings: DataFrame, reservations: DataFrame) -> DataFrame:
    """Bookings vs seat holds by booking_ref (full outer join): orphan
    holds, confirmed without a hold, cancelled but still holding, ..."""
    b = bookings.select("booking_ref", "booking_status")
    j = b.join(reservations, "booking_ref", "full_outer")
    bs, rs = F.col("booking_status"), F.col("rsv_status")
    verdict = (F.when(bs.isNull() & (rs == "ACTIVE"), "ORPHAN_HOLD")
               .when(bs.isNull(), "RELEASED_NO_BOOKING")
               .when((bs == "CONFIRMED") & rs.isNull(), "CONFIRMED_WITHOUT_HOLD")
               .when((bs == "CONFIRMED") & (rs == "ACTIVE"), "OK")
               .when(bs == "CONFIRMED", "CONFIRMED_BUT_RELEASED")
               .when(rs == "ACTIVE", "CANCELLED_BUT_ACTIVE")
               .when(rs.isNull(), "CANCELLED_WITHOUT_HOLD")
               .otherwise("OK"))
    return j.select("booking_ref", "booking_status", "rsv_status", verdict.alias("verdict"))


def bookings_newest(bookings: DataFrame) -> DataFrame:
    """Each customer's bookings newest first, with the position in that
    list (counted by ranges of the order, so one big customer is split)."""
    order = [F.col("created_at").desc(), F.col("booking_id").desc()]
    r = positions(bookings, ["customer_id"], order, "position").withColumn("position", F.col("position") + 1)
    return r.select("customer_id", "booking_id", "created_at", "booking_status", "position")


# ---------------------------------------------------------------------------
# Seat admission (H1) and release (H2)
# ---------------------------------------------------------------------------

class Seats:
    """Free seats of one flight and the references holding some."""

    def __init__(self, left: int, held: dict[str, int] | None = None):
        self.left, self.held = left, held if held is not None else {}

    def decide(self, kind: str, ref: str, seats: int | None) -> str:
        """Status of the next request; moves the state on."""
        if kind == "RELEASE":
            if ref not in self.held:
                return "NOT_HELD"
            self.left += self.held.pop(ref)
            return "RELEASED"
        if ref in self.held:
            return "DUPLICATE"
        if ref is None or seats is None or seats <= 0:
            return "INVALID"
        if seats > self.left:
            return "REJECTED"
        self.left -= seats
        self.held[ref] = seats
        return "ACCEPTED"


#: Rows that the pass turns into Python values at a time, and requests of one flight that a task sorts.
FOLD_ROWS = 4096
SLICE_ROWS = 1 << 21


def _fold_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Decide the requests of sorted batches; the last flight's state goes on into the next batch.

    Rows marked ``__held`` come before a flight's requests and are the state that an earlier slice
    left; if there is that column, the state at each flight's end follows in the same form."""
    flight, state, schema = None, None, None

    def end() -> Iterator[pa.RecordBatch]:
        if state is None or "__held" not in schema.names:
            return
        held = [(None, None), *state.held.items()]
        values = {"flight_id": [flight] * len(held), "booking_ref": [r for r, _ in held], "seats": [None if n is None else int(n) for _, n in held],
                  "seats_left": [state.left] * len(held), "__held": [True] * len(held)}
        yield pa.RecordBatch.from_arrays([pa.array(values.get(f.name, [None] * len(held)), f.type) for f in schema], schema=schema)

    for whole in batches:
        if schema is None:
            kept = [f for f in whole.schema if f.name not in ("__cap", "__seats", "__held")]
            schema = pa.schema([*kept, pa.field("status", pa.string()), pa.field("seats_left", pa.int64()),
                                *(f for f in whole.schema if f.name == "__held")])
        for lo in range(0, len(whole), rows):
            batch = whole.slice(lo, rows)
            columns = [batch.column(c).to_pylist() for c in ("flight_id", "__cap", "kind", "booking_ref", "__seats")]
            marks = batch.column("__held").to_pylist() if "__held" in schema.names else [False] * len(batch)
            status, left = [], []
            for f, cap, kind, ref, seats, mark in zip(*columns, marks):
                if cap is None:
                    status.append("NOT_FOUND")
                    left.append(None)
                    continue
                if f != flight:
                    yield from end()
                    flight, state = f, Seats(cap)
                if mark:
                    if ref is not None:
                        state.held[ref] = seats
                    continue
                status.append(state.decide(kind, ref, seats))
                left.append(state.left)
            if any(marks):
                batch = batch.filter(pa.array([not m for m in marks]))
            done = {"status": pa.array(status, pa.string()), "seats_left": pa.array(left, pa.int64())}
            yield pa.RecordBatch.from_arrays([done[f.name] if f.name in done else batch.column(f.name) for f in schema], schema=schema)
    yield from end()


def _sliced(hot: DataFrame, order: list[str], slice_rows: int, rows: int, fold) -> DataFrame:
    """The requests of flights with more than ``slice_rows`` each (``rows`` in all), decided slice after slice.

    They are dealt once by ranges of (flight, request order).  Round k decides the k-th range of every
    flight, onto the state that round k - 1 wrote."""
    spark = hot.sparkSession
    dealt = deal(hot, ["flight_id"], [F.col(c).asc() for c in order], -(-rows // slice_rows))
    spans = staged(dealt.groupBy("flight_id").agg(F.min("__range").alias("first"), F.max("__range").alias("last")), "spans")  # one row per such flight
    rounds = spans.agg(F.max(F.col("last") - F.col("first"))).first()[0] + 1
    root, paths, state = scratch_path(spark, "seats"), [], None
    for k in range(rounds):
        at = spans.where(F.col("first") + k <= F.col("last")).select("flight_id", (F.col("first") + k).alias("__range"))
        now = dealt.where(F.col("__range").isin([r[0] for r in at.select("__range").distinct().collect()]))  # one number per such flight, so only those files are read
        now = now.join(F.broadcast(at), ["flight_id", "__range"]).drop("__range", "__nth").withColumn("__held", F.lit(False))
        if state is not None:
            now = now.unionByName(state, allowMissingColumns=True)
        done = fold(now)
        paths.append(f"{root}/{k}")
        done.write.parquet(paths[-1])
        goes_on = F.broadcast(spans.where(F.col("first") + k + 1 <= F.col("last")).select("flight_id"))
        state = (spark.read.schema(done.schema).parquet(paths[-1]).where("__held").join(goes_on, "flight_id", "left_semi")
                 .select("flight_id", "booking_ref", F.col("seats").cast(hot.schema["__seats"].dataType).alias("__seats"),
                         F.col("seats_left").alias("__cap"), "__held"))
    return spark.read.schema(done.schema).parquet(*paths).where("NOT __held").drop("__held")


def seat_admission(requests: DataFrame, flights: DataFrame, fold_rows: int = FOLD_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """H1 (and H2 when ``requests`` has ``kind`` = RELEASE rows): status of
    every request -- ACCEPTED, REJECTED, DUPLICATE (ref already holding),
    INVALID (a reservation without a reference or a positive seat count),
    RELEASED / NOT_HELD -- and ``seats_left`` after it; NOT_FOUND with null
    ``seats_left`` if ``flights`` has no such flight or no seat count for it.

    Requests need ``flight_id, booking_ref, seats`` and the ordering columns
    of ``REQ_ORDER``; a booking_ref is expected on one flight only (V7).
    Requests of unknown flights need no order and are spread by a hash.
    Requests are counted first: flights with more than ``slice_rows`` are
    decided in slices of about that many."""
    if "kind" not in requests.columns:
        requests = requests.withColumn("kind", F.lit("RESERVE"))
    cap = flights.select("flight_id", F.col("total_seats").cast("long").alias("__cap"))
    known = requests.withColumn("seats", F.col("seats").cast("long")).withColumn("__seats", F.col("seats")).join(cap, "flight_id", "left")
    known = known.select(*requests.columns, "__cap", "__seats")
    order = [*(c for c in REQ_ORDER if c in requests.columns), "kind", "booking_ref"]

    def fold(rows: DataFrame) -> DataFrame:
        held = [c for c in rows.columns if c == "__held"]
        spread = F.when(F.col("__cap").isNull(), F.xxhash64(*order))
        dealt = rows.repartition("flight_id", spread).sortWithinPartitions("flight_id", *(F.desc(c) for c in held), *order)
        # rows of the state have nulls in columns that requests fill
        schema = T.StructType([T.StructField(f.name, f.dataType, f.nullable or bool(held)) for f in known.schema.fields if f.name not in ("__cap", "__seats")]
                              + [T.StructField("status", T.StringType()), T.StructField("seats_left", T.LongType())]
                              + [T.StructField(c, T.BooleanType()) for c in held])
        return dealt.mapInArrow(lambda batches: _fold_batches(batches, fold_rows), schema)

    many = staged(requests.groupBy("flight_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > slice_rows)
                  .join(cap.where("__cap IS NOT NULL"), "flight_id", "left_semi"), "many")  # few: each stands for so many requests
    rows = many.agg(F.sum("rows")).first()[0]
    if not rows:
        return fold(known)
    many = F.broadcast(many.select("flight_id"))
    return fold(known.join(many, "flight_id", "left_anti")).unionByName(
        _sliced(known.where("__cap IS NOT NULL").join(many, "flight_id", "left_semi"), order, slice_rows, rows, fold))
