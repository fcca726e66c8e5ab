"""Seat admission on a stream of requests (H1/H2 stream form).

State per flight: seats left and the references currently holding seats
(with their seat counts).  Holding references are bounded by the aircraft
(each holds at least one seat), so the state is small whatever the request
volume.  Each micro-batch sorts a flight's new requests by request order
and folds them onto the state with the same rules as the batch operator;
requests must arrive in request order across micro-batches (a file or topic
partition per time slice), which is what makes stream = batch.
"""

from __future__ import annotations

import json
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marquee.operators.flights import REQ_ORDER, Seats

OUT_SCHEMA = ("flight_id long, booking_ref string, seats long, req_ts timestamp, kind string, "
              "status string, seats_left long")
STATE_SCHEMA = "seats_left long, holding string"


def _update(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (flight_id,) = key
    pdf = pd.concat(list(batches), ignore_index=True)
    order = [c for c in REQ_ORDER if c in pdf.columns] + ["kind", "booking_ref"]
    pdf = pdf.sort_values(order, kind="stable")
    if state.exists:
        left, holding = state.get
        seats = Seats(left, json.loads(holding))
    else:
        seats = Seats(int(pdf["cap"].iloc[0]))
    status, left = [], []
    for ref, q, kind in zip(pdf["booking_ref"], pdf["seats"], pdf["kind"]):
        status.append(seats.decide(kind, ref, None if pd.isna(q) else int(q)))
        left.append(seats.left)
    state.update((seats.left, json.dumps(seats.held, sort_keys=True)))
    out = pdf[["flight_id", "booking_ref", "seats", "req_ts", "kind"]].copy()
    out["status"] = status
    out["seats_left"] = left
    yield out


def seat_admission_stream(requests: DataFrame, flights: DataFrame) -> DataFrame:
    """Streaming H1/H2: ``requests`` is a streaming frame with the batch
    operator's columns (``req_ts`` as TIMESTAMP); ``flights`` a static frame
    of capacities.  Output in append mode: one labelled row per request
    (NOT_FOUND, without state, if the flight or its capacity is unknown)."""
    if "kind" not in requests.columns:
        requests = requests.withColumn("kind", F.lit("RESERVE"))
    cap = flights.select("flight_id", F.col("total_seats").cast("long").alias("cap")).where("cap IS NOT NULL")
    requests = requests.withColumn("seats", F.col("seats").cast("long"))
    missing = requests.join(cap, "flight_id", "left_anti").select(
        F.col("flight_id").cast("long").alias("flight_id"), "booking_ref", "seats", F.col("req_ts").cast("timestamp").alias("req_ts"),
        "kind", F.lit("NOT_FOUND").alias("status"), F.lit(None).cast("long").alias("seats_left"))
    return (requests.join(cap, "flight_id").groupBy("flight_id")
            .applyInPandasWithState(_update, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
            .unionByName(missing))
