"""Seat admission as a stream equals the batch operator when requests arrive
in request order (one file per time slice)."""

import os

from pyspark.sql import functions as F

from marquee.operators import flights as FL
from marquee.plans.flights_queries import _requests_with_flag, _with_releases
from marquee.sources.adapters import view
from marquee.streaming.seats import seat_admission_stream

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_root):
    req = _with_releases(_requests_with_flag(spark, SF)).withColumn("req_ts", F.col("req_ts").cast("timestamp"))
    fl = view(spark, SF, "flights")
    years = sorted(r[0] for r in req.select(F.year("req_ts")).distinct().collect())
    for y in years:  # one directory per year, read in that order
        req.where(F.year("req_ts") == y).coalesce(1).write.parquet(os.path.join(tmp_root, "in", f"y={y}"))
    stream = (spark.readStream.schema(req.schema).option("maxFilesPerTrigger", 1)
              .parquet(os.path.join(tmp_root, "in", "y=*")))
    q = (seat_admission_stream(stream, fl).writeStream.format("memory").queryName("seats_t")
         .outputMode("append").option("checkpointLocation", os.path.join(tmp_root, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT flight_id, booking_ref, seats, kind, status, seats_left FROM seats_t")
    exp = FL.seat_admission(req, fl).select("flight_id", "booking_ref", "seats", "kind", "status", "seats_left")
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
