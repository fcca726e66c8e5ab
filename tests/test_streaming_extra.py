"""Streaming dedup (T3), per-tier sinks (T6) and the dead-letter sink (K8)."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from marquee.sources.adapters import view
from marquee.streaming import delivery as SD
from marquee.streaming import ingest as I


def test_stream_dedup_drops_redelivered_ids(spark, tmp_root):
    src = os.path.join(tmp_root, "in")
    rows = [("a", "u", "m", "VIEW_STARTED", 1_700_000_000_000, "TV", "s", 0),
            ("b", "u", "m", "VIEW_STARTED", 1_700_000_001_000, "TV", "s", 0)]
    spark.createDataFrame(rows, I.WIRE_SCHEMA).coalesce(1).write.json(os.path.join(src, "f1"))
    # the same id redelivered a minute later, in a later file
    spark.createDataFrame([("a", "u", "m", "VIEW_STARTED", 1_700_000_060_000, "TV", "s", 0)], I.WIRE_SCHEMA) \
        .coalesce(1).write.json(os.path.join(src, "f2"))
    stream = spark.readStream.schema(I.WIRE_SCHEMA).option("maxFilesPerTrigger", 1).json(os.path.join(src, "*"))
    q = (I.dedup(I.validated(stream)).select("event_id").writeStream.format("memory").queryName("dedup_t")
         .option("checkpointLocation", os.path.join(tmp_root, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r[0] for r in spark.sql("SELECT event_id FROM dedup_t").collect()) == ["a", "b"]


def test_tier_sinks_and_dead_letters(spark, tmp_root):
    att = view(spark, SF_SMALL, "attempts").withColumn("ts", F.col("ts").cast("timestamp"))
    src = f"{tmp_root}/attempts"
    att.write.parquet(src)
    stream = spark.readStream.schema(att.schema).option("maxFilesPerTrigger", 1).parquet(src)
    qs = SD.tier_sinks(stream, f"{tmp_root}/tiers", f"{tmp_root}/ck-tiers")
    for q in qs:
        q.awaitTermination()
    counts = {t: spark.read.parquet(f"{tmp_root}/tiers/{t}").count() for t in ("transactional", "service", "marketing")}
    assert sum(counts.values()) == att.count()
    states = SD.delivery_state_stream(spark.readStream.schema(att.schema).parquet(src))
    q = SD.start_dead_letter_sink(states, f"{tmp_root}/dead", f"{tmp_root}/ck-dead")
    q.awaitTermination()
    if os.path.exists(f"{tmp_root}/dead"):
        dead = spark.read.parquet(f"{tmp_root}/dead")
        assert dead.where("state <> 'EXHAUSTED'").count() == 0
