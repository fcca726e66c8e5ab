"""Continuous ingest (S1, K1, K2, T1, T3) and incremental state.

Source: a file source of wire-form events (JSON lines, one file per
producer flush), parsed with the explicit event schema; each message's bytes
stay beside its fields, so the quarantine table holds what was sent.  A Kafka topic is the
same stream with ``value`` parsed by ``from_json``; the Kafka connector jar
is not bundled here, so that path is written but untested.  Avro with a
schema registry would need ``from_avro`` (spark-avro) after stripping the
5-byte registry header -- also not bundled.

Sinks: accepted rows go to the raw table, partitioned by ``event_date`` and
``batch_id``; a micro-batch or backfill overwrites its own partitions, so a
replayed batch replaces itself and the table needs no commit log: stream,
backfill and purge work on the same folders.  Rejected rows go to a
quarantine table with their reasons, one folder per batch.  The incremental
views write one partial-state partition per micro-batch under
``batch_id=<id>`` in the same way; readers merge all batches.

Upkeep of both is in ``streaming.upkeep``: batch folders become sorted day
files, batch states become one merged state, while readers and the stream go on.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import quality as Q
from marquee.operators import state as S
from marquee.streaming.upkeep import read_partials

# Wire schema of one event (string ids, epoch-millis time, nullable progress).
WIRE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("movie_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("progress_seconds", T.IntegerType()),
])


def parse_wire(lines: DataFrame, payload: str = "value") -> DataFrame:
    """The wire fields of JSON messages in ``payload`` (string or binary), the message itself as
    ``payload`` (its bytes) and ``unparsable``: cut off, not an object, or a field of the wrong type.

    Nothing is dropped: what does not parse goes on with the fields that could be read."""
    schema = T.StructType([*WIRE_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    rows = lines.select(F.col(payload).cast("binary").alias("payload"), F.col(payload).cast("string").alias("__text"))
    e = F.from_json("__text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # generated, not projected: a filter on any of the fields would else parse the message again for each use of one
    parsed = rows.select("payload", "__text", F.explode(F.array(e)).alias("__e"))
    whole = F.col("__e").isNotNull() & F.col("__e._corrupt").isNull() & F.trim("__text").startswith("{")
    return parsed.select(*[F.col(f"__e.{f.name}").alias(f.name) for f in WIRE_SCHEMA.fields], "payload",
                         (~F.coalesce(whole, F.lit(False))).alias("unparsable"))


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 over files of JSON lines: a streaming frame in the wire schema (``parse_wire``)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_wire(r.load(path).where(F.length(F.trim("value")) > 0))


def kafka_event_stream(spark: SparkSession, servers: str, topic: str,
                       max_offsets_per_trigger: int = 1_048_576) -> DataFrame:
    """S1 over Kafka (connector required at runtime; untested here)."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
           .option("maxOffsetsPerTrigger", str(max_offsets_per_trigger)).load())
    return parse_wire(raw)


def to_kafka_records(events: DataFrame) -> DataFrame:
    """K2: keyed records for a Kafka sink: key = user_id (per-user order),
    headers carry the type and id, value is the JSON event."""
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in events.columns])).alias("value"),
        F.array(F.struct(F.lit("event_type").alias("key"), F.col("event_type").cast("string").cast("binary").alias("value")),
                F.struct(F.lit("event_id").alias("key"), F.col("event_id").cast("string").cast("binary").alias("value")))
        .alias("headers"))


def validated(stream: DataFrame, clock=None) -> DataFrame:
    """V1 + V2 + P1 + P2 on a wire-form frame (batch or stream): defaults
    filled, rules applied, stored form with ``valid`` and ``reasons``."""
    return Q.validate_events(Q.normalise_raw(stream, clock=clock))


def start_ingest(stream: DataFrame, raw_path: str, quarantine_path: str, checkpoint_root: str,
                 trigger: dict | None = None):
    """T1 + K1: two queries on one source, each with its own checkpoint; a
    batch that is run again replaces what it wrote.  Batch folders carry the
    query's own id, so a second stream into the same table adds to it.
    Returns (raw_query, quarantine_query)."""
    v = validated(stream)
    trig = trigger or {"availableNow": True}
    source = hashlib.md5(checkpoint_root.encode()).hexdigest()[:8]  # the checkpoint names the stream

    def put_raw(df: DataFrame, bid: int) -> None:
        write_raw_batch(df, raw_path, f"stream-{source}-{bid}")

    def put_quarantine(df: DataFrame, bid: int) -> None:
        df.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id=stream-{source}-{bid}")

    ok = (v.where("valid").drop("valid", "reasons", "payload").writeStream.foreachBatch(put_raw)
          .option("checkpointLocation", f"{checkpoint_root}/raw").trigger(**trig).start())
    bad = (v.where("NOT valid").drop("valid").writeStream.foreachBatch(put_quarantine)
           .option("checkpointLocation", f"{checkpoint_root}/quarantine").trigger(**trig).start())
    return ok, bad


def write_raw_batch(events: DataFrame, raw_path: str, batch_id: str | None = None) -> None:
    """K1 for a micro-batch or a backfill: partitioned by day and batch, files
    sorted by the table's key (type, user, time) for min/max skipping.

    Rows are rebalanced by day, so a large day is split over tasks by its
    measured size.  Writing a ``batch_id`` again replaces it; without one the
    rows are a batch of their own."""
    batch_id = batch_id or f"backfill-{uuid.uuid4().hex[:12]}"
    (events.hint("rebalance", "event_date").sortWithinPartitions("event_date", "event_type", "user_id", "event_time")
     .withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(raw_path))


def dedup(stream: DataFrame, key: str = "event_id", within: str = "24 hours",
          ts: str = "event_time") -> DataFrame:
    """Drop repeats of ``key`` arriving within ``within`` of each other;
    the watermark bounds the state.  A batch frame is deduplicated whole."""
    if not stream.isStreaming:
        return stream.dropDuplicates([key])
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark([key])


def write_state_batch(batch: DataFrame, batch_id: int, state_root: str) -> None:
    """T2 body: the three partial states of one micro-batch, each written to
    ``batch_id=<id>`` with overwrite (replay-safe)."""
    b = batch.where("valid") if "valid" in batch.columns else batch
    # three states from one reading of the source: only the columns they use are kept
    b = (b.select("event_date", "user_id", "movie_id", "event_type", "progress_seconds", F.lit(batch_id).cast("long").alias("batch_id"))
         .persist(StorageLevel.DISK_ONLY))
    try:
        for name, frame in (("dau_state", S.dau_state(b)), ("movie_views_state", S.views_state(b)),
                            ("avg_progress_state", S.avg_state(b))):
            frame.drop("batch_id").write.mode("overwrite").parquet(f"{state_root}/{name}/batch_id={batch_id}")
    finally:
        b.unpersist()


def start_state_views(stream: DataFrame, state_root: str, checkpoint: str, trigger: dict | None = None):
    """Incremental views as one foreachBatch query over validated events."""
    v = validated(stream)
    return (v.writeStream.foreachBatch(lambda df, bid: write_state_batch(df, bid, state_root))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_state(spark: SparkSession, state_root: str) -> dict[str, DataFrame]:
    """Merged readers over all batches."""
    return {
        "dau": S.dau_from_state(read_partials(spark, f"{state_root}/dau_state")),
        "views": S.views_from_state(read_partials(spark, f"{state_root}/movie_views_state")),
        "avg_watch": S.avg_from_state(read_partials(spark, f"{state_root}/avg_progress_state")),
    }
