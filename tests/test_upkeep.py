"""Compaction of the raw table and of the state tables: readers see each row once at every step."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marquee.operators import stores as ST
from marquee.streaming import ingest as I
from marquee.streaming import upkeep as U

DAY = 86_400_000
START = 1_704_067_200_000  # 2024-01-01


def events(spark, ids, days=3, movie="m"):
    rows = [(f"00000000-0000-0000-0000-{i:012d}", f"u{i % 17}", movie, "VIEW_STARTED" if i % 3 else "VIEW_FINISHED",
             START + (i % days) * DAY + i, "TV", "s", i) for i in ids]
    return I.validated(spark.createDataFrame(rows, I.WIRE_SCHEMA)).drop("valid", "reasons", "payload")


def ids(frame):
    return sorted(int(r.event_id[-12:]) for r in frame.select("event_id").collect())


def folders(raw):
    return sorted(f"{d}/{b}" for d in os.listdir(raw) if "=" in d for b in os.listdir(f"{raw}/{d}"))


def test_compact_replay_vacuum(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    for b in range(5):
        I.write_raw_batch(events(spark, range(b * 60, b * 60 + 60)), raw, f"stream-x-{b}")
    everything = list(range(300))
    early = U.read_raw(spark, raw)  # planned before any compaction
    assert U.compact(spark, raw, dt.date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    # batch folders and compact folders both stand
    assert ids(U.read_raw(spark, raw)) == everything == ids(early)
    # a batch is replayed, and another one brought other rows than before
    I.write_raw_batch(events(spark, range(60, 120)), raw, "stream-x-1")
    I.write_raw_batch(events(spark, [*range(120, 180), *range(300, 330)]), raw, "stream-x-2")
    everything = list(range(330))
    assert ids(U.read_raw(spark, raw)) == everything
    # within the grace nothing goes
    assert U.vacuum(spark, raw) == []
    gone = U.vacuum(spark, raw, grace_seconds=0)
    assert sorted(gone) == [f"event_date=2024-01-0{d}/batch_id=stream-x-{b}" for d in (1, 2) for b in (0, 3, 4)]
    assert ids(U.read_raw(spark, raw)) == everything
    # batch 2 comes again after its first rows were compacted and vacuumed
    assert U.compact(spark, raw, dt.date(2024, 1, 3)) == ["2024-01-01", "2024-01-02"]
    assert ids(U.read_raw(spark, raw)) == everything
    U.vacuum(spark, raw, grace_seconds=0)
    assert ids(U.read_raw(spark, raw)) == everything
    assert [len(os.listdir(f"{raw}/event_date=2024-01-0{d}")) for d in (1, 2, 3)] == [1, 1, 5]
    I.write_raw_batch(events(spark, range(60, 120)), raw, "stream-x-1")
    assert ids(U.read_raw(spark, raw)) == everything
    got = {r.batch_id: r.n for r in U.read_raw(spark, raw).groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"stream-x-0": 60, "stream-x-1": 60, "stream-x-2": 90, "stream-x-3": 60, "stream-x-4": 60}
    # once all is compacted, a plain reader is right as well; nothing more to do
    U.compact(spark, raw, dt.date(2024, 2, 1))
    U.vacuum(spark, raw, grace_seconds=0)
    assert ids(spark.read.parquet(raw)) == everything
    assert U.compact(spark, raw, dt.date(2024, 2, 1)) == [] and U.vacuum(spark, raw, grace_seconds=0) == []
    assert ST.purge_old_days(spark, raw, "event_date", 1, dt.date(2024, 1, 3)) == ["event_date=2024-01-01"]
    assert ids(U.read_raw(spark, raw)) == [i for i in everything if i % 3]


def test_numeric_batches_and_pruning(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    for b in range(3):
        I.write_raw_batch(events(spark, range(b * 30, b * 30 + 30)), raw, str(b))
    U.compact(spark, raw, dt.date(2024, 2, 1))
    one = U.read_raw(spark, raw).where(F.col("event_date") == dt.date(2024, 1, 2))
    assert ids(one) == [i for i in range(90) if i % 3 == 1]
    plan = one._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scans = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    # the day reaches both scans, and no row of the table is shuffled
    assert len(scans) == 2 and all("= 2024-01-02" in s for s in scans) and "hashpartitioning" not in plan


def test_lost_compaction_changes_nothing(spark, tmp_root, monkeypatch):
    raw = f"{tmp_root}/raw"
    for b in range(3):
        I.write_raw_batch(events(spark, range(b * 30, b * 30 + 30)), raw, f"b{b}")
    before = folders(raw)
    visible = U._visible
    monkeypatch.setattr(U, "_visible", lambda *a: visible(*a).withColumn("user_id", F.when(F.col("event_id").endswith("77"), F.raise_error(F.lit("lost"))).otherwise(F.col("user_id"))))
    with pytest.raises(Exception, match="lost"):
        U.compact(spark, raw, dt.date(2024, 2, 1))
    monkeypatch.undo()
    assert [f for f in folders(raw) if U.COMPACT in f] == [] and folders(raw) == before
    assert ids(U.read_raw(spark, raw)) == list(range(90))


def test_merged_state_counts_replays_once(spark, tmp_root):
    root = f"{tmp_root}/state"
    batches = [events(spark, range(b * 40, b * 40 + 40), movie=f"m{b % 2}") for b in range(6)]

    def read():
        return {k: sorted(map(tuple, v.collect())) for k, v in I.read_state(spark, root).items()}

    for b, frame in enumerate(batches[:4]):
        I.write_state_batch(frame, b, root)
    want = read()
    assert set(U.merge_state(spark, root).values()) == {2}
    assert read() == want
    I.write_state_batch(batches[1], 1, root)  # a merged batch again
    I.write_state_batch(batches[3], 3, root)  # the newest one again
    assert read() == want
    assert U.vacuum_state(spark, root) == []
    assert len(U.vacuum_state(spark, root, grace_seconds=-60)) == 9
    assert read() == want
    for b in (4, 5):
        I.write_state_batch(batches[b], b, root)
    want = read()
    assert set(U.merge_state(spark, root).values()) == {4}
    U.vacuum_state(spark, root, grace_seconds=-60)
    assert read() == want
    assert sorted(os.listdir(f"{root}/movie_views_state")) == ["batch_id=5", "batch_id=merged-4"]
    total = sum(r.view_count for r in I.read_state(spark, root)["views"].collect())
    assert total == sum(1 for i in range(240) if i % 3)
    # a merge that was not finished is not read
    os.makedirs(f"{root}/movie_views_state/batch_id=merged-5")
    assert read() == want
