"""Raw table: stream, backfill, replay and purge on the same folders; store writes; derived ids; promo limits."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F


from marquee.operators import commerce as C
from marquee.operators import stores as ST
from marquee.sources.adapters import view
from marquee.streaming import ingest as I

DAY = 86_400_000
START = 1_704_067_200_000  # 2024-01-01


def wire(i, day):
    return {"event_id": f"00000000-0000-0000-0000-{i:012d}", "user_id": f"u{i}", "movie_id": "m", "event_type": "VIEW_STARTED",
            "timestamp": START + day * DAY + i, "device_type": "TV", "session_id": "s", "progress_seconds": 0}


def test_stream_backfill_replay_purge(spark, tmp_root):
    src, raw = f"{tmp_root}/in", f"{tmp_root}/raw"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write("\n".join(json.dumps(wire(i, i % 3)) for i in range(200)))
    for q in I.start_ingest(I.event_stream(spark, src), raw, f"{tmp_root}/bad", f"{tmp_root}/ck"):
        q.awaitTermination()
    ids = lambda: sorted(r.user_id for r in spark.read.parquet(raw).select("user_id").collect())
    assert ids() == sorted(f"u{i}" for i in range(200))
    late = I.validated(spark.createDataFrame([tuple(wire(i, 1).values()) for i in range(200, 250)], I.WIRE_SCHEMA)).drop("valid", "reasons")
    I.write_raw_batch(late, raw, "late")
    I.write_raw_batch(late, raw, "late")  # again: replaces itself
    assert ids() == sorted(f"u{i}" for i in range(250))
    assert ST.purge_old_days(spark, raw, "event_date", 1, dt.date(2024, 1, 2)) == []
    assert ST.purge_old_days(spark, raw, "event_date", 1, dt.date(2024, 1, 3)) == ["event_date=2024-01-01"]
    assert ids() == sorted(f"u{i}" for i in range(250) if i >= 200 or i % 3)


def test_new_row_wins_with_an_older_clock(spark, tmp_root):
    schema = "metric_date date, metric_name string, metric_value double, extra string, updated_at timestamp"
    row = lambda v, h: (dt.date(2024, 1, 1), "dau", v, "{}", dt.datetime(2024, 1, 2, h))
    path = f"{tmp_root}/m"
    for v, h in ((1.0, 9), (2.0, 3), (3.0, 3)):
        ST.upsert(spark, spark.createDataFrame([row(v, h)], schema), path, ST.METRIC_KEY, "updated_at", "metric_date")
    assert [r.metric_value for r in spark.read.parquet(path).collect()] == [3.0]


def test_failed_replace_leaves_the_day(spark, tmp_root):
    path, day = f"{tmp_root}/t", dt.date(2024, 1, 1)
    rows = spark.createDataFrame([(day, 1)], "d date, x int")
    ST.replace_day(spark, rows, path, "d", day)
    broken = rows.withColumn("x", F.raise_error(F.lit("lost")).cast("int"))
    try:
        ST.replace_day(spark, broken, path, "d", day)
        raise AssertionError("no failure")
    except Exception as e:  # noqa: BLE001
        assert "lost" in str(e)
    assert spark.read.parquet(path).count() == 1


def test_distinct_events_keep_distinct_ids(spark):
    base = ("", "u", "m", "VIEW_STARTED", START, "TV", "s", 0)
    rows = [base, (*base[:5], "MOBILE", "s", 0), (*base[:7], 5), (*base[:7], None), base]
    got = I.validated(spark.createDataFrame(rows, I.WIRE_SCHEMA))
    assert I.dedup(got).count() == 4
    assert got.where(~F.col("event_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).count() == 0


def test_no_promo_code_beyond_its_limit(spark):
    promos = C.promo_table(spark)
    priced = C.order_pricing(view(spark, "/root/testdata/sf0.01", "shop_orders"), view(spark, "/root/testdata/sf0.01", "order_items"),
                             view(spark, "/root/testdata/sf0.01", "products"), promos)
    used = (priced.groupBy(F.col("applied_promo").alias("code")).count().join(promos, "code")
            .where("count > max_uses - current_uses"))
    assert used.count() == 0 and priced.where("applied_promo IS NOT NULL").count() > 0
