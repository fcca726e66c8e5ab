"""The six states of a notification: rules, batch against plain Python, stream with timers against batch."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from marquee.operators import delivery as D
from marquee.streaming import delivery as SD

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "notif_id string, user_id long, tier string, step_id long, step string, channel string, ts timestamp"
at = lambda h: T0 + dt.timedelta(hours=h)


def log(rows):
    return [(n, 1, "service", i, step, ch, at(h)) for i, (n, step, ch, h) in enumerate(rows)]


def states(spark, rows, hour, **kw):
    out = D.delivery_machine(spark.createDataFrame(log(rows), SCHEMA), F.lit(at(hour).isoformat()).cast("timestamp"), **kw)
    return {r.notif_id: (r.state, r.next_channel) for r in out.collect()}


def test_each_state_and_its_time(spark):
    rows = [("p", "REQUESTED", None, 0), ("d", "REQUESTED", None, 0), ("d", "DISPATCHED", "push", 1), ("ok", "DISPATCHED", "push", 1), ("ok", "DELIVERED", "push", 2),
            ("f", "DISPATCHED", "push", 1), ("f", "CHANNEL_FAILED", "push", 2),
            *[("x", s, c, h) for h, c in enumerate(("push", "sms", "email")) for s in ("DISPATCHED", "CHANNEL_FAILED")],
            ("late", "CHANNEL_FAILED", "push", 1), ("late", "DISPATCHED", "sms", 2), ("late", "DELIVERED", "push", 2.5)]
    assert states(spark, rows, 2.75) == {"p": ("PENDING", "push"), "d": ("DISPATCHING", None), "ok": ("DELIVERED", None), "f": ("CHANNEL_FAILED", "sms"),
                                         "x": ("CHANNEL_FAILED", None), "late": ("DELIVERED", None)}
    after = states(spark, rows, 3.5)
    assert after["f"] == ("FAILOVER", "sms") and after["x"] == ("EXHAUSTED", None) and after["d"][0] == "DISPATCHING"
    assert states(spark, rows, 7)["d"] == ("CHANNEL_FAILED", "sms") and states(spark, rows, 8)["d"] == ("FAILOVER", "sms")
    assert states(spark, rows, 0.5) == {"p": ("PENDING", "push"), "d": ("PENDING", "push"), "x": ("CHANNEL_FAILED", "sms")}


def random_log(seed, n):
    rng = random.Random(seed)
    rows = [(f"n{rng.randrange(60)}", rng.choice(D.STEPS), rng.choice(("push", "sms", "email")), round(rng.random() * 40, 3)) for _ in range(n)]
    return [(n, s, None if s == "REQUESTED" else c, h) for n, s, c, h in rows]


def test_batch_equals_the_step_by_step_rules(spark):
    rows = random_log(3, 150)
    for hour in (5, 20, 41, 60):
        plain = {}
        for i, (n, step, ch, h) in enumerate(rows):
            if h <= hour:
                us = int(at(h).replace(tzinfo=dt.timezone.utc).timestamp() * 1e6 + 0.5)
                plain.setdefault(n, SD.Notification(None, D.ACK_TIMEOUT_S * 1000, D.FAILOVER_S * 1000)).add(us // 1000, us, i, step, ch, None)
        want = {n: x.at(int(at(hour).replace(tzinfo=dt.timezone.utc).timestamp() * 1000))[0] for n, x in plain.items()}
        assert states(spark, rows, hour) == {n: (w["state"], w["next_channel"]) for n, w in want.items()}


def test_stream_with_timers_equals_batch(spark, tmp_root):
    """After the watermark has passed everything, the last row of each notification is the batch state at that watermark."""
    rows = sorted(log(random_log(9, 160)), key=lambda r: r[6])
    src = os.path.join(tmp_root, "in")
    cuts = [rows[:60], rows[60:120], rows[120:], [("clock", 1, "service", 9999, "REQUESTED", None, at(44))]]
    for i, part in enumerate(cuts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(os.path.join(src, f"f{i}"))
    files = sorted((os.path.join(d, f) for d, _, fs in os.walk(src) for f in fs if f.endswith(".parquet")))
    flat = os.path.join(tmp_root, "flat")
    os.makedirs(flat)
    for i, f in enumerate(files):
        os.link(f, os.path.join(flat, f"{i}.parquet"))
        os.utime(os.path.join(flat, f"{i}.parquet"), (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(flat)
    q = (SD.delivery_machine_stream(stream, watermark="0 seconds").writeStream.outputMode("update").format("memory").queryName("machine_t")
         .option("checkpointLocation", f"{tmp_root}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    out = [r for r in spark.sql("SELECT * FROM machine_t").collect() if r.notif_id != "clock"]
    last = {}
    for r in out:
        if r.notif_id not in last or (r.steps, r.as_of_ms) > (last[r.notif_id].steps, last[r.notif_id].as_of_ms):
            last[r.notif_id] = r
    batch = D.delivery_machine(spark.createDataFrame(rows, SCHEMA), F.lit(at(44).isoformat()).cast("timestamp"))
    want = {r.notif_id: (r.steps, r.state, r.delivered_by, ",".join(r.failed_channels), r.next_channel) for r in batch.collect()}
    assert {n: (r.steps, r.state, r.delivered_by, r.failed_channels, r.next_channel) for n, r in last.items()} == want
    assert {w[1] for w in want.values()} >= {"DELIVERED", "FAILOVER", "EXHAUSTED", "DISPATCHING"} and len({r.state for r in out}) == 6
