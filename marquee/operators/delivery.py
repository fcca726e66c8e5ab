"""Notification delivery operators from the platform design (T6-T14,
A24-A29, W5, K8).

Input is an attempt log ``notif_id, attempt_id, user_id, tier, channel,
status, ts, latency_s`` (one row per send attempt).  Current state is a
``max_by`` over the attempt order -- a group-by, so a notification with many
attempts is reduced map-side -- and every metric is a group-by over windows
of time.  Ordered-per-provider checks (W5) use bucketed running counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.quantiles import exact_percentiles
from marquee.functions.ranking import positions
from marquee.functions.windows import look_back

# The failover chain after the user's preference (the design
# names push first, then SMS or email; the order is a parameter).
DEFAULT_CHAIN = ("push", "sms", "email")
TIERS = ("transactional", "service", "marketing")


def _attempt_key() -> Column:
    return F.struct("ts", "attempt_id")


def next_channel(preferred: Column, failed: Column, chain=DEFAULT_CHAIN) -> Column:
    """First channel of (preference, chain...) not yet failed; NULL means
    exhausted.  ``get`` returns NULL past the end (``[0]`` would raise)."""
    full = F.array_compact(F.array(preferred, *[F.lit(c) for c in chain]))
    return F.get(F.array_except(full, failed), 0)


def delivery_state(attempts: DataFrame, prefs: DataFrame, chain=DEFAULT_CHAIN) -> DataFrame:
    """Current state per notification: DELIVERED, or after a failed last
    attempt FAILOVER (a channel is left) / EXHAUSTED (dead letter)."""
    g = attempts.groupBy("notif_id", "user_id", "tier").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.max_by("status", _attempt_key()).alias("last_status"),
        F.max_by("channel", _attempt_key()).alias("last_channel"),
        F.array_sort(F.collect_set(F.when(F.col("status") == "CHANNEL_FAILED", F.col("channel"))))
        .alias("failed_channels"))
    p = prefs.select("user_id", "preferred_channel")
    j = g.join(p, "user_id", "left")
    nxt = next_channel(F.col("preferred_channel"), F.col("failed_channels"), chain)
    state = (F.when(F.col("last_status") == "DELIVERED", "DELIVERED")
             .when(nxt.isNotNull(), "FAILOVER").otherwise("EXHAUSTED"))
    return j.select("notif_id", "user_id", "tier", "attempts", "last_channel", "failed_channels",
                    state.alias("state"),
                    F.when(F.col("last_status") != "DELIVERED", nxt).alias("next_channel"))


# What a step log records, and the states of a notification.
STEPS = ("REQUESTED", "DISPATCHED", "DELIVERED", "CHANNEL_FAILED")
STATES = ("PENDING", "DISPATCHING", "DELIVERED", "CHANNEL_FAILED", "FAILOVER", "EXHAUSTED")
#: Seconds after which a dispatch without an answer counts as failed, and after a failure until the failover is taken up.
ACK_TIMEOUT_S, FAILOVER_S = 6 * 3600, 3600


def delivery_machine(steps: DataFrame, as_of: Column, prefs: DataFrame | None = None, ack_timeout_s: int = ACK_TIMEOUT_S,
                     failover_s: int = FAILOVER_S, chain=DEFAULT_CHAIN) -> DataFrame:
    """State of every notification at ``as_of`` (a timestamp), from a log of
    ``notif_id, user_id, tier, step_id, step, channel, ts``.

    An acknowledgement ends it as DELIVERED, also one that comes late; other
    channels' answers are then no longer waited for.  Else
    each channel counts by its last step: a dispatch is in flight (DISPATCHING)
    until ``ack_timeout_s`` have passed without an answer, then it has failed;
    a failure is CHANNEL_FAILED for ``failover_s`` and after that FAILOVER, if
    a channel of the chain has not failed, else EXHAUSTED.  Without a dispatch it is PENDING.
    Later steps than ``as_of`` are not known yet."""
    known = steps.where(F.col("ts") <= as_of)
    last = F.struct("ts", "step_id")
    seconds = lambda s: F.make_dt_interval(secs=F.lit(s))
    # by channel first: a notification's log is merged in every task, whatever its length
    per = known.groupBy("notif_id", "channel").agg(
        F.max("user_id").alias("user_id"), F.max("tier").alias("tier"), F.max_by("step", last).alias("step"), F.max("ts").alias("ts"),
        F.bool_or(F.col("step") == "DELIVERED").alias("ok"), F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("step") == "DELIVERED", last)).alias("ok_at"))
    overdue = F.col("ts") + seconds(ack_timeout_s)
    failed_at = F.when(F.col("step") == "CHANNEL_FAILED", F.col("ts")).when((F.col("step") == "DISPATCHED") & (overdue <= as_of), overdue)
    per = per.withColumn("failed_at", F.when(F.col("channel").isNotNull(), failed_at))
    g = per.groupBy("notif_id").agg(
        F.max("user_id").alias("user_id"), F.max("tier").alias("tier"), F.sum("n").alias("steps"), F.bool_or("ok").alias("ok"),
        F.max_by("channel", "ok_at").alias("ok_channel"), F.max("failed_at").alias("failed_at"),
        F.bool_or(F.col("channel").isNotNull() & (F.col("step") == "DISPATCHED") & F.col("failed_at").isNull()).alias("flying"),
        F.array_sort(F.collect_set(F.when(F.col("failed_at").isNotNull(), F.col("channel")))).alias("failed"),
        F.array_sort(F.collect_set(F.when(F.col("step") == "CHANNEL_FAILED", F.col("channel")))).alias("refused"))
    # what was delivered waits for no other answer, so only stated failures count there
    g = g.withColumn("failed_channels", F.when(F.col("ok"), F.col("refused")).otherwise(F.col("failed")))
    preferred = F.lit(None).cast("string")
    if prefs is not None:
        g, preferred = g.join(prefs.select("user_id", "preferred_channel"), "user_id", "left"), F.col("preferred_channel")
    nxt = next_channel(preferred, F.col("failed_channels"), chain)
    state = (F.when(F.col("ok"), "DELIVERED").when(F.col("flying"), "DISPATCHING").when(F.col("failed_at").isNull(), "PENDING")
             .when(F.col("failed_at") + seconds(failover_s) > as_of, "CHANNEL_FAILED").when(nxt.isNotNull(), "FAILOVER").otherwise("EXHAUSTED"))
    return g.select("notif_id", "user_id", "tier", "steps", state.alias("state"), F.when(F.col("ok"), F.col("ok_channel")).alias("delivered_by"),
                    "failed_channels", F.when(state.isin("PENDING", "CHANNEL_FAILED", "FAILOVER"), nxt).alias("next_channel"))


def dead_letters(states: DataFrame) -> DataFrame:
    """K8: exhausted notifications, written to their own table by the caller."""
    return states.where(F.col("state") == "EXHAUSTED")


def opt_out(notifications: DataFrame, prefs: DataFrame) -> DataFrame:
    """Service and marketing sends may be refused by the user;
    transactional ones never are."""
    p = prefs.select("user_id", "opt_out_service", "opt_out_marketing")
    j = notifications.join(p, "user_id", "left")
    blocked = (F.when(F.col("tier") == "service", F.coalesce(F.col("opt_out_service"), F.lit(False)))
               .when(F.col("tier") == "marketing", F.coalesce(F.col("opt_out_marketing"), F.lit(False)))
               .otherwise(F.lit(False)))
    return j.select("notif_id", "user_id", "tier", blocked.alias("blocked"))


def route_by_tier(df: DataFrame) -> dict[str, DataFrame]:
    """One filtered frame per tier (each goes to its own sink/topic)."""
    return {t: df.where(F.col("tier") == t) for t in TIERS}


def duplicate_delivery(attempts: DataFrame) -> DataFrame:
    """Notifications delivered more than once."""
    return (attempts.where(F.col("status") == "DELIVERED").groupBy("notif_id")
            .agg(F.count(F.lit(1)).alias("deliveries")).where(F.col("deliveries") > 1))


def tier_volume(attempts: DataFrame, per_minute_cap: int = 60000) -> DataFrame:
    """Sends per tier and minute against the campaign throughput target."""
    return (attempts.groupBy("tier", F.window("ts", "1 minute").start.alias("minute"))
            .agg(F.count(F.lit(1)).alias("sends"))
            .withColumn("over_cap", F.col("sends") > per_minute_cap))


def delivery_success(attempts: DataFrame, target: float = 0.995, push_alert: float = 0.85, tier: str = "transactional",
                     hours: int = 24) -> DataFrame:
    """Success rate of a tier over any ``hours``: for every minute with
    attempts and each channel, and for all channels together (channel NULL),
    the rate over the window that ends with it; target flag for the whole
    tier, alert for push.

    Attempts are first counted per (minute, channel), partial sums that merge;
    only these are looked back over.  A minute goes to the bucket of its
    window and to the next one as context, so no window spans the history."""
    minute = F.unix_micros(F.date_trunc("minute", F.col("ts")).cast("timestamp")).alias("minute")
    per = (attempts.where(F.col("tier") == tier).groupBy(minute, "channel")
           .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "DELIVERED").alias("ok")))
    every = per.withColumn("channel", F.explode(F.array(F.col("channel"), F.lit(None).cast("string"))))
    every = every.groupBy("minute", "channel").agg(F.sum("n").alias("n"), F.sum("ok").alias("ok"))
    width = hours * 3_600_000_000
    bucket = F.expr(f"minute div {width}")
    placed = every.select("*", F.inline(F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("past")), F.struct((bucket + 1).alias("bucket"), F.lit(True).alias("past")))))
    w = Window.partitionBy("channel", "bucket").orderBy("minute").rangeBetween(-(width - 60_000_000), 0)
    r = placed.withColumns({"attempts": F.sum("n").over(w), "delivered": F.sum("ok").over(w)}).where("NOT past")
    rate = F.col("delivered") / F.col("attempts")
    return r.select(F.timestamp_micros("minute").cast("timestamp_ntz").alias("window_end"), "channel", "attempts", "delivered", rate.alias("success_rate"),
                    F.when(F.col("channel").isNull(), rate >= target).alias("meets_target"),
                    ((F.col("channel") == "push") & (rate < push_alert)).alias("push_alert"))


def delivery_latency(attempts: DataFrame) -> DataFrame:
    """Exact P95 / P99 of event-to-delivery seconds per tier."""
    d = attempts.where(F.col("status") == "DELIVERED")
    return exact_percentiles(d, ["tier"], "latency_s", {"p95": 0.95, "p99": 0.99})


def sms_share(attempts: DataFrame, cap: float = 0.10) -> DataFrame:
    """Share of transactional sends that went by SMS, per day."""
    t = attempts.where(F.col("tier") == "transactional")
    g = (t.groupBy(F.to_date("ts").alias("day"))
         .agg(F.count(F.lit(1)).alias("sends"), F.count_if(F.col("channel") == "sms").alias("sms")))
    share = F.col("sms") / F.col("sends")
    return g.select("day", "sends", "sms", share.alias("sms_share"), (share > cap).alias("over_cap"))


def queue_depth(states: DataFrame) -> DataFrame:
    """Notifications still on their way (neither DELIVERED nor EXHAUSTED)
    per tier, state and the channel they wait for."""
    return (states.where(~F.col("state").isin("DELIVERED", "EXHAUSTED"))
            .groupBy("tier", "state", "next_channel").agg(F.count(F.lit(1)).alias("waiting")))


def send_quota(attempts: DataFrame, quota: int, per: str = "1 hour") -> DataFrame:
    """Sends per channel (provider) per window against a quota; rows over
    the quota with the excess."""
    g = (attempts.groupBy("channel", F.window("ts", per).start.alias("window_start"))
         .agg(F.count(F.lit(1)).alias("sends")))
    return g.where(F.col("sends") > quota).withColumn("excess", F.col("sends") - quota)


def campaign_batches(attempts: DataFrame, batch_size: int = 1000) -> DataFrame:
    """Recipients of each marketing campaign (day) and channel cut into
    provider calls of ``batch_size``, in user order; only the last call of a
    campaign and channel is part-filled.  A recipient's place in the campaign
    comes from ranges of (campaign, channel, user), so a big campaign is
    numbered by many tasks."""
    rec = (attempts.where(F.col("tier") == "marketing")
           .select(F.to_date("ts").alias("campaign_day"), "channel", "user_id").distinct())
    b = (positions(rec, ["campaign_day", "channel"], [F.col("user_id")], "place")
         .withColumn("batch_no", F.expr(f"place div {int(batch_size)}")))
    ids = F.transform(F.sort_array(F.collect_list("user_id")), lambda x: x.cast("string"))
    return (b.groupBy("campaign_day", "channel", "batch_no")
            .agg(F.count(F.lit(1)).alias("recipients"), F.min("user_id").alias("first_user"),
                 F.max("user_id").alias("last_user"),
                 # one provider call's recipient list: at most batch_size ids
                 F.array_join(ids, ",").alias("recipient_ids")))


def attempt_history(attempts: DataFrame) -> DataFrame:
    """Ordered attempts per notification (bounded by channels x tries)."""
    g = attempts.groupBy("notif_id").agg(F.array_sort(F.collect_list(
        F.struct("ts", "attempt_id", "channel", "status"))).alias("h"))
    return g.select("notif_id", F.transform("h", lambda x: F.struct(
        x["attempt_id"].alias("attempt_id"), x["channel"].alias("channel"),
        x["status"].alias("status"))).alias("history"))


def trace_gaps(attempts: DataFrame, prefs: DataFrame, chain=DEFAULT_CHAIN) -> DataFrame:
    """Accepted notifications with neither a delivery nor a dead letter, from one pass over the attempts."""
    g = attempts.groupBy("notif_id").agg(
        F.max("user_id").alias("user_id"), F.max("tier").alias("tier"), F.bool_or(F.col("status") == "DELIVERED").alias("ok"),
        F.array_sort(F.collect_set(F.when(F.col("status") == "CHANNEL_FAILED", F.col("channel")))).alias("failed"))
    open_ = g.where("NOT ok").join(prefs.select("user_id", "preferred_channel"), "user_id", "left")
    return open_.where(next_channel(F.col("preferred_channel"), F.col("failed"), chain).isNotNull()).select("notif_id", "tier")


def silent_drops(acks: DataFrame, receipts: DataFrame) -> DataFrame:
    """Acknowledged sends with no receipt from the app, ratio per day."""
    seen = receipts.select("attempt_id", F.lit(True).alias("__seen")).dropDuplicates(["attempt_id"])
    return (acks.join(seen, "attempt_id", "left").groupBy(F.to_date("ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("acked"), F.count_if(F.col("__seen").isNull()).alias("no_receipt"))
            .withColumn("drop_rate", F.col("no_receipt") / F.col("acked")))


def provider_health(attempts: DataFrame, n: int = 10, threshold: int = 5) -> DataFrame:
    """Failures among the last ``n`` calls to each provider (channel);
    a failing call trips the flag when the window is full and holds at least
    ``threshold`` failures.  Each call sees the ``n - 1`` calls before it
    through ``look_back``, so no provider is one task and nothing is joined
    with itself."""
    fail = (F.col("status") == "CHANNEL_FAILED").cast("int")
    calls = look_back(attempts.withColumn("fail", F.coalesce(fail, F.lit(0))), ["channel"], [F.col("ts"), F.col("attempt_id")], F.col("fail"), n - 1)
    fails = F.aggregate("past", F.col("fail").cast("long"), lambda acc, x: acc + x)
    full = F.col("seq") >= n
    return calls.select("channel", "attempt_id", "ts", "seq", fails.alias("fails_in_window"),
                        full.alias("window_full"),
                        (full & (F.col("fail") == 1) & (fails >= threshold)).alias("unhealthy"))
