"""Registered notification-delivery and request-log queries with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import delivery as D
from marquee.operators import logs as L
from marquee.sources.adapters import view, with_views

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _att(spark, sf):
    return view(spark, sf, "attempts")


def _states(spark, sf):
    return D.delivery_state(_att(spark, sf), view(spark, sf, "preferences"))


_STATE_SQL = with_views("attempts", "preferences") + """,
g AS (SELECT notif_id, user_id, tier, COUNT(*) AS attempts,
             arg_max(status, (ts, attempt_id)) AS last_status,
             arg_max(channel, (ts, attempt_id)) AS last_channel,
             COALESCE(list_sort(list_distinct(list(channel) FILTER (WHERE status = 'CHANNEL_FAILED'))),
                      CAST([] AS VARCHAR[])) AS failed
      FROM attempts GROUP BY notif_id, user_id, tier),
n AS (SELECT g.*, p.preferred_channel AS pref,
        CASE WHEN p.preferred_channel IS NOT NULL AND NOT list_contains(g.failed, p.preferred_channel)
               THEN p.preferred_channel
             WHEN NOT list_contains(g.failed, 'push') THEN 'push'
             WHEN NOT list_contains(g.failed, 'sms') THEN 'sms'
             WHEN NOT list_contains(g.failed, 'email') THEN 'email' END AS nxt
      FROM g LEFT JOIN preferences p USING (user_id)),
states AS (SELECT notif_id, user_id, tier, attempts, last_channel,
                  array_to_string(failed, ',') AS failed_channels,
                  CASE WHEN last_status = 'DELIVERED' THEN 'DELIVERED'
                       WHEN nxt IS NOT NULL THEN 'FAILOVER' ELSE 'EXHAUSTED' END AS state,
                  CASE WHEN last_status <> 'DELIVERED' THEN nxt END AS next_channel
           FROM n)"""


@register("delivery_state", _STATE_SQL + "\nSELECT * FROM states")
def q_delivery_state(spark, sf):
    return _states(spark, sf).withColumn("failed_channels", F.array_join("failed_channels", ","))


@register("next_channel", _STATE_SQL + """
SELECT notif_id, failed_channels, next_channel FROM states WHERE state <> 'DELIVERED'""")
def q_next_channel(spark, sf):
    s = _states(spark, sf).where(F.col("state") != "DELIVERED")
    return s.select("notif_id", F.array_join("failed_channels", ",").alias("failed_channels"), "next_channel")


_AS_OF = "2024-01-20 12:00:00"
_MACHINE_SQL = with_views("notification_steps", "preferences") + f""",
clock AS (SELECT TIMESTAMP '{_AS_OF}' AS as_of),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY notif_id, channel ORDER BY ts DESC, step_id DESC) AS back
           FROM notification_steps, clock WHERE ts <= as_of),
ends AS (SELECT *, CASE WHEN channel IS NULL THEN NULL WHEN step = 'CHANNEL_FAILED' THEN ts
                        WHEN step = 'DISPATCHED' AND ts + INTERVAL 6 HOUR <= as_of THEN ts + INTERVAL 6 HOUR END AS failed_at
         FROM ranked WHERE back = 1),
oks AS (SELECT notif_id, arg_max(channel, (ts, step_id)) AS delivered_by FROM ranked WHERE step = 'DELIVERED' GROUP BY notif_id),
totals AS (SELECT notif_id, MAX(user_id) AS user_id, MAX(tier) AS tier, COUNT(*) AS steps FROM ranked GROUP BY notif_id),
g AS (SELECT e.notif_id, MAX(failed_at) AS failed_at, bool_or(channel IS NOT NULL AND step = 'DISPATCHED' AND failed_at IS NULL) AS flying,
             COALESCE(list_sort(list(DISTINCT channel) FILTER (WHERE failed_at IS NOT NULL AND (o.notif_id IS NULL OR step = 'CHANNEL_FAILED'))),
                      CAST([] AS VARCHAR[])) AS failed
      FROM ends e LEFT JOIN oks o USING (notif_id) GROUP BY e.notif_id),
n AS (SELECT g.*, t.user_id, t.tier, t.steps, o.notif_id IS NOT NULL AS ok, o.delivered_by,
             list_filter([p.preferred_channel, 'push', 'sms', 'email'], lambda c: c IS NOT NULL AND NOT list_contains(g.failed, c))[1] AS nxt
      FROM g JOIN totals t USING (notif_id) LEFT JOIN oks o USING (notif_id) LEFT JOIN preferences p ON p.user_id = t.user_id),
machine AS (SELECT *, CASE WHEN ok THEN 'DELIVERED' WHEN flying THEN 'DISPATCHING' WHEN failed_at IS NULL THEN 'PENDING'
                           WHEN failed_at + INTERVAL 1 HOUR > as_of THEN 'CHANNEL_FAILED' WHEN nxt IS NOT NULL THEN 'FAILOVER' ELSE 'EXHAUSTED' END AS state
            FROM n, clock)"""


def _machine(spark, sf):
    return D.delivery_machine(view(spark, sf, "notification_steps"), F.lit(_AS_OF).cast("timestamp_ntz"), view(spark, sf, "preferences"))


@register("delivery_machine", _MACHINE_SQL + """
SELECT notif_id, user_id, tier, steps, state, delivered_by, array_to_string(failed, ',') AS failed_channels,
       CASE WHEN state IN ('PENDING', 'CHANNEL_FAILED', 'FAILOVER') THEN nxt END AS next_channel FROM machine""")
def q_delivery_machine(spark, sf):
    """All six states, at a point in the log's time."""
    return _machine(spark, sf).withColumn("failed_channels", F.array_join("failed_channels", ","))


@register("queue_depth", _MACHINE_SQL + """
SELECT tier, state, CASE WHEN state <> 'DISPATCHING' THEN nxt END AS next_channel, COUNT(*) AS waiting FROM machine
WHERE state NOT IN ('DELIVERED', 'EXHAUSTED') GROUP BY ALL""")
def q_queue_depth(spark, sf):
    return D.queue_depth(_machine(spark, sf))


@register("trace_gaps", _STATE_SQL + """
SELECT DISTINCT notif_id, tier FROM attempts
WHERE notif_id NOT IN (SELECT notif_id FROM attempts WHERE status = 'DELIVERED')
  AND notif_id NOT IN (SELECT notif_id FROM states WHERE state = 'EXHAUSTED')""")
def q_trace_gaps(spark, sf):
    return D.trace_gaps(_att(spark, sf), view(spark, sf, "preferences"))


@register("opt_out", with_views("attempts", "preferences") + """
SELECT n.notif_id, n.user_id, n.tier,
  CASE WHEN n.tier = 'service' THEN COALESCE(p.opt_out_service, FALSE)
       WHEN n.tier = 'marketing' THEN COALESCE(p.opt_out_marketing, FALSE) ELSE FALSE END AS blocked
FROM (SELECT DISTINCT notif_id, user_id, tier FROM attempts) n LEFT JOIN preferences p USING (user_id)""")
def q_opt_out(spark, sf):
    n = _att(spark, sf).select("notif_id", "user_id", "tier").distinct()
    return D.opt_out(n, view(spark, sf, "preferences"))


@register("duplicate_delivery", with_views("attempts") + """
SELECT notif_id, COUNT(*) AS deliveries FROM attempts WHERE status = 'DELIVERED'
GROUP BY notif_id HAVING COUNT(*) > 1""")
def q_duplicate_delivery(spark, sf):
    return D.duplicate_delivery(_att(spark, sf))


@register("tier_volume", with_views("attempts") + """
SELECT tier, date_trunc('minute', ts) AS minute, COUNT(*) AS sends, COUNT(*) > 60000 AS over_cap
FROM attempts GROUP BY tier, date_trunc('minute', ts)""")
def q_tier_volume(spark, sf):
    return D.tier_volume(_att(spark, sf))


@register("delivery_success", with_views("attempts") + """,
per AS (SELECT date_trunc('minute', ts) AS window_end, channel, COUNT(*) AS n, COUNT(CASE WHEN status = 'DELIVERED' THEN 1 END) AS ok
        FROM attempts WHERE tier = 'transactional' GROUP BY GROUPING SETS ((date_trunc('minute', ts), channel), (date_trunc('minute', ts)))),
r AS (SELECT window_end, channel, CAST(SUM(n) OVER w AS BIGINT) AS attempts, CAST(SUM(ok) OVER w AS BIGINT) AS delivered FROM per
      WINDOW w AS (PARTITION BY channel ORDER BY window_end RANGE BETWEEN INTERVAL 1439 MINUTE PRECEDING AND CURRENT ROW))
SELECT *, delivered / attempts AS success_rate, CASE WHEN channel IS NULL THEN delivered / attempts >= 0.995 END AS meets_target,
       (channel = 'push' AND delivered / attempts < 0.85) AS push_alert FROM r""")
def q_delivery_success(spark, sf):
    return D.delivery_success(_att(spark, sf))


@register("delivery_latency", with_views("attempts") + """
SELECT tier, ROUND(quantile_cont(latency_s, 0.95), 6) AS p95, ROUND(quantile_cont(latency_s, 0.99), 6) AS p99
FROM attempts WHERE status = 'DELIVERED' GROUP BY tier""")
def q_delivery_latency(spark, sf):
    return D.delivery_latency(_att(spark, sf))


@register("sms_share", with_views("attempts") + """
SELECT day, sends, sms, sms / sends AS sms_share, sms / sends > 0.10 AS over_cap
FROM (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS sends, COUNT(CASE WHEN channel = 'sms' THEN 1 END) AS sms
      FROM attempts WHERE tier = 'transactional' GROUP BY CAST(ts AS DATE))""")
def q_sms_share(spark, sf):
    return D.sms_share(_att(spark, sf))


@register("send_quota", with_views("attempts") + """
SELECT channel, date_trunc('hour', ts) AS window_start, COUNT(*) AS sends, COUNT(*) - 8 AS excess
FROM attempts GROUP BY channel, date_trunc('hour', ts) HAVING COUNT(*) > 8""")
def q_send_quota(spark, sf):
    return D.send_quota(_att(spark, sf), quota=8, per="1 hour")


@register("campaign_batches", with_views("attempts") + """,
rec AS (SELECT DISTINCT CAST(ts AS DATE) AS campaign_day, channel, user_id FROM attempts WHERE tier = 'marketing'),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY campaign_day, channel ORDER BY user_id) AS rn FROM rec)
SELECT campaign_day, channel, CAST(floor((rn - 1) / 20) AS BIGINT) AS batch_no,
       COUNT(*) AS recipients, MIN(user_id) AS first_user, MAX(user_id) AS last_user,
       string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS recipient_ids
FROM n GROUP BY campaign_day, channel, CAST(floor((rn - 1) / 20) AS BIGINT)""")
def q_campaign_batches(spark, sf):
    """T12 with calls of 20 recipients, so that campaigns of any size take several."""
    return D.campaign_batches(_att(spark, sf), batch_size=20)


@register("attempt_history", with_views("attempts") + """
SELECT notif_id, to_json(list({'attempt_id': attempt_id, 'channel': channel, 'status': status}
                              ORDER BY ts, attempt_id)) AS history
FROM attempts GROUP BY notif_id""")
def q_attempt_history(spark, sf):
    return D.attempt_history(_att(spark, sf)).withColumn("history", F.to_json("history"))


@register("silent_drops", with_views("attempts", "receipts") + """,
acks AS (SELECT * FROM attempts WHERE status = 'DELIVERED')
SELECT day, acked, no_receipt, no_receipt / acked AS drop_rate FROM (
  SELECT CAST(a.ts AS DATE) AS day, COUNT(*) AS acked,
         COUNT(CASE WHEN r.attempt_id IS NULL THEN 1 END) AS no_receipt
  FROM acks a LEFT JOIN receipts r USING (attempt_id) GROUP BY CAST(a.ts AS DATE))""")
def q_silent_drops(spark, sf):
    acks = _att(spark, sf).where(F.col("status") == "DELIVERED")
    return D.silent_drops(acks, view(spark, sf, "receipts"))


@register("provider_health", with_views("attempts") + """
SELECT channel, attempt_id, ts, seq, fails_in_window, seq >= 10 AS window_full,
       (seq >= 10 AND status = 'CHANNEL_FAILED' AND fails_in_window >= 5) AS unhealthy
FROM (SELECT channel, attempt_id, ts, status,
        ROW_NUMBER() OVER (PARTITION BY channel ORDER BY ts, attempt_id) AS seq,
        SUM(CASE WHEN status = 'CHANNEL_FAILED' THEN 1 ELSE 0 END) OVER (
            PARTITION BY channel ORDER BY ts, attempt_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS fails_in_window
      FROM attempts)""")
def q_provider_health(spark, sf):
    return D.provider_health(_att(spark, sf), n=10, threshold=5)


@register("request_log_rollup", with_views("request_log") + """
SELECT endpoint, status_code, COUNT(*) AS requests, AVG(duration_ms) AS avg_ms,
       ROUND(quantile_cont(duration_ms, 0.95), 6) AS p95_ms,
       CAST(floor(status_code / 100) AS BIGINT) || 'xx' AS status_class
FROM request_log GROUP BY endpoint, status_code""")
def q_request_log_rollup(spark, sf):
    return L.request_rollup(view(spark, sf, "request_log"))


@register("mask_bodies", with_views("request_bodies") + r"""
SELECT request_id, body,
  CASE WHEN json_valid(body) THEN regexp_replace(body, '"(password|password_hash)":\s*("[^"]*"|\{[^{}]*\}|[^\s,}"{\[\]]+)', '"\1":"***"', 'g') END
    AS masked_body
FROM request_bodies""")
def q_mask_bodies(spark, sf):
    return L.mask_bodies(view(spark, sf, "request_bodies"))
