"""Registered queries over the movie event view, with their DuckDB oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marquee.functions.scalars import ratio_round_half_even_sql
from marquee.operators import metrics as M
from marquee.operators import quality as Q
from marquee.operators import retention as R
from marquee.operators import state as S
from marquee.sources.adapters import view, with_views

EV = with_views("movie_events")


def _ev(spark, sf):
    return view(spark, sf, "movie_events")


QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("dau_daily", EV + """
SELECT event_date, COUNT(DISTINCT user_id) AS dau FROM movie_events GROUP BY event_date""")
def q_dau_daily(spark, sf):
    return M.dau_daily(_ev(spark, sf))


@register("dau_sketch_state")
def q_dau_sketch_state(spark, sf):
    # rows only: HLL estimate, the oracle's exact count differs by design
    return S.dau_from_state(S.dau_state(_ev(spark, sf)))


@register("dau_sketch_check", EV + """
SELECT event_date, COUNT(DISTINCT user_id) AS dau, true AS within_3_percent FROM movie_events GROUP BY event_date""")
def q_dau_sketch_check(spark, sf):
    """A2 + A3 against the exact state: the estimate is within 3 % (or one user)."""
    est = S.dau_from_state(S.dau_state(_ev(spark, sf))).withColumnRenamed("dau", "est")
    j = S.dau_exact_from_state(S.dau_exact_state(_ev(spark, sf))).join(est, "event_date")
    return j.select("event_date", "dau", (F.abs(F.col("est") - F.col("dau")) <= F.greatest(F.lit(1.0), 0.03 * F.col("dau"))).alias("within_3_percent"))


@register("dau_exact_state", EV + """
SELECT event_date, COUNT(DISTINCT user_id) AS dau FROM movie_events GROUP BY event_date""")
def q_dau_exact_state(spark, sf):
    return S.dau_exact_from_state(S.dau_exact_state(_ev(spark, sf)))


@register("views_state_merge", EV + """
SELECT event_date, movie_id, COUNT(*) AS view_count FROM movie_events
WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id""")
def q_views_state_merge(spark, sf):
    return S.views_from_state(S.views_state(_ev(spark, sf)))


@register("avg_watch_daily", EV + """
SELECT event_date,
       COALESCE(SUM(CASE WHEN event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL
                         THEN progress_seconds END)
                / NULLIF(COUNT(CASE WHEN event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL
                                    THEN 1 END), 0), 0.0) AS avg_watch_seconds
FROM movie_events GROUP BY event_date""")
def q_avg_watch_daily(spark, sf):
    ev = _ev(spark, sf)
    return S.avg_from_state(S.avg_state(ev), ev)


@register("conversion_daily", EV + """
SELECT event_date, 'view_conversion' AS metric_name,
       COALESCE(ends / NULLIF(starts, 0), 0.0) AS metric_value,
       '{"ends":' || CAST(ends AS VARCHAR) || ',"starts":' || CAST(starts AS VARCHAR) || '}' AS extra
FROM (SELECT event_date,
             COUNT(CASE WHEN event_type = 'VIEW_STARTED' THEN 1 END) AS starts,
             COUNT(CASE WHEN event_type = 'VIEW_FINISHED' THEN 1 END) AS ends
      FROM movie_events GROUP BY event_date)""")
def q_conversion_daily(spark, sf):
    return M.conversion_daily(_ev(spark, sf))


@register("conversion_series", EV + """
SELECT event_date,
       COUNT(CASE WHEN event_type = 'VIEW_FINISHED' THEN 1 END)
       / NULLIF(COUNT(CASE WHEN event_type = 'VIEW_STARTED' THEN 1 END), 0) AS conversion
FROM movie_events GROUP BY event_date""")
def q_conversion_series(spark, sf):
    return M.conversion_series(_ev(spark, sf))


@register("device_distribution", EV + """
SELECT device_type, COUNT(*) AS cnt FROM movie_events GROUP BY device_type ORDER BY cnt DESC""")
def q_device_distribution(spark, sf):
    return M.device_distribution(_ev(spark, sf))


@register("device_distribution_week", EV + """
SELECT device_type, COUNT(*) AS cnt FROM movie_events
WHERE event_time >= (SELECT MAX(event_time) FROM movie_events) - INTERVAL 7 DAY GROUP BY device_type""")
def q_device_distribution_week(spark, sf):
    """P9 with the dashboard's default range, the last 7 days up to the newest event."""
    ev = _ev(spark, sf)
    hi = ev.agg(F.max("event_time")).first()[0]
    return M.device_distribution(ev, lo=hi - dt.timedelta(days=7), hi=hi)


@register("events_by_day_type", EV + """
SELECT event_date, event_type, COUNT(*) AS cnt FROM movie_events
GROUP BY event_date, event_type ORDER BY event_date DESC, event_type LIMIT 20""")
def q_events_by_day_type(spark, sf):
    return M.events_by_day_type(_ev(spark, sf))


@register("top_movies_daily", EV + """
SELECT metric_date, movie_id, rank_pos, view_count FROM (
  SELECT event_date AS metric_date, movie_id, view_count,
         ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY view_count DESC, movie_id) AS rank_pos
  FROM (SELECT event_date, movie_id, COUNT(*) AS view_count FROM movie_events
        WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id))
WHERE rank_pos <= 10""")
def q_top_movies_daily(spark, sf):
    return M.top_movies_daily(_ev(spark, sf))


@register("top_movies_range", EV + """
SELECT movie_id, COUNT(*) AS views FROM movie_events WHERE event_type = 'VIEW_STARTED'
GROUP BY movie_id ORDER BY views DESC, movie_id LIMIT 10""")
def q_top_movies_range(spark, sf):
    return M.top_movies_range(_ev(spark, sf))


_FIRST = """, first_day AS (SELECT user_id, MIN(event_date) AS cohort_date FROM movie_events GROUP BY user_id)"""

@register("cohort_sizes", EV + _FIRST + """
SELECT cohort_date, COUNT(*) AS cohort_size FROM first_day GROUP BY cohort_date""")
def q_cohort_sizes(spark, sf):
    return R.cohort_sizes(_ev(spark, sf))


_ACT = _FIRST + """,
activity AS (
  SELECT DISTINCT f.cohort_date, e.user_id, date_diff('day', f.cohort_date, e.event_date) AS day_offset
  FROM movie_events e JOIN first_day f USING (user_id)
  WHERE date_diff('day', f.cohort_date, e.event_date) BETWEEN 0 AND 7),
sizes AS (SELECT cohort_date, COUNT(*) AS cohort_size FROM first_day GROUP BY cohort_date)"""

@register("retention_long", EV + _ACT + """
SELECT a.cohort_date, a.day_offset, s.cohort_size AS cohort_total, COUNT(*) AS returned,
       COUNT(*) / s.cohort_size AS retention_pct
FROM activity a JOIN sizes s USING (cohort_date)
GROUP BY a.cohort_date, a.day_offset, s.cohort_size""")
def q_retention_long(spark, sf):
    return R.retention_long(_ev(spark, sf))


def _matrix_sql():
    cols = ",\n  ".join(
        ratio_round_half_even_sql(f"COUNT(CASE WHEN a.day_offset = {k} THEN 1 END)", "ANY_VALUE(s.cohort_size)", 1)
        + f" AS day_{k}" for k in range(8))
    return EV + _ACT + f"""
SELECT CAST(a.cohort_date AS VARCHAR) AS cohort_date, ANY_VALUE(s.cohort_size) AS cohort_size,
  {cols}
FROM activity a JOIN sizes s USING (cohort_date)
GROUP BY a.cohort_date ORDER BY a.cohort_date DESC LIMIT 30"""


@register("retention_matrix", _matrix_sql())
def q_retention_matrix(spark, sf):
    return R.retention_matrix(_ev(spark, sf))


@register("session_counts", EV + """
SELECT session_id, COUNT(*) AS events FROM movie_events GROUP BY session_id""")
def q_session_counts(spark, sf):
    return M.session_counts(_ev(spark, sf))


_DAILY_SQL = """
SELECT event_date AS metric_date, 'dau' AS metric_name, CAST(COUNT(DISTINCT user_id) AS DOUBLE) AS metric_value,
       '{}' AS extra
FROM {src} GROUP BY event_date
UNION ALL
SELECT event_date, 'avg_watch_seconds',
       COALESCE(SUM(CASE WHEN event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL
                         THEN progress_seconds END)
                / NULLIF(COUNT(CASE WHEN event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL
                                    THEN 1 END), 0), 0.0), '{}'
FROM {src} GROUP BY event_date
UNION ALL
SELECT event_date, 'view_conversion',
       COALESCE(COUNT(CASE WHEN event_type = 'VIEW_FINISHED' THEN 1 END)
                / NULLIF(COUNT(CASE WHEN event_type = 'VIEW_STARTED' THEN 1 END), 0), 0.0),
       '{"ends":' || CAST(COUNT(CASE WHEN event_type = 'VIEW_FINISHED' THEN 1 END) AS VARCHAR)
       || ',"starts":' || CAST(COUNT(CASE WHEN event_type = 'VIEW_STARTED' THEN 1 END) AS VARCHAR) || '}'
FROM {src} GROUP BY event_date"""


_DAY_SECTIONS = """,
metrics AS (""" + _DAILY_SQL.replace("{src}", "movie_events") + """),
top AS (SELECT metric_date, movie_id, rank_pos, view_count FROM (
  SELECT event_date AS metric_date, movie_id, view_count,
         ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY view_count DESC, movie_id) AS rank_pos
  FROM (SELECT event_date, movie_id, COUNT(*) AS view_count FROM movie_events
        WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id)) WHERE rank_pos <= 10),
ret AS (SELECT a.cohort_date, a.day_offset, s.cohort_size AS cohort_total, COUNT(*) AS returned,
               COUNT(*) / s.cohort_size AS retention_pct
        FROM activity a JOIN sizes s USING (cohort_date) GROUP BY a.cohort_date, a.day_offset, s.cohort_size),
runs AS (SELECT DISTINCT event_date AS run_date FROM movie_events WHERE event_date IS NOT NULL)"""


@register("daily_run", EV + _ACT + _DAY_SECTIONS + """
SELECT 'metrics' AS "table", metric_date AS run_date, * EXCLUDE (metric_date) FROM metrics
UNION ALL BY NAME SELECT 'top_movies' AS "table", metric_date AS run_date, * EXCLUDE (metric_date) FROM top
UNION ALL BY NAME SELECT 'retention' AS "table", run_date, ret.* FROM runs JOIN ret
  ON ret.cohort_date = run_date - 1 OR ret.cohort_date = run_date - 7""")
def q_daily_run(spark, sf):
    """A21 for every day: its metrics, top list and the retention of cohorts D-1 and D-7."""
    from marquee.operators import export as X
    ev = _ev(spark, sf)
    dated = lambda df: df.withColumnRenamed("metric_date", "run_date")
    return X.export_union(dated(M.daily_metrics(ev)), dated(M.top_movies_daily(ev)), R.retention_by_run(ev))


@register("retention_cohorts", EV + _ACT + """
SELECT a.cohort_date, a.day_offset, s.cohort_size AS cohort_total, COUNT(*) AS returned,
       COUNT(*) / s.cohort_size AS retention_pct
FROM activity a JOIN sizes s USING (cohort_date)
WHERE a.cohort_date IN (SELECT MAX(event_date) - d FROM movie_events, (VALUES (1), (7)) AS t(d) GROUP BY d
                        UNION ALL SELECT MIN(event_date) FROM movie_events)
GROUP BY a.cohort_date, a.day_offset, s.cohort_size""")
def q_retention_cohorts(spark, sf):
    """The cohorts one and seven days before the newest day, and the first one, in one plan."""
    ev = _ev(spark, sf)
    lo, hi = ev.agg(F.min("event_date"), F.max("event_date")).first()
    return R.retention_long(ev, cohorts=[hi - dt.timedelta(days=1), hi - dt.timedelta(days=7), lo])


_TEXT = "CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.{0}') END"
_HASHED = ["user_id", "movie_id", "event_type", "timestamp", "device_type", "session_id", "progress_seconds"]
_ID_HASH = "sha256(concat_ws(chr(1), " + ", ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in _HASHED) + "))"
_DERIVED = " || '-' || ".join(f"substr({_ID_HASH}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
_WIRE_SQL = with_views("wire_events") + """,
fields AS (SELECT payload, """ + ", ".join(f"{_TEXT.format(c)} AS {c}" for c in ["event_id", *_HASHED]) + f""" FROM wire_events),
checked AS (SELECT payload, user_id, movie_id, event_type, device_type, session_id, TRY_CAST(progress_seconds AS INT) AS progress_seconds,
    COALESCE(NULLIF(event_id, ''), {_DERIVED}) AS event_id,
    make_timestamp(COALESCE(NULLIF(TRY_CAST(timestamp AS BIGINT), 0), 1706745600000) * 1000) AS event_time,
    NOT json_valid(payload) OR (timestamp IS NOT NULL AND TRY_CAST(timestamp AS BIGINT) IS NULL) AS unparsable FROM fields),
ruled AS (SELECT *, CASE WHEN unparsable THEN 'unparsable' ELSE concat_ws(',',
    CASE WHEN NOT regexp_full_match(event_id, '[0-9a-fA-F]{{8}}(-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}') THEN 'bad_event_id' END,
    CASE WHEN event_type IS NULL OR event_type NOT IN ('VIEW_STARTED','VIEW_FINISHED','VIEW_PAUSED','VIEW_RESUMED','LIKED','SEARCHED') THEN 'bad_event_type' END,
    CASE WHEN device_type IS NULL OR device_type NOT IN ('MOBILE','DESKTOP','TV','TABLET') THEN 'bad_device_type' END,
    CASE WHEN COALESCE(user_id, '') = '' THEN 'empty_user_id' END,
    CASE WHEN COALESCE(movie_id, '') = '' THEN 'empty_movie_id' END,
    CASE WHEN COALESCE(session_id, '') = '' THEN 'empty_session_id' END,
    CASE WHEN progress_seconds < 0 THEN 'negative_progress' END) END AS reasons FROM checked)"""
_INGEST_CLOCK = "2024-02-01 00:00:00"


def _wire(spark, sf):
    from marquee.streaming import ingest as I
    return I.validated(I.parse_wire(view(spark, sf, "wire_events"), "payload"), clock=F.lit(_INGEST_CLOCK).cast("timestamp"))


@register("event_normalise", _WIRE_SQL + """
SELECT event_id, user_id, movie_id, event_type, event_time, CAST(event_time AS DATE) AS event_date, device_type, session_id,
       progress_seconds FROM ruled WHERE reasons = ''""")
def q_event_normalise(spark, sf):
    """Accepted messages in the stored form (absent times take a fixed ingest clock)."""
    ok, _ = Q.split_valid(_wire(spark, sf))
    return Q.normalise(ok).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@register("event_quarantine", _WIRE_SQL + """
SELECT payload, reasons FROM ruled WHERE reasons <> ''""")
def q_event_quarantine(spark, sf):
    """V1: refused messages as they were sent, with every rule they break."""
    _, bad = Q.split_valid(_wire(spark, sf))
    return bad.select(F.col("payload").cast("string").alias("payload"), F.array_join("reasons", ",").alias("reasons"))


_NOON = ", noon_events AS (SELECT * FROM movie_events WHERE event_time < CAST(event_date AS TIMESTAMP) + INTERVAL 12 HOUR)"


@register("latest_metrics", EV + _NOON + ",\nm1 AS (" + _DAILY_SQL.replace("{src}", "noon_events") + "),\nm2 AS ("
          + _DAILY_SQL.replace("{src}", "movie_events") + """),
store AS (SELECT metric_date, metric_name, extra FROM m2
          UNION ALL
          SELECT metric_date, metric_name, extra FROM m1
          WHERE (metric_date, metric_name, extra) NOT IN (SELECT (metric_date, metric_name, extra) FROM m2)),
v AS (SELECT metric_date, metric_name, COUNT(*) AS versions FROM store GROUP BY metric_date, metric_name)
SELECT m2.metric_date, m2.metric_name, m2.metric_value, m2.extra, v.versions
FROM m2 JOIN v USING (metric_date, metric_name)""")
def q_latest_metrics(spark, sf):
    from marquee.operators import stores as ST
    ev = _ev(spark, sf)
    noon = ev.where(F.col("event_time") < F.col("event_date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS"))
    day_ts = F.col("metric_date").cast("timestamp_ntz")
    run1 = M.daily_metrics(noon).withColumn("updated_at", day_ts + F.expr("INTERVAL 12 HOURS"))
    run2 = M.daily_metrics(ev).withColumn("updated_at", day_ts + F.expr("INTERVAL 25 HOURS"))
    store = ST.merge_rows(run1, run2, ST.METRIC_KEY, "updated_at")
    return ST.latest_metrics(store).drop("updated_at")


@register("export_union", EV + _ACT + ",\nmetrics AS (" + _DAILY_SQL.replace("{src}", "movie_events") + """),
top AS (SELECT metric_date, movie_id, rank_pos, view_count FROM (
  SELECT event_date AS metric_date, movie_id, view_count,
         ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY view_count DESC, movie_id) AS rank_pos
  FROM (SELECT event_date, movie_id, COUNT(*) AS view_count FROM movie_events
        WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id)) WHERE rank_pos <= 10),
ret AS (SELECT a.cohort_date, a.day_offset, s.cohort_size AS cohort_total, COUNT(*) AS returned,
               COUNT(*) / s.cohort_size AS retention_pct
        FROM activity a JOIN sizes s USING (cohort_date) GROUP BY a.cohort_date, a.day_offset, s.cohort_size)
SELECT 'metrics' AS "table", * FROM metrics
UNION ALL BY NAME SELECT 'top_movies' AS "table", * FROM top
UNION ALL BY NAME SELECT 'retention' AS "table", * FROM ret""")
def q_export_union(spark, sf):
    from marquee.operators import export as X
    ev = _ev(spark, sf)
    return X.export_union(M.daily_metrics(ev), M.top_movies_daily(ev), R.retention_long(ev))


@register("newest_metrics", EV + ",\nm AS (" + _DAILY_SQL.replace("{src}", "movie_events") + """)
SELECT metric_date, metric_name, metric_value, extra FROM m
ORDER BY metric_date DESC, metric_name LIMIT 30""")
def q_newest_metrics(spark, sf):
    """Newest 30 rows of the metric store (a top-k report)."""
    from marquee.operators import stores as ST
    m = M.daily_metrics(_ev(spark, sf)).withColumn("updated_at", F.col("metric_date").cast("timestamp_ntz"))
    return ST.newest_rows(m, 30).drop("updated_at")


@register("export_counts", EV + _ACT + ",\nmetrics AS (" + _DAILY_SQL.replace("{src}", "movie_events") + """),
top AS (SELECT * FROM (
  SELECT event_date, movie_id, ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY view_count DESC, movie_id) AS rank_pos
  FROM (SELECT event_date, movie_id, COUNT(*) AS view_count FROM movie_events
        WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id)) WHERE rank_pos <= 10),
ret AS (SELECT DISTINCT cohort_date, day_offset FROM activity)
SELECT 'metrics' AS "table", COUNT(*) AS records FROM metrics
UNION ALL SELECT 'top_movies', COUNT(*) FROM top
UNION ALL SELECT 'retention', COUNT(*) FROM ret""")
def q_export_counts(spark, sf):
    """Records per export section."""
    from marquee.operators import export as X
    return X.section_counts(q_export_union(spark, sf))
