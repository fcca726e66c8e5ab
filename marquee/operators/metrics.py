"""Daily movie metrics over the raw event table.

Every operator is a declarative DataFrame plan over the event table with
columns ``event_id, user_id, movie_id, event_type, event_time, event_date,
device_type, session_id, progress_seconds``.  All of them reduce with a
group-by first (partial aggregation runs map-side, so hot users or movies
only ever send one partial row per task through the shuffle); windows run
on the already-reduced rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.scalars import canonical_json

STARTED = "VIEW_STARTED"
FINISHED = "VIEW_FINISHED"


def time_range(events: DataFrame, lo=None, hi=None, col: str = "event_time") -> DataFrame:
    """Closed time filter; either end may be open.  On a date-partitioned
    table Spark derives the partition filter from it."""
    if lo is not None:
        events = events.where(F.col(col) >= F.lit(lo))
    if hi is not None:
        events = events.where(F.col(col) <= F.lit(hi))
    return events


def for_dates(events: DataFrame, dates=None) -> DataFrame:
    """Restrict to the given days (partition pruning on a stored table)."""
    if dates is None:
        return events
    return events.where(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))


def dau_daily(events: DataFrame) -> DataFrame:
    """A1: exact distinct users per day, all event types count (Q2)."""
    return events.groupBy("event_date").agg(F.countDistinct("user_id").alias("dau"))


def conversion_counts(events: DataFrame) -> DataFrame:
    """Starts and finishes per day as conditional counts."""
    return events.groupBy("event_date").agg(
        F.count_if(F.col("event_type") == STARTED).alias("starts"),
        F.count_if(F.col("event_type") == FINISHED).alias("ends"),
    )


def conversion_daily(events: DataFrame) -> DataFrame:
    """Finishes / starts per day, 0.0 when a day has no starts (Q4), with
    the two counts as canonical JSON in ``extra``."""
    c = conversion_counts(events)
    return c.select(
        "event_date",
        F.lit("view_conversion").alias("metric_name"),
        F.coalesce(F.try_divide(F.col("ends"), F.col("starts")), F.lit(0.0)).alias("metric_value"),
        canonical_json(ends=F.col("ends"), starts=F.col("starts")).alias("extra"),
    )


def conversion_series(events: DataFrame) -> DataFrame:
    """The dashboard series, NULL on a day without starts."""
    c = conversion_counts(events)
    return c.select("event_date",
                    F.try_divide(F.col("ends"), F.col("starts")).alias("conversion"))


def device_distribution(events: DataFrame, lo=None, hi=None) -> DataFrame:
    """A10: events per device over a time range, largest first."""
    return (time_range(events, lo, hi).groupBy("device_type")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), "device_type"))


def events_by_day_type(events: DataFrame, newest: int = 20) -> DataFrame:
    """Counts per (day, type); the newest ``newest`` groups (top-k report)."""
    return (events.groupBy("event_date", "event_type")
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("event_date"), "event_type")
            .limit(newest))


def session_counts(events: DataFrame) -> DataFrame:
    """Events per session."""
    return events.groupBy("session_id").agg(F.count(F.lit(1)).alias("events"))


def movie_views(events: DataFrame) -> DataFrame:
    """Views per (day, movie): VIEW_STARTED rows only."""
    return (events.where(F.col("event_type") == STARTED)
            .groupBy("event_date", "movie_id").agg(F.count(F.lit(1)).alias("view_count")))


def top_movies_daily(events: DataFrame = None, k: int = 10, views: DataFrame = None) -> DataFrame:
    """Top ``k`` movies per day, ties broken by movie id (Q6), rank by
    ``row_number``.  The window runs on (day, movie) counts, never raw rows,
    and Spark pushes the ``rank <= k`` limit below the shuffle."""
    v = views if views is not None else movie_views(events)
    w = Window.partitionBy("event_date").orderBy(F.desc("view_count"), F.asc("movie_id"))
    return (v.withColumn("rank_pos", F.row_number().over(w))
            .where(F.col("rank_pos") <= k)
            .select(F.col("event_date").alias("metric_date"), "movie_id", "rank_pos", "view_count"))


def top_movies_range(events: DataFrame, k: int = 10, lo=None, hi=None) -> DataFrame:
    """O1: top ``k`` movies over a range (TakeOrderedAndProject)."""
    ev = time_range(events, lo, hi).where(F.col("event_type") == STARTED)
    return (ev.groupBy("movie_id").agg(F.count(F.lit(1)).alias("views"))
            .orderBy(F.desc("views"), F.asc("movie_id")).limit(k))


def avg_watch_daily(events: DataFrame) -> DataFrame:
    """A7 over raw rows: mean progress of VIEW_FINISHED rows with a value
    (Q3), 0.0 for a day without any (Q5)."""
    fin = (F.col("event_type") == FINISHED) & F.col("progress_seconds").isNotNull()
    agg = events.groupBy("event_date").agg(
        F.sum(F.when(fin, F.col("progress_seconds").cast("long"))).alias("sum_sec"),
        F.count_if(fin).alias("cnt"))
    return agg.select("event_date", F.coalesce(F.try_divide(F.col("sum_sec"), F.col("cnt")),
                                               F.lit(0.0)).alias("avg_watch_seconds"))


def daily_metrics(events: DataFrame) -> DataFrame:
    """A21 metric rows for every day in ``events``: dau, avg_watch_seconds and
    view_conversion in the metric store's long form.  One aggregation pass:
    the distinct-user count and the conditional sums share the scan."""
    fin = (F.col("event_type") == FINISHED) & F.col("progress_seconds").isNotNull()
    # (day, user) first: the distinct count becomes a plain count and no
    # Expand doubles the rows the way a mixed distinct aggregate would.
    per_user = events.groupBy("event_date", "user_id").agg(
        F.sum(F.when(fin, F.col("progress_seconds").cast("long"))).alias("sum_sec"),
        F.count_if(fin).alias("cnt"),
        F.count_if(F.col("event_type") == STARTED).alias("starts"),
        F.count_if(F.col("event_type") == FINISHED).alias("ends"),
    )
    a = per_user.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("dau"),
        F.sum("sum_sec").alias("sum_sec"),
        F.sum("cnt").alias("cnt"),
        F.sum("starts").alias("starts"),
        F.sum("ends").alias("ends"),
    )
    empty = F.lit("{}")
    rows = F.array(
        F.struct(F.lit("dau").alias("metric_name"), F.col("dau").cast("double").alias("metric_value"),
                 empty.alias("extra")),
        F.struct(F.lit("avg_watch_seconds").alias("metric_name"),
                 F.coalesce(F.try_divide(F.col("sum_sec"), F.col("cnt")), F.lit(0.0)).alias("metric_value"),
                 empty.alias("extra")),
        F.struct(F.lit("view_conversion").alias("metric_name"),
                 F.coalesce(F.try_divide(F.col("ends"), F.col("starts")), F.lit(0.0)).alias("metric_value"),
                 canonical_json(ends=F.col("ends"), starts=F.col("starts")).alias("extra")),
    )
    return (a.select(F.col("event_date").alias("metric_date"), F.inline(rows)))
