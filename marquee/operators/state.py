"""Mergeable per-batch state tables and their readers (A2-A7, feeds T2).

Each ingest micro-batch writes one partial row per key under its own
``batch_id``; a reader merges all batches.  Partial states are ordinary
columns, so a replayed batch simply overwrites its own rows and a merge is a
plain group-by:

* DAU: an HLL sketch (``hll_sketch_agg``) per (day, batch), merged with
  ``hll_union_agg`` and read with ``hll_sketch_estimate``;
* views: a count per (day, batch, movie), merged with ``sum``;
* watch time: a ``(sum, count)`` pair per (day, batch), merged by summing
  both halves before dividing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HLL_LG_K = 12


def with_batch(events: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """Assign arrival batches to a static table: one batch per hour of event
    time, the grain at which a periodic ingest would have delivered it."""
    if batch_col in events.columns:
        return events
    return events.withColumn(batch_col, F.hour("event_time").cast("long"))


def dau_state(events: DataFrame) -> DataFrame:
    """A2: sketch of users per (day, batch)."""
    return (with_batch(events).groupBy("event_date", "batch_id")
            .agg(F.hll_sketch_agg(F.col("user_id"), HLL_LG_K).alias("uniq_users")))


def dau_from_state(state: DataFrame) -> DataFrame:
    """A3: merged sketch estimate per day."""
    return (state.groupBy("event_date")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("uniq_users")).alias("dau")))


def views_state(events: DataFrame) -> DataFrame:
    """A4: VIEW_STARTED count per (day, batch, movie)."""
    return (with_batch(events).where(F.col("event_type") == "VIEW_STARTED")
            .groupBy("event_date", "batch_id", "movie_id")
            .agg(F.count(F.lit(1)).alias("view_cnt")))


def views_from_state(state: DataFrame) -> DataFrame:
    """A5: merged views per (day, movie)."""
    return state.groupBy("event_date", "movie_id").agg(F.sum("view_cnt").alias("view_count"))


def avg_state(events: DataFrame) -> DataFrame:
    """(sum, count) of progress of finished views per (day, batch)."""
    fin = with_batch(events).where((F.col("event_type") == "VIEW_FINISHED")
                                   & F.col("progress_seconds").isNotNull())
    return (fin.groupBy("event_date", "batch_id")
            .agg(F.sum(F.col("progress_seconds").cast("long")).alias("sum_sec"),
                 F.count(F.lit(1)).alias("cnt")))


def avg_from_state(state: DataFrame, days: DataFrame = None) -> DataFrame:
    """Merged mean per day; with ``days`` (any frame with ``event_date``)
    every listed day appears, 0.0 where no finished view exists (Q5)."""
    m = state.groupBy("event_date").agg(F.sum("sum_sec").alias("s"), F.sum("cnt").alias("c"))
    if days is not None:
        m = days.select("event_date").distinct().join(m, "event_date", "left")
    return m.select("event_date",
                    F.coalesce(F.try_divide(F.col("s"), F.col("c")), F.lit(0.0)).alias("avg_watch_seconds"))


def dau_exact_state(events: DataFrame) -> DataFrame:
    """A2, exact variant: the distinct (day, user) set of each batch."""
    return with_batch(events).select("event_date", "batch_id", "user_id").distinct()


def dau_exact_from_state(state: DataFrame) -> DataFrame:
    """A3, exact variant: users per day over all batches.  Users are first
    made distinct per day, so the count is a plain count."""
    return (state.select("event_date", "user_id").distinct()
            .groupBy("event_date").agg(F.count(F.lit(1)).alias("dau")))


def merged_dau_state(state: DataFrame) -> DataFrame:
    """A2 partials of many batches as one sketch per day."""
    return state.groupBy("event_date").agg(F.hll_union_agg("uniq_users").alias("uniq_users"))


def merged_views_state(state: DataFrame) -> DataFrame:
    """A4 partials of many batches as one count per (day, movie)."""
    return state.groupBy("event_date", "movie_id").agg(F.sum("view_cnt").alias("view_cnt"))


def merged_avg_state(state: DataFrame) -> DataFrame:
    """A6 partials of many batches as one (sum, count) per day."""
    return state.groupBy("event_date").agg(F.sum("sum_sec").alias("sum_sec"), F.sum("cnt").alias("cnt"))
