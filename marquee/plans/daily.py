"""Daily run and export (A21, T5, K3-K7 wiring).

``run_day`` computes one day's metrics, top movies and the retention of
cohorts D-1 and D-7 from the raw table and upserts them into the store;
``export_day`` reads the store for a day and writes the export.  The
scheduler (cron, an orchestrator) calls these with a date; the default is
yesterday in UTC.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.staging import staged
from marquee.operators import export as X
from marquee.operators import metrics as M
from marquee.operators import retention as R
from marquee.operators import stores as ST
from marquee.streaming.upkeep import read_raw


def default_day(today: dt.date | None = None) -> dt.date:
    """T5: yesterday, UTC."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    return today - dt.timedelta(days=1)


def compute_day(events: DataFrame, day) -> dict[str, DataFrame]:
    """A21 for one day.  The day's metrics and top list read only that
    partition; retention needs every user's first day, so it scans the
    (column-pruned) history."""
    d = dt.date.fromisoformat(str(day))
    today = events.where(F.col("event_date") == F.lit(d))
    metrics = M.daily_metrics(today)
    top = M.top_movies_daily(today)
    cohorts = [d - dt.timedelta(days=1), d - dt.timedelta(days=7)]
    retention = R.retention_long(events.select("user_id", "event_date"), cohorts=cohorts)
    return {"metrics": metrics, "top_movies": top, "retention": retention}


def run_day(spark: SparkSession, events: DataFrame, store_root: str, day=None) -> dict[str, DataFrame]:
    """Compute and store one day: metric upsert (K3), top list replace (K4),
    retention upsert (K5).  Each table write is idempotent on re-run."""
    day = day or default_day()
    # each section is computed once; the upserts read it several times
    out = {name: staged(df, name) for name, df in compute_day(events, day).items()}
    now = F.current_timestamp()
    metrics = out["metrics"].withColumn("updated_at", now)
    if metrics.isEmpty():  # empty day: the stated fallback values (Q5)
        metrics = empty_day_metrics(spark, day)
    ST.upsert(spark, metrics, f"{store_root}/metrics_daily", ST.METRIC_KEY, "updated_at", "metric_date")
    ST.replace_day(spark, out["top_movies"].withColumn("computed_at", now),
                   f"{store_root}/top_movies_daily", "metric_date", day)
    ret = out["retention"].withColumn("computed_at", now)
    ST.upsert(spark, ret, f"{store_root}/retention_stats", ST.RETENTION_KEY, "computed_at", "cohort_date")
    return out


def empty_day_metrics(spark: SparkSession, day) -> DataFrame:
    rows = [("dau", 0.0, "{}"), ("avg_watch_seconds", 0.0, "{}"),
            ("view_conversion", 0.0, '{"ends":0,"starts":0}')]
    return (spark.createDataFrame(rows, "metric_name string, metric_value double, extra string")
            .select(F.lit(str(day)).cast("date").alias("metric_date"), "*")
            .withColumn("updated_at", F.current_timestamp()))


def export_day(spark: SparkSession, store_root: str, out_root: str, day, fmt: str = "json") -> str:
    """K6/K7: one day's export in csv, json (nested document) or parquet."""
    parts = ST.read_day(spark, store_root, day)
    empty = {
        "metrics": "metric_date date, metric_name string, metric_value double, extra string, updated_at timestamp",
        "top_movies": "metric_date date, movie_id long, rank_pos int, view_count long, computed_at timestamp",
        "retention": ("cohort_date date, day_offset int, cohort_total long, returned long, "
                      "retention_pct double, computed_at timestamp"),
    }
    frames = {k: parts.get(k, spark.createDataFrame([], v)) for k, v in empty.items()}
    frames["metrics"] = frames["metrics"].drop("versions")
    ts_cols = {"updated_at", "computed_at"}
    flat = {k: v.select(*[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(c) if c in ts_cols
                          else F.col(c) for c in v.columns]) for k, v in frames.items()}
    union = X.export_union(flat["metrics"], flat["top_movies"], flat["retention"])
    doc = X.export_document(day, flat["metrics"], flat["top_movies"], flat["retention"]) if fmt == "json" else None
    return X.write_export(union, out_root, day, fmt, document=doc)


def main(argv=None) -> None:
    """Scheduler entry (T5): ``python -m marquee.plans.daily RAW STORE [--date D]
    [--export OUT --format json]``.  The date defaults to yesterday, UTC."""
    import argparse

    from marquee.session import build_session

    ap = argparse.ArgumentParser(prog="marquee.plans.daily")
    ap.add_argument("raw", help="raw event table (Parquet, partitioned by event_date)")
    ap.add_argument("store", help="metric store root")
    ap.add_argument("--date", default=None)
    ap.add_argument("--export", default=None, help="export root; skip when absent")
    ap.add_argument("--format", default="json", choices=X.FORMATS)
    a = ap.parse_args(argv)
    spark = build_session()
    day = dt.date.fromisoformat(a.date) if a.date else default_day()
    run_day(spark, read_raw(spark, a.raw), a.store, day)
    if a.export:
        export_day(spark, a.store, a.export, day, a.format)


if __name__ == "__main__":
    main()
