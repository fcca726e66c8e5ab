"""Metric store on date-partitioned Parquet.

Parquet has no MERGE, so an upsert is read-merge-overwrite of only the
partitions a run touches: the touched partitions are read, merged with the
new rows (newest row per key wins), staged under the shared checkpoint
folder, and written back with dynamic partition overwrite, which leaves all
other days alone.  Staging first means a partition is never overwritten
while it is being read.  A day whose new result is empty is cleared by
deleting that partition explicitly (dynamic overwrite touches nothing when
no rows arrive).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

METRIC_KEY = ["metric_date", "metric_name", "extra"]
RETENTION_KEY = ["cohort_date", "day_offset"]
TOP_KEY = ["metric_date", "movie_id"]


def newest_per_key(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Keep the newest row per key (ties: any one of the newest).  A
    ``max_by`` aggregate, so a key with many versions is reduced map-side."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(ts)).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]))


def merge_rows(existing: DataFrame, new: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """K3/K5 semantics on frames: a new row wins over a stored one on the same
    key whatever their clocks say; among new rows the newest."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys, "__new")]
    return (both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("__new", F.col(ts))).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def upsert(spark: SparkSession, new: DataFrame, path: str, keys: list[str], ts: str,
           part: str) -> None:
    """K3 / K5: upsert ``new`` into the table at ``path`` partitioned by ``part``.
    No new rows: nothing changes."""
    if new.isEmpty():
        return
    if path_exists(spark, path):
        touched = new.select(part).distinct()
        old = spark.read.parquet(path).join(touched, part, "left_semi")
        merged = merge_rows(old, new, keys, ts)
    else:
        merged = newest_per_key(new, keys, ts)
    stage = scratch_path(spark, "upsert-stage")
    merged.write.mode("overwrite").partitionBy(part).parquet(stage)
    (spark.read.parquet(stage).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path))
    delete_path(spark, stage)


def replace_day(spark: SparkSession, rows: DataFrame, path: str, part: str, day) -> None:
    """K4: the day's rows become exactly ``rows`` (possibly none).

    The rows are staged first and then swapped in by a partition overwrite, so
    a failure on the way leaves the old day; only an empty result deletes it."""
    stage = scratch_path(spark, "day-stage")
    rows.where(F.col(part) == F.lit(day).cast("date")).write.partitionBy(part).parquet(stage)
    staged = spark.read.schema(rows.schema).parquet(stage)
    if staged.isEmpty():
        delete_path(spark, f"{path.rstrip('/')}/{part}={day}")
    else:
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    delete_path(spark, stage)


def read_day(spark: SparkSession, root: str, day) -> dict[str, DataFrame]:
    """S4 + O5: the store's three tables for one day, in their read order;
    metrics through the latest-row reader (W2)."""
    d = F.lit(day).cast("date")
    out = {}
    if path_exists(spark, f"{root}/metrics_daily"):
        out["metrics"] = latest_metrics(spark.read.parquet(f"{root}/metrics_daily")
                                        .where(F.col("metric_date") == d)).orderBy("metric_name")
    if path_exists(spark, f"{root}/top_movies_daily"):
        out["top_movies"] = (spark.read.parquet(f"{root}/top_movies_daily")
                             .where(F.col("metric_date") == d).orderBy("rank_pos"))
    if path_exists(spark, f"{root}/retention_stats"):
        out["retention"] = (spark.read.parquet(f"{root}/retention_stats")
                            .where(F.col("cohort_date") == d).orderBy("day_offset"))
    return out


def latest_metrics(store: DataFrame) -> DataFrame:
    """One row per (date, name): the most recently updated, with the
    number of stored versions (Q9 keeps one per distinct ``extra``)."""
    keys = ["metric_date", "metric_name"]
    rest = [c for c in store.columns if c not in keys]
    return (store.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"),
                                     F.max_by(F.struct(*rest), F.col("updated_at")).alias("__row"))
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest], "versions"))


def newest_rows(store: DataFrame, n: int = 30) -> DataFrame:
    """Newest ``n`` metric rows (top-k report)."""
    return store.orderBy(F.desc("metric_date"), F.desc("updated_at"), "metric_name").limit(n)


def purge_old_days(spark: SparkSession, path: str, part: str, keep_days: int, today) -> list[str]:
    """T4: drop ``part=`` partitions older than ``keep_days`` before ``today``.
    Lists directory names only; never reads the data."""
    import datetime as dt
    if not path_exists(spark, path):
        return []
    fs, p = _fs(spark, path)
    cutoff = (dt.date.fromisoformat(str(today)) - dt.timedelta(days=keep_days))
    removed = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{part}="):
            try:
                day = dt.date.fromisoformat(name.split("=", 1)[1])
            except ValueError:
                continue
            if day < cutoff:
                fs.delete(st.getPath(), True)
                removed.append(name)
    return removed
