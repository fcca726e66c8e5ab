"""Upkeep of the tables that micro-batches write (K1, T2): few sorted files instead of many small folders.

Neither table has a commit log.  What a reader sees follows from folder names
alone, so stream, replay, compaction and readers need no lock:

* Raw table.  ``compact`` writes the rows of a day's batch folders into one
  more folder of that day, ``batch_id=compact-<millis>``; each row there keeps
  the batch it came from (``from_batch``) and the file it was read from
  (``from_file``).  ``read_raw`` takes the newest compact folder of a day and
  every batch folder, and leaves out compacted rows whose batch still stands,
  so each row is seen once before, during and after, and a batch written again
  replaces its compacted rows.  ``vacuum`` deletes batch folders whose files
  are all compacted; one with a file that is not (a replay) stays until the
  next ``compact``.
* State tables.  ``merge_state`` merges all batches but the newest ones, which
  may still be written or replayed, into ``batch_id=merged-<last id>``;
  ``read_partials`` takes the newest merged folder and the batches after it,
  so a replay of a merged batch counts nothing twice.

A reader keeps the file list it began with, so ``vacuum`` leaves alone what
was compacted less than ``grace_seconds`` ago.  A day's folder appears by one
rename.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import state as S
from marquee.operators.stores import _fs, path_exists

COMPACT = "compact-"
MERGED = "merged-"
#: The merge of each state table.
MERGES = {"dau_state": S.merged_dau_state, "movie_views_state": S.merged_views_state, "avg_progress_state": S.merged_avg_state}


def _folders(spark: SparkSession, path: str, part: str) -> dict[str, int]:
    """Names (the part after ``part=``) of the folders in ``path`` and when each last changed, in millis."""
    fs, p = _fs(spark, path)
    return {st.getPath().getName().split("=", 1)[1]: st.getModificationTime() for st in fs.listStatus(p)
            if st.isDirectory() and st.getPath().getName().startswith(f"{part}=")}


def _raw_files(spark: SparkSession, raw_path: str) -> tuple[DataFrame, dict[tuple[str, str], set[str]]]:
    """All rows of the raw table with ``from_batch`` and ``from_file``, and the files of each (day, batch) they are read from."""
    fields = [f for f in spark.read.parquet(raw_path).schema if f.name not in ("event_date", "batch_id", "from_batch", "from_file")]
    schema = T.StructType([*fields, *(T.StructField(c, T.StringType()) for c in ("from_batch", "from_file")),
                           T.StructField("event_date", T.DateType()), T.StructField("batch_id", T.StringType())])
    rows = spark.read.schema(schema).parquet(raw_path)
    files: dict[tuple[str, str], set[str]] = {}
    for f in rows.inputFiles():  # the list this frame is bound to
        *_, day, batch, name = f.split("/")
        files.setdefault((day.split("=", 1)[1], batch.split("=", 1)[1]), set()).add(name)
    return rows, files


def _newest(files: dict[tuple[str, str], set[str]]) -> dict[str, str]:
    """The newest compact folder of each day that has one."""
    newest: dict[str, str] = {}
    for day, batch in files:
        if batch.startswith(COMPACT) and int(batch[len(COMPACT):]) > int(newest.get(day, COMPACT + "-1")[len(COMPACT):]):
            newest[day] = batch
    return newest


def _visible(spark: SparkSession, rows: DataFrame, files: dict[tuple[str, str], set[str]]) -> DataFrame:
    newest = _newest(files)
    plain = rows.where(~F.col("batch_id").startswith(COMPACT))
    if not newest:
        return plain
    key = "event_date string, batch_id string"
    cast = F.col("event_date").cast("date").alias("event_date")
    kept = spark.createDataFrame(list(newest.items()), key).select(cast, "batch_id")
    standing = spark.createDataFrame([k for k in files if k[0] in newest and not k[1].startswith(COMPACT)], key).select(
        cast, F.col("batch_id").alias("from_batch"))
    # folder names only: as many rows as a compacted day has folders
    compacted = (rows.where(F.col("batch_id").startswith(COMPACT) & F.col("event_date").isin([F.lit(d).cast("date") for d in newest]))
                 .join(F.broadcast(kept), ["event_date", "batch_id"], "left_semi")
                 .join(F.broadcast(standing), ["event_date", "from_batch"], "left_anti"))
    return plain.unionByName(compacted)


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    """The rows of the raw table, each once, whatever has been compacted; ``batch_id`` is the batch that brought the row."""
    rows, files = _raw_files(spark, raw_path)
    return (_visible(spark, rows, files).withColumn("batch_id", F.coalesce("from_batch", "batch_id")).drop("from_batch", "from_file"))


def compact(spark: SparkSession, raw_path: str, before, least_folders: int = 2) -> list[str]:
    """K1 upkeep: the days before ``before`` with ``least_folders`` folders or more get one sorted folder; returns them.

    Rows are dealt by ranges of (day, type, user, time), so files of a day do not
    overlap in type and user and large days are split over tasks.  Batch folders
    stay until ``vacuum``."""
    rows, files = _raw_files(spark, raw_path)
    newest = _newest(files)
    folders: dict[str, int] = {}
    for day, batch in files:
        if day < str(before) and (not batch.startswith(COMPACT) or batch == newest.get(day)):
            folders[day] = folders.get(day, 0) + 1
    days = sorted(d for d, n in folders.items() if n >= least_folders)
    if not days:
        return []
    run = max([int(time.time() * 1000), *(int(b[len(COMPACT):]) + 1 for b in newest.values())])
    some = rows.where(F.col("event_date").isin([F.lit(d).cast("date") for d in days]))
    order = ["event_date", "event_type", "user_id", "event_time"]
    visible = _visible(spark, some.withColumn("__file", F.col("_metadata.file_name")), {k: v for k, v in files.items() if k[0] in folders})
    named = visible.withColumns({"from_batch": F.coalesce("from_batch", "batch_id"), "from_file": F.coalesce("from_file", "__file"),
                                "batch_id": F.lit(f"{COMPACT}{run}")}).drop("__file")
    (named.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(raw_path))
    return days


def vacuum(spark: SparkSession, raw_path: str, grace_seconds: float = 3600, now: float | None = None) -> list[str]:
    """Delete what the newest compact folder of each day holds: batch folders with all their files in it, and older
    compact folders; returns the deleted folders.  Days compacted less than ``grace_seconds`` ago are left alone."""
    rows, files = _raw_files(spark, raw_path)
    latest = ((time.time() if now is None else now) - grace_seconds) * 1000
    newest = {d: b for d, b in _newest(files).items() if int(b[len(COMPACT):]) <= latest}
    dead = [(d, b) for d, b in files if d in newest and b.startswith(COMPACT) and b != newest[d]]
    todo = {d for d, b in files if d in newest and not b.startswith(COMPACT)}
    if todo:
        held: dict[str, set[str]] = {}
        names = (rows.where(F.col("event_date").isin([F.lit(d).cast("date") for d in todo]) & F.col("batch_id").isin([newest[d] for d in todo]))
                 .select(F.col("event_date").cast("string"), "batch_id", "from_file").distinct())
        for day, batch, name in names.toLocalIterator():  # file names of the folders that stand
            if batch == newest[day]:
                held.setdefault(day, set()).add(name)
        dead += [(d, b) for (d, b), f in files.items() if d in todo and not b.startswith(COMPACT) and f <= held.get(d, set())]
    fs, _ = _fs(spark, raw_path)
    out = []
    for day, batch in sorted(dead):
        folder = f"event_date={day}/batch_id={batch}"
        fs.delete(_fs(spark, f"{raw_path.rstrip('/')}/{folder}")[1], True)
        out.append(folder)
    return out


def _state_folders(spark: SparkSession, path: str) -> tuple[int, dict[int, str], dict[int, str]]:
    """Last batch id of the newest finished merge (-1: none), and the folders of batches and of finished merges by id."""
    names = _folders(spark, path, "batch_id")
    batches = {int(n): n for n in names if not n.startswith(MERGED)}
    merges = {int(n[len(MERGED):]): n for n in names if n.startswith(MERGED) and path_exists(spark, f"{path}/batch_id={n}/_SUCCESS")}
    return max(merges, default=-1), batches, merges


def _read_folders(spark: SparkSession, path: str, upto: int, last: int | None = None) -> DataFrame:
    _, batches, merges = _state_folders(spark, path)
    names = [merges[upto]] if upto in merges else []
    names += [batches[b] for b in sorted(batches) if b > upto and (last is None or b <= last)]
    return spark.read.parquet(*[f"{path}/batch_id={n}" for n in names])


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The partial states of a state table, each batch counted once, merged or not."""
    path = path.rstrip("/")
    return _read_folders(spark, path, _state_folders(spark, path)[0])


def merge_state(spark: SparkSession, state_root: str, keep: int = 1) -> dict[str, int]:
    """T2 upkeep: one merged state per table of all batches but the newest ``keep``; returns the last merged batch of each.

    Rows are sorted by day, so a reader of few days skips by file statistics."""
    done = {}
    for name, merge in MERGES.items():
        path = f"{state_root.rstrip('/')}/{name}"
        upto, batches, _ = _state_folders(spark, path)
        open_ = [b for b in sorted(batches) if b > upto]
        last = open_[-1 - keep] if len(open_) > keep else None
        if last is not None:
            (merge(_read_folders(spark, path, upto, last)).repartitionByRange("event_date").sortWithinPartitions("event_date")
             .write.mode("overwrite").parquet(f"{path}/batch_id={MERGED}{last}"))
            done[name] = last
    return done


def vacuum_state(spark: SparkSession, state_root: str, grace_seconds: float = 3600, now: float | None = None) -> list[str]:
    """Delete batches and older merges that the newest merge holds, if it is older than ``grace_seconds``; returns them."""
    out = []
    latest = ((time.time() if now is None else now) - grace_seconds) * 1000
    for name in MERGES:
        path = f"{state_root.rstrip('/')}/{name}"
        upto, batches, merges = _state_folders(spark, path)
        if upto < 0 or _folders(spark, path, "batch_id")[merges[upto]] > latest:
            continue
        for n in [*(n for b, n in batches.items() if b <= upto), *(n for b, n in merges.items() if b < upto)]:
            fs, p = _fs(spark, f"{path}/batch_id={n}")
            fs.delete(p, True)
            out.append(f"{name}/batch_id={n}")
    return sorted(out)
