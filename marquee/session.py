"""Spark session settings shared by jobs, tests and the bench.

Everything here is plain Spark configuration: UTC session clock, ANSI mode,
adaptive execution (partition coalescing + skew-join splitting) and dynamic
partition overwrite for the day-partitioned stores.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on; applied to new sessions and re-asserted on
# existing ones (they are all runtime-settable SQL confs).
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "marquee", driver_memory: str | None = None) -> SparkSession:
    """Create (or reuse) a session.  ``master`` is only set when given, so a
    cluster launcher's own master wins."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SQL_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:  # only takes effect when this call starts the JVM
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; only when nothing is set
    (local tests) do we create a scratch folder of our own.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="marquee-ckpt-")  # single machine only
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench on one machine."""
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    spark = build_session(master=f"local[{cores}]", shuffle_partitions=shuffle_partitions,
                          driver_memory=os.environ.get("MARQUEE_DRIVER_MEMORY"))
    spark.sparkContext.setLogLevel("ERROR")
    return spark
