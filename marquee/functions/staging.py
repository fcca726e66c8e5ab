"""Lineage cuts that survive the loss of executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
