"""Point lookups by id (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, key: str, ids) -> DataFrame:
    """Rows whose ``key`` equals one id, or lies in a frame of ids.

    A single id is a pushed-down equality filter (an empty result means not
    found).  A frame of ids is a ``left_semi`` join; Spark broadcasts it only
    when its measured size is under the threshold, otherwise it shuffles."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_semi")
    return df.where(F.col(key) == F.lit(ids))
