"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

# Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

#: Bytes of text that one vectorised pass handles at a time; bounds the memory of a Python worker.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage with a table that every executor sees and that survives the
    loss of any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, in order (null text: no words)."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    return F.filter(parts, lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words of a text as long (null text: 0)."""
    text = F.coalesce(text, F.lit(""))
    pieces = F.size(F.split(text, f"[{SPACE}]+"))
    blank = lambda c: F.instr(F.lit(" \t\n\x0b\f\r"), c) > 0
    first, last = F.substring(text, 1, 1), F.substring(text, -1, 1)
    edges = F.when(first == "", F.lit(1)).otherwise(
        F.when(blank(first), 1).otherwise(0) + F.when(blank(last), 1).otherwise(0))
    return F.when(~text.rlike(rf"[^{SPACE}]"), F.lit(0)).otherwise(pieces - edges).cast("long")


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def blocks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``most`` bytes (one row at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (in place on a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class PrefixHash:
    """Polynomial hashes of any byte range from one prefix sum (mod 2^64, odd base)."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._pow = self._inv = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self._pow) < n:
            n = max(n, 2 * CHUNK_BYTES)
            for name, b in (("_pow", self.base), ("_inv", self.inverse)):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._pow[:len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((sums[end] - sums[start]) * self._inv[start])


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)
