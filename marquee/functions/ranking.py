"""Positions in an order, without putting a group into one task.

``row_number`` over a window sends every row of a group to one task.  Here the
rows are dealt by ranges of (group, order) instead, so one big group covers
many tasks: a row's position is its place among the rows of its group in its
own range plus the number of rows of the group in the ranges before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.staging import staged


def deal(df: DataFrame, groups: list[str], order: list[Column], ranges: int | None = None) -> DataFrame:
    """``df`` dealt by ranges of (groups, order), as a staged table read back.

    Two more columns: ``__range``, ascending along the order, and ``__nth``, a
    row number that splits ties, so a run of equal rows, however long, is
    spread over several ranges.  Groups come in ascending order, null first; a
    group that fills several ranges is the only one in all but the first and
    last of them."""
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g).asc_nulls_first() for g in groups]
    dealt = (df.withColumn("__nth", F.monotonically_increasing_id())
             .repartitionByRange(n, *keys, *order, F.col("__nth").asc())
             .withColumn("__range", F.spark_partition_id()))
    return staged(dealt, "ranges")


def same(left: str, right: str, columns: list[str]) -> Column:
    """Null-safe equality of two aliased frames on ``columns``."""
    on = F.lit(True)
    for c in columns:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def continued(dealt: DataFrame, groups: list[str], sums: dict[str, str]) -> DataFrame:
    """__range, groups, ``__part`` (1, 2, ... along the group's ranges) and, for every (column -> total) of ``sums``,
    the column's sum over the group's ranges before, for the ranges in which a group goes on from an earlier one.

    That is one row per range at most, since only a range's first group can
    have begun before it; small enough to broadcast."""
    per = dealt.groupBy("__range", *groups).agg(*[F.sum(c).alias(t) for c, t in sums.items()])
    # a running sum over the ranges of one group
    w = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("__range")
    for t in sums.values():
        per = per.withColumn(t, F.sum(t).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return per.withColumn("__part", F.row_number().over(w) - 1).where("__part > 0")


def positions(df: DataFrame, groups: list[str], order: list[Column], out: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with ``out``, the 0-based position of the row in its group.

    ``groups`` may be empty (one order over all rows); null group values form
    groups of their own.  Rows equal in ``order`` come in any order."""
    dealt = deal(df, groups, order, ranges).withColumn("__one", F.lit(1).cast("long"))
    before = continued(dealt, groups, {"__one": "__before"})
    inside = Window.partitionBy("__range", *groups).orderBy(*order, "__nth")
    placed = dealt.withColumn("__place", F.row_number().over(inside) - 1)
    return (placed.alias("r").join(F.broadcast(before).alias("b"), same("r", "b", ["__range", *groups]), "left")
            .select(*[F.col(f"r.`{c}`") for c in df.columns], (F.coalesce("b.__before", F.lit(0)) + F.col("r.__place")).cast("long").alias(out)))


@dataclass
class PageIndex:
    """Rows dealt by ranges of one order, and the number of rows before each range."""

    rows: DataFrame
    offsets: DataFrame
    order: list[Column]
    columns: list[str]
    total: int

    def ranges_of(self, offset: int, size: int) -> DataFrame:
        """The ranges that hold any of the positions sought: one row each, with the rows before."""
        return self.offsets.where((F.col("__before") < offset + size) & (F.col("__before") + F.col("__rows") > offset))


def page_index(df: DataFrame, order: list[Column], ranges: int | None = None) -> PageIndex:
    """An index for any number of pages of ``df`` in ``order``: the rows are dealt once, their count comes with it."""
    dealt = deal(df, [], order, ranges)
    w = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    offsets = staged(counts.withColumn("__before", F.coalesce(F.sum("__rows").over(w), F.lit(0))), "offsets")
    total = offsets.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    return PageIndex(dealt, offsets, order, df.columns, total)


def page(index: PageIndex, offset: int, size: int) -> DataFrame:
    """Rows ``offset`` to ``offset + size - 1`` (0-based) with their ``position``.  Only the ranges that hold them are
    sorted, so a page deep in the table costs what the first one does."""
    inside = Window.partitionBy("__range").orderBy(*index.order, "__nth")
    held = index.rows.join(F.broadcast(index.ranges_of(offset, size)), "__range")  # one row per range
    placed = held.withColumn("position", F.col("__before") + F.row_number().over(inside) - 1)
    return placed.where(F.col("position").between(offset, offset + size - 1)).select(*index.columns, F.col("position").cast("long"))
