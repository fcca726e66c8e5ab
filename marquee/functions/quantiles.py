"""Exact percentiles by distributed rank selection.

``percentile`` / ``percentile_cont`` gather every value of a group into one
buffer, and a window over a group sorts it in one task; for a group holding a
third of the rows that is one task holding a third of the table.  Here no
group is ever in one task:

1. The values are reduced to (group, value, count), with partial counts in
   every task, and dealt by ranges of (group, value).
2. The counts of the ranges and their prefix sums, one row per (group, range),
   say in which range of a group each rank sought lies.
3. Only those ranges are looked into: their prefix sums give the values at
   the ranks.

Interpolation is ``lo + (hi - lo) * frac`` at position ``p * (n - 1)``
(continuous percentile, the common SQL definition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.ranking import deal, same


def exact_percentiles(df: DataFrame, groups: list[str], value: str, ps: dict[str, float],
                      digits: int | None = 6, ranges: int | None = None) -> DataFrame:
    """One row per group with a column per entry of ``ps`` (name -> p); null values are not counted.

    The result is rounded to ``digits`` decimals (default 6): interpolating
    values of fixed precision gives a few more decimals at most, and the
    rounding removes the last-bit differences between equivalent float
    formulas, so engines agree exactly."""
    hist = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__c"))
    dealt = deal(hist, groups, [F.col(value)], ranges)
    along = Window.partitionBy(*groups).orderBy("__range")  # the ranges of a group, never its values
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (dealt.groupBy("__range", *groups).agg(F.sum("__c").alias("__rows"))
           .withColumns({"__n": F.sum("__rows").over(whole),
                         "__end": F.sum("__rows").over(along.rowsBetween(Window.unboundedPreceding, 0))}))
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), ((F.col("__n") - 1).cast("double") * F.lit(float(p))).alias("pos")) for k, p in ps.items()]))
    inside = lambda r: (F.col(r) < F.col("__end")) & (F.col(r) >= F.col("__end") - F.col("__rows"))
    # per group and percentile the one or two ranges that hold its ranks
    picks = (per.withColumn("__p", wanted)
             .select("__range", *groups, (F.col("__end") - F.col("__rows")).alias("__before"), "__end", "__rows", "__p.name", "__p.pos",
                     F.floor("__p.pos").cast("long").alias("__r0"), F.ceil("__p.pos").cast("long").alias("__r1"))
             .where(inside("__r0") | inside("__r1")))
    sought = picks.select("__range", *groups).distinct()
    w = Window.partitionBy("__range", *groups).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    looked = (dealt.alias("d").join(sought.alias("s"), same("d", "s", ["__range", *groups]), "left_semi")
              .withColumn("__hi", F.sum("__c").over(w)))
    rank = lambda r: (F.col(r) - F.col("__before") < F.col("__hi")) & (F.col(r) - F.col("__before") >= F.col("__hi") - F.col("__c"))
    found = (looked.alias("d").join(picks.alias("k"), same("d", "k", ["__range", *groups]))
             .groupBy(*[F.col(f"k.{g}").alias(g) for g in groups], "name")
             .agg(F.max("pos").alias("pos"), F.max(F.when(rank("__r0"), F.col(f"d.`{value}`"))).alias("lo"),
                  F.max(F.when(rank("__r1"), F.col(f"d.`{value}`"))).alias("hi")))
    val = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("pos") - F.floor("pos"))
    val = F.round(val, digits) if digits is not None else val
    return (found.groupBy(*groups)
            .agg(*[F.max(F.when(F.col("name") == k, val)).alias(k) for k in ps]))
