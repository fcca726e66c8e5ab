"""Ordered-per-key computations that stay parallel when one key is hot.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.
These helpers cut the rows of a key into pieces instead:

* ``running_totals`` and ``look_back`` deal the rows by ranges of (key, order)
  (``ranking.deal``), so every task gets about as many rows whatever the keys,
  and a window covers one (range, key).  What a piece needs of the pieces
  before it comes from a table with one row per range at most: the sums
  before it, or the last n rows before it, copied in.  The same plan serves
  few hot keys and many small ones.
* ``count_in_range``: rows of the same key in ``[t - width, t]``.  Rows near
  the end of a bucket are also sent to the next bucket as context ("halo"),
  so every row's time frame lies inside its own bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.ranking import continued, deal, same

HOT_KEY_ROWS = 1_000_000


def running_totals(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column],
                   ranges: int | None = None) -> DataFrame:
    """Add one inclusive running-sum column per entry of ``sums``.

    ``order`` must be a total order inside a key (ties would make the running
    value arbitrary, as in any ROWS frame)."""
    held = {name: f"__v_{name}" for name in sums}
    dealt = deal(df.withColumns({held[n]: e for n, e in sums.items()}), keys, order, ranges)
    before = continued(dealt, keys, {v: f"__o_{n}" for n, v in held.items()})
    w = Window.partitionBy("__range", *keys).orderBy(*order, "__nth").rowsBetween(Window.unboundedPreceding, 0)
    inside = dealt.withColumns({f"__s_{n}": F.sum(v).over(w) for n, v in held.items()})
    return (inside.alias("r").join(F.broadcast(before).alias("b"), same("r", "b", ["__range", *keys]), "left")
            .select(*[F.col(f"r.`{c}`") for c in df.columns],
                    *[(F.coalesce(f"b.__o_{n}", F.lit(0)) + F.col(f"r.__s_{n}")).alias(n) for n in sums]))


def look_back(df: DataFrame, keys: list[str], order: list[Column], value: Column, n: int, out: str = "past",
              number: str = "seq", ranges: int | None = None) -> DataFrame:
    """Add ``out``, the values of the key's ``n`` rows before (oldest first, fewer at its start),
    and ``number``, the row's number in its key (1, 2, ...).

    ``value`` must not be null.  The last n values before a range, for the key that goes on
    in it, are n per range at most and are joined by broadcast."""
    dealt = deal(df.withColumn("__v", value), keys, order, ranges).withColumn("__one", F.lit(1).cast("long"))
    heads = continued(dealt, keys, {"__one": "__before"}).drop("__part")
    w = Window.partitionBy("__range", *keys).orderBy(*order, "__nth")

    def numbered(rows: DataFrame) -> DataFrame:
        placed = rows.withColumn("__place", F.row_number().over(w))
        return (placed.alias("r").join(F.broadcast(heads).alias("b"), same("r", "b", ["__range", *keys]), "left")
                .select("r.*", (F.coalesce("b.__before", F.lit(0)) + F.col("r.__place")).cast("long").alias("__seq")))

    wanted = heads.select(F.col("__range").alias("__to"), *keys, F.explode(F.sequence(F.greatest(F.col("__before") - (n - 1), F.lit(1)), F.col("__before"))).alias("__seq"))
    long_keys = dealt.alias("d").join(F.broadcast(heads.select(*keys).distinct()).alias("h"), same("d", "h", keys), "left_semi")
    tails = (numbered(long_keys.select("__range", "__nth", "__v", *keys, *_needed(dealt, order, keys))).alias("t")
             .join(F.broadcast(wanted).alias("q"), same("t", "q", keys) & (F.col("t.__seq") == F.col("q.__seq")))
             .groupBy("q.__to", *[F.col(f"q.{k}").alias(k) for k in keys])
             .agg(F.transform(F.sort_array(F.collect_list(F.struct("t.__seq", "t.__v"))), lambda x: x["__v"]).alias("__tail"))
             .withColumnRenamed("__to", "__range"))
    here = F.collect_list("__v").over(w.rowsBetween(-n, -1))
    rows = numbered(dealt.withColumn("__here", here))
    past = F.concat(F.coalesce("t.__tail", F.expr("array()").cast(rows.schema["__here"].dataType)), F.col("r.__here"))
    return (rows.alias("r").join(F.broadcast(tails).alias("t"), same("r", "t", ["__range", *keys]), "left")
            .select(*[F.col(f"r.`{c}`") for c in df.columns], F.slice(past, F.greatest(F.size(past) - (n - 1), F.lit(1)), n).alias(out),
                    F.col("r.__seq").alias(number)))


def _needed(df: DataFrame, order: list[Column], keys: list[str]) -> list[str]:
    """Columns of ``df`` that the order uses."""
    used = df.select(*order).columns if all(c in df.columns for c in df.select(*order).columns) else df.columns
    return [c for c in used if c not in keys and not c.startswith("__")]


def count_in_range(df: DataFrame, keys: list[str], micros: Column, width_us: int,
                   bucket_us: int, out: str = "n_in_range", hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Add ``out`` = rows of the same key with time in ``[t - width, t]``
    (the row itself included).  ``bucket_us`` must be >= ``width_us``.
    Keys with more than ``hot_rows`` rows use buckets of the range width
    itself, so their windows hold at most two widths of rows."""
    if bucket_us < width_us:
        raise ValueError("bucket must be at least as wide as the range")
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
           .where(F.col("__n") > hot_rows).select(*keys).withColumn("__hot", F.lit(True)))
    d = (df.join(F.broadcast(hot), keys, "left")
         .withColumn("__w", F.when(F.col("__hot"), F.lit(width_us)).otherwise(F.lit(bucket_us)))
         .withColumn("__t", micros)
         .withColumn("__b", F.floor(F.col("__t") / F.col("__w"))))
    own = d.withColumn("__ctx", F.lit(False))
    # rows in the last `width` of a bucket are context for the next bucket
    halo = (d.where(F.col("__t") >= (F.col("__b") + 1) * F.col("__w") - F.lit(width_us))
            .withColumn("__b", F.col("__b") + 1).withColumn("__ctx", F.lit(True)))
    w = (Window.partitionBy(*keys, "__b").orderBy("__t")
         .rangeBetween(-width_us, 0))
    return (own.unionByName(halo)
            .withColumn(out, F.count(F.lit(1)).over(w))
            .where(~F.col("__ctx"))
            .drop("__t", "__b", "__ctx", "__w", "__hot"))
