"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words, each of its documents the expected
number of copies target / source size.  The whole part is taken outright.  The
fractional parts are rounded dependently: two documents at a time, mass moves
at random from one to the other until one of them is 0 or 1.  Mass is counted
in words, so the words taken from a source stay at its target throughout, but
for the one document that is left at the end.

A source is cut into blocks by a hash of doc_id; every block is rounded alone
and leaves at most one document undecided.  Those are rounded again in groups
of ``FAN_IN`` blocks, level by level, until one is left per source.  It goes to
the nearer side.

Where that one document is so large that its source misses the target by more
than ``MOST_ERROR``, its copies are settled and the other documents of the
source are rounded anew, to what then is left of the target.  That goes on
until ``STALLED`` attempts in a row have not halved the error; of all attempts
a source keeps the best one.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import mix64, stored, word_count

#: Fixed values of the mix: weights by rank of source (code point order, null last), repeating; most copies of a document.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Documents of one source that one task rounds at a time, and undecided ones that meet on the next level.
BLOCK_ROWS = 4_000
FAN_IN = 256
#: Share of its target by which a source may miss it before its largest documents are settled first.
MOST_ERROR = 0.002
STALLED = 4


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, rank, rows, source_size, target: shares of all words by weight; a
    target stops at ``most`` times its source's size and the rest is shared
    again by weight.  The result is the level at which the capped shares add up
    to all words, found in one pass over the sources by size per weight."""
    per = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    ranked = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    every = Window.partitionBy()
    before = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    cap = F.lit(most) * F.col("source_size")
    level = (ranked.withColumn("weight", w).withColumn("fill", cap / F.col("weight"))
             .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
             .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
             .withColumn("full", F.col("left") * F.col("weight") > cap * F.col("open")))
    rest = F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("full"), cap)).over(every), F.lit(0))
    weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(every)
    return level.select("source", "rank", "rows", "source_size", F.when(F.col("full"), cap.cast("double")).otherwise(
        F.col("weight") * rest / F.nullif(weight, F.lit(0.0))).alias("target"))


def pivotal(p: np.ndarray, size: np.ndarray, coin: np.ndarray) -> np.ndarray:
    """Rounds ``p`` (each in [0, 1)) to 0 or 1 in order, all but one at most.

    ``size``: words of each element; ``coin``: a uniform number for each.  A
    step takes two undecided elements and moves words from one to the other,
    one way or the other at random, until one of them is 0 or 1.  The odds
    leave every element's expectation at ``p``, and the sum of p * size is the
    same after every step."""
    out = np.zeros(len(p))
    carry = -1
    has = full = 0.0  # words of the carried element that are in, and its size
    for i, (q, s, u) in enumerate(zip(p.tolist(), size.tolist(), coin.tolist())):
        if q <= 0.0:
            continue
        if carry < 0:
            carry, has, full = i, q * s, float(s)
            continue
        own = q * s
        up, down = min(full - has, own), min(has, s - own)  # most that the carried one can gain, can lose
        move = up if u * (up + down) < down else -down
        has, own = has + move, own - move
        if own <= 1e-9 * s or own >= s * (1 - 1e-9):
            out[i] = float(own > 0.5 * s)
            if has <= 1e-9 * full or has >= full * (1 - 1e-9):
                out[carry] = float(has > 0.5 * full)
                carry = -1
        else:
            out[carry] = float(has > 0.5 * full)
            carry, has, full = i, own, float(s)
    if carry >= 0:
        out[carry] = has / full
    return out


def _coins(ids: np.ndarray, level: int, seed: int) -> np.ndarray:
    x = mix64(ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 1_000_003 + level + 1))
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _round_groups(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """One level: rounds ``part`` within (rank, block)."""
    def run(table):
        size = table.column("size").to_numpy()
        ids = table.column("coin_id").to_numpy()
        order = np.lexsort((ids, -size))  # from large to small: what is left undecided is small
        part = table.column("part").to_numpy()[order]
        done = np.empty(len(part))
        done[order] = pivotal(part, size[order], _coins(ids[order], level, seed))
        at = table.schema.get_field_index("part")
        return table.set_column(at, "part", pa.array(done))

    return rows.groupBy("rank", "block").applyInArrow(run, rows.schema)


def _rounded(rows: DataFrame, rates: DataFrame, largest: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rounds ``rows`` (uid, doc_id, rank, block, size, coin_id) at the rate of their source, level by level: the
    decided rows, and those left undecided, one per source at most; both with whole and part."""
    rate = F.col("rate")
    left = (rows.join(rates, "rank").withColumn("whole", F.floor(rate).cast("int"))
            .withColumn("part", F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(F.lit(0.0)))
            .select("uid", "doc_id", "rank", "block", "size", "coin_id", "whole", "part"))
    level, decided = 0, []
    while True:
        done = stored(_round_groups(left, level, seed), f"rounded{level}")
        open_ = (F.col("part") > 0) & (F.col("part") < 1)
        decided.append(done.where(~open_))
        left = done.where(open_).withColumn("block", F.floor(F.col("block") / FAN_IN))
        level += 1
        if largest <= 1:
            return functools.reduce(DataFrame.unionByName, decided), left
        largest = math.ceil(largest / FAN_IN)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, most: int = MOST_COPIES, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    size: words of the text (null or blank: 0).  copies: 0 to ``most``; taken =
    copies * size.  Documents without words get no copies.  A null source is a
    source of its own, after all others; rows that repeat a doc_id are rounded
    one by one; a null doc_id is an id like any other.  The coins depend on
    doc_id, size and the seed only, so reruns agree however the table is
    partitioned.  An empty table gives an empty result.
    """
    sizes = stored(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               word_count(F.col(text_col)).alias("size")), "sizes")
    targets = stored(source_targets(sizes, weights, most).withColumn(
        "rate", F.coalesce(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)), F.lit(0.0)))
        .withColumn("n_blocks", F.ceil(F.col("rows") / BLOCK_ROWS)), "targets")
    largest = targets.agg(F.max("n_blocks")).first()[0] or 1  # one number
    every = (sizes.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
             .withColumn("coin_id", F.xxhash64("doc_id", "size"))
             .withColumn("block", F.pmod(F.xxhash64("coin_id"), F.col("n_blocks"))))
    rows, rates = every.select("uid", "doc_id", "rank", "block", "size", "coin_id"), targets.select("rank", "rate")
    # what is settled already: copies of single documents, and the words left for the others of their source
    goals = targets.select("rank", F.col("target").alias("goal"), F.col("source_size").alias("words"), F.lit(None).cast("double").alias("error"), F.lit(0).alias("stalled"))
    settled, attempts, errors = None, [], []
    while True:
        k = len(attempts)
        decided, last = _rounded(rows, rates, largest, seed)
        last = stored(last, f"last{k}")  # one row per source at most
        part = decided.unionByName(last).select("rank", "doc_id", "size", (F.col("whole") + F.round("part").cast("int")).alias("copies"))
        attempts.append((part if settled is None else part.unionByName(settled)).withColumn("attempt", F.lit(k)))
        miss = F.abs(F.col("part") - F.round("part")) * F.col("size")
        missed = stored(goals.join(targets.select("rank", "target"), "rank").join(last.withColumn("miss", miss), "rank", "left")
                        .withColumn("miss", F.coalesce("miss", F.lit(0.0))), f"missed{k}")
        errors.append(missed.select("rank", F.lit(k).alias("attempt"), "miss"))
        better = F.col("error").isNull() | (2 * F.col("miss") <= F.col("error"))
        off = (missed.where((F.col("miss") > MOST_ERROR * F.col("target")) & (F.col("words") > F.col("size")))
               .withColumns({"stalled": F.when(better, 0).otherwise(F.col("stalled") + 1), "error": F.when(better, F.col("miss")).otherwise(F.col("error"))})
               .where(F.col("stalled") < STALLED))
        # the nearer side, unless the others cannot take the rest
        others = F.col("words") - F.col("size")
        after = lambda c: F.col("goal") - c * F.col("size")
        near = F.col("whole") + F.round("part").cast("int")
        copies = F.when(after(near) < 0, F.col("whole")).when(after(near) > most * others, F.col("whole") + 1).otherwise(near)
        off = stored(off.withColumn("copies", copies.cast("int")).select(
            "rank", "uid", "doc_id", F.col("size"), "copies", after(F.col("copies")).alias("goal"), others.alias("words"), "error", "stalled")
            .where((F.col("goal") >= 0) & (F.col("goal") <= most * F.col("words"))), f"off{k}")
        if off.isEmpty():
            break
        one = off.select("rank", "doc_id", "size", "copies")
        # stored, or every attempt's plan would hold those of all before it
        settled = one if settled is None else stored(one.unionByName(settled.join(off.select("rank"), "rank", "left_semi")), f"settled{k}")
        rows = stored(rows.join(off.select("rank", F.col("uid").alias("u")), "rank").where("uid != u").drop("u"), f"others{k}")
        rates = off.select("rank", (F.col("goal") / F.col("words")).alias("rate"))
        goals = off.select("rank", "goal", "words", "error", "stalled")
    taken = functools.reduce(DataFrame.unionByName, attempts)
    if len(attempts) > 1:
        best = functools.reduce(DataFrame.unionByName, errors).groupBy("rank").agg(F.min(F.struct("miss", "attempt"))["attempt"].alias("attempt"))
        taken = taken.join(best, ["rank", "attempt"])
    return (taken.join(targets.select("rank", "source", "source_size", "target"), "rank")
            .withColumn("copies", F.when(F.col("size") > 0, F.col("copies")).otherwise(0))
            .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it, columns as they are, whatever their names.

    Rows and decisions meet by doc_id, source, size and their number within
    these, so rows that repeat a doc_id each get a decision of their own.  Rows
    are numbered by a hash of the whole row, decisions by their copies, so
    reruns agree."""
    key = ["doc_id", "size", "source"]
    nth = lambda by: F.row_number().over(Window.partitionBy(*key).orderBy(by))
    plan = mix(docs, id_col, text_col, source_col, **options).where("copies > 0").select(*key, "copies").withColumn("nth", nth(F.desc("copies")))
    # the row travels as one column, so no column name can clash
    rows = (docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("size"),
                        F.col(source_col).cast("string").alias("source")).withColumn("nth", nth(F.xxhash64("row"))))
    met = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*key, "nth")]
    return (rows.alias("r").join(plan.alias("p"), met)
            .select("r.row", F.explode(F.sequence(F.lit(1), F.col("p.copies"))).alias("copy")).select("row.*"))
