"""Near-duplicate documents: MinHash signatures joined by a multi-index over Hamming distance.

Method
------
1. Every document becomes its set of five-word shingles (64-bit hashes) and a
   signature of ``POSITIONS`` b-bit MinHash values.  Documents with the same
   set are one class from here on; its smallest doc_id stands for it.
2. Two signatures within distance ``GUARANTEED`` agree, by pigeonhole, in at
   least one of the ``CHUNKS`` chunks up to ``CHUNK_ERRORS`` values.  Each
   class therefore enumerates, for every chunk, the ways to leave out that
   many values, and two classes meet if one such key is equal.  At a
   similarity of 0.75 a chunk agrees with probability 0.63, so a pair fails to
   meet in any of the 16 with probability 1e-7.
3. Every class that shares a key is first tested against the smallest doc_id
   under that key, so a large group of copies costs a star, not all its pairs.
   Components of these links are found.  Under each key only pairs from
   different components are left, and those are compared in blocks.
4. Pairs within signature distance ``NEAR`` and of compatible sizes are
   confirmed on their full sets (exact Jaccard, in integers).
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import mix64, stored, text_buffers
from marquee.llm.graph import components
from marquee.llm.shingles import shingle_sets

CHUNKS, CHUNK_SIZE, CHUNK_ERRORS, BITS = 16, 5, 1, 16
POSITIONS = CHUNKS * CHUNK_SIZE
#: Signature distance up to which the index finds every pair (pigeonhole).
GUARANTEED = CHUNKS * (CHUNK_ERRORS + 1) - 1
#: Least similarity in percent that chunks of this size are made for: the index misses 1e-7 of the links there.
LEAST_PERCENT = 75
#: Rows of one key, and their shingles, that make up a block; a task compares two blocks at a time.
BLOCK_ROWS = 1500
BLOCK_SHINGLES = 1 << 20

_PATTERNS = [c for c in combinations(range(CHUNK_SIZE), CHUNK_SIZE - CHUNK_ERRORS)]


def near_distance(percent: int) -> int:
    """Signature distance up to which pairs that met are confirmed on their sets.

    A link of similarity p lies beyond it, its distance being binomial, no
    more often than all chunks have more than ``CHUNK_ERRORS`` errors."""
    p = percent / 100
    tail = lambda n, q, most: sum(comb(n, k) * q ** k * (1 - q) ** (n - k) for k in range(most + 1, n + 1))
    missed = tail(CHUNK_SIZE, 1 - p, CHUNK_ERRORS) ** CHUNKS
    return next(t for t in range(POSITIONS + 1) if tail(POSITIONS, 1 - p, t) <= missed)


def _multipliers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, n (set size), d1 and d2 (128-bit digest of the set), sig (POSITIONS values of BITS bits; null if the set is empty)."""
    multipliers, mask = _multipliers(POSITIONS), np.uint64((1 << BITS) - 1)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for i, j, shingles, ends in shingle_sets(data, offsets):
                starts = np.concatenate(([0], ends[:-1]))
                sizes = ends - starts
                some = np.flatnonzero(sizes)
                at = starts[some]
                d1, d2 = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
                sig = np.zeros((len(some), POSITIONS), np.int32)
                if len(some):
                    d1[some] = np.add.reduceat(mix64(shingles + np.uint64(1)), at)
                    d2[some] = np.add.reduceat(mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)), at)
                    for k in range(POSITIONS):
                        low = np.minimum.reduceat(shingles * multipliers[k], at)
                        sig[:, k] = (mix64(low) & mask).astype(np.int32)
                spread = np.zeros(j - i + 1, np.int32)
                spread[some + 1] = POSITIONS
                offs = pa.array(np.cumsum(spread, dtype=np.int32), mask=None)
                lists = pa.ListArray.from_arrays(offs, pa.array(sig.ravel()), mask=pa.array(sizes == 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(sizes), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     lists], ["doc_id", "text_hash", "n", "d1", "d2", "sig"])

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(
        run, "doc_id long, text_hash long, n long, d1 long, d2 long, sig array<int>")


def index_keys(sigs: DataFrame) -> DataFrame:
    """One row per chunk key of a signature: doc_id, n, which (number of the chunk and pattern), key (64 bits)."""
    keys = [F.xxhash64(F.lit(i * len(_PATTERNS) + p), *[F.col("sig")[i * CHUNK_SIZE + x] for x in pattern])
            for i in range(CHUNKS) for p, pattern in enumerate(_PATTERNS)]
    return sigs.select("doc_id", "n", F.posexplode(F.array(*keys)).alias("which", "key"))


def shingle_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and its sorted distinct shingle hashes as little-endian bytes."""
    def run(batches):
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            for i, j, shingles, ends in shingle_sets(data, offsets):
                offs = np.concatenate(([0], ends)).astype(np.int64) * 8
                column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(offs), pa.py_buffer(shingles)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), column.cast(pa.binary())], ["doc_id", "shingles"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on their full sets."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    sides = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
             .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b"))
    return sides.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x != y).sum(axis=-1)


def near_star_pairs(stars: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those of compatible sizes and near enough by signature."""
    most = near_distance(percent)

    def run(batches):
        for batch in batches:
            n = len(batch)
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            y = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            keep = pa.array(_distance(x, y) <= most) if n else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    side = lambda k: sigs.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col("sig").alias(f"s{k}"))
    sized = (stars.join(side("a"), "a").join(side("b"), "b")
             .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    return sized.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _pairs_of_group(table, lo: int, hi: int, which: int, percent: int):
    """(i, js): row numbers of pairs of the group to look at, one i at a time.

    Pairs have different components, compatible sizes and near signatures;
    each pair of rows belongs to one group only, that of the first
    key that both share."""
    chunk, pattern = divmod(which, len(_PATTERNS))
    most = near_distance(percent)
    own, n, comp = (table.column(c).to_numpy() for c in ("own", "n", "component"))
    sig = table.column("sig").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1).astype(np.uint16)
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
    left, right = (order, order) if lo == hi else (order[own[order] == lo], order[own[order] == hi])
    for k, i in enumerate(left):
        rest = right[k + 1:] if lo == hi else right
        rest = rest[(comp[rest] != comp[i]) & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))]
        if not len(rest):
            continue
        same = sig[rest] == sig[i]
        near = same.sum(axis=1) >= POSITIONS - most
        rest, same = rest[near], same[near].reshape(-1, CHUNKS, CHUNK_SIZE)
        if not len(rest):
            continue
        first = (same.sum(axis=2) >= CHUNK_SIZE - CHUNK_ERRORS).argmax(axis=1) == chunk
        rest, same = rest[first], same[first][:, chunk]
        if len(rest):
            rest = rest[np.stack([same[:, list(p)].all(axis=1) for p in _PATTERNS], axis=1).argmax(axis=1) == pattern]
        if len(rest):
            yield i, rest


_GROUP = ("key", "lo", "hi", "which")


def in_blocks(members: DataFrame) -> DataFrame:
    """Deals the rows of every key to groups (key, lo, hi).

    A key's rows fall into blocks by a hash of doc_id, about ``BLOCK_ROWS``
    rows or ``BLOCK_SHINGLES`` shingles to a block; every pair of blocks is a
    group, so a hot key is split over many tasks and none holds more than two blocks."""
    blocks = F.greatest(F.ceil(F.col("size") / F.lit(BLOCK_ROWS)), F.ceil(F.col("total") / F.lit(BLOCK_SHINGLES)))
    return (members.withColumn("own", F.pmod(F.xxhash64("doc_id"), blocks))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
            .drop("other", "size", "total"))


def crossing_rows(placed: DataFrame, percent: int) -> DataFrame:
    """The rows of each group that are in a pair to look at: group, doc_id, own, component, n, sig."""
    def run(keys, table):
        lo, hi, which = (k.as_py() for k in keys[1:])
        hit = np.zeros(len(table), bool)
        for i, js in _pairs_of_group(table, lo, hi, which, percent):
            hit[i] = True
            hit[js] = True
        return table.select([*_GROUP, "doc_id", "own", "component", "n", "sig"]).filter(pa.array(hit))

    return placed.groupBy(*_GROUP).applyInArrow(run, "key long, lo long, hi long, which int, doc_id long, own long, component long, n long, sig array<int>")


def crossing_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components, confirmed on the full sets of their rows.

    ``rows``: group, doc_id, own, component, n, sig, shingles.  Pairs whose
    components are linked already within the group are not looked at again, so
    a group returns fewer links than it has rows."""
    def run(keys, table):
        lo, hi, which = (k.as_py() for k in keys[1:])
        comp = table.column("component").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        root = {int(c): int(c) for c in comp}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        found = []
        for i, js in _pairs_of_group(table, lo, hi, which, percent):
            mine, size = sets[i], len(sets[i])
            lengths = np.array([len(sets[j]) for j in js])
            every = np.concatenate([sets[j] for j in js])
            equal = mine[np.minimum(np.searchsorted(mine, every), size - 1)] == every
            common = np.add.reduceat(equal, np.cumsum(lengths) - lengths, dtype=np.int64)
            for j in js[100 * common >= percent * (size + lengths - common)]:
                a, b = find(int(comp[i])), find(int(comp[j]))
                if a != b:
                    root[max(a, b)] = min(a, b)
                    found.append((min(a, b), max(a, b)))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return rows.groupBy(*_GROUP).applyInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """doc_id, text_hash, n (set size) of every row, component (a number of its own for each) and component_id (its smallest doc_id).

    Classes of equal sets are the nodes.  A class is numbered by its smallest
    doc_id; if several have the same one, since an id repeats with another
    text, all but one of them take a hash instead."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent: {LEAST_PERCENT} to 100")
    sigs = stored(signatures(docs, id_col, text_col), "signatures")
    named = sigs.where("doc_id is not null and n > 0")
    per = named.groupBy("n", "d1", "d2").agg(F.min(F.struct("doc_id", "text_hash")).alias("r"))
    per = per.select("n", "d1", "d2", F.col("r.doc_id").alias("rep"), F.col("r.text_hash").alias("text_hash"))
    first = per.groupBy("rep").agg(F.min(F.struct("n", "d1", "d2")).alias("first"))
    node = F.when(F.struct("n", "d1", "d2") == F.col("first"), F.col("rep")).otherwise(F.xxhash64("rep", "n", "d1", "d2"))
    classes = stored(per.join(first, "rep").select("n", "d1", "d2", "rep", "text_hash", node.alias("node")), "classes")
    # one signature per class
    mine = ["n", "d1", "d2", "text_hash"]
    reps = stored(named.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *mine])
                  .dropDuplicates(["node"]).select(F.col("node").alias("doc_id"), "n", "sig"), "representatives")
    keys = index_keys(reps)
    groups = stored(keys.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("total"), F.min("doc_id").alias("lead"),
                                            F.min("which").alias("which")).where("size > 1"), "groups")
    members = stored(keys.select("doc_id", "key").join(groups, "key"), "members")
    stars = members.where("doc_id != lead").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()
    near = stored(near_star_pairs(stars, reps, percent), "stars")
    # full sets of the classes that met another one, each made from one of its rows
    met = classes.join(members.select(F.col("doc_id").alias("node")).distinct(), "node", "left_semi").select("node", F.col("rep").alias("doc_id"), "text_hash")
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    sets = stored(shingle_table(texts.join(met, ["doc_id", "text_hash"]).dropDuplicates(["node"]), "node", "text"), "sets")
    first = components(stored(confirm(near, sets, percent), "linked"))

    # keys whose rows are still in different components: compare those rows across components.  Each row
    # takes its signature once, before its key is dealt to blocks, and keeps it from there on
    labelled = (members.where("size > 2").drop("lead", "n").join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                .withColumn("component", F.coalesce("component", "doc_id")))
    mixed = (labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
             .where("x != y").select("key"))
    cross = in_blocks(labelled.join(mixed, "key", "left_semi").join(reps, "doc_id"))
    rows = stored(crossing_rows(cross, percent), "crossing")
    bridges = stored(crossing_links(rows.join(sets, "doc_id"), percent).distinct(), "bridges")
    second = components(bridges)
    joined = (first.unionByName(bridges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                                .join(first, "node", "left_anti").withColumn("component", F.col("node")))
              .join(second.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left")
              .select("node", F.coalesce("top", "component").alias("top")))
    linked = classes.select("node", "rep").join(joined, "node")
    least = linked.groupBy("top").agg(F.min("rep").alias("least"))
    tops = (classes.select("n", "d1", "d2", "rep", "node").join(joined.join(least, "top"), "node", "left")
            .select("n", "d1", "d2", F.coalesce("top", "node").alias("component"), F.coalesce("least", "rep").alias("component_id")))
    mine = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return (sigs.select("doc_id", "text_hash", "n", "d1", "d2").join(tops, ["n", "d1", "d2"], "left")
            .select("doc_id", "text_hash", "n", F.when(mine, F.col("component")).alias("component"),
                    F.when(mine, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * |A and B| >= percent * |A or B| over their
    sets of five-word shingles (A-Z lower-cased); component_id is the smallest
    doc_id reachable over links.  A text that is null, empty or only space has
    an empty set, is linked with nothing and kept.  Rows that repeat a doc_id
    are separate rows; with another text they are separate documents too, each
    with the links of its own text.  A null doc_id cannot be named: its row has
    a null component and is kept.  Extra columns are ignored; an empty table
    gives an empty result.  ``percent`` is 75 to 100, the range for which the
    index and the signature distance lose about 1e-7 of the links at most.
    """
    return (_grouped(docs, id_col, text_col, percent)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stand for their group, columns as they are:
    one row of each component, that with the smallest doc_id.  Of rows that
    repeat a doc_id and text one stays; documents without words and rows with a null
    doc_id are in no group and stay."""
    grouped = _grouped(docs, id_col, text_col, percent).where("doc_id is not null")
    standing = (grouped.where("n > 0").groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("r")).select("r.*")
                .unionByName(grouped.where("n = 0").select("doc_id", "text_hash").distinct()))
    # the row travels as one column, so no column name can clash
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    one = Window.partitionBy("doc_id", "text_hash").orderBy(F.xxhash64("row"))
    kept = rows.join(standing, ["doc_id", "text_hash"], "left_semi").withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return kept.select("row.*").unionByName(rows.where("doc_id is null").select("row.*"))
