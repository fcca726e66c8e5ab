"""Approximate nearest neighbours: stable random projections, kd-trees and a chi-square stopping test.

Method
------
For a projection on ``PROJECTIONS`` random normal directions, the squared
projected distance of two vectors over their squared distance follows a
chi-square law with as many degrees of freedom.  So once the k-th best
distance found is d, a vector nearer than d lies within the projected
distance sqrt(q) * d with probability ``CONFIDENCE``, q being that quantile;
projected neighbours need to be verified only up to there.

1. Equal vectors are one class (its smallest ids stand for it: a further copy
   could not be among the k nearest).  Classes are projected.
2. A kd-tree over the projections of a bounded sample cuts the space into
   cells; every class belongs to one.  A cell with many classes is cut into
   parts by hash, so a part is bounded however the data lie.
3. Every query first searches one part of its own cell.  That gives a bound d.
4. It then visits the cells whose box lies within sqrt(q) * d.  In every part
   a kd-tree over the part's projections hands out its leaves in order of
   their projected distance; their classes are verified by exact distance,
   and the scan ends when the next leaf fails the test at the best d so far.
5. The candidates of all parts are merged.

Queries meet a part in blocks; a task holds one part and one block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import stored

#: Normal directions that vectors are projected on, and the seed they are drawn with.
PROJECTIONS, SEED = 8, 11
#: Probability with which a nearer vector must have been met before a scan stops.
CONFIDENCE = 0.97
#: Cells at most, and classes sampled for the tree (as expected; twice that at most).
MOST_CELLS, SAMPLE_ROWS = 4096, 65536
#: Components of a part and of a block of queries: what one task holds at a time (32 and 8 MB).
PART_SIZE, BLOCK_SIZE = 1 << 22, 1 << 20
#: Classes of a leaf of a part's tree.
LEAF_ROWS = 32


def chi2_cdf(x: float, dof: int) -> float:
    """The chi-square distribution function, by the series of the lower incomplete gamma function."""
    a, x = dof / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = math.exp(a * math.log(x) - x - math.lgamma(a + 1))
    n = a
    while term > total * 1e-17:
        n += 1
        term *= x / n
        total += term
    return min(total, 1.0)


def chi2_quantile(p: float, dof: int) -> float:
    lo, hi = 0.0, 1.0
    while chi2_cdf(hi, dof) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, dof) < p else (lo, mid)
    return hi


def directions(dim: int, m: int = PROJECTIONS, seed: int = SEED) -> np.ndarray:
    """dim x m independent standard normal numbers (the 2-stable law); the same for every task."""
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((dim, m))


class Cells:
    """A kd-tree over a sample: median cuts along the widest side.  Its leaves are the cells."""

    def __init__(self, points: np.ndarray, cells: int):
        self.axis, self.cut, self.kids, self.boxes = [], [], [], []
        m = points.shape[1]
        self._grow(points, cells, np.full(m, -np.inf), np.full(m, np.inf))
        self.boxes = np.array(self.boxes).reshape(-1, 2, m)

    def _grow(self, points, cells, lo, hi) -> int:
        """Number of the node, or ~cell."""
        if cells > 1 and len(points) > 1:
            axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
            cut = float(np.median(points[:, axis]))
            left = points[:, axis] <= cut
            if left.any() and not left.all():
                at = len(self.axis)
                self.axis.append(axis), self.cut.append(cut), self.kids.append(None)
                below, above = hi.copy(), lo.copy()
                below[axis] = above[axis] = cut
                self.kids[at] = (self._grow(points[left], cells // 2, lo, below), self._grow(points[~left], cells - cells // 2, above, hi))
                return at
        self.boxes.append((lo, hi))
        return ~(len(self.boxes) - 1)

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of every point."""
        out = np.zeros(len(points), np.int64)
        todo = [(0 if self.axis else -1, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = ~node
            elif len(rows):
                left = points[rows, self.axis[node]] <= self.cut[node]
                todo += [(self.kids[node][0], rows[left]), (self.kids[node][1], rows[~left])]
        return out


def box_distance(point: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Squared distance of a point to every box (lower and upper corners)."""
    gap = np.maximum(np.maximum(boxes[:, 0] - point, point - boxes[:, 1]), 0)
    return (gap * gap).sum(axis=1)


def leaves_of(points: np.ndarray, most: int = LEAF_ROWS) -> tuple[list[np.ndarray], np.ndarray]:
    """Leaves (row numbers) of a kd-tree over ``points`` and the boxes that hold them."""
    leaves, boxes, todo = [], [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        p = points[rows]
        lo, hi = p.min(axis=0), p.max(axis=0)
        axis = int(np.argmax(hi - lo))
        if len(rows) <= most or hi[axis] == lo[axis]:
            leaves.append(rows)
            boxes.append((lo, hi))
        else:
            order = np.argpartition(p[:, axis], len(rows) // 2)
            todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return leaves, np.array(boxes)


class Part:
    """One part of the index: vectors, ids, projections and a kd-tree over them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, quantile: float, m: int, seed: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.quantile = ids[order], vectors[order], quantile
        self.normals = directions(vectors.shape[1], m, seed)
        self.points = self.vectors @ self.normals
        self.leaves, self.boxes = leaves_of(self.points)

    def search(self, vector: np.ndarray, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest met, nearest first, none beyond ``bound``; ties to the smaller id."""
        point = vector @ self.normals
        away = box_distance(point, self.boxes)
        order = np.argsort(away, kind="stable")
        ids, best, at, take = np.zeros(0, np.int64), np.zeros(0), 0, 4
        while at < len(order):
            reach = self.quantile * bound * bound * (1 + 1e-12)
            now = order[at:at + take]
            now = now[away[now] <= reach]  # the next leaf fails the test: every later one does too
            if not len(now):
                break
            rows = np.concatenate([self.leaves[i] for i in now])
            gap = self.points[rows] - point
            rows = rows[(gap * gap).sum(axis=1) <= reach + 1e-9]
            diff = self.vectors[rows] - vector
            d = np.sqrt((diff * diff).sum(axis=1))
            inside = d <= bound
            ids, best = np.concatenate([ids, self.ids[rows[inside]]]), np.concatenate([best, d[inside]])
            if len(ids) > k:
                first = np.lexsort((ids, best))[:k]
                ids, best = ids[first], best[first]
            if len(ids) == k:
                bound = min(bound, float(best.max()))
            at += len(now)
            take = min(2 * take, 256)
        first = np.lexsort((ids, best))
        return ids[first], best[first]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, x (array of double): the rows that take part; an id that repeats with other components stays as rows of its own."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite & F.exists("x", lambda v: v != 0)))


def classes(rows: DataFrame, copies: int) -> DataFrame:
    """class_id, first_id (the smallest id), dim, x, ids: distinct vectors with their ``copies`` smallest ids.

    Repeated rows fall together and ranks are cut off within each task before
    the vectors are shuffled, so a vector that a third of the rows hold sends
    a few rows per task only."""
    w = Window.partitionBy("x").orderBy("vec_id")
    few = rows.distinct().withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= copies)
    return (few.groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
            .select(_name(F.col("ids")[0]).alias("class_id"), F.col("ids")[0].alias("first_id"), F.size("x").alias("dim"), "x", "ids"))


def _name(first_id) -> F.Column:
    """Name of a distinct vector: its smallest id, and a hash since ids may repeat."""
    return F.concat_ws(":", first_id.cast("string"), F.hex(F.xxhash64("x")))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def neighbours(queries: DataFrame, vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
               confidence: float = CONFIDENCE, m: int = PROJECTIONS, seed: int = SEED, part_size: int = PART_SIZE, block_size: int = BLOCK_SIZE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` found for every row of ``queries``.

    Nearness is Euclidean distance (score) between vectors of equally many
    components, ties go to the smaller id.  The query's own row (its id and
    vector) is no candidate.  With fewer candidates all are returned.  Vectors
    that are null, empty, all zero or hold null or non-finite components take
    no part, as queries or candidates, nor do rows with a null id.  Rows that
    repeat an id and vector count once; an id that repeats with another vector
    is a row, and a query, of its own.  Other columns are not looked at; empty
    tables give an empty result."""
    spark = vectors.sparkSession
    index = stored(classes(usable(vectors, id_col, vector_col), k + 1), "classes")
    asked = stored(usable(queries, id_col, vector_col).distinct(), "queries")
    # equal queries are searched once; k + 1 rows found leave k without the query's own
    wanted = stored(asked.groupBy("x").agg(F.min("vec_id").alias("q")).select(_name(F.col("q")).alias("query"), F.size("x").alias("dim"), "x"), "wanted")
    dims = [(r.dim, r.n) for r in index.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()]  # one row per vector length in use
    found = None
    for dim, n in dims:
        part = _search(index.where(F.col("dim") == dim), wanted.where(F.col("dim") == dim), dim, n, k + 1, confidence, m, seed,
                       max(part_size // dim, 64), max(block_size // dim, 64))
        found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = Window.partitionBy("query").orderBy("score", "first_id", "class_id")
    top = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1).drop("nth")
    listed = top.join(index.select("class_id", "ids"), "class_id").select("query", "score", F.explode("ids").alias("vec_id"))
    # at most (k + 1)^2 rows a query; its k + 1 nearest go to every member of the query's class
    nearest = listed.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k + 1).alias("near"))
    member = asked.join(wanted.select("query", "x"), "x").select(F.col("vec_id").alias("query_id"), "query")
    others = F.slice(F.filter("near", lambda c: (c["vec_id"] != F.col("query_id")) | (c["score"] > 0)), 1, k)
    return (member.join(nearest, "query").select("query_id", F.posexplode(others).alias("at", "c"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("c.vec_id").alias("vec_id"), F.col("c.score").alias("score")))


def _search(index: DataFrame, wanted: DataFrame, dim: int, n: int, k: int, confidence: float, m: int, seed: int,
            part_rows: int, block_queries: int) -> DataFrame:
    """query, class_id, first_id, score: the best k classes of every part that a query visits."""
    spark = index.sparkSession
    quantile = chi2_quantile(confidence, m)
    normals = directions(dim, m, seed)
    # the tree is fitted on a bounded sample: classes whose hash is small
    chosen = F.pmod(F.xxhash64("class_id", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(min(1.0, SAMPLE_ROWS / n) * (1 << 30)))

    def project(batches):
        for b in batches:
            p = _matrix(b.column(0)) @ normals
            yield pa.RecordBatch.from_arrays([pa.array(p[:, i]) for i in range(m)], [f"p{i}" for i in range(m)])

    sample = (index.where(chosen).select("x").mapInArrow(project, ", ".join(f"p{i} double" for i in range(m)))
              .limit(2 * SAMPLE_ROWS).toPandas().to_numpy())
    cells = Cells(sample, min(MOST_CELLS, -(-n // part_rows)))

    def place(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells.of(_matrix(b.column(2)) @ normals))], ["class_id", "first_id", "x", "cell"])

    placed = index.select("class_id", "first_id", "x").mapInArrow(place, "class_id string, first_id long, x array<double>, cell long")
    # parts of every cell: MOST_CELLS rows at most, also on the driver
    parts = [(r.cell, -(-r.n // part_rows)) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()]
    full = np.array(sorted(c for c, _ in parts))
    parts = F.broadcast(spark.createDataFrame(parts, "cell long, parts long"))
    placed = stored(placed.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("class_id"), F.col("parts"))).drop("parts"), "placed")

    def home(batches):
        """Each query with its cell: the nearest one that holds classes."""
        for b in batches:
            p = _matrix(b.column(1)) @ normals
            own = cells.of(p)
            for i in np.flatnonzero(~np.isin(own, full)):
                own[i] = full[int(np.argmin(box_distance(p[i], cells.boxes[full])))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.full(len(b), np.inf)), pa.array(own)], ["query", "x", "bound", "cell"])

    def visits(batches):
        """Each query with every cell that a nearer vector may lie in."""
        for b in batches:
            p, bound = _matrix(b.column(1)) @ normals, b.column(2).to_numpy()
            for i in range(0, len(b), 256):
                near = [full[box_distance(p[j], cells.boxes[full]) <= quantile * bound[j] ** 2 * (1 + 1e-12) + 1e-9] for j in range(i, min(i + 256, len(b)))]
                at = pa.array(np.repeat(np.arange(i, i + len(near)), [len(x) for x in near]))
                yield pa.RecordBatch.from_arrays([b.column(c).take(at) for c in range(3)] + [pa.array(np.concatenate(near))], ["query", "x", "bound", "cell"])

    def search(part, batch):
        if not len(part) or not len(batch):
            return pa.table({"query": pa.array([], pa.string()), "class_id": pa.array([], pa.string()), "first_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        order = pa.compute.sort_indices(part, sort_keys=[("first_id", "ascending"), ("class_id", "ascending")])
        part = part.take(order)  # ties go to the smaller row number
        tree = Part(np.arange(len(part)), _matrix(part.column("x")), quantile, m, seed)
        xs, bounds = _matrix(batch.column("x")), batch.column("bound").to_numpy()
        rows, scores = zip(*[tree.search(xs[i], k, float(bounds[i])) for i in range(len(batch))])
        asked = np.repeat(np.arange(len(batch)), [len(r) for r in rows])
        hit = part.select(["class_id", "first_id"]).take(pa.array(np.concatenate(rows)))
        return pa.table({"query": batch.column("query").take(pa.array(asked)), "class_id": hit.column(0), "first_id": hit.column(1), "score": np.concatenate(scores)})

    def met(asked: DataFrame, chosen_part) -> DataFrame:
        """Searches of queries (with a cell) in the chosen parts of it."""
        asked = stored(asked.join(parts, "cell").withColumn("part", chosen_part).drop("parts"), "asked")
        # queries of a part are dealt to blocks; the part goes to every block of its queries
        counts = asked.groupBy("cell", "part").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_queries)).alias("blocks"))
        q = asked.join(counts, ["cell", "part"]).withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks"))).drop("blocks")
        p = placed.join(counts, ["cell", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
        return stored(p.groupBy("cell", "part", "block").cogroup(q.groupBy("cell", "part", "block"))
                      .applyInArrow(search, "query string, class_id string, first_id long, score double"), "met")

    one, every = F.pmod(F.xxhash64("query"), F.col("parts")), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    homes = "query string, x array<double>, bound double, cell long"
    first = met(wanted.select("query", "x").mapInArrow(home, homes), one)
    bounds = first.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.max("score")).alias("bound"))
    bounded = wanted.join(bounds, "query", "left").select("query", "x", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    # what the first search found stays, so a query never ends with less than it has
    return (first.unionAll(met(bounded.mapInArrow(visits, homes), every))
            .groupBy("query", "class_id", "first_id").agg(F.min("score").alias("score")))


def neighbour_table(vectors: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by 100, among all rows."""
    return neighbours(vectors.where(F.col("vec_id") % 100 == 0), vectors)
