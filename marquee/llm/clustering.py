"""Centroid clustering in exact integers, by equal-average equal-variance nearest-neighbour search.

Method
------
1. Vectors become integers, floor(scale * x); everything after that is exact.
2. A vector's nearest centroid is sought outward from the vector's mean: the
   centroids are kept sorted by their component sum, and the scan takes the
   one nearest in mean first.  With D components, sums S and deviations
   V = sqrt(sum of (x - mean)^2), for every centroid
   distance^2 >= (S_x - S_c)^2 / D and
   distance^2 >= (S_x - S_c)^2 / D + (V_x - V_c)^2.
   The first inequality ends a vector's scan (all centroids further out are
   beyond it too), the second rejects single centroids.  What is left is
   compared by its exact squared distance; only bounds strictly above the
   best distance reject, so ties are seen and go to the smaller number.
3. A round is one pass over the vectors: each task adds up its clusters'
   components (clusters x D numbers at most, whatever the rows) and Spark sums
   the tasks' rows.  Only the centroids reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored

#: Largest quantised component times the number of components, so that every sum of squares below fits in 64 bits.
LARGEST = 1 << 30
#: Vectors that one vectorised search handles at a time.
BLOCK = 4096


def _quantise(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their integer components) of a list column: exactly ``dim`` components, none null or non-finite."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    fits = lengths == dim
    if column.null_count:
        fits &= ~np.asarray(column.is_null())
    rows = np.flatnonzero(fits)
    values = column.take(pa.array(rows, pa.int64())).flatten()
    x = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(rows), dim)
    finite = np.isfinite(x).all(axis=1)
    rows, x = rows[finite], np.floor(scale * x[finite])
    if len(x) and np.abs(x).max() > LARGEST // dim:
        raise OverflowError(f"a component times {scale} is beyond {LARGEST // dim}: squared distances would not fit in 64 bits")
    return rows, x.astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, exact distances computed) of each row of ``x``, by the scan of the module's docstring."""
    n, dim = x.shape
    sums, c_sums = x.sum(axis=1), centroids.sum(axis=1)
    spread = lambda v, s: np.sqrt(dim * (v * v).sum(axis=1) - s * s) / np.sqrt(dim)  # noqa: E731  (exact up to the root)
    dev, c_dev = spread(x, sums), spread(centroids, c_sums)
    apart = np.abs(sums[:, None] - c_sums[None, :])
    outward = np.argsort(apart, axis=1, kind="stable")  # nearest in mean first
    cluster = np.full(n, -1, np.int64)
    best = np.full(n, np.iinfo(np.int64).max)
    active, computed = np.arange(n), 0
    for step in range(len(centroids)):
        c = outward[active, step]
        gap = apart[active, c].astype(np.float64) ** 2 / dim
        limit = best[active].astype(np.float64) * (1 + 1e-9) + 1e-3  # rounding of the float bounds never rejects a tie
        reach = gap <= limit
        active, c, gap, limit = active[reach], c[reach], gap[reach], limit[reach]
        if not len(active):
            break
        uneven = np.maximum(np.abs(dev[active] - c_dev[c]) - 1e-14 * (dev[active] + c_dev[c]), 0)
        close = gap + uneven ** 2 <= limit
        rows, c = active[close], c[close]
        d = ((x[rows] - centroids[c]) ** 2).sum(axis=1)
        computed += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = d[better], c[better]
    return cluster, best, computed


def _blocks(batches, dim: int, scale: int):
    for batch in batches:
        for i in range(0, len(batch), BLOCK):
            part = batch.slice(i, BLOCK)
            rows, x = _quantise(part.column(1), dim, scale)
            if len(rows):
                yield part.column(0).take(pa.array(rows, pa.int64())), x


def _columns(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))


def first_centroids(vectors: DataFrame, k: int, seed: int, dim: int, scale: int) -> np.ndarray:
    """The ``k`` kept vectors whose ids have the smallest sha256 of ``<seed>:<id>`` (null ids last, ties by components), in that order."""
    def run(batches):
        for ids, x in _blocks(batches, dim, scale):
            yield pa.RecordBatch.from_arrays([ids, pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dim).cast(pa.list_(pa.int64()))], ["vec_id", "x"])

    kept = vectors.mapInArrow(run, "vec_id long, x array<long>")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    top = kept.select(key.alias("key"), "x").orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()  # k rows
    return np.array([r.x for r in top], np.int64).reshape(len(top), dim)


def _means(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """The floor of every cluster's mean; a cluster without vectors keeps its centroid."""
    k, dim = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, dim), object), np.zeros(k, np.int64)
        for _, x in _blocks(batches, dim, scale):
            cluster = nearest(x, centroids)[0]
            order = np.argsort(cluster, kind="stable")
            some, first = np.unique(cluster[order], return_index=True)
            sums[some] += np.add.reduceat(x[order], first, axis=0)
            counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some]), pa.array([[str(v) for v in sums[c]] for c in some], pa.list_(pa.string()))],
                                             ["cluster", "n", "sums"])

    parts = vectors.mapInArrow(run, "cluster long, n long, sums array<string>")
    sized = parts.select("cluster", "n", F.posexplode(F.col("sums").cast("array<decimal(38,0)>")).alias("at", "v"))
    totals = sized.groupBy("cluster", "at").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect()  # k x dim rows
    out = centroids.copy()
    for r in totals:
        out[r.cluster, r.at] = int(r.v) // r.n
    return out


def assign(vectors: DataFrame, centroids: np.ndarray, scale: int) -> DataFrame:
    """vec_id, cluster and squared distance of every kept vector."""
    def run(batches):
        for ids, x in _blocks(batches, centroids.shape[1], scale):
            cluster, distance, _ = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, dim: int = 64, scale: int = 64,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance of every kept vector, the centroids) after ``rounds`` rounds of k-means.

    Kept are vectors of exactly ``dim`` components, none null or non-finite;
    a null vector is not kept.  Fewer than ``k`` kept vectors start as many
    clusters; none, or an empty table, gives no rows.  Equal vectors and
    repeated or null ids are rows of their own; among starting vectors null
    ids come last and equal ids in the order of their components.  Ties go to
    the smaller cluster; an empty cluster keeps its centroid.  A component beyond
    ``LARGEST / dim / scale`` stops the job with an OverflowError, as long
    arithmetic does in ANSI mode.  Other columns are not looked at."""
    vectors = _columns(vectors, id_col, vector_col)
    centroids = first_centroids(vectors, k, seed, dim, scale)
    if len(centroids):
        for _ in range(rounds):
            centroids = _means(vectors, centroids, scale)
    else:
        vectors = vectors.limit(0)
    return assign(vectors, centroids, scale), centroids


def cluster_digest(vectors: DataFrame) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    found, centroids = cluster_vectors(vectors)
    found = stored(found, "clusters")
    per = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # k rows
    whole = found.agg(F.sum("distance").alias("inertia"))
    shas = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    names = found.sparkSession.createDataFrame(shas, "cluster int, centroid_sha256 string")
    facts = per.join(names, "cluster").crossJoin(whole)  # k rows, one row
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
