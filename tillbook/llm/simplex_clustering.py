"""Centroid clustering of integer vectors with n-simplex projection as filter.

The first centroids that are independent enough serve as pivots.  The pivots
span a simplex, and a point's squared distances to them, taken once and kept
in the table of vectors, put the point at the apex of that simplex with one
dimension more: coordinates in the pivots' space by forward substitution, and
the height above it.  The distance of two points is at least the Euclidean
distance of their apexes and at most the distance with one of the two turned
to the other side of the base.  A centroid whose lower bound lies above the
least upper bound of all centroids can't be the nearest; the rest is compared
in exact integers.

The bounds are floating-point numbers with a slack of ``SLACK`` of the squared
distances that went into them, thousands of times their rounding error; they
only save comparisons, the integers decide.

A round reads the table of vectors, sends the centroids to the tasks, and
returns one partial sum per centroid and task, so no vector is shuffled and a
vector that is most of the table makes no task longer than the others.

Defined results: vectors that are null, of another length or with null or
non-finite components take no part; components beyond ``LIMIT`` after scaling
count as ``LIMIT``, so that distances fit a long; rows that repeat an id are
rows of their own; null ids come last among the first centroids; fewer vectors
than centroids give as many centroids; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillbook.llm.integer_vectors import exact_totals, integers, matrix, usable
from tillbook.session import materialize

LIMIT = 1 << 27
SLACK = 1e-6
PIVOTS = 40
MIN_HEIGHT = 1e-3       # a pivot's height over the others, as a share of its distance to the first
BLOCK_ROWS = 1024
_LONG = (1 << 63) - 1
_RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


class Simplex(NamedTuple):
    pivots: np.ndarray      # int64, one a row
    base: np.ndarray        # squared distances of the pivots after the first to the first
    inverse: np.ndarray     # of the lower triangular matrix of their coordinates


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact, of every row of ``x`` to every row of ``y``."""
    out = np.empty((len(x), len(y)), dtype=np.int64)
    for j, row in enumerate(y):
        diff = x - row
        out[:, j] = np.einsum("ij,ij->i", diff, diff)
    return out


def apexes(simplex: Simplex, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates in the pivots' space and heights, from squared distances to the pivots."""
    d = distances.astype(np.float64)
    y = ((d[:, :1] + simplex.base - d[:, 1:]) / 2) @ simplex.inverse.T
    return y, np.sqrt(np.maximum(d[:, 0] - np.einsum("ij,ij->i", y, y), 0))


def build_simplex(candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
    """The base of the candidates, in order, that rise enough above the ones before; at most ``most``."""
    simplex = Simplex(candidates[:1], np.zeros(0), np.zeros((0, 0)))
    rows: list[np.ndarray] = []
    for candidate in candidates[1:]:
        if len(simplex.pivots) >= most:
            break
        d = squared_distances(candidate[None], simplex.pivots)
        y, height = apexes(simplex, d)
        if height[0] <= MIN_HEIGHT * np.sqrt(float(d[0, 0])):
            continue
        rows.append(np.append(y[0], height[0]))
        lower = np.zeros((len(rows), len(rows)))
        for i, r in enumerate(rows):
            lower[i, :i + 1] = r
        simplex = Simplex(np.vstack([simplex.pivots, candidate]), np.append(simplex.base, float(d[0, 0])), np.linalg.inv(lower))
    return simplex


def nearest(x: np.ndarray, distances: np.ndarray, simplex: Simplex, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid (ties: the smaller), and how many were compared exactly."""
    to_pivots = squared_distances(centroids, simplex.pivots)
    base, height = apexes(simplex, to_pivots)
    number, least, compared = np.empty(len(x), dtype=np.int32), np.empty(len(x), dtype=np.int64), 0
    for lo in range(0, len(x), BLOCK_ROWS):
        part, d = x[lo:lo + BLOCK_ROWS], distances[lo:lo + BLOCK_ROWS]
        y, h = apexes(simplex, d)
        flat = np.einsum("ij,ij->i", y, y)[:, None] + np.einsum("ij,ij->i", base, base) - 2 * (y @ base.T)
        slack = SLACK * (d[:, :1].astype(np.float64) + to_pivots[:, 0] + 1)
        upper = (flat + (h[:, None] + height) ** 2 + slack).min(axis=1)
        row, column = np.nonzero(flat + (h[:, None] - height) ** 2 - slack <= upper[:, None])
        diff = part[row] - centroids[column]
        exact = np.full((len(part), len(centroids)), _LONG, dtype=np.int64)
        exact[row, column] = np.einsum("ij,ij->i", diff, diff)
        at = exact.argmin(axis=1)
        number[lo:lo + len(part)], least[lo:lo + len(part)] = at, exact[np.arange(len(part)), at]
        compared += len(row)
    return number, least, compared


def _with_distances(simplex: Simplex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = squared_distances(matrix(batch.column(1)), simplex.pivots)
            kept = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1]), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), kept], names=["vec_id", "x", "to_pivots"])
    return run


def _partial_sums(simplex: Simplex, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(centroids.shape, dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0))
            number, _, _ = nearest(x, matrix(batch.column(1)), simplex, centroids)
            order = np.argsort(number, kind="stable")
            present, first = np.unique(number[order], return_index=True)
            total[present] += np.add.reduceat(x[order], first, axis=0)
            count += np.bincount(number, minlength=len(centroids))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(total[used].tolist(), type=pa.list_(pa.int64()))],
            names=["cluster", "n", "totals"])
    return run


def _assigned(simplex: Simplex, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number, least, _ = nearest(matrix(batch.column(1)), matrix(batch.column(2)), simplex, centroids)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number), pa.array(least)], names=["vec_id", "cluster", "distance"])
    return run


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors of smallest SHA-256 of ``<salt>:<vec_id>``; equal ids by components."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "x").limit(k).select("x").collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def cluster(embeddings: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, salt: str = "2",
            id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part."""
    spark = embeddings.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    plain = (embeddings.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v")).where((F.size("v") == dim) & usable(F.col("v")))
             .select("vec_id", integers(F.col("v"), scale, LIMIT).alias("x")))
    centroids = first_centroids(plain, k, salt)
    if not len(centroids):
        return spark.createDataFrame([], _RESULT)
    simplex = build_simplex(centroids, pivots)
    table = materialize(plain.mapInArrow(_with_distances(simplex), "vec_id long, x array<long>, to_pivots array<long>"), "vectors")
    for _ in range(rounds):
        partials = table.select("x", "to_pivots").mapInArrow(_partial_sums(simplex, centroids), "cluster int, n long, totals array<long>")
        moved = exact_totals(partials, "cluster")
        centroids = np.array([[t // moved[c][0] for t in moved[c][1]] if c in moved else row.tolist() for c, row in enumerate(centroids)],
                             dtype=np.int64)
    out = materialize(table.mapInArrow(_assigned(simplex, centroids), "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = F.array(*[F.lit(min(sums.get(c, 0), _LONG)).cast("long") for c in range(len(centroids))])
    return out.select("vec_id", "cluster", "distance", F.get(inertia, F.col("cluster")).alias("cluster_inertia"),
                      F.lit(min(sum(sums.values()), _LONG)).cast("long").alias("inertia"),
                      F.get(F.array(*map(F.lit, digest)), F.col("cluster")).alias("centroid_sha256"))
