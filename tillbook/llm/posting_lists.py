"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample by balanced hierarchical clustering:
a cluster with more than its share of the sample is split again, so lists are
of like size.  Every vector goes to its nearest centroid's list and, as a
boundary vector, to further lists whose centroid is nearly as near
(``CLOSURE``), unless a nearer chosen centroid already covers that direction.
Lists are found by best-first search in an in-memory neighbour graph, for a
block of vectors at once.  A query probes the lists whose centroid is at most
a ratio times as far as its nearest one, so a query in the midst of a cluster
reads few and one between many clusters reads many; the search goes on, twice
as broad each time, until it has left that range, and no number of lists caps
it.  The ratio is the least at which a sample of the queries, compared with all
vectors, finds ``TARGET`` of its true neighbours in the lists that the same
search selects; so it follows the table's size and structure.

Largest inner product becomes least distance: vectors are scaled to the unit
ball and get one more coordinate that makes all lengths one; a query gets 0.

Lists are cut into pieces of about ``CHUNK`` vectors by a hash of the row, and
pieces are dealt in turn to shards, so a list that holds a third of all vectors
stands in many of them.  A query goes once to each shard that holds a piece of
its lists, and each shard returns its best k; those are merged by rank.  The
scores are exact inner products of the original vectors in double precision.

The centroids (at most ``MAX_LISTS``) are all that goes to every task.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id or of another length than
the table's most frequent one; an id in several rows is found as often, each
row a candidate for the other; with fewer candidates than k all are returned,
and lists beyond the ratio are probed where those within hold too few; finite
components may be so large that a score is infinite, which ranks as such;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillbook.session import materialize

FIT_ROWS = 20_000
LIST_ROWS = 64          # vectors aimed at per list
MAX_LISTS = 4096
COPIES = 4              # lists a boundary vector stands in, at most
CLOSURE = 1.10          # distance ratio up to which it is replicated
TARGET = 0.95           # share of the sampled queries' neighbours that the probed lists hold
SAMPLED = 128           # queries compared with all vectors
BREADTH = 32            # lists a query's search looks for at first
CHUNK = 1024
SHARD_ROWS = 16_384
MIN_SHARDS = 32
SHARD_QUERIES = 32_768
QUERY_BLOCK = 512
DEGREE = 24
ROWS_AT_ONCE = 512
CELLS_AT_ONCE = 1 << 22 # numbers laid out at once in a task's search

_ASSIGNED = "vec_id long, row_key long, vector array<double>, lists array<int>"
_ASKED = "vec_id long, row_key long, vector array<double>, shard int, pieces array<int>"


class Pruning(NamedTuple):
    ratio: float            # lists up to so many times as far as the nearest are probed
    least: float            # a nearest list counts as no nearer than this


class Index(NamedTuple):
    scale: float            # length of the longest vector
    centroids: np.ndarray   # (lists, width + 1)
    graph: np.ndarray       # (lists, DEGREE) neighbours
    entry: np.ndarray       # where a search starts


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, row_key, vector array<double>`` of the rows that take part.

    ``row_key`` tells rows apart that repeat both id and vector; it holds for one stored copy of the result.
    """
    v = F.col("vector")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    return rows.select("vec_id", F.monotonically_increasing_id().alias("row_key"), "vector")


# -- fitting -------------------------------------------------------------------

def balanced_centroids(points: np.ndarray, lists: int, seed: int = 1) -> np.ndarray:
    """Split clusters, largest first, by 2-means until there are ``lists`` of like size."""
    rng = np.random.default_rng(seed)
    most = max(2, int(np.ceil(len(points) / max(lists, 1) * 1.5)))
    todo, done = [np.arange(len(points))], []
    while todo:
        part = todo.pop()
        if len(part) <= most or lists == 1:
            done.append(part)
            continue
        sides = _halve(points[part], rng)
        todo += [part[sides], part[~sides]]
    return np.stack([points[p].mean(axis=0) for p in done])


def _halve(points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two clusters; where one would hold over 4/5, cut at the median instead."""
    a, b = points[rng.choice(len(points), 2, replace=False)]
    for _ in range(6):
        lean = points @ (a - b) - (a @ a - b @ b) / 2
        side = lean > 0
        if not 0 < side.sum() < len(points):
            break
        a, b = points[side].mean(axis=0), points[~side].mean(axis=0)
    share = side.mean()
    if not 0.2 <= share <= 0.8:
        order = np.argsort(lean, kind="stable")
        side = np.zeros(len(points), dtype=bool)
        side[order[len(points) // 2:]] = True
    return side


def neighbour_graph(centroids: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Each centroid's near ones, thinned so that edges point in different directions."""
    n = len(centroids)
    near = np.empty((n, min(n, 3 * degree)), dtype=np.int64)
    norms = (centroids ** 2).sum(axis=1)
    for lo in range(0, n, 512):
        d = norms[None, :] - 2 * centroids[lo:lo + 512] @ centroids.T
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = -np.inf
        near[lo:lo + 512] = np.argsort(d, axis=1)[:, :near.shape[1]]
    graph = np.empty((n, min(degree, n)), dtype=np.int64)
    for i in range(n):
        others = near[i, 1:]
        to_i = ((centroids[others] - centroids[i]) ** 2).sum(axis=1)
        chosen: list[int] = []
        for o, d in zip(others.tolist(), to_i.tolist()):
            if len(chosen) == graph.shape[1] - 1:
                break
            if all(((centroids[o] - centroids[c]) ** 2).sum() > d for c in chosen[:12]):
                chosen.append(o)
        chosen += [o for o in others.tolist() if o not in chosen][:graph.shape[1] - len(chosen)]
        graph[i] = (chosen + [i] * graph.shape[1])[:graph.shape[1]]
    return graph


def build_index(rows: DataFrame) -> Index | None:
    """Fit centroids on at most ``FIT_ROWS`` vectors, those of the smallest hashes."""
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(_length("vector")).alias("longest"), F.mode(F.size("vector")).alias("width")).first()
    if not stats["n"]:
        return None
    sample = rows.where(F.size("vector") == stats["width"]).select("vector", F.xxhash64("vec_id", "vector", F.lit(5)).alias("h")).orderBy("h").limit(FIT_ROWS)
    points = lifted(np.array([r["vector"] for r in sample.collect()], dtype=np.float64), stats["longest"])
    lists = int(min(MAX_LISTS, max(1, stats["n"] // LIST_ROWS), max(1, len(points) // 4)))
    centroids = balanced_centroids(points, lists)
    first = np.unique(np.linspace(0, len(centroids) - 1, min(len(centroids), 32)).astype(np.int64))
    graph = neighbour_graph(centroids)
    return Index(float(stats["longest"]), centroids, graph, _entries(graph, first))


def _entries(graph: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``first``, and a centroid of every part of the graph that can't be reached from them."""
    reached, entry = np.zeros(len(graph), dtype=bool), []
    for i in [*first.tolist(), *range(len(graph))]:
        if reached[i] and i not in first:
            continue
        entry.append(i)
        reached[i], todo = True, np.array([i])
        while len(todo):
            todo = np.unique(graph[todo])
            todo = todo[~reached[todo]]
            reached[todo] = True
    return np.unique(entry)


def _length(vector: str) -> Column:
    """Euclidean length; where squares overflow or vanish, a bound of it."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    bound = F.array_max(F.transform(vector, F.abs)) * F.sqrt(F.size(vector))
    return F.when((length > 0) & (length < float("inf")), length).otherwise(F.least(bound, F.lit(float(np.finfo(np.float64).max))))


def lifted(vectors: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
    """Unit vectors whose distances order like inner products."""
    if query:
        x = vectors / np.abs(vectors).max(axis=1, keepdims=True)            # squares neither overflow nor vanish
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.concatenate([x, np.zeros((len(x), 1))], axis=1)
    x = vectors / longest
    return np.concatenate([x, np.sqrt(np.maximum(0.0, 1 - (x ** 2).sum(axis=1, keepdims=True)))], axis=1)


# -- search of centroids -----------------------------------------------------------

def nearest_centroids(index: Index, points: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first graph search; the nearest ``breadth`` of each point and their distances, infinite where fewer were reached."""
    breadth = min(breadth, len(index.centroids))
    opens = min(16, max(4, breadth // 16))
    step = max(1, CELLS_AT_ONCE // (opens * index.graph.shape[1] * points.shape[1] + breadth))
    parts = [_search_block(index, points[lo:lo + step], breadth, opens) for lo in range(0, max(len(points), 1), step)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _search_block(index: Index, points: np.ndarray, breadth: int, opens: int) -> tuple[np.ndarray, np.ndarray]:
    centroids, n = index.centroids, len(index.centroids)
    rows = np.arange(len(points))
    norms = (centroids ** 2).sum(axis=1)
    own = (points ** 2).sum(axis=1)

    def distance(of: np.ndarray) -> np.ndarray:
        d = norms[of] - 2 * np.einsum("ijk,ik->ij", centroids[of], points) + own[:, None]
        return np.sqrt(np.maximum(d, 0))

    seen = np.zeros((len(points), n), dtype=bool)
    pool = np.tile(index.entry, (len(points), 1))
    dist = distance(pool)
    seen[:, index.entry] = True
    if pool.shape[1] < breadth:
        gap = breadth - pool.shape[1]
        pool = np.concatenate([pool, np.zeros((len(points), gap), dtype=np.int64)], axis=1)
        dist = np.concatenate([dist, np.full((len(points), gap), np.inf)], axis=1)
    opened = np.zeros(pool.shape, dtype=bool)
    while True:
        waiting = np.where(opened, np.inf, dist)
        best = waiting.argsort(axis=1)[:, :opens]
        live = np.isfinite(np.take_along_axis(waiting, best, axis=1))
        if not live.any():
            break
        opened[rows[:, None], best] = True
        new = index.graph[np.take_along_axis(pool, best, axis=1)].reshape(len(points), -1)
        new_dist = distance(new)
        new_dist[np.repeat(~live, index.graph.shape[1], axis=1)] = np.inf
        new_dist[np.take_along_axis(seen, new, axis=1)] = np.inf
        order = np.sort(new, axis=1)                          # the same centroid from two edges
        if new.shape[1] > 1:
            by = np.argsort(new, axis=1, kind="stable")
            twice = np.zeros(new.shape, dtype=bool)
            np.put_along_axis(twice, by[:, 1:], order[:, 1:] == order[:, :-1], axis=1)
            new_dist[twice] = np.inf
        seen[rows[:, None], np.where(np.isfinite(new_dist), new, pool[:, :1])] = True
        pool = np.concatenate([pool, new], axis=1)
        dist = np.concatenate([dist, new_dist], axis=1)
        opened = np.concatenate([opened, np.zeros(new.shape, dtype=bool)], axis=1)
        keep = np.argsort(dist, axis=1, kind="stable")[:, :breadth]
        pool, dist, opened = (np.take_along_axis(x, keep, axis=1) for x in (pool, dist, opened))
    order = np.argsort(dist, axis=1, kind="stable")
    return np.take_along_axis(pool, order, axis=1), np.take_along_axis(dist, order, axis=1)


def _replicas(index: Index, points: np.ndarray) -> list[list[int]]:
    """Lists of each vector: the nearest, and near ones in other directions."""
    found, dist = nearest_centroids(index, points, 16)
    out = []
    for ids, d in zip(found.tolist(), dist.tolist()):
        chosen = [ids[0]]
        for i, x in zip(ids[1:], d[1:]):
            if len(chosen) == COPIES or x > CLOSURE * d[0] + 1e-12:
                break
            apart = ((index.centroids[chosen] - index.centroids[i]) ** 2).sum(axis=1)
            if (apart > (0.5 * x) ** 2).all():
                chosen.append(i)
        out.append(chosen)
    return out


def probed_lists(index: Index, points: np.ndarray, pruning: Pruning, sizes: np.ndarray | None = None,
                 need: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Lists to probe, as (row of the point, list) by point, nearest first.

    These are the lists within the ratio, and beyond it as many more as it
    takes for those before to hold ``need`` entries (``sizes``: of each list).
    """
    n = len(index.centroids)
    sizes = np.zeros(n, dtype=np.int64) if sizes is None else sizes
    of, lists = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    todo, breadth = np.arange(len(points)), min(BREADTH, n)
    while len(todo):
        found, dist = nearest_centroids(index, points[todo], breadth)
        far = pruning.ratio * np.maximum(dist[:, :1], pruning.least)
        reached = np.isfinite(dist)
        held = np.cumsum(np.where(reached, sizes[found], 0), axis=1)
        near = reached & ((dist <= far) | (held - sizes[found] < need))
        done = ~near[:, -1] | (breadth == n)
        at, place = np.nonzero(near & done[:, None])
        of.append(todo[at])
        lists.append(found[at, place])
        todo, breadth = todo[~done], min(n, 2 * breadth)
    of, lists = np.concatenate(of), np.concatenate(lists)
    order = np.argsort(of, kind="stable")
    return of[order], lists[order]


def _points(part: pa.RecordBatch, width: int) -> np.ndarray:
    return part.column(2).flatten().to_numpy().reshape(-1, width)


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``ROWS_AT_ONCE`` rows whose vectors are ``width`` long."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            part = part.filter(pa.array(np.diff(part.column(2).offsets.to_numpy()) == width))
            if part.num_rows:
                yield part


def _assigner(index: Index):
    width = index.centroids.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, width):
            lists = _replicas(index, lifted(_points(part, width), index.scale))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, type=pa.list_(pa.int32()))],
                                             names=["vec_id", "row_key", "vector", "lists"])
    return run


def _asker(index: Index, pruning: Pruning, sizes: np.ndarray, need: int, first: np.ndarray, shards: int):
    """Queries -> one row per shard that holds pieces of their lists; list i has pieces ``first[i]`` to ``first[i + 1]``."""
    width = index.centroids.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches, width):
            asked, lists = probed_lists(index, lifted(_points(part, width), index.scale, True), pruning, sizes, need)
            many = first[lists + 1] - first[lists]
            each = int(np.bincount(asked, many).max(initial=1))
            step = max(1, CELLS_AT_ONCE // max(each, 1))
            for lo in range(0, part.num_rows, step):
                some = slice(*np.searchsorted(asked, [lo, lo + step]))
                of, count = np.repeat(asked[some], many[some]), many[some]
                if not len(of):
                    continue
                pieces = np.repeat(first[lists[some]] - np.cumsum(count) + count, count) + np.arange(len(of))
                order = np.lexsort((pieces, pieces % shards, of))
                of, pieces = of[order], pieces[order]
                fresh = np.ones(len(of), dtype=bool)
                fresh[1:] = (of[1:] != of[:-1]) | (pieces[1:] % shards != pieces[:-1] % shards)
                at = np.flatnonzero(fresh)
                rows = part.select(["vec_id", "row_key", "vector"]).take(pa.array(of[at]))
                held = pa.ListArray.from_arrays(pa.array(np.append(at, len(of)).astype(np.int32)), pa.array(pieces.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array((pieces[at] % shards).astype(np.int32)), held],
                                                 names=["vec_id", "row_key", "vector", "shard", "pieces"])
    return run


# -- ratio ---------------------------------------------------------------------

def _scanner(queries: np.ndarray, keys: np.ndarray, k: int):
    """Assigned rows -> the best k of a task's rows for each query, with their lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, lists = np.zeros((len(queries), 0)), np.zeros((len(queries), 0), dtype=object)
        for part in _parts(batches, queries.shape[1]):
            new = queries @ _points(part, queries.shape[1]).T
            new[keys[:, None] == part.column(1).to_numpy()[None, :]] = -np.inf
            held = np.empty(part.num_rows, dtype=object)
            held[:] = part.column(3).to_pylist()
            score = np.concatenate([score, new], axis=1)
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            lists = np.take_along_axis(np.concatenate([lists, np.tile(held, (len(queries), 1))], axis=1), top, axis=1)
            score = np.take_along_axis(score, top, axis=1)
        q, at = np.nonzero(np.isfinite(score))
        if len(q):
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(score[q, at]),
                                              pa.array(list(lists[q, at]), type=pa.list_(pa.int32()))], names=["q", "score", "lists"])
    return run


def learned_pruning(index: Index, assigned: DataFrame, asking: DataFrame, k: int, target: float = TARGET) -> Pruning:
    """The least ratio at which sampled queries find ``target`` of their true neighbours, by a scan of all vectors.

    Distances to all centroids propose ratios; the graph search that all
    queries go through decides which is enough.
    """
    width = index.centroids.shape[1] - 1
    sample = asking.where(F.size("vector") == width).orderBy(F.xxhash64("vec_id", "vector", F.lit(9))).limit(SAMPLED).collect()
    if not sample:
        return Pruning(1.0, 1.0)
    queries = np.array([r["vector"] for r in sample], dtype=np.float64)
    best = assigned.mapInArrow(_scanner(queries, np.array([r["row_key"] for r in sample]), k), "q int, score double, lists array<int>")
    best = best.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score")))).where(F.col("r") <= k).collect()
    points = lifted(queries, index.scale, True)
    nearest = nearest_centroids(index, points, BREADTH)[1][:, 0]
    least = float(nearest.mean())
    if not best or least == 0:
        return Pruning(np.inf if best else 1.0, 1.0)
    nearest = np.maximum(nearest, least)
    away = np.stack([np.sqrt(((index.centroids - p) ** 2).sum(axis=1)) for p in points]) / nearest[:, None]
    ratios = np.sort([away[r["q"], r["lists"]].min() for r in best])
    missed = 1 - target
    while True:
        at = min(len(ratios), int(np.ceil((1 - missed) * len(ratios)))) - 1
        pruning = Pruning(float(ratios[at]) * (1 + 1e-9), least)
        there = np.zeros(away.shape, dtype=bool)
        there[probed_lists(index, points, pruning)] = True
        if at == len(ratios) - 1 or np.mean([there[r["q"], r["lists"]].any() for r in best]) >= target:
            return pruning
        missed *= 0.85


# -- search of lists ---------------------------------------------------------------

def _best_of_shard(k: int):
    def run(key: tuple, members: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(members) and len(asking):
            members = members.sort_values(["piece", "vec_id", "row_key"])
            ids, keys, piece = (members[c].to_numpy() for c in ("vec_id", "row_key", "piece"))
            vectors = np.stack(members["vector"].to_numpy())
            pieces, at = np.unique(piece, return_index=True)
            ends = np.append(at[1:], len(piece))
            for lo in range(0, len(asking), QUERY_BLOCK):
                parts += _best_of_block(asking.iloc[lo:lo + QUERY_BLOCK], ids, keys, vectors, pieces, at, ends, k)
        return pd.concat(parts) if parts else pd.DataFrame({"query_id": [], "query_key": [], "vec_id": [], "row_key": [], "score": []})
    return run


def _best_of_block(some: pd.DataFrame, ids, keys, vectors, pieces, at, ends, k: int) -> list[pd.DataFrame]:
    """The best k distinct rows of each query among the pieces it probes; rows stand by piece, then id."""
    q_ids, q_keys = some["vec_id"].to_numpy(), some["row_key"].to_numpy()
    asked = np.stack(some["vector"].to_numpy())
    counts = some["pieces"].map(len).to_numpy()
    query = np.repeat(np.arange(len(some)), counts)
    wanted = np.concatenate(some["pieces"].to_list())
    order = np.argsort(wanted, kind="stable")
    query, wanted = query[order], wanted[order]
    of, row, score = [], [], []
    for p, lo, hi in zip(pieces, at, ends):
        who = query[np.searchsorted(wanted, p):np.searchsorted(wanted, p, side="right")]
        if not len(who):
            continue
        own = (q_ids[who][:, None] == ids[None, lo:hi]) & (q_keys[who][:, None] == keys[None, lo:hi])
        near, place, value = best_pairs(asked[who], vectors[lo:hi], own, k)
        of.append(who[near])
        row.append(place + lo)
        score.append(value)
    if not of:
        return []
    of, row, score = (np.concatenate(x) for x in (of, row, score))
    order = np.lexsort((keys[row], ids[row], -score, of))        # copies of a row in several lists come together
    of, row, score = of[order], row[order], score[order]
    fresh = np.ones(len(of), dtype=bool)
    fresh[1:] = (of[1:] != of[:-1]) | (ids[row[1:]] != ids[row[:-1]]) | (keys[row[1:]] != keys[row[:-1]])
    of, row, score = of[fresh], row[fresh], score[fresh]
    nth = np.arange(len(of)) - np.searchsorted(of, of)
    of, row, score = of[nth < k], row[nth < k], score[nth < k]
    return [pd.DataFrame({"query_id": q_ids[of], "query_key": q_keys[of], "vec_id": ids[row], "row_key": keys[row], "score": score})]


def best_pairs(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``k`` vectors of each query, ties to the earlier, as pairs with their scores; none of those marked ``own``.

    A matrix product leaves those within its rounding error of the k-th; their
    scores are double-precision sums in component order, so that a pair has the
    same score in any group.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        rough = queries @ vectors.T
        kept = ~own
        if np.isfinite(rough).all() and len(vectors) > k:
            rough[own] = -np.inf
            error = 2 * queries.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max()
            kept &= rough >= (np.partition(rough, len(vectors) - k, axis=1)[:, len(vectors) - k] - 2 * error)[:, None]
        query, place = np.nonzero(kept)
        score = np.zeros(len(query))
        for q, v in zip(queries.T, vectors.T):
            score += q[query] * v[place]
    score = np.fmax(score, -np.inf)                                         # infinite terms of both signs rank last
    order = np.lexsort((place, -score, query))
    best = order[np.arange(len(order)) - np.searchsorted(query[order], query[order]) < k]
    return query[best], place[best], score[best]


def search(table: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row for which ``queries`` (on ``vec_id``) holds."""
    spark = table.sparkSession
    rows = materialize(valid_vectors(table, id_col, vector_col), "vectors")
    index = build_index(rows)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    assigned = materialize(rows.mapInArrow(_assigner(index), _ASSIGNED), "lists")
    asking = rows.where(queries)
    pruning = learned_pruning(index, assigned, asking, k)
    lists = assigned.select("vec_id", "row_key", "vector", F.explode("lists").alias("list"))
    sizes = np.zeros(len(index.centroids), dtype=np.int64)             # at most MAX_LISTS
    for r in lists.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    chunks = -(-sizes // CHUNK)
    first = np.concatenate([[0], np.cumsum(chunks)])
    shards = max(MIN_SHARDS, -(-int(sizes.sum()) // SHARD_ROWS))
    blocks = F.lit(max(1, -(-asking.count() // SHARD_QUERIES)))        # a group holds a bounded number of queries
    starts = spark.createDataFrame([(i, int(first[i]), int(chunks[i])) for i in range(len(chunks))], "list int, first int, chunks int")
    members = lists.join(F.broadcast(starts), "list").select(
        "vec_id", "row_key", "vector", (F.col("first") + F.pmod(F.xxhash64("row_key", F.lit(1)), F.col("chunks"))).cast("int").alias("piece"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")).withColumn("shard", F.col("piece") % F.lit(shards))
    asked = asking.mapInArrow(_asker(index, pruning, sizes, COPIES * (k + 1), first, shards), _ASKED).withColumn(
        "block", F.pmod(F.xxhash64("row_key", F.lit(2)), blocks).cast("int"))
    found = members.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        _best_of_shard(k), "query_id long, query_key long, vec_id long, row_key long, score double")
    once = found.dropDuplicates(["query_id", "query_key", "vec_id", "row_key"])
    rank = F.row_number().over(W.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id", "row_key"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
