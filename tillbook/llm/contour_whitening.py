"""Embedding whitening; principal components by FEAST contour integration.

Spark does the work on all vectors: exact integer sums and products of the
scaled vectors, centred to the nearest integer mean before they are
multiplied, so that the covariance comes out as correctly rounded quotients of
whole numbers, alike for any partitioning.  What reaches the driver is one
number per pair of dimensions.

There the leading eigenvectors come from contour integrals.  Inertia counts
(signs of a symmetric factorisation of the shifted covariance) bisect a bound
with at least ``k`` eigenvalues above it.  The resolvent of the covariance is
integrated along a circle around that interval by Gauss-Legendre quadrature: a
few complex shifted solves applied to a block of trial vectors, which leaves of
them what lies in the wanted eigenspace.  Rayleigh-Ritz in that subspace gives
eigenpairs, which are the next trial vectors until their residuals vanish, and
the number found must equal the inertia count, so that none is missed.

Defined results: vectors that are null, empty or hold null or non-finite
entries take no part, nor do those whose length isn't the most frequent one
(ties: the greater); entries beyond ``LIMIT`` after scaling count as ``LIMIT``;
``deviation`` is null where it exceeds a long; rows that repeat an id are rows
of their own and null ids pass through; directions without variance (up to
``RANK`` of the trace) are no components, so a table of equal vectors, or an
empty one, gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillbook.llm.integer_vectors import exact_totals, integers, matrix, usable
from tillbook.session import materialize

LIMIT = 1 << 31
RANK = 1e-10            # least eigenvalue that counts, as a share of the trace
NODES = 16              # quadrature points on the half circle
RESIDUAL = 1e-14        # of an eigenpair, relative to the largest eigenvalue
MAX_ROUNDS = 60
MOVES = 10
BLOCK_ROWS = 2048
_LONG = (1 << 63) - 1
_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# -- eigenpairs ----------------------------------------------------------------

def eigenvalues_above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues exceed ``shift``: positive signs of a factorisation with complete pivoting (Bunch and Parlett)."""
    m = a - shift * np.eye(len(a))
    positive = 0
    while len(m):
        size = np.abs(m)
        p = int(np.argmax(size.diagonal()))
        r, s = np.unravel_index(int(np.argmax(size)), size.shape)
        if size[r, s] == 0:
            break                                       # only zeros are left
        if size[p, p] >= 0.6404 * size[r, s]:
            pivot = [p]
            positive += m[p, p] > 0
        else:
            pivot = [int(r), int(s)]                    # an indefinite pair: one sign each
            positive += 1
        rest = [i for i in range(len(m)) if i not in pivot]
        block, side = m[np.ix_(pivot, pivot)], m[np.ix_(rest, pivot)]
        m = m[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        m = (m + m.T) / 2
    return int(positive)


def contour_projection(a: np.ndarray, lo: float, hi: float, trial: np.ndarray, nodes: int = NODES) -> np.ndarray:
    """The trial vectors' part in the eigenspace of (lo, hi), by quadrature of the resolvent on a circle through both ends."""
    at, weight = np.polynomial.legendre.leggauss(nodes)
    middle, radius = (lo + hi) / 2, (hi - lo) / 2
    out = np.zeros_like(trial)
    for x, w in zip(at, weight):
        turn = radius * np.exp(1j * np.pi * (1 + x) / 2)            # the lower half circle gives the conjugate
        out += w / 2 * (turn * np.linalg.solve((middle + turn) * np.eye(len(a)) - a, trial.astype(complex))).real
    return out


def feast(a: np.ndarray, lo: float, hi: float, expected: int, scale: float, seed: int = 13) -> tuple[np.ndarray, np.ndarray] | None:
    """All eigenpairs with values in (lo, hi), falling, or None if not as many as expected converge; ``scale``: the largest eigenvalue."""
    size = min(len(a), expected + max(8, expected // 2))
    trial = np.random.default_rng(seed).normal(size=(len(a), size))
    for _ in range(MAX_ROUNDS):
        q, _ = np.linalg.qr(contour_projection(a, lo, hi, trial))
        small = q.T @ a @ q
        values, turn = np.linalg.eigh((small + small.T) / 2)
        vectors = q @ turn
        residual = np.linalg.norm(a @ vectors - vectors * values, axis=0)
        inside = (values > lo) & (values < hi) & (residual <= RESIDUAL * scale * max(1.0, np.sqrt(len(a)) / 8))
        if inside.sum() == expected:
            order = np.argsort(-values[inside], kind="stable")
            return values[inside][order], vectors[:, inside][:, order]
        trial = vectors
    return None


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues above ``RANK`` of the trace, falling, and their unit eigenvectors as columns.

    The spectrum is taken from above in intervals that end at a quarter of
    where they begin, or sooner where more eigenvalues crowd than are wanted.
    """
    trace = float(np.trace(a))
    wanted = min(k, eigenvalues_above(a / trace, RANK)) if trace > 0 else 0
    if not wanted:
        return np.zeros(0), np.zeros((len(a), 0))
    a = a / trace
    low, high = 0.0, float(np.abs(a).sum(axis=1).max()) * (1 + 1e-9)
    while high - low > 0.02 * high:                     # until the greatest eigenvalue lies just below ``high``
        middle = (low + high) / 2
        low, high = (middle, high) if eigenvalues_above(a, middle) else (low, middle)
    top = high = 1.02 * high
    values, vectors = np.zeros(0), np.zeros((len(a), 0))
    while len(values) < wanted and high > RANK:
        done, need = len(values), wanted - len(values)
        low, above = max(RANK, high / 4), high          # enough eigenvalues beyond the one, too few beyond the other
        count = eigenvalues_above(a, low) - done
        while count > need + 4 and above - low > 1e-12 * top:
            middle = (low + above) / 2
            some = eigenvalues_above(a, middle) - done
            low, above, count = (middle, above, some) if some >= need else (low, middle, count)
        found = feast(a, low, high, count, top) if count else (np.zeros(0), np.zeros((len(a), 0)))
        for _ in range(MOVES):
            if found is not None:
                break
            low = max(RANK / 2, low - 0.03 * (high - low))          # the bound may touch an eigenvalue
            count = eigenvalues_above(a, low) - done
            found = feast(a, low, high, count, top)
        if found is None:
            raise ArithmeticError(f"{count} eigenvalues lie between {low * trace} and {high * trace}, but not as many converge")
        values, vectors, high = np.append(values, found[0]), np.hstack([vectors, found[1]]), low
    q, _ = np.linalg.qr(vectors)
    small = q.T @ a @ q
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return values[::-1][:wanted] * trace, (q @ turn)[:, ::-1][:, :wanted]


# -- sums over all vectors -------------------------------------------------------

def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of x, in Python integers where they could pass a long."""
    total, n = None, 0
    for batch in batches:
        if batch.num_rows:
            part = matrix(batch.column(0)).sum(axis=0)              # at most 2**31 by 2**16 rows of a batch
            total = part.astype(object) if total is None else total + part
            n += batch.num_rows
    if n:
        yield _partial([0], [n], [total.tolist()])


def _partial(keys: list[int], n: list[int], totals: list) -> pa.RecordBatch:
    from decimal import Decimal
    kind = pa.list_(pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(n, pa.int64()),
                                       pa.array([[Decimal(int(v)) for v in row] for row in totals], type=kind)], names=["row", "n", "totals"])


def exact_products(y: np.ndarray) -> np.ndarray:
    """Sum of outer products of the rows, exact, as Python integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top * len(y) < 1 << 53:                                # products of floats are exact
        return np.rint(y.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64).astype(object)
    high, low = y >> 17, y & 0x1FFFF                                # |high| < 2**16: sums of 2,048 products stay below 2**53
    part = lambda p, q: np.rint(p.astype(np.float64).T @ q.astype(np.float64)).astype(np.int64).astype(object)
    cross = part(high, low)
    return part(high, high) * (1 << 34) + (cross + cross.T) * (1 << 17) + part(low, low)


def _products(centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            x = matrix(batch.column(0))
            for lo in range(0, len(x), BLOCK_ROWS):
                part = exact_products(x[lo:lo + BLOCK_ROWS] - centre)
                total = part if total is None else total + part
            n += len(x)
        if n:
            yield _partial(list(range(len(centre))), [n] * len(centre), total.tolist())
    return run


class Whitening(NamedTuple):
    n: int
    centre: np.ndarray      # integers next to the means
    rest: np.ndarray        # n * mean - n * centre, integers as Python objects
    values: np.ndarray      # variances along the components, falling
    vectors: np.ndarray     # unit eigenvectors as columns
    trace: float


def scaled_vectors(embeddings: DataFrame, scale: int = 1024, offset: int = 100_000, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the vectors that take part, written once."""
    v = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where(usable(F.col("v")) & (F.size("v") > 0))
    lengths = v.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    v = v.where(F.size("v") == (lengths[0]["length"] if lengths else 0))
    x = F.transform(integers(F.col("v"), scale, LIMIT), lambda e: e + F.lit(offset).cast("long"))
    return materialize(v.select("vec_id", x.alias("x")), "scaled")


def fit(table: DataFrame, k: int = 8) -> Whitening | None:
    """The whitening of a table of integer vectors, or None if it is empty."""
    x, kind = table.select("x"), "row int, n long, totals array<decimal(38,0)>"
    sums = exact_totals(x.mapInArrow(_sums, kind), "row")
    if not sums:
        return None
    n, total = sums[0]
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = np.array([s - n * c for s, c in zip(total, centre)], dtype=object)
    centre = np.array(centre, dtype=np.int64)
    found = exact_totals(x.mapInArrow(_products(centre), kind), "row")
    products = np.array([found[i][1] for i in range(len(centre))], dtype=object)
    covariance = np.array([[(n * int(p) - int(rest[i]) * int(rest[j])) / (n * n) for j, p in enumerate(row)]
                           for i, row in enumerate(products)], dtype=np.float64)
    values, vectors = leading_components(covariance, k)
    return Whitening(n, centre, rest, values, vectors, float(np.trace(covariance)))


def _projected(w: Whitening):
    mean_rest = np.array([int(r) / w.n for r in w.rest])
    to_components = w.vectors / np.sqrt(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            y = x - w.centre
            white = (y - mean_rest) @ to_components
            if (w.n * (int(np.abs(y).max()) + 1)) ** 2 * len(w.centre) <= _LONG:
                far = w.n * y - w.rest.astype(np.int64)
                deviation = np.einsum("ij,ij->i", far, far).tolist()
            else:
                deviation = [v if v <= _LONG else None for v in ((w.n * y.astype(object) - w.rest) ** 2).sum(axis=1).tolist()]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, type=pa.int64()), lists], names=["vec_id", "deviation", "w"])
    return run


def identity_error(rows: DataFrame, k: int) -> float:
    """Largest entry of the covariance of ``w`` (its ``k`` components) minus the identity."""
    of = lambda i: F.get("w", F.lit(i))
    means = rows.agg(*[F.avg(of(i)).alias(f"m{i}") for i in range(k)]).first()
    centred = rows.select(*[(of(i) - F.lit(float(means[i]))).alias(f"c{i}") for i in range(k)])
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    found = centred.agg(*[F.avg(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"v{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"v{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(embeddings: DataFrame, k: int = 8, scale: int = 1024, offset: int = 100_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component."""
    table = scaled_vectors(embeddings, scale, offset, id_col, vector_col)
    w = fit(table, k)
    if w is None or not len(w.values):
        return embeddings.sparkSession.createDataFrame([], _RESULT)
    rows = materialize(table.mapInArrow(_projected(w), "vec_id long, deviation long, w array<double>"), "whitened")
    explained = F.array(*[F.lit(float(e / w.trace)) for e in w.values])
    error = identity_error(rows, len(w.values))
    return rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
