"""Embeddings as exact integer vectors, and sums of them, for the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """Neither null nor with null or non-finite components."""
    odd = F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    return vector.isNotNull() & ~odd


def integers(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * component) of every component; products beyond ``limit`` either way count as ``limit``."""
    scaled = lambda e: F.greatest(F.least(e * F.lit(float(scale)), F.lit(float(limit))), F.lit(float(-limit)))
    return F.transform(vector, lambda e: F.floor(scaled(e)).cast("long"))


def matrix(column: pa.Array, kind=np.int64) -> np.ndarray:
    """A batch's list column, all lists of one length, as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype=kind)


def exact_totals(partials: DataFrame, key: str, n_col: str = "n", values: str = "totals") -> dict[int, tuple[int, list[int]]]:
    """``key -> (n, componentwise totals)`` of partial sums, exact; as many numbers as one partial table has."""
    long = partials.select(key, n_col, F.posexplode(values).alias("pos", "value"))
    rows = (long.groupBy(key, "pos").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.sum(n_col).alias("n"))
            .orderBy(key, "pos").collect())
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r[key], (int(r["n"]), []))[1].append(int(r["total"]))
    return out
