"""Hashed sparse text features, and bounded labelled samples, for the classifiers.

A text's features are its words, the shape of each white-space token (case,
digits, first and last byte, length class) and whether a token repeats the one
before, each hashed to ``2**BITS`` columns; values are the square roots of
relative frequencies, so every text with words has length about one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillbook.llm.textnp import Block, blocks, mix, words, segment_hashes

BITS = 16
KINDS = 3        # words, shapes, repeats: each weighs the same


class Sparse(NamedTuple):
    rows: int
    row: np.ndarray      # sorted
    column: np.ndarray
    value: np.ndarray

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Matrix product with one weight column, or with several."""
        if weights.ndim == 1:
            return np.bincount(self.row, weights=self.value * weights[self.column], minlength=self.rows)
        return np.stack([self.times(w) for w in weights.T], axis=1)

    def transposed_times(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights=self.value * per_row[self.row], minlength=1 << BITS)


def features(block: Block) -> Sparse:
    """The features of a block's rows."""
    data, found = block.data, words(block)
    rows = len(block.offsets) - 1
    if not len(found.starts):
        none = np.zeros(0, dtype=np.int64)
        return Sparse(rows, none, none, np.zeros(0))
    word = segment_hashes(data, found.starts, found.ends, lower=True)
    upper = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    length = found.ends - found.starts
    n_upper = np.add.reduceat(np.append(upper, False).astype(np.int32), np.stack([found.starts, found.ends], 1).ravel())[::2]
    n_digit = np.add.reduceat(np.append(digit, False).astype(np.int32), np.stack([found.starts, found.ends], 1).ravel())[::2]
    shape = (np.minimum(n_upper, 2) + 3 * (n_upper == length) + 6 * (n_digit > 0)).astype(np.uint64) * np.uint64(1 << 24)
    last = data[found.ends - 1].astype(np.uint64)
    first = data[found.starts].astype(np.uint64)
    shape += np.where(_LETTER[first], 0, first).astype(np.uint64) << np.uint64(16)
    shape += np.where(_LETTER[last], 0, last).astype(np.uint64) << np.uint64(8)
    shape += np.minimum(np.log2(length + 1) * 2, 20).astype(np.uint64)
    again = np.zeros(len(word), dtype=np.uint64)
    again[1:] = (word[1:] == word[:-1]) & (found.row[1:] == found.row[:-1])
    key = np.concatenate([mix(word), mix(shape + np.uint64(1 << 40)), mix(again + np.uint64(1 << 41))]) >> np.uint64(64 - BITS)
    row = np.tile(found.row, KINDS)
    cell, count = np.unique(row.astype(np.int64) << BITS | key.astype(np.int64), return_counts=True)
    row, column = cell >> BITS, cell & ((1 << BITS) - 1)
    total = np.bincount(found.row, minlength=rows) * KINDS
    return Sparse(rows, row, column, np.sqrt(count / total[row]))


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


def labelled_sample(docs: DataFrame, graded: DataFrame, limit: int) -> tuple[Sparse, np.ndarray, np.ndarray]:
    """Features and grades of at most ``limit`` labelled documents, on the driver.

    ``graded(doc_id, grade)``; the sample is that of the smallest hashes of
    the id, the same for any layout of the tables.  An id that repeats with one
    grade counts once, one that has different grades is left out.  Only ids go out to the
    tasks and only the sample's features come back: the text isn't shuffled.
    """
    picked = (graded.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id")
              .agg(F.min("grade").alias("grade"), F.max("grade").alias("most")).where("grade = most")
              .orderBy(F.xxhash64(F.col("doc_id"), F.lit(11)), "doc_id").limit(limit).collect())
    grade = {int(r["doc_id"]): int(r["grade"]) for r in picked}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(_sampled(grade), "doc_id long, columns array<int>, amounts array<float>").toArrow()
    ids, first = np.unique(rows.column("doc_id").to_numpy(), return_index=True)
    rows = rows.take(pa.array(first))
    sizes = np.array([len(x) for x in rows.column("columns")], dtype=np.int64)
    flat = lambda name: rows.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sparse = Sparse(len(ids), np.repeat(np.arange(len(ids)), sizes), flat("columns").astype(np.int64), flat("amounts").astype(np.float64))
    return sparse, np.array([grade[i] for i in ids.tolist()], dtype=np.int64), ids


def _sampled(grade: dict[int, int]):
    chosen = pa.array(sorted(grade), type=pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        for batch in batches:
            batch = batch.filter(pc.is_in(batch.column(0), value_set=chosen))
            for block in blocks(batch.column(1)):
                found = features(block)
                at = np.searchsorted(found.row, np.arange(found.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, found.rows),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(found.column.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(at), pa.array(found.value.astype(np.float32)))],
                    names=["doc_id", "columns", "amounts"])
    return run


def adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    """Plain full-batch Adam on one flat parameter vector."""
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(x)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        x -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return x
