"""Document quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w . x): one weight vector over hashed
text features shared by all grades, and ordered thresholds.  Per document it
gives the expected grade and the tail probability P(grade >= select), by which
documents are kept.

The grades of the query come from ``labels``: 0 junk (quality 0), 1 readable
but toxic, 2 readable and clean.  The model is fitted on a documented, bounded
sample of labelled rows (``FIT_ROWS``) whose crc32(doc_id) mod 5 is not 0, so
the rest can measure it; every document is scored.

Defined results: null and wordless texts have no features and get the scores
of the thresholds alone; null ids are scored too; without labelled rows, or
with one grade only, every document gets that grade (or 0) for certain; labels
that repeat an id with one grade count once, those that give it different
grades are left out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillbook.llm.hashed_text import BITS, adam, features, labelled_sample
from tillbook.llm.textnp import blocks

FIT_ROWS = 6000
STEPS = 150
RATE = 0.15
PENALTY = 1e-5
KEEP_TAIL = 0.5


class OrdinalModel(NamedTuple):
    weights: np.ndarray        # 2**BITS
    thresholds: np.ndarray     # ordered, one fewer than grades

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k + 1) for each threshold k."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _ordered(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def fit(x, grade: np.ndarray, n_grades: int) -> OrdinalModel:
    """Penalised maximum likelihood; grades 0 to n_grades - 1."""
    present = np.unique(grade)
    if len(present) < 2:
        sure = int(present[0]) if len(present) else 0
        return OrdinalModel(np.zeros(1 << BITS), np.array([-40.0 if k < sure else 40.0 for k in range(n_grades - 1)]))
    size, n = 1 << BITS, len(grade)
    share = np.clip(np.array([(grade <= k).mean() for k in range(n_grades - 1)]), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    raw = np.concatenate([[start[0]], np.log(np.maximum(np.diff(start), 1e-2))])

    def gradient(p: np.ndarray) -> np.ndarray:
        cut = _ordered(p[size:])
        score = x.times(p[:size])
        below = _sigmoid(np.concatenate([np.full((n, 1), -40.0), cut[None, :] - score[:, None], np.full((n, 1), 40.0)], axis=1))
        high, low = below[np.arange(n), grade + 1], below[np.arange(n), grade]
        mass = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / mass, low * (1 - low) / mass
        g_score = (d_high - d_low) / n                     # of the negative log likelihood
        g_cut = np.zeros(n_grades - 1)
        for k in range(n_grades - 1):
            g_cut[k] = (d_low[grade == k + 1].sum() - d_high[grade == k].sum()) / n
        g_raw = np.cumsum(g_cut[::-1])[::-1].copy()
        g_raw[1:] *= np.exp(p[size + 1:])
        return np.concatenate([x.transposed_times(g_score) + PENALTY * p[:size], g_raw])

    found = adam(gradient, np.concatenate([np.zeros(size), raw]), STEPS, RATE)
    return OrdinalModel(found[:size], _ordered(found[size:]))


def grades_from_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)``: 0 junk, 1 readable but toxic, 2 readable and clean."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1)
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_on(docs: DataFrame, graded: DataFrame, n_grades: int = 3, rows: int = FIT_ROWS) -> OrdinalModel:
    x, grade, _ = labelled_sample(docs, graded.where(~held_out(F.col("doc_id"))), rows)
    return fit(x, grade, n_grades)


def score_quality(docs: DataFrame, model: OrdinalModel, select: int = 2, keep_tail: float = KEEP_TAIL) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, keep`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                found = features(block)
                tail = model.at_least(found.times(model.weights))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, found.rows), pa.array(tail.sum(axis=1)), pa.array(tail[:, select - 1]),
                     pa.array(tail[:, select - 1] >= keep_tail)],
                    names=["doc_id", "expected_grade", "tail_probability", "keep"])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, keep boolean")
