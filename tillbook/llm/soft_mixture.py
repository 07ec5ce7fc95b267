"""Mixing sources to target weights by soft domain membership.

A softmax classifier over hashed text features, fitted on the labelled table,
gives every document a posterior over domains.  Then nonnegative rates r are
sought, near 1, whose expected domain token totals

    T_d(r) = sum_i r_i * n_i * p_id

match targets: projected gradient on the least-squares objective
(T(r) - target)' M^-1 (T(r) - target) / 2 in the metric of the token counts,
with M = sum_i n_i p_i p_i'.  One step is r_i <- max(0, r_i - p_i . M^-1 (T - target)),
so each round is one map and one small distributed sum; only T (one number a
domain) reaches the driver.  A document is then repeated floor(r) times, once
more with the probability of the fraction (by a hash of its id and text).

``targets`` are shares of the corpus' own number of tokens, which stays.  With
``keep`` instead, each domain is to keep a share of what its documents have,
nothing is repeated for it, and documents that more likely than not belong to
the domain ``fixed`` stay exactly once: no document of that domain is thinned
or copied to make up for others.  Domains of the query come from ``labels``:
clean prose, toxic prose, junk.

Defined results: null and empty texts have no tokens, rate 1 and stay once;
null ids are handled like others; targets of domains without any tokens can't
be met and are approached as far as rates allow; labels that give an id
different domains are left out; without labelled rows all posteriors are
equal, and with ``keep`` every row then stays once; empty tables give empty results; other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillbook.llm.hashed_text import BITS, Sparse, adam, features, labelled_sample
from tillbook.llm.textnp import blocks, words
from tillbook.session import materialize

FIT_ROWS = 6000
STEPS = 120
RATE = 0.15
PENALTY = 1e-5
ROUNDS = 40
TOLERANCE = 1e-3
DOMAINS = ("clean", "toxic", "junk")
TARGETS = (0.90, 0.04, 0.06)
FIXED = 0.5             # posterior from which a document belongs to the fixed domain


def fit_domains(x: Sparse, domain: np.ndarray, n_domains: int) -> np.ndarray:
    """Softmax regression: weights (2**BITS + 1, n_domains), the last row the biases."""
    size = 1 << BITS
    if not len(domain):
        return np.zeros((size + 1, n_domains))
    share = np.maximum(np.bincount(domain, minlength=n_domains) / len(domain), 1e-4)
    wanted = np.eye(n_domains)[domain]

    def gradient(flat: np.ndarray) -> np.ndarray:
        w = flat.reshape(size + 1, n_domains)
        off = (softmax(x.times(w[:-1]) + w[-1]) - wanted) / len(domain)
        return np.concatenate([np.stack([x.transposed_times(off[:, d]) for d in range(n_domains)], axis=1) + PENALTY * w[:-1],
                               off.sum(axis=0)[None, :]]).ravel()
    start = np.zeros((size + 1, n_domains))
    start[-1] = np.log(share)
    return adam(gradient, start.ravel(), STEPS, RATE).reshape(size + 1, n_domains)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def domains_from_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)`` with the number of the domain in ``DOMAINS``."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.when(F.col("quality") == 0, 2).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 0).alias("grade"))


def _members(block, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token counts and posteriors of a block's rows."""
    found = features(block)
    return np.bincount(words(block).row, minlength=found.rows), softmax(found.times(weights[:-1]) + weights[-1])


def posteriors(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``n_tokens, p array<double>`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                tokens, p = _members(block, weights)
                yield pa.RecordBatch.from_arrays([pa.array(tokens), _lists(p)], names=["n_tokens", "p"])
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "n_tokens long, p array<double>")


def _lists(p: np.ndarray) -> pa.Array:
    n, d = p.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(p.ravel()))


def _totals(state: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """T(r), M over the rows that may move, the fixed rows' part of T, and the number of tokens."""
    p = [F.get("p", F.lit(d)) for d in range(n)]
    tokens, moving = F.col("n_tokens"), F.when(F.col("moves"), F.col("n_tokens")).otherwise(0)
    row = state.agg(*[F.sum(F.col("rate") * tokens * p[d]).alias(f"t{d}") for d in range(n)],
                    *[F.sum((tokens - moving) * p[d]).alias(f"f{d}") for d in range(n)],
                    *[F.sum(moving * p[a] * p[b]).alias(f"m{a}_{b}") for a in range(n) for b in range(a, n)],
                    F.sum(tokens).alias("tokens")).first()
    m = np.array([[row[f"m{min(a, b)}_{max(a, b)}"] or 0.0 for b in range(n)] for a in range(n)])
    of = lambda letter: np.array([row[f"{letter}{d}"] or 0.0 for d in range(n)])
    return of("t"), m, of("f"), float(row["tokens"] or 0)


def fit_rates(members: DataFrame, targets: Sequence[float], rounds: int = ROUNDS, keep: Sequence[float] | None = None,
              fixed: int | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The gradient steps (one number a domain each) and the relative residual of each round."""
    n = len(targets if keep is None else keep)
    moves = F.lit(True) if fixed is None else F.get("p", F.lit(fixed)) < FIXED
    state = materialize(members.withColumns({"rate": F.lit(1.0), "moves": moves}), "rates")
    steps: list[np.ndarray] = []
    history: list[np.ndarray] = []
    total, m, still, tokens = _totals(state, n)
    if tokens == 0:
        return steps, history
    wanted = still + m @ np.asarray(keep, dtype=float) if keep is not None else np.asarray(targets, dtype=float) / sum(targets) * tokens
    inverse = np.linalg.pinv(m + np.eye(n) * 1e-6 * np.trace(m) / n)
    done = 0
    for _ in range(rounds):
        history.append((total - wanted) / tokens)
        if np.abs(history[-1]).max() < TOLERANCE:
            break
        steps.append(inverse @ (total - wanted))
        if len(steps) - done == 8:                      # keep the expression short
            state, done = materialize(state.withColumn("rate", _rate(steps[done:])), "rates"), len(steps)
        total, *_ = _totals(state.withColumn("rate", _rate(steps[done:])) if done < len(steps) else state, n)
    return steps, history


def _rate(steps: list[np.ndarray]) -> Column:
    rate = F.col("rate")
    for step in steps:
        move = sum((F.get("p", F.lit(d)) * float(v) for d, v in enumerate(step)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - move)
    return F.when(F.col("moves"), rate).otherwise(F.col("rate"))


def rates(tokens: np.ndarray, p: np.ndarray, steps: list[np.ndarray], fixed: int | None = None) -> np.ndarray:
    """All steps applied to each document; one without tokens, or of the fixed domain, keeps rate 1."""
    rate = np.ones(len(p))
    for step in steps:
        rate = np.maximum(0.0, rate - p @ step)
    moves = tokens > 0 if fixed is None else (tokens > 0) & (p[:, fixed] < FIXED)
    return np.where(moves, rate, 1.0)


def _copies(rate: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """How often a document is repeated: a whole number whose mean is the rate."""
    whole = np.floor(rate)
    return (whole + (chance < rate - whole)).astype(np.int32)


def _chance() -> Column:
    return F.pmod(F.xxhash64("doc_id", "text", F.lit(29)), F.lit(1 << 40)) / F.lit(float(1 << 40))


class Mixture(NamedTuple):
    weights: np.ndarray
    steps: list[np.ndarray]
    history: list[np.ndarray]
    fixed: int | None = None


def fit_mixture(docs: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS, rows: int = FIT_ROWS,
                keep: Sequence[float] | None = None, fixed: int | None = None) -> Mixture:
    x, domain, _ = labelled_sample(docs, domains_from_labels(labels), rows)
    weights = fit_domains(x, domain, len(targets if keep is None else keep))
    if keep is not None and not len(domain):
        return Mixture(weights, [], [], fixed)              # nothing is known of any document, so all stay
    return Mixture(weights, *fit_rates(posteriors(docs, weights), targets, keep=keep, fixed=fixed), fixed)


def rated(docs: DataFrame, fitted: Mixture) -> DataFrame:
    """``doc_id, n_tokens, p, rate, copies`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                tokens, p = _members(block, fitted.weights)
                rate = rates(tokens, p, fitted.steps, fitted.fixed)
                chance = batch.column(2).slice(block.first, len(p)).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, len(p)), pa.array(tokens), _lists(p), pa.array(rate), pa.array(_copies(rate, chance))],
                    names=["doc_id", "n_tokens", "p", "rate", "copies"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _chance().alias("chance"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, p array<double>, rate double, copies int")


def mix(docs: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS, keep: Sequence[float] | None = None,
        fixed: int | None = None) -> DataFrame:
    """``docs`` with every row as often as its rate asks; columns unchanged.

    Rates are recomputed where the rows are, so no text is shuffled.
    """
    fitted = fit_mixture(docs, labels, targets, keep=keep, fixed=fixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns
            for block in blocks(batch.column(n - 2)):
                tokens, p = _members(block, fitted.weights)
                chance = batch.column(n - 1).slice(block.first, len(p)).to_numpy(zero_copy_only=False)
                times = _copies(rates(tokens, p, fitted.steps, fitted.fixed), chance)
                rows = pa.array(np.repeat(np.arange(block.first, block.first + len(p)), times))
                yield pa.RecordBatch.from_arrays([batch.column(k).take(rows) for k in range(n - 2)], names=batch.schema.names[:n - 2])
    # the two last columns are found by place, so their names may clash with others
    rows = docs.select("*", F.col("text").cast("string").alias("__text"), _chance().alias("__chance"))
    return rows.mapInArrow(run, docs.schema)
