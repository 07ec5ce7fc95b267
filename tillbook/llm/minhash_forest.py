"""Near-duplicate documents by a MinHash LSH forest.

Each distinct shingle set gets ``TREES`` orders of ``DEPTH`` MinHash values
(16 bits each).  In every order the sets are sorted by signature inside the
region that shares the first ``BASE`` values, and each set is paired with the
``NEAR`` sets that follow it: a region of up to ``NEAR`` + 1 sets is paired
completely, in a denser one the partners are those of longest common prefix,
so the depth adapts to the region.  The rows of regions with company carry
their signatures, and pairs that agree in far fewer values than the similarity
asks for (fewer than one link in a million) are left out on the spot, before
any pair is shuffled.  The others are compared by sets of
16-bit hashes, which can only look more alike than the true ones but for the
margin given, and what remains is confirmed on the full shingle sets.  For regions that are too dense for the window, a last round
also tests every pair that shares all ``DEPTH`` values of a tree and is not
yet connected, so that no cap on partners decides alone.

Equal sets are one class from the start, copies never meet as pairs.  Each
set first tries the likeliest of its direct neighbours; the full window then
pairs only sets that are not connected yet, because the result is the
component.

Defined results: null or wordless texts have an empty set and link with
nothing; texts below five words have one shingle; a null id never links and
is a kept row with a null component; rows that repeat an id are one document,
whose smallest set is the one compared if their texts differ; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillbook.llm.components import connected_components
from tillbook.llm.textnp import blocks, mix, sorted_sets
from tillbook.session import materialize

TREES = 16
BASE = 4            # values in the region key; two longs of 4 x 16 bits hold an order
DEPTH = 8
NEAR = 8
_RNG = np.random.default_rng(97)
_SCALE = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)

_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, sig array<long>"
MARGIN = 2          # percent by which the 16-bit sets may fall short, by hash collisions inside a set
_SETS = "doc_id long, set_a long, shingles array<long>, small array<short>"


def signature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> set size, two set digests, forest orders."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            rows = len(block.offsets) - 1
            value, row, present = sorted_sets(block)
            size = np.bincount(row, minlength=rows)
            digests = np.zeros((2, rows), dtype=np.uint64)
            orders = np.zeros((rows, 2 * TREES), dtype=np.uint64)
            if len(present):
                at = np.searchsorted(row, present)
                for k in range(2):
                    digests[k, present] = np.add.reduceat(mix(value + np.uint64(k + 1)), at, dtype=np.uint64)
                for j in range(TREES * DEPTH):
                    least = np.minimum.reduceat(value * _SCALE[j] + _SHIFT[j], at)
                    orders[present, j // BASE] = (orders[present, j // BASE] << np.uint64(16)) | (mix(least) >> np.uint64(48))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * 2 * TREES),
                                             pa.array(orders.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, rows), pa.array(size.astype(np.int64)),
                 pa.array(digests[0].view(np.int64)), pa.array(digests[1].view(np.int64)), lists],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sig"])


def set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> the full set of shingle hashes."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            rows = len(block.offsets) - 1
            value, row, present = sorted_sets(block)
            at = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
            digest = np.zeros(rows, dtype=np.uint64)
            if len(present):
                digest[present] = np.add.reduceat(mix(value + np.uint64(1)), at[present], dtype=np.uint64)
            low = np.unique(row.astype(np.int64) << 16 | (mix(value) >> np.uint64(48)).astype(np.int64))
            low_at = np.searchsorted(low >> 16, np.arange(rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, rows), pa.array(digest.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(value.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(low_at), pa.array((low & 0xFFFF).astype(np.uint16).view(np.int16)))],
                names=["doc_id", "set_a", "shingles", "small"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if 100 * |A n B| >= ``percent`` * |A u B|.
    """
    key = ["set_a", "set_b", "n_shingles"]
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(texts.mapInArrow(signature_batches, _SIGNED), "signed")
    classes = materialize(signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key)
                          .agg(F.min("doc_id").alias("rep")), "classes")
    # an id in several rows of different texts stands for its smallest set
    nodes = classes.groupBy(F.col("rep").alias("doc_id")).agg(F.min(F.struct("n_shingles", "set_a", "set_b")).alias("s")).select("doc_id", "s.*")
    reps = signed.join(nodes, ["doc_id", *key], "left_semi").dropDuplicates(["doc_id"])
    reps = materialize(reps.select(F.col("doc_id").alias("rep"), "n_shingles", "sig"), "reps")
    branches = materialize(_branches(reps), "branches")
    # the likeliest partner of each set first; what they connect is not paired again
    best = W.partitionBy("b").orderBy(F.desc("trees"), "a")
    first = _neighbours(branches, reps, percent, 1).withColumn("r", F.row_number().over(best)).where("r = 1")
    links = materialize(_confirmed(first.select("a", "b"), signed, texts, percent), "links")
    labels = connected_components(links)
    rooted = branches.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    rest = _neighbours(rooted, reps, percent, NEAR).select("a", "b")
    links = materialize(links.unionByName(_confirmed(rest, signed, texts, percent)), "links")
    labels = connected_components(links)
    dense = materialize(_dense_links(branches, labels, reps, signed, texts, percent), "dense")
    if not dense.isEmpty():
        labels = connected_components(links.unionByName(dense))
    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        *key, F.coalesce("root", "rep").alias("component"))
    return signed.select("doc_id", *key).join(named, key, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()


def _full_sets(texts: DataFrame, signed: DataFrame, ids: DataFrame) -> DataFrame:
    """``(doc_id, shingles, small)`` of the given documents; only ids that stand in several rows are grouped."""
    rows = signed.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    rows = materialize(rows, "set_ids")
    once, again = (texts.join(rows.where(c), "doc_id", "left_semi").mapInArrow(set_batches, _SETS) for c in ("rows = 1", "rows > 1"))
    size = F.struct(F.size("shingles"), "set_a")
    least = again.groupBy("doc_id").agg(F.min_by(F.struct("shingles", "small"), size).alias("s")).select("doc_id", "s.*")
    return once.select("doc_id", "shingles", "small").unionByName(least)


def _confirmed(pairs: DataFrame, signed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The links among the pairs, by their sets."""
    tested = materialize(pairs, "pairs")
    return confirm(tested, materialize(_full_sets(texts, signed, _ends(tested)), "sets"), percent)


def _branches(reps: DataFrame) -> DataFrame:
    """One row per class and tree: region key ``p``, the rest of the order ``q``."""
    trees = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(
        t.alias("tree"), F.get("sig", 2 * t).alias("p"), F.get("sig", 2 * t + 1).alias("q")))
    rows = reps.select("rep", "n_shingles", F.explode(trees).alias("t")).select("t.*", "rep", "n_shingles")
    return rows.withColumn("crowd", F.count(F.lit(1)).over(W.partitionBy("tree", "p"))).where("crowd > 1")


def _close_sizes(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _neighbours(branches: DataFrame, reps: DataFrame, percent: int, window: int) -> DataFrame:
    """``(a, b, trees)``, a < b: pairs of following sets in the sorted orders, of sizes and signatures that allow a link.

    With a column ``root``, pairs inside a component are left out.
    """
    branches = branches.join(reps.select("rep", "sig"), "rep")
    facts = [c for c in ("rep", "n_shingles", "sig", "root") if c in branches.columns]
    order = W.partitionBy("tree", "p").orderBy("q", "rep").rowsBetween(1, window)
    ahead = branches.select(*facts, F.collect_list(F.struct(*facts)).over(order).alias("ahead"))
    if "root" in facts:
        ahead = ahead.withColumn("ahead", F.filter("ahead", lambda o: o.root != F.col("root")))
    pairs = ahead.select("rep", "n_shingles", "sig", F.explode("ahead").alias("o")).where(
        (F.col("rep") != F.col("o.rep")) & _close_sizes("n_shingles", "o.n_shingles", percent)
        & (_agreement("sig", "o.sig") >= TREES * DEPTH - _most_unequal(percent)))
    return pairs.groupBy(F.least("rep", "o.rep").alias("a"), F.greatest("rep", "o.rep").alias("b")).agg(
        F.count(F.lit(1)).alias("trees"))


def _most_unequal(percent: int) -> int:
    """How many of the values of two linked sets differ, but for one link in a million."""
    n, p = TREES * DEPTH, 1 - percent / 100
    beyond = 0.0
    for most in range(n, 0, -1):
        beyond += math.comb(n, most) * p ** most * (1 - p) ** (n - most)
        if beyond >= 1e-6:
            return most
    return 0


def _agreement(a: str, b: str) -> Column:
    """How many of the 16-bit values of two signatures are equal."""
    lanes = lambda x: sum((F.shiftrightunsigned(x, 16 * k).bitwiseAND(F.lit(0xFFFF)) == 0).cast("int") for k in range(4))
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda n, x: n + lanes(x))


def _dense_links(branches: DataFrame, labels: DataFrame, reps: DataFrame, signed: DataFrame, texts: DataFrame,
                 percent: int) -> DataFrame:
    """Links between unconnected sets that share a whole order in a region denser than the window.

    One end of such a pair stands outside the group's largest component, so
    only those rows look for partners; pairs too unlike leave the join at once.
    """
    key = ["tree", "p", "q"]
    crowded = (branches.where(F.col("crowd") > NEAR + 1)
               .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
               .select(*key, "rep", "n_shingles", F.coalesce("root", "rep").alias("root")))
    parts = crowded.groupBy(*key, "root").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy(*key).agg(F.max(F.struct("n", F.col("root"))).alias("m"), F.count(F.lit(1)).alias("parts"))
    mixed = materialize(crowded.join(main.where("parts > 1").select(*key, F.col("m.root").alias("main")), key), "mixed")
    sets = materialize(_full_sets(texts, signed, mixed.select(F.col("rep").alias("doc_id")).distinct()), "sets")
    rows = mixed.join(reps.select("rep", "sig"), "rep").join(sets.select(F.col("doc_id").alias("rep"), "small"), "rep")
    right = rows.drop("main").withColumnsRenamed({c: f"{c}2" for c in rows.columns})
    likely = rows.where("root <> main").join(
        right, (F.col("tree") == F.col("tree2")) & (F.col("p") == F.col("p2")) & (F.col("q") == F.col("q2")) & (F.col("root") != F.col("root2"))
        & _close_sizes("n_shingles", "n_shingles2", percent) & (_agreement("sig", "sig2") >= TREES * DEPTH - _most_unequal(percent))
        & _alike("small", "small2", percent - MARGIN))
    pairs = materialize(likely.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct(), "likely")
    return _similar(pairs, sets, "shingles", percent)


def _alike(a: str, b: str, percent: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common * 100 >= (F.size(a) + F.size(b) - common) * percent


def _similar(pairs: DataFrame, sets: DataFrame, column: str, percent: int) -> DataFrame:
    of_a = sets.select(F.col("doc_id").alias("a"), F.col(column).alias("sa"))
    of_b = sets.select(F.col("doc_id").alias("b"), F.col(column).alias("sb"))
    return pairs.join(of_a, "a").join(of_b, "b").where(_alike("sa", "sb", percent)).select("a", "b")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Keep the pairs whose full sets reach the similarity; most others fall out by their small sets."""
    likely = materialize(_similar(pairs, sets, "small", percent - MARGIN), "likely")
    return _similar(likely, sets, "shingles", percent)


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without all but the smallest id of each near-duplicate group; columns unchanged."""
    drop = near_duplicates(docs, percent=percent).where(~F.col("kept")).select(F.col("doc_id")).distinct()
    return docs.join(drop, "doc_id", "left_anti")
