"""Toxicity by gradient-boosted trees over dense features, calibrated.

A lexicon of hashed stems (whole words and their first bytes) is learned from a
bounded sample of labelled rows: a stem enters if it stands in many toxic
documents, behind many different words, and hardly in any other.  (Rare words
of one document's many copies always follow the same word, so they stay out.)
Every text then gets dense features: lexicon densities, how often a lexicon
word stands near the second person, capitals, punctuation, obfuscation.  Spark
ML's gradient-boosted trees are trained on three quarters of the labelled rows
and their output is calibrated by isotonic regression on the last quarter.

Only rows whose crc32(doc_id) mod 5 is not 0 are learned from; id, source,
language and labels are never features.  ``MIN_DOCS`` and ``MIN_BEFORE`` are
the pair with the fewest wrong predictions on the rows with remainder 1, of
five pairs fitted on those with remainders 2 to 4 (sf0.1).

Defined results: null and empty texts have zero features and a score like any
other; without labels of both kinds every score is the share of toxic labels
(0 without labels); labels that repeat an id count as toxic if any row says
so; null ids are scored and not held out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from tillbook.llm.textnp import Block, blocks, mix, segment_hashes
from tillbook.session import materialize

LEXICON_ROWS = 12000      # labelled rows that the lexicon is learned from
STEM_BYTES = (4, 5, 6)
MIN_DOCS = 4              # toxic documents
MIN_BEFORE = 6            # different words before it (of 64 hash classes)
MAX_OTHERS = 0.02         # documents that aren't toxic, as a share of the toxic ones
NEAR_WORDS = 4
TREES = 20
DEPTH = 4

# Second-person words of the four languages.
SECOND_PERSON = """you your yours yourself tu te ton ta tes toi vous votre vos du dich dir dein deine deinen ihr euch euer eure
tú ti tus usted ustedes vosotros vuestro vuestra""".split()

FEATURES = ["hits", "word_density", "stem_density", "near_you", "you_density", "capitals", "capital_words", "punctuation",
            "exclamations", "obfuscated", "digits", "word_length", "log_words"]

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


def _letter_words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of letters: starts, ends, rows."""
    letter = _LETTER[block.data]
    before = np.zeros(len(letter) + 1, dtype=bool)
    before[1:] = letter
    before[block.offsets[:-1]] = False
    after = np.zeros(len(letter) + 1, dtype=bool)
    after[:-1] = letter
    after[block.offsets[1:]] = False
    starts = np.flatnonzero(letter & ~before[:-1])
    ends = np.flatnonzero(letter & ~after[1:]) + 1
    return starts, ends, np.searchsorted(block.offsets, starts, side="right") - 1


def _stem_hashes(block: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per word its own hash and those of its first bytes (0 if it isn't longer)."""
    columns = [segment_hashes(block.data, starts, ends, lower=True)]
    for k in STEM_BYTES:
        long = ends - starts > k
        cut = segment_hashes(block.data, starts, np.where(long, starts + k, ends), lower=True)
        columns.append(np.where(long, mix(cut + np.uint64(k)), np.uint64(0)))
    return np.stack(columns, axis=1)


def _stem_batches(toxic: dict[int, int]):
    """Sampled documents -> per stem: toxic and other documents, classes of preceding words."""
    chosen = pa.array(sorted(toxic), type=pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        for batch in batches:
            batch = batch.filter(pc.is_in(batch.column(0), value_set=chosen))
            marks = np.array([toxic[i] for i in batch.column(0).to_pylist()], dtype=np.int64)
            for block in blocks(batch.column(1), 1 << 22):
                starts, ends, row = _letter_words(block)
                if not len(starts):
                    continue
                stems = _stem_hashes(block, starts, ends)
                previous = np.zeros(len(starts), dtype=np.uint64)
                previous[1:] = np.where(row[1:] == row[:-1], stems[:-1, 0] >> np.uint64(58), 0)
                k = stems.shape[1]
                key, rows, bit = stems.ravel(), np.repeat(row, k), np.uint64(1) << np.repeat(previous, k)
                real = key != 0
                key, rows, bit = key[real], rows[real], bit[real]
                order = np.lexsort((rows, key))
                key, rows, bit = key[order], rows[order], bit[order]
                at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                first = np.concatenate([[True], (key[1:] != key[:-1]) | (rows[1:] != rows[:-1])])
                mark = marks[block.first:block.first + len(block.offsets) - 1][rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at].view(np.int64)), pa.array(np.add.reduceat(first * mark, at)),
                     pa.array(np.add.reduceat(first * (1 - mark), at)),
                     pa.array(np.bitwise_or.reduceat(np.where(mark > 0, bit, np.uint64(0)), at).view(np.int64))],
                    names=["stem", "toxic", "other", "before"])
    return run


def learn_lexicon(docs: DataFrame, marked: DataFrame, rows: int = LEXICON_ROWS) -> np.ndarray:
    """Sorted hashes of the lexicon's stems; ``marked(doc_id, toxic)``.

    The sample is bounded, and so is the lexicon: each stem needs ``MIN_DOCS``
    documents of the sample.
    """
    picked = marked.orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id").limit(rows).collect()
    toxic = {int(r["doc_id"]): int(r["toxic"]) for r in picked}
    found = (_texts(docs).mapInArrow(_stem_batches(toxic), "stem long, toxic long, other long, before long")
             .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.bit_or("before").alias("before"))
             .where((F.col("toxic") >= MIN_DOCS) & (F.bit_count("before") >= MIN_BEFORE) & (F.col("other") <= F.col("toxic") * MAX_OTHERS)))
    return np.sort(np.array([r["stem"] for r in found.select("stem").collect()], dtype=np.int64).view(np.uint64))


def _you_hashes() -> np.ndarray:
    raw = [w.encode() for w in SECOND_PERSON]
    ends = np.cumsum([len(w) for w in raw])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return np.sort(segment_hashes(data, np.concatenate([[0], ends[:-1]]), ends, lower=True))


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(values.shape, dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def dense_features(block: Block, lexicon: np.ndarray, you: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per row of the block."""
    data, rows = block.data, len(block.offsets) - 1
    of_byte = np.repeat(np.arange(rows), np.diff(block.offsets))
    starts, ends, row = _letter_words(block)
    out = np.zeros((rows, len(FEATURES)))
    per_row = lambda mask, where: np.bincount(where[mask], minlength=rows).astype(float)
    n_words = np.bincount(row, minlength=rows)
    size, per_word = np.maximum(np.diff(block.offsets), 1), np.maximum(n_words, 1)
    upper, letter, space = (data >= 65) & (data <= 90), _LETTER[data], (data == 32) | ((data >= 9) & (data <= 13))
    digit = (data >= 48) & (data <= 57)
    if len(starts):
        stems = _stem_hashes(block, starts, ends)
        hit = _among(stems, lexicon)
        any_hit, is_you = hit.any(axis=1), _among(stems[:, 0], you)
        mark = np.flatnonzero(is_you)
        near = np.zeros(len(starts), dtype=bool)
        if len(mark):
            at = np.arange(len(starts))
            right = np.searchsorted(mark, at)
            for side in (np.minimum(right, len(mark) - 1), np.maximum(right - 1, 0)):
                near |= (np.abs(mark[side] - at) <= NEAR_WORDS) & (row[mark[side]] == row)
        caps = np.add.reduceat(np.append(upper, False).astype(np.int32), np.stack([starts, ends], 1).ravel())[::2]
        out[:, 0] = np.log1p(per_row(any_hit, row))
        out[:, 1] = per_row(hit[:, 0], row) / per_word
        out[:, 2] = per_row(hit[:, 1:].any(axis=1), row) / per_word
        out[:, 3] = per_row(any_hit & near, row) / per_word
        out[:, 4] = per_row(is_you, row) / per_word
        out[:, 6] = per_row((caps == ends - starts) & (caps > 1), row) / per_word
        out[:, 11] = np.bincount(row, weights=ends - starts, minlength=rows) / per_word
    out[:, 5] = per_row(upper, of_byte) / np.maximum(per_row(letter, of_byte), 1)
    out[:, 7] = per_row(~letter & ~space & ~digit, of_byte) / size
    out[:, 8] = per_row(data == 33, of_byte) / size
    inside = np.zeros(len(data), dtype=bool)             # a mark or digit between two letters hides a word
    if len(data) > 2:
        inside[1:-1] = ~letter[1:-1] & ~space[1:-1] & letter[:-2] & letter[2:] & (data[1:-1] != 39) & (data[1:-1] != 45)
    out[:, 9] = per_row(inside, of_byte) / per_word
    out[:, 10] = per_row(digit, of_byte) / size
    out[:, 12] = np.log1p(n_words)
    return out


def _feature_batches(lexicon: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        you = _you_hashes()
        for batch in batches:
            for block in blocks(batch.column(1)):
                x = dense_features(block, lexicon, you)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, len(x)), *map(pa.array, x.T.copy())],
                                                 names=["doc_id", *FEATURES])
    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    marked = materialize(labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
                         .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
                         .where(~held_out(F.col("doc_id"))), "marked")
    counts = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = counts["n"], counts["toxic"] or 0
    if toxic in (0, n):
        return _scored(_texts(docs).select("doc_id", F.lit(float(toxic / n if n else 0)).alias("score")))
    lexicon = learn_lexicon(docs, marked)
    dense = materialize(_texts(docs).mapInArrow(_feature_batches(lexicon), ", ".join(["doc_id long", *(f"{c} double" for c in FEATURES)])), "dense")
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(dense)
    known = assembled.join(marked, "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "features", F.col("toxic").cast("double").alias("label"))
    known = materialize(known, "known")
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("toxic")).first()
    if (seen["toxic"] or 0) in (0, seen["n"]):          # the labels are of other documents, or of one kind
        return _scored(_texts(docs).select("doc_id", F.lit(float(seen["toxic"] / seen["n"] if seen["n"] else 0)).alias("score")))
    check = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(3)), F.lit(4)) == 0
    train, rest = known.where(~check), known.where(check)
    if train.select("label").distinct().count() < 2 or rest.select("label").distinct().count() < 2:
        train = rest = known
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=17, maxBins=64).fit(train)
    raw = lambda rows: model.transform(rows).withColumn("p", F.round(vector_to_array("probability")[1], 4))
    points = raw(rest).groupBy("p").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    curve = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight", predictionCol="score").fit(points)
    return _scored(curve.transform(raw(assembled).select("doc_id", "p")))


def _scored(rows: DataFrame) -> DataFrame:
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic; columns unchanged."""
    rejected = score_toxicity(docs, labels).where("predicted = 1").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(docs.columns)
