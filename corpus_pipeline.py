"""A training-corpus pipeline of five stages over ``documents``.

Every stage is a function of ``(spark, docs, sf_dir)`` and works on all rows
that the one before kept; ``run`` writes each stage's rows as Parquet in the
shared folder and reads them again as the next one's input.  All but the last
stage return the columns of ``documents``, whatever others there are.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbook.llm import gear_dedup, minhash_forest, soft_mixture, speculative_bpe, toxicity_trees
from tillbook.session import scratch_path

#: What the mixture is to keep of the tokens of clean, toxic and junk text: policy of the
#: corpus, the same for every input. Clean documents stay once each, none is thinned or repeated.
KEEP = (1.0, 0.25, 0.5)
CLEAN = 0


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the calibrated trees predict as toxic go."""
    return toxicity_trees.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies stays."""
    return minhash_forest.keep_one(docs, percent=80).select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut; ``n_chars``, if there is one, follows the text."""
    spans = "__cut"
    while spans in {c.lower() for c in docs.columns}:
        spans += "_"
    cut = gear_dedup.remove_repeats(docs, spans=spans).select(docs.columns)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of other domains than the clean one are thinned to what ``KEEP`` leaves of them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return soft_mixture.mix(docs, labels, keep=KEEP, fixed=CLEAN).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every row."""
    return speculative_bpe.token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("mixture", mixture), ("tokens", tokens)]

#: The trees, the mixture and the encoding can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
