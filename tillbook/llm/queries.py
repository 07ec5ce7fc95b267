"""The thirteen operators as queries over the whole intended tables.

Each callable takes ``(spark, sf_dir)`` and returns the full result.  Digest
columns are derived here; the operators keep their general interface.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tillbook.llm import (block_rules, contour_whitening, gear_dedup, minhash_forest, ordinal_quality, posting_lists, progressive_dedup,
                          simplex_clustering, soft_mixture, speculative_bpe, toxicity_trees, uniform_shards, weighted_sampling)

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_block_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_rules.extract_text(table(spark, sf_dir, "pages"))


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op4_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = uniform_shards.text_facts(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32")
    return uniform_shards.shuffle_into_shards(facts).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ordinal_quality.fit_on(docs, ordinal_quality.grades_from_labels(table(spark, sf_dir, "labels")))
    return ordinal_quality.score_quality(docs, model).withColumn("held_out", ordinal_quality.held_out(F.col("doc_id")))


def op6_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.fingerprints(table(spark, sf_dir, "documents"))


def op7_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_trees.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speculative_bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op9_soft_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return soft_mixture.rated(docs, soft_mixture.fit_mixture(docs, table(spark, sf_dir, "labels")))


def op10_gear_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without repeated runs, and the documents that keep them."""
    cut = gear_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "text", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.n_words).alias("removed_words"),
        F.array_distinct(F.transform("spans", lambda s: s.first_doc)).alias("first_docs"))


def op11_simplex_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex_clustering.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def op12_progressive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest is asked for of every row, copies or not; the operator itself hashes whole texts of survivors only."""
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    marked = progressive_dedup.mark_duplicates(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_contour_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contour_whitening.whiten(table(spark, sf_dir, "embeddings"), k=8)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_posting_lists, op2_block_rules, op3_minhash_forest, op4_uniform_shards, op5_ordinal_quality,
                            op6_weighted_sampling, op7_toxicity_trees, op8_speculative_bpe, op9_soft_mixture, op10_gear_dedup, op11_simplex_clustering,
                            op12_progressive_dedup, op13_contour_whitening, pipeline)
}


def _clustering_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round is a pair of tables: assignments to the last centroids, and the centroids they make."""
    assigned = """
a{r} AS MATERIALIZED (
    SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d
    FROM (SELECT v.vec_id, m.c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN c{r} m USING (i) GROUP BY v.vec_id, m.c) GROUP BY vec_id)"""
    moved = """
c{n} AS MATERIALIZED (
    SELECT m.c, m.i, CASE WHEN s.n IS NULL THEN m.x ELSE CAST((s.t - ((s.t % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x
    FROM c{r} m LEFT JOIN (SELECT a.c, v.i, sum(v.x) AS t, count(*) AS n FROM a{r} a JOIN v USING (vec_id) GROUP BY a.c, v.i) s
    ON s.c = m.c AND s.i = m.i)"""
    steps = ",".join(assigned.format(r=r) + "," + moved.format(r=r, n=r + 1) for r in range(rounds))
    return f"""
WITH fine AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
v AS MATERIALIZED (
    SELECT vec_id, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM fine, range(1, 65) t(i)),
seeds AS (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM fine ORDER BY sha256('2:' || vec_id) LIMIT {k}),
c0 AS MATERIALIZED (SELECT c, i, x FROM seeds JOIN v USING (vec_id)),{steps},{assigned.format(r=rounds)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
    CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) USING (c)
"""


#: op3: sets of shingles, exact links, and the smallest document reachable.  SQL
#: expresses no other of the thirteen.
ORACLE: dict[str, str] = {
    "op3_minhash_forest": r"""
WITH RECURSIVE tokens AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                                        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM tokens),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN lowest USING (doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op11_simplex_clustering": _clustering_sql(),
    "op12_progressive_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
}
