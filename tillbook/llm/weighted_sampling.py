"""Document fingerprints by consistent weighted sampling, DataFrame operations only.

A text is the multiset of its words, weighted by their counts.  For each term
and each of ``SAMPLES`` draws, a hash of both gives two Gamma(2, 1) variates
r, c and a uniform b; with weight w the term's level is t = floor(ln(w)/r + b)
and its value is ln(c) - r * (t - b + 1).  The draw's sample is the (term, t)
of the least value, and two texts have the same sample with a probability that
is their generalised Jaccard similarity, sum of min(w) over sum of max(w).

A Gamma(2, 1) variate is minus the logarithm of a product of two uniform ones,
which are hash bits.  Draws are made four to a row, so that the generated code
of the aggregate stays small enough to be compiled.

The edited text takes the last floor(n/2) code points of a text away and puts
the first as many (or all) of the next document's in their place.  Documents
follow each other by descending id (ties by text), the last is followed by the
first.  They are cut into runs of near ``RUN_ROWS`` ids at quantiles; each run
also gets the first row of the next, so neighbours meet without one ordered
task and the text moves once.

Defined results: null text counts as empty; a text without words has the empty
fingerprint, like 1 to another empty one and 0 to any other; one document is
its own next; null ids come last; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillbook.session import materialize

SAMPLES = 32         # a multiple of four
RUN_ROWS = 200
MAX_RUNS = 65_536
NO_ID = -(1 << 63)     # stands for a null id in the order
_PER_ROW = 4
_DIGEST = 0xFFFFFFFF
_SCALE = float(1 << 24)


def _uniform(bits_of: Column, at: int, bits: int) -> Column:
    """A number in (0, 1) from some bits of a hash."""
    return (F.shiftrightunsigned(bits_of, at).bitwiseAND(F.lit((1 << bits) - 1)) + 0.5) / float(1 << bits)


def sample_value(term: Column, log_weight: Column, draw: Column) -> Column:
    """One draw of a weighted term, as a long: its value above, a digest of (term, level) in the lower 32 bits."""
    h = F.xxhash64(term, draw)
    g = F.xxhash64(h)
    c = -F.log(_uniform(h, 0, 32) * _uniform(h, 32, 32))
    r = -F.log(_uniform(g, 0, 21) * _uniform(g, 21, 21))
    b = _uniform(g, 42, 22)
    level = F.floor(log_weight / r + b)
    value = F.log(c) - r * (level - b + 1.0)
    return F.shiftleft(((value + 64.0) * _SCALE).cast("long"), 32).bitwiseOR(F.xxhash64(h, level).bitwiseAND(F.lit(_DIGEST)))


def _run_of(edges: list[int]) -> Column:
    """How many edges lie below the id, searched in two steps."""
    if not edges:
        return F.lit(0)
    group = math.isqrt(len(edges)) + 1
    table = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>")
    coarse = F.split(F.lit(",".join(map(str, edges[group - 1::group] or edges[-1:]))), ",").cast("array<bigint>")
    below = lambda e: e < F.col("doc_id")
    if len(edges) < group:
        return F.size(F.filter(table, below))
    skip = F.size(F.filter(coarse, below)) * group
    return skip + F.size(F.filter(F.slice(table, skip + 1, F.lit(group)), below))


def _in_runs(docs: DataFrame) -> DataFrame:
    """``run, order, key, halo, text``: all rows by descending id in runs, the next run's first row as ``halo``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    n = docs.count()
    runs = int(min(MAX_RUNS, max(1, n // RUN_ROWS)))
    edges: list[int] = []
    if runs > 1:
        at = rows.agg(F.percentile_approx("doc_id", [(k + 1) / runs for k in range(runs - 1)], 100_000).alias("at")).first()["at"]
        edges = sorted(set(at or []))
    # a null id comes last of all, below the smallest id
    rows = rows.select(F.when(F.col("doc_id").isNull(), 0).otherwise(_run_of(edges)).cast("int").alias("run"),
                       F.coalesce("doc_id", F.lit(NO_ID)).alias("order"), F.xxhash64("doc_id", "text").alias("key"), "text")
    heads = rows.groupBy("run").agg(F.max(F.struct("order", "key")).alias("head"))
    everyone = W.partitionBy(F.lit(0))                    # at most MAX_RUNS rows
    above = F.coalesce(F.lead("run").over(everyone.orderBy("run")), F.min("run").over(everyone))
    heads = materialize(heads.select("run", "head.order", "head.key", above.alias("above")), "heads")
    here = F.struct(F.col("run"), F.lit(False).alias("halo"))
    there = F.struct(F.col("above").alias("run"), F.lit(True).alias("halo"))
    places = F.when(F.col("above").isNull(), F.array(here)).otherwise(F.array(here, there))
    placed = rows.join(F.broadcast(heads), ["run", "order", "key"], "left").withColumn("place", F.explode(places))
    partitions = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), (len(edges) + 1) // 4)
    # the filter stands here so that both readers of the exchange plan it alike and share it
    return placed.select("place.run", "order", "key", "place.halo", "text").where("run IS NOT NULL").repartition(partitions, "run")


def edited_texts(docs: DataFrame) -> DataFrame:
    """``run, pos, halo, order, text, edited``: every document with its edited text."""
    line = W.partitionBy("run").orderBy("halo", F.desc("order"), F.desc("key"))
    rows = _in_runs(docs).select("run", F.row_number().over(line).alias("pos"), "halo", "order", "text",
                                 F.lead("text").over(line).alias("follows"))
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 2) as int))"),
                      F.coalesce(F.substring("follows", F.lit(1), half), F.lit("")))
    return rows.select("run", "pos", "halo", "order", "text", edited.alias("edited"))


def sketches(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys, draws, m0..m3`` of ``terms(keys, term, weight)``; ``draws`` numbers the rows of four draws."""
    rows = terms.select(*keys, "term", F.log(F.col("weight").cast("double")).alias("lw"),
                        F.explode(F.sequence(F.lit(0), F.lit(samples // _PER_ROW - 1))).alias("draws"))
    least = [F.min(sample_value(F.col("term"), F.col("lw"), F.col("draws") * _PER_ROW + k)).bitwiseAND(F.lit(_DIGEST)).alias(f"m{k}")
             for k in range(_PER_ROW)]
    return rows.groupBy(*keys, "draws").agg(*least)


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per document."""
    rows = edited_texts(docs)
    facts = rows.select("run", "pos", "halo", F.when(F.col("order") != NO_ID, F.col("order")).alias("doc_id"),
                        F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("t")))
    words = F.explode(F.split(F.translate("v.t", "\t\n\x0b\x0c\r", "     "), " "))
    terms = (rows.select("run", "pos", F.explode(both).alias("v")).select("run", "pos", "v.which", words.alias("word"))
             .where("word <> ''").groupBy("run", "pos", "which", F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("weight")))
    part = sketches(terms, ["run", "pos", "which"], samples)
    cells = [(which, d, k) for which in (0, 1) for d in range(samples // _PER_ROW) for k in range(_PER_ROW)]
    wide = part.groupBy("run", "pos").agg(
        *[F.max(F.when((F.col("which") == which) & (F.col("draws") == d), F.col(f"m{k}"))).alias(f"s{which}_{d}_{k}") for which, d, k in cells])

    def whole(which: int) -> Column:
        names = [f"s{w}_{d}_{k}" for w, d, k in cells if w == which]
        return F.when(F.col(names[0]).isNotNull(), F.array(*names))
    pairs = wide.select("run", "pos", whole(0).alias("own"), whole(1).alias("changed"))
    joined = facts.join(pairs, ["run", "pos"], "left")
    follows = F.lead("own").over(W.partitionBy("run").orderBy("pos"))
    return joined.withColumn("follows", follows).where("NOT halo").select(
        "doc_id", "n_chars", "edited_sha256", _hex("own").alias("fingerprint"), _hex("changed").alias("edited_fingerprint"),
        likeness("own", "changed", samples).alias("near_edited"), likeness("own", "follows", samples).alias("near_next"))


def _hex(sketch: str) -> Column:
    digits = F.transform(sketch, lambda m: F.lower(F.lpad(F.hex(m), 8, "0")))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: str, b: str, samples: int = SAMPLES) -> Column:
    """Share of equal samples: an estimate of the generalised Jaccard similarity."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(samples))
    return F.when(F.col(a).isNull() & F.col(b).isNull(), 1.0).when(F.col(a).isNull() | F.col(b).isNull(), 0.0).otherwise(same)
