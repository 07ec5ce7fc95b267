"""Uniform random sharding with exact shard sizes, DataFrame operations only.

Rows stand in blocks (by a hash of id and text).  How many rows of each block
go to each shard is drawn as a whole, the communication matrix: its rows sum
to the block sizes and its columns to the exact shard sizes, and its law is
the multivariate hypergeometric one that a uniform shuffle of all rows would
give.  Each block is permuted on its own and cut by its matrix row, the rows
go to their shards, and there they are permuted again, which gives the slots.
The outcome is a uniform shuffle, though no task ever sees more than a block.

The law is ``rows``: shard counts differ by at most one.  Only block sizes
reach the driver: one number per ``BLOCK_ROWS`` rows.  Within a shard the
second permutation is by a random key whose leading bits name a piece of about
``BLOCK_ROWS`` rows; a piece's first slot is the sum of the pieces before.

Defined results: null text has size 8 and the checksum of the empty text; null
ids are rows like others; rows that agree in id and text get different slots;
an empty table gives an empty result; other columns pass through, but
``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` are
written anew.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tillbook.session import materialize

SHARDS = 24
BLOCK_ROWS = 50_000
LEAST_BLOCKS = 64       # so that small tables are dealt out too
SEED = 20240301


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` taken without return are good.

    Inverse of the distribution function, walked outwards from the mode, so a
    draw costs about the standard deviation, not the number of rows.
    """
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    total = good + bad
    low, high = max(0, draws - bad), min(draws, good)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    ln = math.lgamma
    peak = math.exp(ln(good + 1) - ln(mode + 1) - ln(good - mode + 1) + ln(bad + 1) - ln(draws - mode + 1) - ln(bad - draws + mode + 1)
                    - ln(total + 1) + ln(draws + 1) + ln(total - draws + 1))
    left = rng.random() - peak
    up = down = mode
    p_up = p_down = peak
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int = SEED) -> list[list[int]]:
    """Rows from each block to each shard, as a uniform shuffle would send them."""
    rng = random.Random(seed)
    room = list(shard_sizes)
    matrix = []
    for size in block_sizes:
        row, left, rest = [], size, sum(room)
        for s, capacity in enumerate(room):
            rest -= capacity
            take = hypergeometric(rng, capacity, rest, left) if s < len(room) - 1 else left
            row.append(take)
            left -= take
        room = [c - t for c, t in zip(room, row)]
        matrix.append(row)
    return matrix


def _random_key(seed: int) -> Column:
    """A pseudo-random number per row, a function of id, text checksum and seed."""
    return F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("text_crc32"), F.col("size"), F.lit(seed))


def text_facts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text and 8) and ``text_crc32``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"size": (F.octet_length(text) + 8).cast("long"), "text_crc32": F.crc32(text.cast("binary")).cast("long")})


def shuffle_into_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` (with ``doc_id``, ``text_crc32`` and ``size``) plus ``law, shard, slot, grown_shard``."""
    docs = docs.drop("law", "shard", "slot", "grown_shard")
    n = docs.count()
    blocks = max(LEAST_BLOCKS, math.ceil(n / BLOCK_ROWS))
    rows = docs.withColumns({"__block": F.pmod(_random_key(seed), F.lit(blocks)).cast("int"), "__key": _random_key(seed + 1)})
    sizes = {r["__block"]: r["n"] for r in rows.groupBy("__block").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(sizes)
    matrix = communication_matrix([sizes[b] for b in order], [n // shards + (s < n % shards) for s in range(shards)], seed)
    cuts = docs.sparkSession.createDataFrame(
        [(b, [sum(row[:s + 1]) for s in range(shards)]) for b, row in zip(order, matrix)], "__block int, __cuts array<int>")
    place = F.row_number().over(W.partitionBy("__block").orderBy("__key", "doc_id", "text_crc32"))
    shard = F.size(F.filter("__cuts", lambda c: c < F.col("__place"))).cast("int")
    pieces = max(4, math.ceil(n / shards / BLOCK_ROWS))
    bits = max(2, math.ceil(math.log2(pieces)))
    dealt = (rows.withColumn("__place", place).join(cuts, "__block").withColumn("shard", shard)
             .withColumn("__key", _random_key(seed + 2)).withColumn("__piece", F.shiftrightunsigned("__key", 64 - bits).cast("int"))
             .drop("__block", "__place", "__cuts"))
    dealt = materialize(dealt, "dealt")
    counts = dealt.groupBy("shard", "__piece").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.partitionBy("shard").orderBy("__piece").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("shard", "__piece", before.alias("__start"))
    within = F.row_number().over(W.partitionBy("shard", "__piece").orderBy("__key", "doc_id", "text_crc32")) - 1
    return (dealt.withColumn("__within", within).join(starts, ["shard", "__piece"])
            .withColumns({"law": F.lit("rows"), "slot": (F.col("__start") + F.col("__within")).cast("long"), "grown_shard": F.lit(None).cast("int")})
            .drop("__piece", "__key", "__within", "__start"))
