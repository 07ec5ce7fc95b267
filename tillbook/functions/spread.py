"""Equi-joins on keys of which one may hold a large part of all rows.

A first pass counts the keys of the large side with a frequent-items sketch
(one small state per task, merged; no shuffle of the keys).  A key with more
rows than an average shuffle partition is hot.  The rows of a hot key are dealt
to so many pieces that a piece is a fraction of a partition, and the few rows
of the other side are repeated once per piece; all other keys join as they
are.  The sketch may miss a key near the threshold or overrate one: that moves
rows, never results, since both sides follow the same collected list, which is
bounded by ``MOST`` entries.

``lookup`` joins a small side by broadcast if it has at most ``limit`` rows,
which is counted, and by ``join`` beyond.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 1000             # hot keys at most; the largest ones
TRACKED = 20_000        # keys that a sketch holds
FINENESS = 4            # pieces per average partition
BROADCAST_ROWS = 200_000


def hot_keys(rows: DataFrame, keys: list[str], partitions: int | None = None) -> dict[int, int]:
    """Hash of the key -> number of pieces, for keys with more rows than an average partition."""
    partitions = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if partitions < 2:
        return {}
    key = F.xxhash64(*keys).alias("key")
    most = min(MOST, partitions)
    found = rows.select(key).agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(key, {most}, {TRACKED})").alias("top")).first()
    n, top = found["n"], found["top"] or []
    return {r["item"]: min(FINENESS * partitions, math.ceil(FINENESS * partitions * r["count"] / n)) for r in top if r["count"] * partitions > n}


def join(large: DataFrame, small: DataFrame, keys: list[str], spread: list[str], how: str = "inner",
         hot: dict[int, int] | None = None) -> DataFrame:
    """``large`` join ``small`` on equally named ``keys``; hot keys of ``large`` are dealt out by ``spread``.

    ``how``: inner, left, left_semi or left_anti (a right row that is repeated
    must not be kept for itself).  ``hot``: the list, if it is known.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no such join of a repeated right side: {how}")
    hot = hot_keys(large, keys) if hot is None else hot
    if not hot:
        return large.join(small, keys, how)
    pieces = _pieces(large, hot)
    left = _with_pieces(large, pieces, keys).withColumn(
        "_piece", F.coalesce(F.pmod(F.xxhash64(F.lit(7), *spread), F.col("_pieces")).cast("int"), F.lit(0))).drop("_pieces")
    right = _with_pieces(small, pieces, keys).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))).drop("_pieces")
    return left.join(right, [*keys, "_piece"], how).drop("_piece")


def lookup(large: DataFrame, small: DataFrame, keys: list[str], spread: list[str], how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a side that is small as a rule: broadcast if counted small, else dealt out.  ``small`` should be stored."""
    if small.limit(limit + 1).count() <= limit:
        return large.join(F.broadcast(small), keys, how)
    return join(large, small, keys, spread, how)


def _pieces(df: DataFrame, hot: dict[int, int]) -> DataFrame:
    """The list as a table, at most ``MOST`` rows."""
    entry: list[Column] = [F.struct(F.lit(k).cast("long").alias("_key"), F.lit(n).cast("int").alias("_pieces")) for k, n in hot.items()]
    return df.sparkSession.range(1).select(F.inline(F.array(*entry)))


def _with_pieces(rows: DataFrame, pieces: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn("_key", F.xxhash64(*keys)).join(F.broadcast(pieces), "_key", "left").drop("_key")
