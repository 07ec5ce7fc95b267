"""Duplicate bank postings: unclaimed, same merchant/day/amount as a claimed one.

"Claimed" = listed on any match row (true matches and break diagnostics).
Postings meet their claims in one anti join; the unclaimed it leaves then
meet every claimed twin of their (merchant, day, amount), which a bit table of
theirs finds without a shuffle of the others. The claimed side of a key is small - a match row lists a posting of
its own merchant, and a merchant has one batch a day - while the unclaimed
side may be any size (a bank that sends one credit thousands of times), so a
hot key's unclaimed rows are dealt out in pieces.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions import sieve, spread
from tillbook.operators.matching import posting_claims

TWIN = ["merchant_id", "posting_date", "amount"]
CELLS = 1 << 20  # of the sieves of unclaimed postings and of those beside them


def duplicate_postings(matches: DataFrame, postings: DataFrame,
                       persist: Callable[[DataFrame, str], DataFrame] = lambda d, name: d) -> DataFrame:
    """One row per unclaimed posting and claimed twin, as the smallest batch id that lists the twin."""
    claims = posting_claims(matches).where(F.col("settlement_batch_id").isNotNull())
    p = postings.select("posting_id", *TWIN)
    unclaimed = persist(p.join(claims.select("posting_id"), "posting_id", "left_anti")
                        .withColumnRenamed("posting_id", "unclaimed_posting_id"), "unclaimed_postings")
    beside = persist(sieve.keep(p, persist(sieve.build(unclaimed, TWIN, CELLS), "unclaimed_sieve"), TWIN, CELLS), "beside_unclaimed")
    listed = sieve.keep(claims, persist(sieve.build(beside, ["posting_id"], CELLS), "beside_sieve"), ["posting_id"], CELLS)
    twins = beside.join(listed.groupBy("posting_id").agg(F.min("settlement_batch_id").alias("duplicated_against_batch_id")), "posting_id").select(
        *TWIN, F.col("posting_id").alias("duplicated_posting_id"), "duplicated_against_batch_id")
    return spread.join(unclaimed, twins, TWIN, ["unclaimed_posting_id"]).select(
        "unclaimed_posting_id", *TWIN, "duplicated_posting_id", "duplicated_against_batch_id")
