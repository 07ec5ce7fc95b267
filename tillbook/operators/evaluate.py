"""Matcher outcome vs the injected ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.money import half_up_ratio
from tillbook.policy import Policy


def right_outcome(window: int) -> Column:
    """Is the outcome of a row of ``judged`` exactly what was injected, by method and posting ids?

    A clean batch, and one that was posted twice, is matched with its first
    posting alone, and the second of the two is reported as its twin; a split
    one with all its parts; a delayed one with its posting inside the window
    and as delayed with that same posting beyond it; a missing or wrong amount
    is not matched.
    """
    scenario, method, matched, own = (F.col(c) for c in ("injected_scenario", "match_method", "is_matched", "injected_posting_ids"))
    ids = F.array_sort("matched_posting_ids")
    first = F.array(F.get(own, F.lit(0)))
    single = matched & (method == "single_match") & (ids == first)
    return F.coalesce(
        F.when(scenario == "clean_match", single)
        .when(scenario == "duplicate_posting", single & F.col("twin_reported"))
        .when(scenario == "split_posting", matched & (method == "split_match") & (ids == F.array_sort(own)))
        .when((scenario == "bank_posting_delay") & (F.col("injected_delay_business_days") <= window), single)
        .when(scenario == "bank_posting_delay", ~matched & (method == "delayed") & (ids == first))
        .when(scenario.isin("missing_posting", "reserve_timing_error"), ~matched), F.lit(False))


def judged(truth: DataFrame, matches: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Truth, outcome and whether the batch's second posting was reported against its first."""
    twins = duplicates.select(F.col("unclaimed_posting_id").alias("_second"), F.col("duplicated_posting_id").alias("_first")).distinct() \
        .withColumn("_reported", F.lit(True))
    t = truth.select("settlement_batch_id", "injected_scenario", "injected_posting_ids", "injected_delay_business_days",
                     F.get("injected_posting_ids", F.lit(0)).alias("_first"), F.get("injected_posting_ids", F.lit(1)).alias("_second"))
    t = t.join(twins, ["_first", "_second"], "left").withColumn("twin_reported", F.coalesce("_reported", F.lit(False)))
    return t.join(matches.select("settlement_batch_id", "match_method", "is_matched", "matched_posting_ids"), "settlement_batch_id")


def matcher_accuracy(truth: DataFrame, matches: DataFrame, duplicates: DataFrame, policy: Policy = Policy()) -> DataFrame:
    ok = right_outcome(policy.window_business_days)
    g = judged(truth, matches, duplicates).groupBy("injected_scenario").agg(
        F.count(F.lit(1)).alias("batch_count"), F.sum(ok.cast("long")).alias("correct_count"))
    return g.withColumn("accuracy", half_up_ratio(F.col("correct_count"), F.col("batch_count"), 4, scale=0))
