"""Open breaks: amount, age in business days, bucket, cash-at-risk, funding cost.

The report date is the latest window end over all batches (a scalar
subquery, evaluated once and inlined as a value; no join). Age is the
business-seq distance from the day the break was identified to the report
date. Risk tier is taken as of that day from the SCD2 history (half-open
validity), falling back to the current tier before the history starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.money import MONEY, funding_cost, money
from tillbook.operators import calendar as cal_ops
from tillbook.policy import Policy

# Fixed values (must equal the reference aging buckets): upper bounds in business days.
AGING_BUCKETS = [(1, "0-1"), (3, "2-3"), (7, "4-7"), (14, "8-14")]
AGING_OVERFLOW = "15+"


def aging_bucket(age):
    expr = None
    for upper, label in AGING_BUCKETS:
        expr = F.when(age <= upper, label) if expr is None else expr.when(age <= upper, label)
    return expr.otherwise(AGING_OVERFLOW)


def reconciliation_breaks(matches: DataFrame, cal: DataFrame, merchants: DataFrame, history: DataFrame,
                          policy: Policy = Policy()) -> DataFrame:
    report_date = matches.agg(F.max("window_end_date")).scalar()
    seq = cal_ops.seq_of(cal, "_d", "_seq")
    report_seq = seq.where(F.col("_d") == report_date).agg(F.max("_seq")).scalar()

    br = matches.where(~F.col("is_matched")).select(
        "settlement_batch_id", "merchant_id", "batch_date", "expected_payout_date",
        F.col("window_end_date").alias("break_first_identified_date"),
        "expected_settlement_amount",
        F.col("actual_cash_received").cast(MONEY).alias("actual_cash_received"),
        money(F.abs(F.col("expected_settlement_amount") - F.coalesce("actual_cash_received", F.lit(0))))
        .alias("break_amount"),
        F.col("match_method").alias("root_cause_hint"))
    # inner: a break without a window end (calendar too short) has no age
    aged = cal_ops.add_seq(br, cal, "break_first_identified_date", "_id_seq", how="inner") \
        .withColumn("age_business_days", (F.lit(report_seq) - F.col("_id_seq")).cast("long")) \
        .withColumn("report_date", F.lit(report_date).cast("date")).drop("_id_seq")

    mer = merchants.select("merchant_id", "industry", "region", F.col("risk_tier").alias("_current_tier"))
    hist = history.select(F.col("merchant_id").alias("_hm"), F.col("risk_tier").alias("_hist_tier"),
                          "valid_from", "valid_to")
    ts = F.col("break_first_identified_date").cast("timestamp_ntz")
    j = aged.join(mer, "merchant_id").join(
        hist, (F.col("merchant_id") == F.col("_hm")) & (ts >= F.col("valid_from")) & (ts < F.col("valid_to")), "left")
    age = F.col("age_business_days")
    return j.select(
        "settlement_batch_id", "merchant_id", "industry", "region",
        F.coalesce("_hist_tier", "_current_tier").alias("risk_tier"),
        "batch_date", "expected_payout_date", "break_first_identified_date", "report_date",
        "expected_settlement_amount", "actual_cash_received", "break_amount", "age_business_days",
        aging_bucket(age).alias("aging_bucket"),
        (age > policy.cash_at_risk_threshold_days).alias("is_cash_at_risk"),
        funding_cost(F.col("break_amount"), age, policy.cost_of_funds_rate).alias("funding_cost_estimate"),
        "root_cause_hint")
