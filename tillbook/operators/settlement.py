"""Daily volume rollup, settlement batch build and reserve ledger.

All three are set-based: the per-merchant reserve "queue" of the original
row loop becomes a one-day range frame hold_days back (a hold on day d is
released by the batch on exactly d + hold_days, if there is one), so
nothing walks rows in order and no second copy of the batches is joined.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import sieve
from tillbook.functions.calendar import day_digits
from tillbook.functions.money import MONEY, bps_fee, money
from tillbook.operators import calendar as cal_ops
from tillbook.policy import Policy

RETURN_CELLS = 1 << 20  # of the sieve of days that returns go back to


def daily_volume(transactions: DataFrame) -> DataFrame:
    """Per (merchant, day): gross sales, refunds (positive), transaction count.

    A refund-only day is kept. One hash aggregate with map-side partial
    aggregation, so a hot merchant contributes one row per task, not per sale.
    """
    sale = F.col("transaction_type") == "sale"
    refund = F.col("transaction_type") == "refund"
    return (transactions.groupBy("merchant_id", F.col("transaction_date").alias("batch_date"))
            .agg(money(F.coalesce(F.sum(F.when(sale, F.col("amount"))), F.lit(0))).alias("gross_sales_volume"),
                 money(-F.coalesce(F.sum(F.when(refund, F.col("amount"))), F.lit(0))).alias("same_day_refunds"),
                 F.count(F.lit(1)).alias("transaction_count")))


def returns_adjustments(drawn: DataFrame, daily: DataFrame) -> DataFrame:
    """Returns as a share of what their merchant sold on the earlier day they go back to.

    ``drawn``: adjustment_id, merchant_id, adjustment_date, lag_days,
    pct_points, reason_code. The amount is ``pct_points`` % of that day's gross
    sales; without sales on that day there is nothing to return, and the row
    goes. An equi-join on (merchant, day), unique on the volume's side, of which
    a bit table of the days gone back to drops the rest before it is shuffled.
    """
    day = ["merchant_id", "original_batch_date"]
    earlier = daily.where(F.col("gross_sales_volume") > 0).select(
        "merchant_id", F.col("batch_date").alias("original_batch_date"), F.col("gross_sales_volume").alias("_gross"))
    back = drawn.withColumn("original_batch_date", F.date_sub("adjustment_date", F.col("lag_days")))
    earlier = sieve.keep(earlier, sieve.build(back, day, RETURN_CELLS), day, RETURN_CELLS)
    share = F.col("pct_points").cast("decimal(3,0)") * F.lit(Decimal("0.01"))
    return back.join(earlier, ["merchant_id", "original_batch_date"]).select(
        "adjustment_id", "merchant_id", "adjustment_date", "original_batch_date",
        money(F.round(F.col("_gross") * share, 2)).alias("amount"), "reason_code")


def settlement_batches(daily: DataFrame, merchants: DataFrame, returns: DataFrame, cal: DataFrame,
                       policy: Policy = Policy()) -> DataFrame:
    """Expected payout per (merchant, day).

    expected = gross - refunds - interchange - network - processing
               - reserve_held + reserve_released - returns
    payout date = batch date + settlement speed business days.
    """
    params = merchants.select("merchant_id", "reserve_rate_bps", "processing_fee_bps",
                              "settlement_speed_business_days")
    gross = F.col("gross_sales_volume")
    b = daily.join(params, "merchant_id").withColumn("reserve_held", bps_fee(gross, F.col("reserve_rate_bps")))

    # several adjustments can land on one merchant-day: summed before, they come as rows of their own
    # into the merchant's window, so that the batches are shuffled once, and their fees after it
    adj = (returns.where(F.col("adjustment_date").isNotNull()).groupBy("merchant_id", F.col("adjustment_date").alias("batch_date"))
           .agg(money(F.sum("amount")).alias("_returns")))
    b = b.withColumn("_batch", F.lit(True)).unionByName(adj, allowMissingColumns=True)

    # reserve released today = reserve held by the same merchant exactly hold_days ago: a range
    # frame of one day, hold_days back. A merchant has one batch and one sum of adjustments per day, so a
    # window partition holds at most two rows per calendar day, however hot the merchant.
    day = F.datediff("batch_date", F.lit("1970-01-01").cast("date"))
    by_day = Window.partitionBy("merchant_id").orderBy(day)
    exactly_then = by_day.rangeBetween(-policy.reserve_hold_days, -policy.reserve_hold_days)
    b = (b.withColumn("reserve_released", money(F.coalesce(F.sum("reserve_held").over(exactly_then), F.lit(0))))
         .withColumn("returns_adjustments_amount", money(F.coalesce(F.max("_returns").over(by_day.rangeBetween(0, 0)), F.lit(0))))
         .where("_batch").drop("_batch", "_returns")
         .withColumn("interchange_fees", bps_fee(gross, policy.interchange_fee_bps))
         .withColumn("network_fees", bps_fee(gross, policy.network_fee_bps))
         .withColumn("processing_fees", bps_fee(gross, F.col("processing_fee_bps"))))

    expected = (gross - F.col("same_day_refunds") - F.col("interchange_fees") - F.col("network_fees")
                - F.col("processing_fees") - F.col("reserve_held") + F.col("reserve_released")
                - F.col("returns_adjustments_amount"))
    b = b.withColumn("expected_settlement_amount", money(expected))
    b = cal_ops.next_business_day(b, cal, "batch_date", F.col("settlement_speed_business_days"),
                                  "expected_payout_date")
    # 'BATCH-<merchant number>-<yyyymmdd>' for MER-nnnnnn ids, else the merchant id itself
    mid = F.col("merchant_id")
    mkey = F.when(mid.rlike("^MER-[0-9]+$"), F.substring(mid, 5, 20).cast("long").cast("string")).otherwise(mid)
    batch_id = F.concat_ws("-", F.lit("BATCH"), mkey, day_digits(F.col("batch_date")))
    return b.select(
        batch_id.alias("settlement_batch_id"), "merchant_id", "batch_date", "transaction_count",
        "gross_sales_volume", "same_day_refunds", "interchange_fees", "network_fees", "processing_fees",
        "reserve_held", "reserve_released", "returns_adjustments_amount", "expected_settlement_amount",
        "expected_payout_date")


def reserve_events(batches: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Hold / release ledger rows (no key: one row per event)."""
    holds = batches.where(F.col("reserve_held") > 0).select(
        "merchant_id", F.lit("hold").alias("event_type"), F.col("batch_date").alias("event_date"),
        F.col("reserve_held").alias("amount"),
        F.date_add("batch_date", policy.reserve_hold_days).alias("related_date"))
    releases = batches.where(F.col("reserve_released") > 0).select(
        "merchant_id", F.lit("release").alias("event_type"), F.col("batch_date").alias("event_date"),
        F.col("reserve_released").alias("amount"),
        F.date_sub("batch_date", policy.reserve_hold_days).alias("related_date"))
    return holds.unionByName(releases)


def formula_violations(batches: DataFrame, tolerance_cents: int = 1) -> DataFrame:
    """Batches whose expected amount deviates from the settlement formula."""
    recomputed = (F.col("gross_sales_volume") - F.col("same_day_refunds") - F.col("interchange_fees")
                  - F.col("network_fees") - F.col("processing_fees") - F.col("reserve_held")
                  + F.col("reserve_released") - F.col("returns_adjustments_amount"))
    return batches.where(F.abs(F.col("expected_settlement_amount") - recomputed)
                         > F.lit(tolerance_cents).cast(MONEY) / 100)
