"""Silver: typed passthroughs of Bronze (``_row_hash`` is not carried on)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.money import MONEY

CARRIED = ["_source_system", "_ingestion_timestamp", "_batch_id"]


def dim_merchant(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "merchant_id", "business_name", "industry", "mcc", "region", "state", "employer_size_class", "risk_tier",
        "onboarding_date", "reserve_rate_bps", "processing_fee_bps", "settlement_speed_business_days",
        "avg_ticket_usd", *CARRIED)


def fct_transaction(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "transaction_id", "merchant_id", F.col("transaction_date").cast("date").alias("transaction_date"),
        "transaction_timestamp", "transaction_type", F.col("channel").alias("payment_channel"),
        F.col("amount").cast(MONEY).alias("amount"), *CARRIED)


def fct_settlement_batch(bronze: DataFrame) -> DataFrame:
    money_cols = ["gross_sales_volume", "same_day_refunds", "interchange_fees", "network_fees", "processing_fees",
                  "reserve_held", "reserve_released", "returns_adjustments_amount", "expected_settlement_amount"]
    return bronze.select(
        "settlement_batch_id", "merchant_id", F.col("batch_date").cast("date").alias("batch_date"),
        "transaction_count", *[F.col(c).cast(MONEY).alias(c) for c in money_cols],
        F.col("expected_payout_date").cast("date").alias("expected_payout_date"), *CARRIED)


def fct_bank_movement(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "posting_id", "merchant_id", F.col("posting_date").cast("date").alias("posting_date"),
        F.col("amount").cast(MONEY).alias("amount"), "bank_reference", *CARRIED)


def fct_reserve_event(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "merchant_id", "event_type", F.col("event_date").cast("date").alias("event_date"),
        F.col("amount").cast(MONEY).alias("amount"), F.col("related_date").cast("date").alias("related_date"),
        *CARRIED)


def fct_returns_adjustment(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "adjustment_id", "merchant_id", F.col("adjustment_date").cast("date").alias("adjustment_date"),
        F.col("original_batch_date").cast("date").alias("original_batch_date"),
        F.col("amount").cast(MONEY).alias("amount"), "reason_code", *CARRIED)


def dim_payment_channel(transactions: DataFrame) -> DataFrame:
    """Distinct acceptance channels with their reporting group."""
    ch = F.col("channel")
    return transactions.select(ch.alias("payment_channel")).distinct().select(
        "payment_channel",
        F.when(F.col("payment_channel") == "card_present", "In-Person")
         .when(F.col("payment_channel") == "ecommerce", "Online").otherwise("Other").alias("payment_channel_group"))
