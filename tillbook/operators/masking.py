"""Report-safe view of the queue: pseudonymous merchant token, coarse amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BANNED_COLUMNS = ["business_name", "merchant_id"]


def exception_queue_masked(queue: DataFrame) -> DataFrame:
    return queue.select(
        F.sha2(F.col("merchant_id"), 256).alias("merchant_token"),
        "industry", "region", "risk_tier", "batch_date", "aging_bucket", "severity", "is_cash_at_risk",
        "suggested_owner_role",
        F.round("break_amount", -2).cast("decimal(18,0)").alias("break_amount_rounded"),
        F.round("funding_cost_estimate", 0).cast("decimal(18,0)").alias("funding_cost_estimate_rounded"))
