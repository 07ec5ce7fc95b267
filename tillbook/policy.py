"""Reconciliation and finance policy, held once.

The matcher and the gold marts read the same frozen object, so a policy
change cannot reach one layer and miss the other.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must equal the reference): keys of the assumptions seed -> fields of the policy.
SEED_FIELDS = {
    "assumed_cost_of_funds_annual_rate": "cost_of_funds_rate",
    "cash_at_risk_aging_threshold_business_days": "cash_at_risk_threshold_days",
    "reconciliation_amount_tolerance_floor_usd": "tolerance_floor_usd",
    "reconciliation_amount_tolerance_pct": "tolerance_pct",
    "reconciliation_date_window_business_days": "window_business_days",
}


@dataclass(frozen=True)
class Policy:
    # Fixed values that must equal the reference policy for the same results.
    tolerance_floor_usd: Decimal = Decimal("1.00")
    tolerance_pct: Decimal = Decimal("0.001")
    window_business_days: int = 2
    cash_at_risk_threshold_days: int = 5
    cost_of_funds_rate: Decimal = Decimal("0.08")
    heartbeat_threshold_hours: int = 26
    interchange_fee_bps: int = 175
    network_fee_bps: int = 10
    reserve_hold_days: int = 90
    critical_break_usd: int = 5000
    break_rate_ceiling: float = 0.10
    volume_change_ceiling: float = 0.25

    def assumptions_df(self, spark: SparkSession) -> DataFrame:
        """The key/value finance-assumptions seed, built from this policy."""
        schema = T.StructType([
            T.StructField("assumption_key", T.StringType(), False),
            T.StructField("assumption_value", T.DecimalType(9, 4), False),
            T.StructField("description", T.StringType(), True),
            T.StructField("owner", T.StringType(), True),
        ])
        rows = [
            ("assumed_cost_of_funds_annual_rate", self.cost_of_funds_rate,
             "Annualized cost of capital used for the funding cost estimate", "VP Treasury"),
            ("cash_at_risk_aging_threshold_business_days", Decimal(self.cash_at_risk_threshold_days),
             "Breaks aged beyond this many business days count as cash-at-risk", "VP Treasury"),
            ("reconciliation_amount_tolerance_floor_usd", self.tolerance_floor_usd,
             "Absolute floor of the amount tolerance", "Controller / Accounting"),
            ("reconciliation_amount_tolerance_pct", self.tolerance_pct,
             "Proportional amount tolerance", "Controller / Accounting"),
            ("reconciliation_date_window_business_days", Decimal(self.window_business_days),
             "Business-day window in which a posting may match a batch", "Controller / Accounting"),
        ]
        return spark.createDataFrame(rows, schema)

    @staticmethod
    def from_assumptions(df: DataFrame, base: "Policy | None" = None) -> "Policy":
        """The policy with the values that an assumptions seed has; only the known keys are read.

        Each key must have one value: a seed that gives two is refused.
        """
        base = base or Policy()
        kv = {r["assumption_key"]: (r["low"], r["high"]) for r in
              df.where(F.col("assumption_key").isin(*SEED_FIELDS)).groupBy("assumption_key")
              .agg(F.min("assumption_value").alias("low"), F.max("assumption_value").alias("high")).collect()}
        torn = sorted(k for k, (low, high) in kv.items() if low != high)
        if torn:
            raise ValueError(f"assumptions with two values: {torn}")
        known = {field: kv[key][0] for key, field in SEED_FIELDS.items() if key in kv and kv[key][0] is not None}
        return replace(base, **{f: int(v) if isinstance(getattr(base, f), int) else v for f, v in known.items()})
