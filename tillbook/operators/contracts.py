"""Enforced schema contracts of the three contracted Gold marts.

A contract is a declared StructType (names, order-insensitive, and types);
``enforce`` compares it with the DataFrame's schema (no job runs) and raises
on any drift, so a type change cannot reach a consumer silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillbook.operators.quality import SchemaDrift, schema_contract

S, D, B, L = T.StringType(), T.DateType(), T.BooleanType(), T.LongType()
MONEY = T.DecimalType(18, 2)
# Fixed values (must equal the reference): precision and scale of the contracted rates.
COUNT_RATE, DOLLAR_RATE, ON_TIME_RATE, MEAN_DELAY = T.DecimalType(20, 4), T.DecimalType(38, 4), T.DecimalType(9, 6), T.DecimalType(9, 2)


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


RECONCILIATION_BREAKS = _struct(
    ("settlement_batch_id", S), ("merchant_id", S), ("industry", S), ("region", S), ("risk_tier", S),
    ("batch_date", D), ("expected_payout_date", D), ("break_first_identified_date", D), ("report_date", D),
    ("expected_settlement_amount", MONEY), ("actual_cash_received", MONEY), ("break_amount", MONEY),
    ("age_business_days", L), ("aging_bucket", S), ("is_cash_at_risk", B), ("funding_cost_estimate", MONEY),
    ("root_cause_hint", S))
DAILY_CASH_POSITION = _struct(
    ("batch_date", D), ("settlement_batch_count", L), ("matched_batch_count", L), ("break_count", L),
    ("total_expected_settlement_amount", MONEY), ("total_actual_cash_received", MONEY),
    ("unresolved_break_amount", MONEY), ("break_rate_count_basis", COUNT_RATE),
    ("break_rate_dollar_basis", DOLLAR_RATE), ("reconciliation_match_rate", DOLLAR_RATE))
MERCHANT_SETTLEMENT_SLA = _struct(
    ("merchant_id", S), ("business_name", S), ("industry", S), ("region", S), ("state", S), ("risk_tier", S),
    ("contracted_settlement_speed_days", L), ("settlement_batch_count", L), ("on_time_batch_count", L),
    ("exception_batch_count", L), ("on_time_settlement_rate", ON_TIME_RATE),
    ("avg_settlement_delay_business_days", MEAN_DELAY),
    ("max_settlement_delay_business_days", L), ("exception_amount_usd", MONEY),
    ("total_expected_settlement_amount", MONEY), ("run_id", S), ("as_of_date", D))

CONTRACTS = {"reconciliation_breaks": RECONCILIATION_BREAKS, "daily_cash_position": DAILY_CASH_POSITION,
             "merchant_settlement_sla": MERCHANT_SETTLEMENT_SLA}


def enforce(df: DataFrame, name: str) -> DataFrame:
    drift = schema_contract(df, CONTRACTS[name])
    if drift:
        raise SchemaDrift(f"{name}: {drift}")
    return df
