"""The build's checks (C1-C21 of the survey), bound to the models they ask.

``DECLARED`` lists the plain tests of every model: key, columns without
nulls, accepted values, references. ``audits`` adds the pipeline's own
assertions and folds everything asked of one model into one pass over it.
``frames`` says where a model's rows come from: from a Pipeline (``models.frames``)
or from a run folder that isn't published yet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.operators import audit
from tillbook.operators.audit import Comparison, Reference, Rule, TableAudit
from tillbook.operators.masking import BANNED_COLUMNS
from tillbook.operators.matching import posting_claims
from tillbook.operators.ops import hours_between
from tillbook.plans.pipeline import Pipeline
from tillbook.sources import adapter
from tillbook.sources.landing import ts_ntz

# Fixed values (must equal the reference): accepted values of the models.
RISK_TIERS = ["standard", "elevated", "high"]
MATCH_METHODS = ["single_match", "split_match", "delayed", "unmatched_closest_candidate", "missing_posting"]
CHANNELS = ["card_present", "ecommerce"]
CHANNEL_GROUPS = ["In-Person", "Online", "Other"]
AGING_BUCKETS = ["0-1", "2-3", "4-7", "8-14", "15+"]
SEVERITIES = ["critical", "high", "medium", "low"]
_MERCHANT = {"industry": [i for i, _ in adapter.INDUSTRY_MCC], "mcc": [m for _, m in adapter.INDUSTRY_MCC],
             "region": adapter.REGIONS, "employer_size_class": adapter.SIZE_CLASSES, "risk_tier": RISK_TIERS,
             "settlement_speed_business_days": [1, 2]}

# model -> (key, columns without nulls, accepted values, references as column -> (model, column))
DECLARED: dict[str, tuple[tuple[str, ...], list[str], dict[str, list], dict[str, tuple[str, str]]]] = {
    "dim_date": (("date_day",), ["date_day"], {}, {}),
    "dim_merchant": (("merchant_id",), ["merchant_id"], _MERCHANT, {}),
    "dim_merchant_history": ((), ["merchant_id", "valid_from", "valid_to"], _MERCHANT, {}),
    "dim_payment_channel": (("payment_channel",), ["payment_channel", "payment_channel_group"],
                            {"payment_channel": CHANNELS, "payment_channel_group": CHANNEL_GROUPS}, {}),
    "fct_transaction": (("transaction_id",), ["transaction_id", "merchant_id"],
                        {"transaction_type": ["sale", "refund"], "payment_channel": CHANNELS},
                        {"merchant_id": ("dim_merchant", "merchant_id")}),
    "fct_settlement_batch": (("settlement_batch_id",), ["settlement_batch_id", "expected_settlement_amount"], {}, {}),
    "fct_bank_movement": (("posting_id",), ["posting_id"], {}, {}),
    "fct_reserve_event": ((), ["merchant_id", "event_type", "amount"], {"event_type": ["hold", "release"]},
                          {"merchant_id": ("dim_merchant", "merchant_id")}),
    "fct_returns_adjustment": (("adjustment_id",), ["adjustment_id"], {"reason_code": adapter.REASON_CODES}, {}),
    "int_reconciliation_matches": (("settlement_batch_id",), ["settlement_batch_id", "is_matched"], {"match_method": MATCH_METHODS}, {}),
    "fct_duplicate_postings": (("unclaimed_posting_id",),
                               ["unclaimed_posting_id", "duplicated_posting_id", "duplicated_against_batch_id"], {}, {}),
    "fct_reconciliation_breaks": (("settlement_batch_id",), ["settlement_batch_id", "merchant_id"], {"aging_bucket": AGING_BUCKETS}, {}),
    "fct_daily_cash_position": (("batch_date",), ["batch_date"], {}, {}),
    "fct_funding_cost_summary": (("report_date", "industry", "region", "risk_tier"), ["report_date", "cash_at_risk_amount"], {}, {}),
    "fct_merchant_exception_trends": (("merchant_id",), ["merchant_id"], {}, {}),
    "fct_merchant_settlement_sla": (("merchant_id",), ["merchant_id", "settlement_batch_count", "on_time_settlement_rate"], {}, {}),
    "fct_payment_mix_context": (("segment",), ["segment", "internal_avg_ticket_usd", "benchmark_collection_year"],
                                {"segment_kind": ["roll_up", "acceptance_channel"]}, {}),
    "fct_duplicate_posting_exceptions": (("unclaimed_posting_id",), ["unclaimed_posting_id"],
                                         {"severity": ["critical", "high"], "triage_status": ["new"]}, {}),
    "fct_exception_queue": (("settlement_batch_id",), ["settlement_batch_id"],
                            {"severity": SEVERITIES, "triage_status": ["new", "resolved"]}, {}),
    "vw_exception_queue_masked": ((), ["merchant_token"], {}, {}),
}
# Names that differ from <kind>_<model>[_<column>].
_NAMES = {
    ("unique", "fct_settlement_batch"): "unique_settlement_batch_id",
    ("unique", "fct_bank_movement"): "unique_posting_id",
    ("unique", "fct_funding_cost_summary"): "unique_combination_funding_summary",
    ("not_null", "fct_settlement_batch", "expected_settlement_amount"): "not_null_expected_settlement_amount",
    ("accepted_values", "dim_merchant", "risk_tier"): "accepted_values_risk_tier",
    ("accepted_values", "int_reconciliation_matches", "match_method"): "accepted_values_match_method",
    ("relationships", "fct_transaction", "merchant_id"): "relationships_transaction_merchant",
    ("relationships", "fct_reserve_event", "merchant_id"): "relationships_reserve_event_merchant",
}
# An analyst's own states are worth a look, not a stop: the queue keeps them by design.
_WARN = {("accepted_values", "fct_exception_queue", "triage_status")}


def check_name(*what: str) -> str:
    return _NAMES.get(what, "_".join(what))


def severity(*what: str) -> str:
    return audit.WARN if what in _WARN else audit.ERROR


def audits(p: Pipeline, frames: Callable[[str], DataFrame], heartbeat: bool = True) -> tuple[list[TableAudit], list[Comparison], list[DataFrame]]:
    """Tables, comparisons and one-row frames of the whole report; the dead-man's switch only with ``heartbeat``."""
    pol, money = p.policy, F.col("expected_settlement_amount")
    claims = lambda: posting_claims(frames("int_reconciliation_matches"))
    tolerance = lambda: F.greatest(F.lit(pol.tolerance_floor_usd), F.lit(pol.tolerance_pct) * F.abs(money)) + F.lit(0.01)
    formula = ("gross_sales_volume - same_day_refunds - interchange_fees - network_fees - processing_fees - reserve_held"
               " + reserve_released - returns_adjustments_amount")
    rows = {"rows": ("rows", lambda: F.lit(1))}
    rules: dict[str, list[Rule]] = {
        "fct_settlement_batch": [Rule("settlement_formula", lambda: F.abs(money - F.expr(formula)) > F.lit(0.01))],
        "int_reconciliation_matches": [Rule("matched_within_tolerance",
                                            lambda: F.col("is_matched") & (F.abs(money - F.col("actual_cash_received")) > tolerance()))],
        "fct_reconciliation_breaks": [Rule("aging_sla_breach", lambda: F.col("aging_bucket") == "15+", audit.WARN)],
        "fct_daily_cash_position": [Rule("daily_break_rate_ceiling", lambda: F.col("break_rate_dollar_basis") > pol.break_rate_ceiling,
                                         audit.WARN)],
        "fct_merchant_settlement_sla": [audit.within("accepted_range_on_time_rate", "on_time_settlement_rate", 0, 1)],
    }
    references: dict[str, list[Reference]] = {
        "fct_duplicate_postings": [Reference("duplicates_are_unclaimed", "unclaimed_posting_id", claims, "posting_id", present=False)],
        "vw_exception_queue_masked": [Reference("masked_tokens_are_no_merchants", "merchant_token", lambda: frames("dim_merchant"),
                                                "merchant_id", present=False)],
    }
    measures = {
        "fct_settlement_batch": rows | {"total": ("sum", lambda: money)},
        "int_reconciliation_matches": rows,
        "fct_reconciliation_breaks": rows,
        "fct_transaction": {"latest": ("max", lambda: F.col("_ingestion_timestamp"))},
    }
    tables = []
    for model, (key, filled, values, refs) in DECLARED.items():
        declared = [audit.not_null(model, c, check_name("not_null", model, c)) for c in filled]
        declared += [audit.accepted(model, c, v, check_name("accepted_values", model, c), severity("accepted_values", model, c))
                     for c, v in values.items()]
        known = [Reference(check_name("relationships", model, c), c, lambda m=m: frames(m), pc) for c, (m, pc) in refs.items()]
        tables.append(TableAudit(
            model, lambda m=model: frames(m), key, check_name("unique", model) if key else "", (*declared, *rules.get(model, ())),
            (*known, *references.get(model, ())), measures.get(model, {})))
    tables += [
        TableAudit("claims", lambda: posting_claims(frames("int_reconciliation_matches"), matched_only=True), ("posting_id",),
                   "no_double_claimed_postings"),
        TableAudit("bronze_batches", lambda: p.bronze("settlement_batches"), measures={"total": ("sum", lambda: money)}),
    ]
    identifying = lambda: len([c for c in frames("vw_exception_queue_masked").columns if c.lower() in BANNED_COLUMNS])
    comparisons = [
        Comparison("equal_rowcount_matches_batches",
                   lambda: (F.col("int_reconciliation_matches__rows") != F.col("fct_settlement_batch__rows")).cast("int")),
        Comparison("control_total_bronze_silver",
                   lambda: (F.abs(F.col("bronze_batches__total") - F.col("fct_settlement_batch__total")) > F.lit(0.01)).cast("int")),
        Comparison("break_volume_stable", lambda: (
            F.abs(F.col("fct_reconciliation_breaks__rows") - F.col("prior_breaks")) / F.col("prior_breaks") > pol.volume_change_ceiling
        ).cast("int"), audit.WARN),
        Comparison("masked_view_no_identity", lambda: F.col("masked_tokens_are_no_merchants") + F.lit(identifying())),
        Comparison("source_freshness_transactions", lambda: audit.stale(F.col("fct_transaction__latest"), p.now, 26, 50, audit.WARN),
                   audit.WARN),
        Comparison("source_expired_transactions", lambda: audit.stale(F.col("fct_transaction__latest"), p.now, 26, 50)),
    ]
    prior = p.telemetry.where((F.col("node_name") == "fct_reconciliation_breaks") & (F.col("node_resource_type") == "model")
                              & (F.col("status") == "success") & F.col("rows_affected").isNotNull())
    extra = [prior.agg(F.max_by("rows_affected", "run_started_at").alias("prior_breaks"))]
    if heartbeat:
        extra.append(p.heartbeat.select("last_run_completed_at", "last_run_node_failures"))
        comparisons.append(Comparison("pipeline_not_silent", lambda: F.when(
            F.col("last_run_completed_at").isNull() | (F.col("last_run_node_failures") > 0)
            | (hours_between(F.col("last_run_completed_at"), ts_ntz(p.now)) > pol.heartbeat_threshold_hours), 1).otherwise(0)))
    return tables, comparisons, extra


def quality_report(p: Pipeline, frames: Callable[[str], DataFrame], heartbeat: bool = True) -> DataFrame:
    return audit.report(*audits(p, frames, heartbeat))
