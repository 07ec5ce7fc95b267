"""The models of a run: layer, name, what they need, and how a Pipeline builds them.

Listed in dependency order. ``BOUND`` names the Pipeline attribute that a
model's stored rows stand for, so that what comes later reads the stored rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillbook.operators import contracts, marts, masking, ops
from tillbook.operators import queue as queue_ops
from tillbook.operators import silver
from tillbook.plans.pipeline import Pipeline


@dataclass(frozen=True)
class Model:
    layer: str
    name: str
    needs: tuple[str, ...]
    build: Callable[[Pipeline], DataFrame]


def _sla(p: Pipeline) -> DataFrame:
    return contracts.enforce(marts.merchant_settlement_sla(p.stored_matches, p.bank_movements, p.calendar, p.merchants, p.run_id, p.as_of),
                             "merchant_settlement_sla")


MODELS = [
    Model("silver", "dim_date", (), lambda p: p.calendar),
    Model("silver", "dim_merchant", (), lambda p: p.dim_merchant),
    Model("silver", "dim_merchant_history", (), lambda p: p.merchant_history),
    Model("silver", "dim_payment_channel", (), lambda p: silver.dim_payment_channel(p.transactions)),
    Model("silver", "fct_transaction", (), lambda p: silver.fct_transaction(p.bronze("transactions"))),
    Model("silver", "fct_settlement_batch", (), lambda p: silver.fct_settlement_batch(p.bronze("settlement_batches"))),
    Model("silver", "fct_bank_movement", (), lambda p: silver.fct_bank_movement(p.bronze("bank_movements"))),
    Model("silver", "fct_reserve_event", (), lambda p: silver.fct_reserve_event(p.bronze("reserve_events"))),
    Model("silver", "fct_returns_adjustment", (), lambda p: silver.fct_returns_adjustment(p.bronze("returns_adjustments"))),
    Model("silver", "int_reconciliation_matches", ("fct_settlement_batch", "fct_bank_movement", "dim_date"), lambda p: p.stored_matches),
    Model("silver", "fct_duplicate_postings", ("int_reconciliation_matches", "fct_bank_movement"), lambda p: p.duplicate_postings),
    Model("gold", "fct_reconciliation_breaks", ("int_reconciliation_matches", "dim_date", "dim_merchant", "dim_merchant_history"),
          lambda p: p.breaks),
    Model("gold", "fct_daily_cash_position", ("int_reconciliation_matches",), lambda p: p.daily_cash_position),
    Model("gold", "fct_funding_cost_summary", ("fct_reconciliation_breaks",), lambda p: marts.funding_cost_summary(p.breaks)),
    Model("gold", "fct_merchant_exception_trends", ("fct_reconciliation_breaks", "dim_merchant"),
          lambda p: marts.merchant_exception_trends(p.breaks, p.merchants)),
    Model("gold", "fct_merchant_settlement_sla", ("int_reconciliation_matches", "fct_bank_movement", "dim_date", "dim_merchant"), _sla),
    Model("gold", "fct_payment_mix_context", ("fct_transaction",),
          lambda p: marts.payment_mix_context(p.transactions, p.frps, p.run_id, p.as_of)),
    Model("gold", "fct_duplicate_posting_exceptions", ("fct_duplicate_postings", "dim_merchant"),
          lambda p: marts.duplicate_posting_exceptions(p.duplicate_postings, p.merchants, p.policy)),
    Model("gold", "fct_exception_queue", ("fct_reconciliation_breaks", "dim_merchant"),
          lambda p: queue_ops.next_queue(p.stored_queue, p.breaks, p.merchants, p.policy)),
    Model("gold", "vw_exception_queue_masked", ("fct_exception_queue",), lambda p: masking.exception_queue_masked(p.current_queue)),
    Model("ops", "run_heartbeat", (), lambda p: p.heartbeat),
    Model("ops", "run_summary", ("fct_daily_cash_position", "fct_exception_queue"),
          lambda p: ops.run_summary(p.daily_cash_position, p.current_queue, p.telemetry, p.policy)),
]

BOUND = {
    "dim_date": "calendar",
    "int_reconciliation_matches": "matches",
    "fct_duplicate_postings": "duplicate_postings",
    "fct_reconciliation_breaks": "breaks",
    "fct_daily_cash_position": "daily_cash_position",
    "fct_exception_queue": "current_queue",
}


def frames(p: Pipeline) -> Callable[[str], DataFrame]:
    """Model name -> its rows as the Pipeline builds them (nothing is stored for it)."""
    by_name = {m.name: m for m in MODELS}
    return lambda name: by_name[name].build(p)
