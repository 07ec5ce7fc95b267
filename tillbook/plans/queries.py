"""Registered queries: a Spark plan and, where SQL can express it, its oracle.

Each Spark entry takes a ``Pipeline`` (one per session and input folder) and
returns a DataFrame; column names and types equal the oracle's. Array columns
are exposed as sorted, comma-joined strings. Every query has an oracle.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions.hashing import row_hash_sql
from tillbook.operators import calendar as cal_ops
from tillbook.operators import contracts, marts, silver
from tillbook.plans import oracle as O
from tillbook.plans.pipeline import Pipeline

QUERIES: dict[str, Callable[[Pipeline], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = O.query(sql)
        return fn
    return deco


def ids(c: str = "matched_posting_ids"):
    return F.array_join(F.array_sort(F.col(c)), ",").alias(c)


def ratio_sql(num: str, den: str, places: int, scale: int = 2) -> str:
    """SQL twin of functions.money.half_up_ratio."""
    k = 10 ** scale
    a, b = f"CAST(abs(({num}) * {k}) AS HUGEINT)", f"CAST(abs(({den}) * {k}) AS HUGEINT)"
    return (f"CASE WHEN {b} = 0 THEN NULL ELSE CAST(sign({num}) * sign({den}) AS DOUBLE) * "
            f"CAST(({a} * {2 * 10 ** places} + {b}) // ({b} * 2) AS DOUBLE) / {float(10 ** places)} END")


def dec_ratio_sql(num: str, den: str, places: int, precision: int = 18, scale: int = 2) -> str:
    """SQL twin of functions.money.half_up_decimal."""
    k = 10 ** scale
    a, b = f"CAST(abs(({num}) * {k}) AS HUGEINT)", f"CAST(abs(({den}) * {k}) AS HUGEINT)"
    q = f"(({a} * {2 * 10 ** places} + {b}) // ({b} * 2))"
    signed = f"(CASE WHEN sign({num}) * sign({den}) < 0 THEN -{q} ELSE {q} END)"
    unit = f"CAST(1e-{places} AS DECIMAL({places + 1},{places}))"
    return (f"CAST(CASE WHEN {b} = 0 THEN NULL ELSE CAST({signed} AS DECIMAL(38,0)) * {unit} END "
            f"AS DECIMAL({precision},{places}))")


LINEAGE_SQL = "'ops_adapter' AS _source_system, TIMESTAMP '2024-01-31 04:00:00' AS _ingestion_timestamp, " \
              "'run-00000000-0000-0000-0000-000000000001' AS _batch_id"

# ------------------------------------------------------------------ calendar
register("dim_date", "SELECT * FROM cal")(lambda p: p.calendar)


@register("federal_holidays", """
SELECT DISTINCT holiday_date, CAST(year(holiday_date) AS INTEGER) AS year FROM hol_all
WHERE holiday_date IN (SELECT date_day FROM cal_days)""")
def _federal_holidays(p: Pipeline) -> DataFrame:
    return p.calendar.where("is_federal_holiday").select(F.col("date_day").alias("holiday_date"), "year")


@register("next_business_day", """
SELECT t.d AS from_date, n.n AS business_days_ahead,
       CASE WHEN n.n = 0 THEN t.d ELSE f.first_day END AS next_business_day
FROM (SELECT DISTINCT transaction_date AS d FROM txn) t
CROSS JOIN (SELECT CAST(n AS INTEGER) AS n FROM range(0, 4) r(n)) n
LEFT JOIN cal c ON c.date_day = t.d LEFT JOIN cal_first f ON f.seq = c.business_day_seq + n.n""")
def _nbd(p: Pipeline) -> DataFrame:
    days = p.transactions.select(F.col("transaction_date").alias("from_date")).distinct()
    days = days.select("from_date", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("business_days_ahead"))
    return cal_ops.next_business_day(days, p.calendar, "from_date", F.col("business_days_ahead"), "next_business_day")


@register("business_days_between", """
SELECT b.settlement_batch_id, b.batch_date, b.expected_payout_date,
       greatest(cp.business_day_seq - cb.business_day_seq, 0) AS payout_lag_business_days,
       greatest(cb.business_day_seq - cp.business_day_seq, 0) AS reverse_business_days
FROM batches b LEFT JOIN cal cb ON cb.date_day = b.batch_date LEFT JOIN cal cp ON cp.date_day = b.expected_payout_date""")
def _bdb(p: Pipeline) -> DataFrame:
    b = p.batches.select("settlement_batch_id", "batch_date", "expected_payout_date")
    b = cal_ops.business_days_between(b, p.calendar, "batch_date", "expected_payout_date", "payout_lag_business_days")
    return cal_ops.business_days_between(b, p.calendar, "expected_payout_date", "batch_date", "reverse_business_days")


# ------------------------------------------------------------------ silver
register("silver_merchant", f"""
SELECT merchant_id, business_name, industry, mcc, region, state, employer_size_class, risk_tier, onboarding_date,
       reserve_rate_bps, processing_fee_bps, settlement_speed_business_days, avg_ticket_usd, {LINEAGE_SQL}
FROM merchants""")(lambda p: p.dim_merchant)
register("silver_transaction", f"""
SELECT transaction_id, merchant_id, transaction_date, transaction_timestamp, transaction_type,
       channel AS payment_channel, amount, {LINEAGE_SQL} FROM txn""")(
    lambda p: silver.fct_transaction(p.bronze("transactions")))
register("silver_settlement_batch", f"SELECT *, {LINEAGE_SQL} FROM batches")(
    lambda p: silver.fct_settlement_batch(p.bronze("settlement_batches")))
register("silver_bank_movement", f"SELECT *, {LINEAGE_SQL} FROM postings")(
    lambda p: silver.fct_bank_movement(p.bronze("bank_movements")))
register("silver_reserve_event", f"SELECT *, {LINEAGE_SQL} FROM reserve_ev")(
    lambda p: silver.fct_reserve_event(p.bronze("reserve_events")))
register("silver_returns_adjustment", f"SELECT *, {LINEAGE_SQL} FROM returns_adj")(
    lambda p: silver.fct_returns_adjustment(p.bronze("returns_adjustments")))
O.cte("dim_channel", """
SELECT DISTINCT channel AS payment_channel,
       CASE channel WHEN 'card_present' THEN 'In-Person' WHEN 'ecommerce' THEN 'Online' ELSE 'Other' END
           AS payment_channel_group FROM txn""")
register("dim_payment_channel", "SELECT * FROM dim_channel")(lambda p: silver.dim_payment_channel(p.transactions))

# ------------------------------------------------------------------ settlement
register("daily_volume", "SELECT * FROM daily")(lambda p: p.daily_volume)
register("settlement_batches", "SELECT * FROM batches")(lambda p: p.batches)
register("reserve_events", "SELECT * FROM reserve_ev")(lambda p: p.reserve_events)
register("returns_adjustments", "SELECT * FROM returns_adj")(lambda p: p.returns)
register("bank_movements", "SELECT * FROM postings")(lambda p: p.bank_movements)

# ------------------------------------------------------------------ matcher
register("recon_matches", """
SELECT settlement_batch_id, merchant_id, batch_date, expected_payout_date, window_end_date,
       expected_settlement_amount, actual_cash_received, array_to_string(list_sort(matched_posting_ids), ',')
       AS matched_posting_ids, match_method, is_matched FROM matches""")(
    lambda p: p.matches.withColumn("matched_posting_ids", ids()).drop("actual_settlement_date"))
register("recon_candidates", """
SELECT settlement_batch_id, posting_id, posting_date, posting_amount, amount_diff, date_diff FROM in_window""")(
    lambda p: p.recon.candidates.select("settlement_batch_id", "posting_id", "posting_date", "posting_amount",
                                        "amount_diff", "date_diff"))
register("recon_single_matches", "SELECT settlement_batch_id, posting_id, matched_amount FROM agreed")(lambda p: p.recon.single_matches)
register("recon_pass_one", """
SELECT settlement_batch_id, a.posting_id AS single_posting_id, a.matched_amount AS single_amount, a.posting_date AS single_posting_date,
       near.posting_id AS closest_posting_id, near.amount AS closest_posting_amount, near.a AS closest_amount_diff
FROM closest LEFT JOIN agreed a USING (settlement_batch_id)""")(lambda p: p.recon.pass_one)


@register("recon_split_matches", """
SELECT settlement_batch_id, summed_amount, posting_count, array_to_string(ids, ',') AS matched_posting_ids FROM whole_sums""")
def _split(p: Pipeline) -> DataFrame:
    lines = p.recon.split_lines.groupBy("settlement_batch_id").agg(
        F.collect_list("posting_id").alias("matched_posting_ids"))
    return p.recon.split_matches.join(lines, "settlement_batch_id").select(
        "settlement_batch_id", "summed_amount", "posting_count", ids())


register("recon_late_candidates", """
SELECT settlement_batch_id, late_posting_id, late_posting_date, late_posting_amount FROM late""")(
    lambda p: p.recon.late_candidates)
register("recon_break_methods", """
SELECT settlement_batch_id, actual_cash_received AS matched_amount,
       array_to_string(matched_posting_ids, ',') AS matched_posting_ids, match_method
FROM matches WHERE NOT is_matched""")(
    lambda p: p.recon.breaks.select("settlement_batch_id", F.col("matched_amount").cast("decimal(18,2)"),
                                    ids(), "match_method"))

# ------------------------------------------------------------------ gold
O.cte("mart_cash", f"""
SELECT batch_date, count(*) AS settlement_batch_count,
       CAST(sum(CASE WHEN is_matched THEN 1 ELSE 0 END) AS BIGINT) AS matched_batch_count,
       CAST(sum(CASE WHEN NOT is_matched THEN 1 ELSE 0 END) AS BIGINT) AS break_count,
       CAST(sum(expected_settlement_amount) AS DECIMAL(18,2)) AS total_expected_settlement_amount,
       CAST(sum(CASE WHEN is_matched THEN actual_cash_received ELSE 0 END) AS DECIMAL(18,2)) AS total_actual_cash_received,
       CAST(sum(CASE WHEN NOT is_matched THEN abs(expected_settlement_amount - coalesce(actual_cash_received, 0))
                ELSE 0 END) AS DECIMAL(18,2)) AS unresolved_break_amount,
       {dec_ratio_sql("sum(CASE WHEN NOT is_matched THEN 1 ELSE 0 END)", "count(*)", 4, 20, 0)} AS break_rate_count_basis,
       {dec_ratio_sql("sum(CASE WHEN NOT is_matched THEN abs(expected_settlement_amount - coalesce(actual_cash_received, 0)) ELSE 0 END)",
                      "sum(expected_settlement_amount)", 4, 38)} AS break_rate_dollar_basis,
       {dec_ratio_sql("sum(CASE WHEN is_matched THEN expected_settlement_amount ELSE 0 END)",
                      "sum(expected_settlement_amount)", 4, 38)} AS reconciliation_match_rate
FROM matches GROUP BY batch_date""")
register("daily_cash_position", "SELECT * FROM mart_cash")(lambda p: p.daily_cash_position)

register("ground_truth_crosstab", """
SELECT t.injected_scenario, m.match_method, m.is_matched, count(*) AS batch_count
FROM truth t JOIN matches m USING (settlement_batch_id) GROUP BY 1, 2, 3""")(
    lambda p: p.ground_truth.join(p.matches, "settlement_batch_id")
    .groupBy("injected_scenario", "match_method", "is_matched").agg(F.count(F.lit(1)).alias("batch_count")))

# ------------------------------------------------------------------ history
register("merchant_history", "SELECT * FROM hist")(lambda p: p.merchant_history)

# ------------------------------------------------------------------ breaks and marts
register("reconciliation_breaks", "SELECT * FROM breaks")(lambda p: p.breaks)


def _cut(col: str):
    def fn(p: Pipeline) -> DataFrame:
        return p.breaks.groupBy(col).agg(
            F.count(F.lit(1)).alias("open_break_count"),
            F.sum("break_amount").cast("decimal(18,2)").alias("total_break_amount"),
            F.sum(F.col("is_cash_at_risk").cast("long")).alias("cash_at_risk_break_count"),
            F.sum("funding_cost_estimate").cast("decimal(18,2)").alias("total_funding_cost_estimate"))
    return fn


for _c, _name in [("aging_bucket", "breaks_by_aging_bucket"), ("root_cause_hint", "breaks_by_root_cause")]:
    register(_name, f"""
SELECT {_c}, count(*) AS open_break_count, CAST(sum(break_amount) AS DECIMAL(18,2)) AS total_break_amount,
       CAST(sum(CASE WHEN is_cash_at_risk THEN 1 ELSE 0 END) AS BIGINT) AS cash_at_risk_break_count,
       CAST(sum(funding_cost_estimate) AS DECIMAL(18,2)) AS total_funding_cost_estimate
FROM breaks GROUP BY 1""")(_cut(_c))

O.cte("mart_funding", """
SELECT report_date, industry, region, risk_tier, count(*) AS open_break_count,
       CAST(sum(break_amount) AS DECIMAL(18,2)) AS total_break_amount,
       CAST(sum(CASE WHEN is_cash_at_risk THEN break_amount ELSE 0 END) AS DECIMAL(18,2)) AS cash_at_risk_amount,
       CAST(sum(funding_cost_estimate) AS DECIMAL(18,2)) AS total_funding_cost_estimate
FROM breaks GROUP BY 1, 2, 3, 4""")
register("funding_cost_summary", "SELECT * FROM mart_funding")(lambda p: marts.funding_cost_summary(p.breaks))

O.cte("mart_trends", f"""
SELECT mer.merchant_id, mer.business_name, mer.industry, mer.region, mer.risk_tier,
       count(*) AS open_break_count, CAST(sum(b.break_amount) AS DECIMAL(18,2)) AS total_break_amount,
       {ratio_sql("sum(b.age_business_days)", "count(*)", 1, 0)} AS avg_age_business_days,
       CAST(sum(CASE WHEN b.is_cash_at_risk THEN 1 ELSE 0 END) AS BIGINT) AS cash_at_risk_break_count,
       CAST(sum(CASE WHEN b.is_cash_at_risk THEN b.break_amount ELSE 0 END) AS DECIMAL(18,2)) AS cash_at_risk_amount,
       CAST(sum(b.funding_cost_estimate) AS DECIMAL(18,2)) AS total_funding_cost_estimate,
       min(md.root_cause_hint) AS most_common_root_cause
FROM breaks b JOIN merchants mer USING (merchant_id)
JOIN (SELECT merchant_id, min(root_cause_hint) AS root_cause_hint
      FROM (SELECT merchant_id, root_cause_hint, rank() OVER (PARTITION BY merchant_id ORDER BY count(*) DESC) AS rk
            FROM breaks GROUP BY 1, 2) r
      WHERE rk = 1 GROUP BY 1) md ON md.merchant_id = b.merchant_id
GROUP BY 1, 2, 3, 4, 5""")
register("merchant_exception_trends", "SELECT * FROM mart_trends")(lambda p: marts.merchant_exception_trends(p.breaks, p.merchants))

O.cte("sla", f"""
SELECT mer.merchant_id, mer.business_name, mer.industry, mer.region, mer.state, mer.risk_tier,
       mer.settlement_speed_business_days AS contracted_settlement_speed_days,
       count(*) AS settlement_batch_count,
       CAST(sum(CASE WHEN s.is_matched AND coalesce(s.delay, 0) <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_time_batch_count,
       CAST(sum(CASE WHEN NOT s.is_matched THEN 1 ELSE 0 END) AS BIGINT) AS exception_batch_count,
       {dec_ratio_sql("sum(CASE WHEN s.is_matched AND coalesce(s.delay, 0) <= 0 THEN 1 ELSE 0 END)", "count(*)", 6, 9, 0)}
           AS on_time_settlement_rate,
       {dec_ratio_sql("sum(s.delay)", "count(s.delay)", 2, 9, 0)} AS avg_settlement_delay_business_days,
       CAST(max(s.delay) AS BIGINT) AS max_settlement_delay_business_days,
       CAST(sum(CASE WHEN NOT s.is_matched THEN s.expected_settlement_amount ELSE 0 END) AS DECIMAL(18,2))
           AS exception_amount_usd,
       CAST(sum(s.expected_settlement_amount) AS DECIMAL(18,2)) AS total_expected_settlement_amount,
       'run-00000000-0000-0000-0000-000000000001' AS run_id, DATE '2002-03-31' AS as_of_date
FROM (SELECT m.merchant_id, m.expected_settlement_amount, m.is_matched,
             CASE WHEN m.is_matched THEN ca.business_day_seq - ce.business_day_seq END AS delay
      FROM matches m
      LEFT JOIN (SELECT u.settlement_batch_id, max(p.posting_date) AS settled
                 FROM (SELECT settlement_batch_id, unnest(matched_posting_ids) AS pid FROM matches WHERE is_matched) u
                 JOIN postings p ON p.posting_id = u.pid GROUP BY 1) st USING (settlement_batch_id)
      LEFT JOIN cal ce ON ce.date_day = m.expected_payout_date
      LEFT JOIN cal ca ON ca.date_day = st.settled) s
JOIN merchants mer USING (merchant_id)
GROUP BY 1, 2, 3, 4, 5, 6, 7""")
register("merchant_settlement_sla", "SELECT * FROM sla")(
    lambda p: contracts.enforce(marts.merchant_settlement_sla(p.matches, p.bank_movements, p.calendar, p.merchants,
                                                             p.run_id, p.as_of), "merchant_settlement_sla"))

register("duplicate_postings", "SELECT * FROM dups")(lambda p: p.duplicate_postings)
O.cte("mart_duplicates", """
SELECT d.unclaimed_posting_id, d.merchant_id, mer.business_name, mer.industry, mer.region, d.posting_date, d.amount,
       d.duplicated_posting_id, d.duplicated_against_batch_id,
       CASE WHEN d.amount >= 5000 THEN 'critical' ELSE 'high' END AS severity,
       'Treasury Ops' AS suggested_owner_role, 'new' AS triage_status
FROM dups d JOIN merchants mer USING (merchant_id)""")
register("duplicate_posting_exceptions", "SELECT * FROM mart_duplicates")(
    lambda p: marts.duplicate_posting_exceptions(p.duplicate_postings, p.merchants, p.policy))

# ------------------------------------------------------------------ queue
register("exception_queue", "SELECT * FROM queue")(lambda p: p.exception_queue)
register("exception_queue_second_run", "SELECT * FROM queue_merged")(lambda p: p.exception_queue_second_run)
O.cte("mart_masked", """
SELECT sha256(merchant_id) AS merchant_token, industry, region, risk_tier, batch_date, aging_bucket, severity,
       is_cash_at_risk, suggested_owner_role,
       CAST(round(break_amount, -2) AS DECIMAL(18,0)) AS break_amount_rounded,
       CAST(round(funding_cost_estimate, 0) AS DECIMAL(18,0)) AS funding_cost_estimate_rounded
FROM queue""")
register("exception_queue_masked", "SELECT * FROM mart_masked")(lambda p: p.exception_queue_masked)

# ------------------------------------------------------------------ ops
register("run_telemetry", "SELECT * FROM telemetry")(lambda p: p.telemetry)
register("run_heartbeat", """
SELECT (SELECT max(run_started_at) FROM telemetry) AS last_run_completed_at,
       (SELECT CAST(coalesce(sum(CASE WHEN status IN ('fail', 'error') THEN 1 ELSE 0 END), 0) AS BIGINT)
        FROM telemetry WHERE invocation_id = (SELECT invocation_id FROM last_inv)) AS last_run_node_failures,
       26 AS heartbeat_threshold_hours, TIMESTAMP '2024-01-31 06:00:00' AS heartbeat_written_at""")(
    lambda p: p.heartbeat)
register("run_summary", """
SELECT ld.batch_date AS latest_report_date, ld.settlement_batch_count, ld.break_count,
       ld.break_rate_dollar_basis, ld.reconciliation_match_rate,
       es.open_exception_count, es.critical_count, es.high_count, es.total_open_break_amount,
       es.total_funding_cost_estimate, ts.last_run_at, ts.last_run_test_failures,
       coalesce(ld.break_rate_dollar_basis > 0.10, false) AS sla_flag_break_rate_ceiling_breached,
       coalesce(es.critical_count > 0, false) AS sla_flag_critical_exceptions_open,
       coalesce(ts.last_run_test_failures > 0, false) AS sla_flag_last_run_had_failures
FROM (SELECT batch_date, settlement_batch_count, break_count,
             """ + dec_ratio_sql("unresolved_break_amount", "total_expected_settlement_amount", 4, 38) + """ AS break_rate_dollar_basis,
             """ + dec_ratio_sql("matched_expected", "total_expected_settlement_amount", 4, 38) + """ AS reconciliation_match_rate
      FROM daily_cash ORDER BY batch_date DESC LIMIT 1) ld
CROSS JOIN (SELECT count(*) AS open_exception_count,
                   CAST(sum(CASE WHEN severity = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_count,
                   CAST(sum(CASE WHEN severity = 'high' THEN 1 ELSE 0 END) AS BIGINT) AS high_count,
                   CAST(sum(break_amount) AS DECIMAL(18,2)) AS total_open_break_amount,
                   CAST(sum(funding_cost_estimate) AS DECIMAL(18,2)) AS total_funding_cost_estimate
            FROM queue_merged) es
CROSS JOIN (SELECT max(run_started_at) AS last_run_at,
                   CAST(sum(CASE WHEN status IN ('fail', 'error') THEN 1 ELSE 0 END) AS BIGINT) AS last_run_test_failures
            FROM telemetry WHERE invocation_id = (SELECT invocation_id FROM last_inv)) ts""")(lambda p: p.run_summary)

# ------------------------------------------------------------------ benchmark, BI, accuracy
from tillbook.operators import evaluate  # noqa: E402
from tillbook.sources import frps_sample  # noqa: E402


O.cte("frps_cells", frps_sample.values_sql())
_MEAS = [f"{m}_{y}" for y in (2015, 2018, 2021, 2024) for m in ("count", "value", "avg")]
O.cte("frps_rows", "SELECT * REPLACE (trim(label) AS label) FROM frps_cells WHERE label IS NOT NULL AND ("
      + " OR ".join(f"{m} IS NOT NULL" for m in _MEAS) + ")")
O.cte("frps_seg", "SELECT *, " + ", ".join(
    f"sum(CASE WHEN level < {k} THEN 1 ELSE 0 END) OVER (ORDER BY row_number ROWS UNBOUNDED PRECEDING) AS seg{k}"
    for k in range(6)) + " FROM frps_rows")
O.cte("frps_path", "SELECT *, concat_ws(' > ', " + ", ".join(
    f"CASE WHEN level >= {k} THEN last_value(CASE WHEN level = {k} THEN label END IGNORE NULLS) OVER "
    f"(PARTITION BY seg{k} ORDER BY row_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END"
    for k in range(6)) + ") AS category_path FROM frps_seg")
O.cte("frps", "\nUNION ALL\n".join(
    f"SELECT row_number, level AS hierarchy_level, label AS payment_type_label, category_path, {y} AS collection_year, "
    f"count_{y} AS count_billions, value_{y} AS value_trillions_usd, avg_{y} AS avg_transaction_amount_usd "
    f"FROM frps_path WHERE count_{y} IS NOT NULL OR value_{y} IS NOT NULL" for y in (2015, 2018, 2021, 2024)))
O.cte("mix_bc", """
SELECT CASE channel WHEN 'card_present' THEN 'In-Person' WHEN 'ecommerce' THEN 'Online' ELSE 'Other' END AS segment,
       count(*) AS transaction_count, sum(amount) AS gross
FROM txn WHERE transaction_type = 'sale' GROUP BY 1""")
O.cte("mix_fb", """
SELECT CAST(avg_transaction_amount_usd AS DECIMAL(18,2)) AS bavg, CAST(collection_year AS INTEGER) AS collection_year
FROM frps WHERE category_path = 'Total payments > Cards' AND collection_year = (SELECT max(collection_year) FROM frps)""")

_RUN = "'run-00000000-0000-0000-0000-000000000001' AS run_id, DATE '2002-03-31' AS as_of_date"
O.cte("mart_mix", f"""
SELECT 'Cards (all)' AS segment, 'roll_up' AS segment_kind, CAST(t.n AS BIGINT) AS transaction_count,
       CAST(t.g AS DECIMAL(18,2)) AS gross_volume_usd, CAST(1 AS DECIMAL(9,6)) AS internal_share_of_volume,
       {dec_ratio_sql('t.g', 't.n', 2)} AS internal_avg_ticket_usd, fb.bavg AS benchmark_avg_ticket_usd,
       CAST(1 AS DECIMAL(9,6)) AS benchmark_share_of_volume,
       CAST({dec_ratio_sql('t.g', 't.n', 2)} - fb.bavg AS DECIMAL(18,2)) AS avg_ticket_variance_usd,
       fb.collection_year AS benchmark_collection_year, {_RUN}
FROM (SELECT sum(transaction_count) AS n, sum(gross) AS g FROM mix_bc) t, mix_fb fb
UNION ALL
SELECT c.segment, 'acceptance_channel', CAST(c.transaction_count AS BIGINT), CAST(c.gross AS DECIMAL(18,2)),
       {dec_ratio_sql('c.gross', '(SELECT sum(gross) FROM mix_bc)', 6, precision=9)},
       {dec_ratio_sql('c.gross', 'c.transaction_count', 2)}, fb.bavg, CAST(NULL AS DECIMAL(9,6)),
       CAST({dec_ratio_sql('c.gross', 'c.transaction_count', 2)} - fb.bavg AS DECIMAL(18,2)),
       fb.collection_year, {_RUN}
FROM mix_bc c, mix_fb fb""")
register("payment_mix_context", "SELECT * FROM mart_mix")(lambda p: marts.payment_mix_context(p.transactions, p.frps, p.run_id, p.as_of))

_RATE = ratio_sql("matched_expected", "total_expected_settlement_amount", 4)
register("bi_measures", f"""
SELECT CAST(sum(total_expected_settlement_amount) AS DECIMAL(18,2)) AS total_expected_settlement,
       CAST(sum(total_actual_cash_received) AS DECIMAL(18,2)) AS total_actual_cash_received,
       round(sum({_RATE} * CAST(total_expected_settlement_amount AS DOUBLE))
             / sum(CAST(total_expected_settlement_amount AS DOUBLE)), 4) AS weighted_match_rate,
       (SELECT CAST(sum(unresolved_break_amount) AS DECIMAL(18,2)) FROM daily_cash
        WHERE batch_date = (SELECT max(batch_date) FROM daily_cash)) AS unresolved_break_amount_latest_day,
       {ratio_sql("CAST(sum(total_expected_settlement_amount) AS DECIMAL(18,2)) - CAST(sum(total_actual_cash_received) AS DECIMAL(18,2))",
                  "CAST(sum(total_expected_settlement_amount) AS DECIMAL(18,2))", 4)} AS break_rate_dollar_net,
       (SELECT CAST(sum(CASE WHEN is_cash_at_risk THEN 1 ELSE 0 END) AS BIGINT) FROM breaks) AS cash_at_risk_count,
       (SELECT CAST(sum(funding_cost_estimate) AS DECIMAL(18,2)) FROM breaks) AS funding_cost_estimate,
       max(batch_date) AS as_of_date
FROM daily_cash""")(lambda p: marts.bi_measures(p.daily_cash_position, p.breaks))
register("risk_matrix", """
SELECT industry, region, count(*) AS open_break_count, CAST(sum(break_amount) AS DECIMAL(18,2)) AS total_break_amount,
       CAST(sum(CASE WHEN is_cash_at_risk THEN 1 ELSE 0 END) AS BIGINT) AS cash_at_risk_count,
       CAST(sum(funding_cost_estimate) AS DECIMAL(18,2)) AS funding_cost_estimate
FROM breaks GROUP BY 1, 2""")(lambda p: marts.risk_matrix(p.breaks))
register("cash_trend", """
SELECT batch_date, total_expected_settlement_amount, total_actual_cash_received, break_count,
       (SELECT max(batch_date) FROM daily_cash) AS as_of_date FROM daily_cash""")(
    lambda p: marts.cash_trend(p.daily_cash_position))
register("matcher_accuracy", f"""
SELECT injected_scenario, count(*) AS batch_count, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS correct_count,
       {ratio_sql("sum(CASE WHEN ok THEN 1 ELSE 0 END)", "count(*)", 4, 0)} AS accuracy
FROM (SELECT t.injected_scenario, coalesce(CASE
               WHEN t.injected_scenario = 'clean_match' THEN m.match_method = 'single_match' AND m.matched_posting_ids = [t.stem || '-1']
               WHEN t.injected_scenario = 'duplicate_posting' THEN m.match_method = 'single_match' AND m.matched_posting_ids = [t.stem || '-1']
                    AND EXISTS (SELECT 1 FROM dups d WHERE d.unclaimed_posting_id = t.stem || '-2' AND d.duplicated_posting_id = t.stem || '-1')
               WHEN t.injected_scenario = 'split_posting' THEN m.match_method = 'split_match'
                    AND list_sort(m.matched_posting_ids) = [t.stem || '-1', t.stem || '-2']
               WHEN t.injected_scenario = 'bank_posting_delay'
                    THEN m.match_method = CASE WHEN t.shift <= 2 THEN 'single_match' ELSE 'delayed' END AND m.matched_posting_ids = [t.stem || '-1']
               ELSE NOT m.is_matched END, false) AS ok
      FROM truth t JOIN matches m USING (settlement_batch_id)) x
GROUP BY 1""")(lambda p: evaluate.matcher_accuracy(p.ground_truth, p.matches, p.duplicate_postings, p.policy))

# ------------------------------------------------------------------ bronze stamping
_BATCH_COLUMNS = ["settlement_batch_id", "merchant_id", "batch_date", "transaction_count", "gross_sales_volume", "same_day_refunds",
                  "interchange_fees", "network_fees", "processing_fees", "reserve_held", "reserve_released",
                  "returns_adjustments_amount", "expected_settlement_amount", "expected_payout_date"]
register("bronze_lineage", f"SELECT *, {row_hash_sql(*_BATCH_COLUMNS)} AS _row_hash, {LINEAGE_SQL} FROM batches")(
    lambda p: p.bronze("settlement_batches"))

# ------------------------------------------------------------------ quality
from tillbook.plans import checks as C  # noqa: E402

# where the models are found in SQL
_MODEL_SQL = {
    "dim_date": "cal", "dim_merchant": "merchants", "dim_merchant_history": "hist", "dim_payment_channel": "dim_channel",
    "fct_transaction": "(SELECT *, channel AS payment_channel FROM txn)", "fct_settlement_batch": "batches", "fct_bank_movement": "postings",
    "fct_reserve_event": "reserve_ev", "fct_returns_adjustment": "returns_adj", "int_reconciliation_matches": "matches",
    "fct_duplicate_postings": "dups", "fct_reconciliation_breaks": "breaks", "fct_daily_cash_position": "mart_cash",
    "fct_funding_cost_summary": "mart_funding", "fct_merchant_exception_trends": "mart_trends", "fct_merchant_settlement_sla": "sla",
    "fct_payment_mix_context": "mart_mix", "fct_duplicate_posting_exceptions": "mart_duplicates", "fct_exception_queue": "queue",
    "vw_exception_queue_masked": "mart_masked",
}


def _declared_sql() -> list[tuple[str, str, str]]:
    out = []
    for model, (key, filled, values, refs) in C.DECLARED.items():
        t = _MODEL_SQL[model]
        if key:
            cols = ", ".join(key)
            out.append((C.check_name("unique", model), "error", f"SELECT {cols} FROM {t} t GROUP BY {cols} HAVING count(*) > 1"))
        out += [(C.check_name("not_null", model, c), "error", f"SELECT 1 FROM {t} t WHERE {c} IS NULL") for c in filled]
        for c, accepted in values.items():
            listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in accepted)
            what = ("accepted_values", model, c)
            out.append((C.check_name(*what), C.severity(*what), f"SELECT 1 FROM {t} t WHERE {c} NOT IN ({listed})"))
        out += [(C.check_name("relationships", model, c), "error",
                 f"SELECT 1 FROM {t} t ANTI JOIN {_MODEL_SQL[m]} u ON u.{pc} = t.{c} WHERE t.{c} IS NOT NULL") for c, (m, pc) in refs.items()]
    return out


_TOL = "greatest(1.00, 0.001 * abs(expected_settlement_amount))"
_AGE = "date_diff('second', max(TIMESTAMP '2024-01-31 04:00:00'), TIMESTAMP '2024-01-31 06:00:00') / 3600.0"
_CHECK_SQL = _declared_sql() + [
    ("settlement_formula", "error", "SELECT 1 FROM batches WHERE abs(expected_settlement_amount - (gross_sales_volume "
     "- same_day_refunds - interchange_fees - network_fees - processing_fees - reserve_held + reserve_released "
     "- returns_adjustments_amount)) > 0.01"),
    ("equal_rowcount_matches_batches", "error",
     "SELECT 1 WHERE (SELECT count(*) FROM matches) <> (SELECT count(*) FROM batches)"),
    ("accepted_range_on_time_rate", "error",
     "SELECT 1 FROM sla WHERE on_time_settlement_rate < 0 OR on_time_settlement_rate > 1"),
    ("control_total_bronze_silver", "error", "SELECT 1 WHERE abs((SELECT round(sum(expected_settlement_amount), 2) "
     "FROM batches) - (SELECT round(sum(CAST(expected_settlement_amount AS DECIMAL(18,2))), 2) FROM batches)) > 0.01"),
    ("matched_within_tolerance", "error", f"SELECT 1 FROM matches WHERE is_matched AND "
     f"abs(expected_settlement_amount - actual_cash_received) > {_TOL} + 0.01"),
    ("no_double_claimed_postings", "error", "SELECT pid FROM (SELECT settlement_batch_id, unnest(matched_posting_ids) "
     "AS pid FROM matches WHERE is_matched) u GROUP BY 1 HAVING count(DISTINCT settlement_batch_id) > 1"),
    ("duplicates_are_unclaimed", "error", "SELECT 1 FROM dups WHERE unclaimed_posting_id IN (SELECT posting_id FROM "
     "claims)"),
    ("aging_sla_breach", "warn", "SELECT 1 FROM breaks WHERE aging_bucket = '15+'"),
    ("daily_break_rate_ceiling", "warn", "SELECT 1 FROM mart_cash WHERE break_rate_dollar_basis > 0.10"),
    ("break_volume_stable", "warn", "SELECT 1 FROM (SELECT arg_max(rows_affected, run_started_at) AS n FROM telemetry "
     "WHERE node_name = 'fct_reconciliation_breaks' AND node_resource_type = 'model' AND status = 'success' "
     "AND rows_affected IS NOT NULL) pr WHERE pr.n IS NOT NULL AND abs((SELECT count(*) FROM breaks) - pr.n) / pr.n "
     "> 0.25"),
    ("masked_tokens_are_no_merchants", "error",
     "SELECT 1 FROM mart_masked WHERE merchant_token IN (SELECT merchant_id FROM merchants)"),
    ("masked_view_no_identity", "error",
     "SELECT 1 FROM queue WHERE sha256(merchant_id) IN (SELECT merchant_id FROM merchants)"),
    ("pipeline_not_silent", "error", "SELECT 1 FROM (SELECT max(run_started_at) AS t FROM telemetry) l, "
     "(SELECT coalesce(sum(CASE WHEN status IN ('fail', 'error') THEN 1 ELSE 0 END), 0) AS f FROM telemetry "
     "WHERE invocation_id = (SELECT invocation_id FROM last_inv)) h WHERE l.t IS NULL OR f > 0 OR "
     "date_diff('hour', date_trunc('hour', l.t), TIMESTAMP '2024-01-31 06:00:00') > 26"),
    ("source_freshness_transactions", "warn", f"SELECT 1 FROM (SELECT {_AGE} AS age FROM txn) f WHERE age IS NULL OR age > 26"),
    ("source_expired_transactions", "error", f"SELECT 1 FROM (SELECT {_AGE} AS age FROM txn) f WHERE age IS NULL OR age > 50"),
]
_REPORT_SQL = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS check_name, '{s}' AS severity, (SELECT count(*) FROM ({q}) x) AS failures"
    for n, s, q in _CHECK_SQL)


@register("quality_report", f"""
SELECT check_name, severity, failures,
       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM ({_REPORT_SQL}) r""")
def _quality(p: Pipeline) -> DataFrame:
    from tillbook.plans.models import frames
    return C.quality_report(p, frames(p))
