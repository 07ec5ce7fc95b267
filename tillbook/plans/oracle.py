"""DuckDB SQL oracle for every registered query.

The adapter, calendar, settlement build and matcher are written a second
time as plain SQL over the driver's pre-registered views. The matcher here
takes grouped minima of ordered structs and joins the choices, so it checks
the Spark plan (packed aggregates, banded late search) against a different
expression of the same rules.
"""

from __future__ import annotations

import re

# Ordered CTE bodies; every oracle query is "WITH <those it needs> SELECT ...".
_CTES: list[tuple[str, str]] = []
_STORED: set[str] = set()  # computed once, however often they are read


def cte(name: str, body: str, stored: bool = False) -> None:
    _CTES.append((name, body))
    if stored:
        _STORED.add(name)


def query(select: str) -> str:
    """The select behind those CTEs that it needs, directly or through others."""
    bodies, text, used = dict(_CTES), select, set()
    todo = [select]
    while todo:
        text = todo.pop()
        found = {w for w in re.findall(r"\w+", text) if w in bodies} - used
        used |= found
        todo += [bodies[n] for n in found]
    head = ",\n".join(f"{n} AS {'MATERIALIZED ' * (n in _STORED)}(\n{b}\n)" for n, b in _CTES if n in used)
    return f"WITH {head}\n{select}" if head else select


# ---------------------------------------------------------------- calendar
cte("span", """
SELECT date_trunc('month', min(CAST(l_shipdate AS DATE))) - INTERVAL 1 MONTH AS first_day,
       date_trunc('month', max(CAST(l_shipdate AS DATE))) + INTERVAL 5 MONTH - INTERVAL 1 DAY AS last_day FROM lineitem""")
cte("cal_days", """
SELECT CAST(unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_day FROM span""")
cte("hol_years", """
SELECT CAST(unnest(range(CAST(year(first_day) AS BIGINT), CAST(year(last_day) AS BIGINT) + 2)) AS INTEGER) AS y FROM span""")
cte("hol_firsts", """
SELECT y, make_date(y, 1, 1) AS jan1, make_date(y, 2, 1) AS feb1, make_date(y, 5, 31) AS may31,
       make_date(y, 9, 1) AS sep1, make_date(y, 10, 1) AS oct1, make_date(y, 11, 1) AS nov1
FROM hol_years""")
cte("hol_all", """
SELECT CASE dayofweek(d) WHEN 6 THEN d - 1 WHEN 0 THEN d + 1 ELSE d END AS holiday_date
FROM (SELECT make_date(y, 1, 1) AS d FROM hol_years UNION ALL SELECT make_date(y, 6, 19) FROM hol_years
      UNION ALL SELECT make_date(y, 7, 4) FROM hol_years UNION ALL SELECT make_date(y, 11, 11) FROM hol_years
      UNION ALL SELECT make_date(y, 12, 25) FROM hol_years) f
UNION ALL SELECT jan1 + CAST((1 - dayofweek(jan1) + 7) % 7 AS INTEGER) + 14 FROM hol_firsts
UNION ALL SELECT feb1 + CAST((1 - dayofweek(feb1) + 7) % 7 AS INTEGER) + 14 FROM hol_firsts
UNION ALL SELECT may31 - CAST((dayofweek(may31) - 1 + 7) % 7 AS INTEGER) FROM hol_firsts
UNION ALL SELECT sep1 + CAST((1 - dayofweek(sep1) + 7) % 7 AS INTEGER) FROM hol_firsts
UNION ALL SELECT oct1 + CAST((1 - dayofweek(oct1) + 7) % 7 AS INTEGER) + 7 FROM hol_firsts
UNION ALL SELECT nov1 + CAST((4 - dayofweek(nov1) + 7) % 7 AS INTEGER) + 21 FROM hol_firsts""")
cte("cal", """
SELECT date_day, day_of_week_num, day_name, is_weekend, is_federal_holiday, is_business_day, year, month, quarter,
       CAST(sum(CASE WHEN is_business_day THEN 1 ELSE 0 END)
            OVER (ORDER BY date_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS business_day_seq
FROM (
  SELECT c.date_day,
         CAST(dayofweek(c.date_day) AS INTEGER) AS day_of_week_num,
         left(dayname(c.date_day), 3) AS day_name,
         dayofweek(c.date_day) IN (0, 6) AS is_weekend,
         h.holiday_date IS NOT NULL AS is_federal_holiday,
         dayofweek(c.date_day) NOT IN (0, 6) AND h.holiday_date IS NULL AS is_business_day,
         CAST(year(c.date_day) AS INTEGER) AS year, CAST(month(c.date_day) AS INTEGER) AS month,
         CAST(quarter(c.date_day) AS INTEGER) AS quarter
  FROM cal_days c LEFT JOIN (SELECT DISTINCT holiday_date FROM hol_all) h ON h.holiday_date = c.date_day
) x""")
cte("cal_first", "SELECT business_day_seq AS seq, min(date_day) AS first_day, max(date_day) AS last_day FROM cal GROUP BY 1")

# ---------------------------------------------------------------- merchants
_TIER_PARAMS = """
  CASE risk_tier WHEN 'high' THEN 1200 WHEN 'elevated' THEN 800 ELSE 500 END::BIGINT AS reserve_rate_bps,
  CASE risk_tier WHEN 'high' THEN 75 WHEN 'elevated' THEN 55 ELSE 40 END::BIGINT AS processing_fee_bps,
  CASE risk_tier WHEN 'standard' THEN 1 ELSE 2 END::BIGINT AS settlement_speed_business_days"""
_MERCHANT_BASE = """
SELECT 'MER-' || printf('%06d', s.s_suppkey) AS merchant_id, s.s_name AS business_name,
  (['retail','restaurant_food_service','professional_services','ecommerce_online_retail','health_wellness',
    'home_trade_services','auto_services','other'])[CAST(s.s_suppkey % 8 AS INTEGER) + 1] AS industry,
  (['5311','5812','8742','5964','8099','1731','7538','5999'])[CAST(s.s_suppkey % 8 AS INTEGER) + 1] AS mcc,
  r.r_name AS region, n.n_name AS state,
  (['1-4','5-9','10-19','20-49','50-99','100-249','250-499','500+'])[CAST(s.s_suppkey % 8 AS INTEGER) + 1]
      AS employer_size_class,
  {tier} AS risk_tier,
  DATE '1994-01-01' + CAST(s.s_suppkey % 365 AS INTEGER) AS onboarding_date,
  CAST(20 + s.s_suppkey % 50 AS DOUBLE) AS avg_ticket_usd
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""
_TIER1 = ("CASE WHEN s.s_suppkey % 20 = 0 THEN 'high' WHEN s.s_suppkey % 20 IN (1, 2, 3) THEN 'elevated' "
          "ELSE 'standard' END")
_TIER2 = f"CASE WHEN s.s_suppkey % 10 = 4 THEN 'elevated' ELSE {_TIER1} END"
cte("merchants", f"SELECT *, {_TIER_PARAMS} FROM ({_MERCHANT_BASE.format(tier=_TIER2)}) m")
cte("merchants_v1", f"SELECT *, {_TIER_PARAMS} FROM ({_MERCHANT_BASE.format(tier=_TIER1)}) m")

# ---------------------------------------------------------------- transactions
cte("txn", """
SELECT 'TXN-' || l_orderkey || '-' || l_linenumber || '-' ||
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                     l_returnflag, l_linestatus, l_shipdate) AS transaction_id,
       'MER-' || printf('%06d', l_suppkey) AS merchant_id,
       CAST(l_shipdate AS DATE) AS transaction_date,
       l_shipdate AS transaction_timestamp,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'refund' ELSE 'sale' END AS transaction_type,
       CASE WHEN l_linestatus = 'F' THEN 'card_present' ELSE 'ecommerce' END AS channel,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -CAST(l_extendedprice AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount
FROM lineitem""")
# ---------------------------------------------------------------- settlement
cte("daily", """
SELECT merchant_id, transaction_date AS batch_date,
       CAST(coalesce(sum(CASE WHEN transaction_type = 'sale' THEN amount END), 0) AS DECIMAL(18,2)) AS gross_sales_volume,
       CAST(-coalesce(sum(CASE WHEN transaction_type = 'refund' THEN amount END), 0) AS DECIMAL(18,2)) AS same_day_refunds,
       count(*) AS transaction_count
FROM txn GROUP BY 1, 2""")
cte("returns_adj", """
SELECT d.adjustment_id, d.merchant_id, d.adjustment_date, v.batch_date AS original_batch_date,
       CAST(round(v.gross_sales_volume * CAST(d.pct_points AS DECIMAL(3,0)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS amount,
       d.reason_code
FROM (SELECT 'ADJ-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS adjustment_id,
             'MER-' || printf('%06d', l_suppkey) AS merchant_id, CAST(l_shipdate AS DATE) AS adjustment_date,
             CAST(1 + CAST(l_quantity AS BIGINT) % 21 AS INTEGER) AS lag_days, 2 + l_partkey % 7 AS pct_points,
             (['chargeback','customer_return','billing_dispute'])[CAST(l_partkey % 3 AS INTEGER) + 1] AS reason_code
      FROM lineitem WHERE l_returnflag = 'A' AND l_linenumber <= 3 AND l_quantity >= 30) d
JOIN daily v ON v.merchant_id = d.merchant_id AND v.batch_date = d.adjustment_date - d.lag_days AND v.gross_sales_volume > 0""")
_FEE = "CAST(round({a} * CAST({bps} AS DECIMAL(6,0)) * CAST(0.0001 AS DECIMAL(5,4)), 2) AS DECIMAL(18,2))"
cte("batch_fees", f"""
SELECT d.*, m.settlement_speed_business_days AS speed,
       {_FEE.format(a='d.gross_sales_volume', bps='m.reserve_rate_bps')} AS reserve_held,
       {_FEE.format(a='d.gross_sales_volume', bps='175')} AS interchange_fees,
       {_FEE.format(a='d.gross_sales_volume', bps='10')} AS network_fees,
       {_FEE.format(a='d.gross_sales_volume', bps='m.processing_fee_bps')} AS processing_fees
FROM daily d JOIN merchants m ON m.merchant_id = d.merchant_id""")
cte("batch_pre", """
SELECT b.*,
       CAST(coalesce(h.reserve_held, 0) AS DECIMAL(18,2)) AS reserve_released,
       CAST(coalesce(a.amt, 0) AS DECIMAL(18,2)) AS returns_adjustments_amount
FROM batch_fees b
LEFT JOIN batch_fees h ON h.merchant_id = b.merchant_id AND h.batch_date + 90 = b.batch_date
LEFT JOIN (SELECT merchant_id, adjustment_date, sum(amount) AS amt FROM returns_adj GROUP BY 1, 2) a
       ON a.merchant_id = b.merchant_id AND a.adjustment_date = b.batch_date""")
cte("batches", """
SELECT 'BATCH-' || CAST(substr(b.merchant_id, 5) AS BIGINT) || '-' || strftime(b.batch_date, '%Y%m%d') AS settlement_batch_id,
       b.merchant_id, b.batch_date, b.transaction_count, b.gross_sales_volume, b.same_day_refunds,
       b.interchange_fees, b.network_fees, b.processing_fees, b.reserve_held, b.reserve_released,
       b.returns_adjustments_amount,
       CAST(b.gross_sales_volume - b.same_day_refunds - b.interchange_fees - b.network_fees - b.processing_fees
            - b.reserve_held + b.reserve_released - b.returns_adjustments_amount AS DECIMAL(18,2))
           AS expected_settlement_amount,
       CASE WHEN b.speed = 0 THEN b.batch_date ELSE f.first_day END AS expected_payout_date
FROM batch_pre b
LEFT JOIN cal c ON c.date_day = b.batch_date
LEFT JOIN cal_first f ON f.seq = c.business_day_seq + b.speed""", stored=True)
cte("reserve_ev", """
SELECT merchant_id, 'hold' AS event_type, batch_date AS event_date, reserve_held AS amount, batch_date + 90 AS related_date
FROM batches WHERE reserve_held > 0
UNION ALL
SELECT merchant_id, 'release', batch_date, reserve_released, batch_date - 90 FROM batches WHERE reserve_released > 0""")

# ---------------------------------------------------------------- bank side
cte("scen", """
SELECT b.*, x,
       CASE WHEN x < 50 THEN 'bank_posting_delay' WHEN x < 80 THEN 'reserve_timing_error'
            WHEN x < 95 THEN 'missing_posting' WHEN x < 105 THEN 'split_posting'
            WHEN x < 110 THEN 'duplicate_posting' ELSE 'clean_match' END AS scenario
FROM (SELECT *, (CAST(substr(merchant_id, 5) AS BIGINT) * 7919
                 + CAST(batch_date - DATE '1995-01-01' AS BIGINT) * 104729) % 1000 AS x FROM batches) b""")
cte("scen_dates", """
SELECT s.*, CASE WHEN shift = 0 THEN s.expected_payout_date ELSE f.first_day END AS alt_date
FROM (SELECT *, CASE WHEN scenario = 'bank_posting_delay' THEN 1 + x % 3
                     WHEN scenario = 'split_posting' AND x % 2 = 1 THEN 1 ELSE 0 END AS shift FROM scen) s
LEFT JOIN cal c ON c.date_day = s.expected_payout_date
LEFT JOIN cal_first f ON f.seq = c.business_day_seq + s.shift""")
cte("postings_raw", """
SELECT merchant_id, batch_date, 1 AS n,
       CASE WHEN scenario = 'bank_posting_delay' THEN alt_date ELSE expected_payout_date END AS posting_date,
       CAST(CASE WHEN scenario = 'reserve_timing_error'
                 THEN expected_settlement_amount - round(CAST(0.5 AS DECIMAL(2,1)) * greatest(reserve_held,
                          CAST(0.01 AS DECIMAL(3,2)) * abs(expected_settlement_amount), CAST(5 AS DECIMAL(3,0))), 2)
                 WHEN scenario = 'split_posting' THEN round(CAST(0.4 AS DECIMAL(2,1)) * expected_settlement_amount, 2)
                 ELSE expected_settlement_amount END AS DECIMAL(18,2)) AS amount
FROM scen_dates WHERE scenario <> 'missing_posting' AND expected_payout_date IS NOT NULL
UNION ALL
SELECT merchant_id, batch_date, 2,
       CASE WHEN scenario = 'split_posting' THEN alt_date ELSE expected_payout_date END,
       CAST(CASE WHEN scenario = 'split_posting'
                 THEN expected_settlement_amount - round(CAST(0.4 AS DECIMAL(2,1)) * expected_settlement_amount, 2)
                 ELSE expected_settlement_amount END AS DECIMAL(18,2))
FROM scen_dates WHERE scenario IN ('split_posting', 'duplicate_posting') AND expected_payout_date IS NOT NULL""")
cte("postings", """
SELECT 'POST-' || CAST(substr(merchant_id, 5) AS BIGINT) || '-' || strftime(batch_date, '%Y%m%d') || '-' || n AS posting_id,
       merchant_id, posting_date, amount,
       upper(substr(sha256('POST-' || CAST(substr(merchant_id, 5) AS BIGINT) || '-' || strftime(batch_date, '%Y%m%d')
                           || '-' || n), 1, 12)) AS bank_reference
FROM postings_raw""", stored=True)
cte("truth", """
SELECT settlement_batch_id, merchant_id, scenario AS injected_scenario, expected_settlement_amount, shift,
       'POST-' || CAST(substr(merchant_id, 5) AS BIGINT) || '-' || strftime(batch_date, '%Y%m%d') AS stem FROM scen_dates""")

cte("batches_r1", "SELECT * FROM batches WHERE batch_date < DATE '2001-07-01'")
cte("postings_r1", "SELECT * FROM postings WHERE posting_date < DATE '2001-07-01'")


# ---------------------------------------------------------------- matcher
def matcher_ctes(sfx: str = "", batches: str = "batches", postings: str = "postings") -> None:
    """The matching rules over the given inputs, by grouped minima; CTE names end in ``sfx``.

    Every first choice is the smallest of an ordered struct, a match is a pair
    that both sides chose, and the three outcomes meet in one row per batch.
    """
    # what a batch expects, how far off a posting may be, and its last day
    cte(f"expected{sfx}", f"""
SELECT b.*, greatest(1.00, 0.001 * abs(expected_settlement_amount)) AS allowed, last_day.window_end_date
FROM (SELECT settlement_batch_id, merchant_id, batch_date, expected_payout_date, expected_settlement_amount FROM {batches}) b
JOIN cal ON cal.date_day = b.expected_payout_date
LEFT JOIN (SELECT business_day_seq - 2 AS seq, max(date_day) AS window_end_date FROM cal GROUP BY 1) last_day
  ON last_day.seq = cal.business_day_seq""")
    cte(f"in_window{sfx}", f"""
SELECT settlement_batch_id, batch_date, expected_settlement_amount, allowed, posting_id, posting_date, amount AS posting_amount,
       CAST(abs(amount - expected_settlement_amount) AS DECIMAL(18,2)) AS amount_diff,
       CAST(abs(posting_date - expected_payout_date) AS INTEGER) AS date_diff
FROM {postings} JOIN expected{sfx} USING (merchant_id)
WHERE posting_date >= expected_payout_date AND posting_date <= window_end_date""", stored=True)
    # both sides name their nearest within tolerance
    cte(f"agreed{sfx}", f"""
SELECT settlement_batch_id, nearest.posting_id AS posting_id, nearest.amount AS matched_amount, nearest.day AS posting_date
FROM (SELECT settlement_batch_id, min({{'a': amount_diff, 'd': date_diff, 'posting_id': posting_id, 'amount': posting_amount,
                                        'day': posting_date}}) AS nearest
      FROM in_window{sfx} WHERE amount_diff <= allowed GROUP BY 1) of_batch
JOIN (SELECT posting_id AS chosen, min({{'a': amount_diff, 'd': date_diff, 'batch': settlement_batch_id}}) AS nearest_batch
      FROM in_window{sfx} WHERE amount_diff <= allowed GROUP BY 1) of_posting
  ON chosen = nearest.posting_id AND nearest_batch.batch = settlement_batch_id""", stored=True)
    # what is left may add up; a posting belongs to the earliest batch whose sum fits, and a sum stands if it owns all its parts
    cte(f"sums{sfx}", f"""
SELECT settlement_batch_id, min(batch_date) AS batch_date, list(posting_id ORDER BY posting_id) AS ids,
       CAST(sum(posting_amount) AS DECIMAL(18,2)) AS summed_amount, count(*) AS posting_count
FROM in_window{sfx} ANTI JOIN agreed{sfx} USING (settlement_batch_id)
WHERE posting_id NOT IN (SELECT posting_id FROM agreed{sfx})
GROUP BY settlement_batch_id, expected_settlement_amount, allowed
HAVING count(*) >= 2 AND abs(sum(posting_amount) - expected_settlement_amount) <= allowed""")
    cte(f"whole_sums{sfx}", f"""
SELECT settlement_batch_id, any_value(ids) AS ids, any_value(summed_amount) AS summed_amount, any_value(posting_count) AS posting_count
FROM (SELECT *, unnest(ids) AS part FROM sums{sfx}) parts
JOIN (SELECT part, min({{'day': batch_date, 'batch': settlement_batch_id}}) AS owner
      FROM (SELECT settlement_batch_id, batch_date, unnest(ids) AS part FROM sums{sfx}) o GROUP BY part) owners USING (part)
GROUP BY settlement_batch_id HAVING bool_and(owner.batch = settlement_batch_id)""")
    cte(f"late{sfx}", f"""
SELECT settlement_batch_id, soonest.posting_id AS late_posting_id, soonest.day AS late_posting_date, soonest.amount AS late_posting_amount
FROM (SELECT settlement_batch_id, min({{'day': p.posting_date, 'posting_id': p.posting_id, 'amount': p.amount}}) AS soonest
      FROM expected{sfx} e ANTI JOIN agreed{sfx} USING (settlement_batch_id) ANTI JOIN whole_sums{sfx} USING (settlement_batch_id)
      JOIN {postings} p ON p.merchant_id = e.merchant_id AND p.posting_date > e.window_end_date
       AND p.amount BETWEEN e.expected_settlement_amount - e.allowed AND e.expected_settlement_amount + e.allowed
      GROUP BY settlement_batch_id) s""")
    cte(f"closest{sfx}", f"""
SELECT settlement_batch_id, min({{'a': amount_diff, 'day': posting_date, 'posting_id': posting_id, 'amount': posting_amount}}) AS near
FROM in_window{sfx} GROUP BY 1""")
    cte(f"matches{sfx}", f"""
SELECT e.settlement_batch_id, e.merchant_id, e.batch_date, e.expected_payout_date, e.window_end_date, e.expected_settlement_amount,
       CAST(coalesce(a.matched_amount, w.summed_amount, l.late_posting_amount, c.near.amount) AS DECIMAL(18,2)) AS actual_cash_received,
       coalesce(w.ids, list_filter([coalesce(a.posting_id, l.late_posting_id, c.near.posting_id)], lambda x: x IS NOT NULL)) AS matched_posting_ids,
       CASE WHEN a.posting_id IS NOT NULL THEN 'single_match' WHEN w.ids IS NOT NULL THEN 'split_match'
            WHEN l.late_posting_id IS NOT NULL THEN 'delayed' WHEN c.near IS NOT NULL THEN 'unmatched_closest_candidate'
            ELSE 'missing_posting' END AS match_method,
       a.posting_id IS NOT NULL OR w.ids IS NOT NULL AS is_matched
FROM expected{sfx} e LEFT JOIN agreed{sfx} a USING (settlement_batch_id) LEFT JOIN whole_sums{sfx} w USING (settlement_batch_id)
LEFT JOIN late{sfx} l USING (settlement_batch_id) LEFT JOIN closest{sfx} c USING (settlement_batch_id)""")


matcher_ctes()
matcher_ctes("_r1", "batches_r1", "postings_r1")

# ---------------------------------------------------------------- history
_ATTRS = ("merchant_id, business_name, industry, mcc, region, state, employer_size_class, risk_tier, onboarding_date, "
          "reserve_rate_bps, processing_fee_bps, settlement_speed_business_days, avg_ticket_usd")
_CHANGED = " OR ".join(f"v1.{c} IS DISTINCT FROM v2.{c}" for c in
                       ["risk_tier", "reserve_rate_bps", "processing_fee_bps", "settlement_speed_business_days"])
cte("hist", f"""
SELECT v1.*, TIMESTAMP '1997-01-01 00:00:00' AS valid_from,
       CASE WHEN v2.merchant_id IS NOT NULL AND ({_CHANGED}) THEN TIMESTAMP '1999-01-01 00:00:00'
            ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to
FROM (SELECT {_ATTRS} FROM merchants_v1) v1 LEFT JOIN merchants v2 USING (merchant_id)
UNION ALL
SELECT v2.*, TIMESTAMP '1999-01-01 00:00:00', TIMESTAMP '9999-12-31 00:00:00'
FROM (SELECT {_ATTRS} FROM merchants) v2 LEFT JOIN merchants_v1 v1 USING (merchant_id)
WHERE v1.merchant_id IS NULL OR ({_CHANGED})""")


# ---------------------------------------------------------------- breaks and queue
def breaks_ctes(sfx: str = "") -> None:
    m = "matches" + sfx
    cte("rep_seq" + sfx, f"""
SELECT r.report_date, c.business_day_seq AS rseq
FROM (SELECT max(window_end_date) AS report_date FROM {m}) r JOIN cal c ON c.date_day = r.report_date""")
    cte("brk_rows" + sfx, f"""
SELECT x.settlement_batch_id, x.merchant_id, x.batch_date, x.expected_payout_date,
       x.window_end_date AS break_first_identified_date, x.expected_settlement_amount, x.actual_cash_received,
       CAST(abs(x.expected_settlement_amount - coalesce(x.actual_cash_received, 0)) AS DECIMAL(18,2)) AS break_amount,
       x.match_method AS root_cause_hint, r.report_date, CAST(r.rseq - c.business_day_seq AS BIGINT) AS age_business_days
FROM {m} x CROSS JOIN rep_seq{sfx} r JOIN cal c ON c.date_day = x.window_end_date
WHERE NOT x.is_matched""")
    cte("breaks" + sfx, f"""
SELECT b.settlement_batch_id, b.merchant_id, mer.industry, mer.region, coalesce(h.risk_tier, mer.risk_tier) AS risk_tier,
       b.batch_date, b.expected_payout_date, b.break_first_identified_date, b.report_date,
       b.expected_settlement_amount, b.actual_cash_received, b.break_amount, b.age_business_days,
       CASE WHEN b.age_business_days <= 1 THEN '0-1' WHEN b.age_business_days <= 3 THEN '2-3'
            WHEN b.age_business_days <= 7 THEN '4-7' WHEN b.age_business_days <= 14 THEN '8-14' ELSE '15+' END
           AS aging_bucket,
       b.age_business_days > 5 AS is_cash_at_risk,
       CAST(CAST((CAST(b.break_amount * 100 AS HUGEINT) * b.age_business_days * 800 * 2 + 3650000) // 7300000
                 AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS funding_cost_estimate,
       b.root_cause_hint
FROM brk_rows{sfx} b JOIN merchants mer USING (merchant_id)
LEFT JOIN hist h ON h.merchant_id = b.merchant_id
 AND CAST(b.break_first_identified_date AS TIMESTAMP) >= h.valid_from
 AND CAST(b.break_first_identified_date AS TIMESTAMP) < h.valid_to""")
    cte("queue" + sfx, f"""
SELECT b.settlement_batch_id, b.merchant_id, mer.business_name, b.industry, b.region, b.risk_tier, b.batch_date,
       b.break_first_identified_date, b.report_date, b.expected_settlement_amount, b.actual_cash_received,
       b.break_amount, b.age_business_days, b.aging_bucket, b.is_cash_at_risk, b.funding_cost_estimate,
       b.root_cause_hint,
       CASE b.root_cause_hint WHEN 'missing_posting' THEN 'Treasury Ops' WHEN 'delayed' THEN 'Treasury Ops'
            WHEN 'unmatched_closest_candidate' THEN 'Controller / Accounting'
            ELSE 'Data/Analytics Engineering' END AS suggested_owner_role,
       CASE WHEN b.is_cash_at_risk AND b.break_amount >= 5000 THEN 'critical' WHEN b.is_cash_at_risk THEN 'high'
            WHEN b.aging_bucket IN ('2-3', '4-7') THEN 'medium' ELSE 'low' END AS severity,
       b.break_first_identified_date + 5 AS sla_due_date,
       'new' AS triage_status
FROM breaks{sfx} b JOIN merchants mer USING (merchant_id)""")


breaks_ctes()
breaks_ctes("_r1")
cte("queue_r1_triaged", """
SELECT * REPLACE (CASE WHEN severity = 'critical' THEN 'investigating' ELSE triage_status END AS triage_status),
       CASE WHEN severity = 'critical' THEN 'analyst-1' END AS triage_owner
FROM queue_r1""")
_OWNED = ["business_name", "industry", "region", "risk_tier", "batch_date", "break_first_identified_date",
          "report_date", "expected_settlement_amount", "actual_cash_received", "break_amount", "age_business_days",
          "aging_bucket", "is_cash_at_risk", "funding_cost_estimate", "root_cause_hint", "suggested_owner_role",
          "severity", "sla_due_date"]
_owned_sql = ",\n       ".join(f"CASE WHEN n.settlement_batch_id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}"
                              for c in _OWNED)
cte("queue_merged", f"""
SELECT coalesce(o.settlement_batch_id, n.settlement_batch_id) AS settlement_batch_id,
       CASE WHEN o.settlement_batch_id IS NOT NULL THEN o.merchant_id ELSE n.merchant_id END AS merchant_id,
       {_owned_sql},
       CASE WHEN o.settlement_batch_id IS NULL THEN n.triage_status
            WHEN n.settlement_batch_id IS NULL AND o.triage_status NOT IN ('resolved') THEN 'resolved'
            ELSE o.triage_status END AS triage_status,
       o.triage_owner
FROM queue_r1_triaged o FULL OUTER JOIN queue n ON o.settlement_batch_id = n.settlement_batch_id""")

# ---------------------------------------------------------------- marts
cte("daily_cash", """
SELECT batch_date, count(*) AS settlement_batch_count,
       CAST(sum(CASE WHEN NOT is_matched THEN 1 ELSE 0 END) AS BIGINT) AS break_count,
       CAST(sum(expected_settlement_amount) AS DECIMAL(18,2)) AS total_expected_settlement_amount,
       CAST(sum(CASE WHEN is_matched THEN actual_cash_received ELSE 0 END) AS DECIMAL(18,2)) AS total_actual_cash_received,
       CAST(sum(CASE WHEN NOT is_matched THEN abs(expected_settlement_amount - coalesce(actual_cash_received, 0))
                ELSE 0 END) AS DECIMAL(18,2)) AS unresolved_break_amount,
       CAST(sum(CASE WHEN is_matched THEN expected_settlement_amount ELSE 0 END) AS DECIMAL(18,2)) AS matched_expected
FROM matches GROUP BY batch_date""")
cte("claims", """
SELECT pid AS posting_id, min(settlement_batch_id) AS batch_id
FROM (SELECT settlement_batch_id, unnest(matched_posting_ids) AS pid FROM matches) u GROUP BY 1""")
cte("dups", """
SELECT u.posting_id AS unclaimed_posting_id, u.merchant_id, u.posting_date, u.amount,
       c.posting_id AS duplicated_posting_id, c.batch_id AS duplicated_against_batch_id
FROM (SELECT * FROM postings ANTI JOIN claims USING (posting_id)) u
JOIN (SELECT p.merchant_id, p.posting_date, p.amount, p.posting_id, cl.batch_id
      FROM postings p JOIN claims cl USING (posting_id)) c USING (merchant_id, posting_date, amount)""")

# ---------------------------------------------------------------- telemetry
cte("telemetry", """
SELECT 'INV-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS invocation_id, ts AS run_started_at,
       'node_' || user_id AS node_name, 'model' AS node_resource_type,
       CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'warn' WHEN 'click' THEN 'pass'
            ELSE 'success' END AS status,
       CAST(value AS DOUBLE) AS execution_time_seconds,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_affected, event_type AS message
FROM events""")
cte("last_inv", "SELECT arg_max(invocation_id, run_started_at) AS invocation_id FROM telemetry")
