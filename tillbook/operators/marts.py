"""Gold marts over the matcher result and the open breaks.

Contracted rates are exact half-up ratios as decimals of the contract's
precision, other rates as DOUBLE; money sums are recast to DECIMAL(18,2). Every
mart is one grouped aggregate (map-side partial aggregation) plus joins to the
merchant dimension, which come after it where the merchant is its key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions.frames import one_row
from tillbook.functions.money import half_up_decimal, half_up_ratio, money
from tillbook.operators import calendar as cal_ops
from tillbook.operators.matching import posting_claims
from tillbook.policy import Policy


def _i(c) -> F.Column:
    return F.col(c).cast("long") if isinstance(c, str) else c.cast("long")


def daily_cash_position(matches: DataFrame) -> DataFrame:
    """Counts, money and three rates per batch date."""
    matched = F.col("is_matched")
    brk = F.abs(F.col("expected_settlement_amount") - F.coalesce("actual_cash_received", F.lit(0)))
    g = matches.groupBy("batch_date").agg(
        F.count(F.lit(1)).alias("settlement_batch_count"),
        F.sum(_i(matched)).alias("matched_batch_count"),
        F.sum(_i(~matched)).alias("break_count"),
        money(F.sum("expected_settlement_amount")).alias("total_expected_settlement_amount"),
        money(F.sum(F.when(matched, F.col("actual_cash_received")).otherwise(F.lit(0)))).alias(
            "total_actual_cash_received"),
        money(F.sum(F.when(~matched, brk).otherwise(F.lit(0)))).alias("unresolved_break_amount"),
        money(F.sum(F.when(matched, F.col("expected_settlement_amount")).otherwise(F.lit(0)))).alias("_matched_exp"))
    return g.select(
        "batch_date", "settlement_batch_count", "matched_batch_count", "break_count",
        "total_expected_settlement_amount", "total_actual_cash_received", "unresolved_break_amount",
        half_up_decimal(F.col("break_count"), F.col("settlement_batch_count"), 4, precision=20, scale=0).alias("break_rate_count_basis"),
        half_up_decimal(F.col("unresolved_break_amount"), F.col("total_expected_settlement_amount"), 4, precision=38)
        .alias("break_rate_dollar_basis"),
        half_up_decimal(F.col("_matched_exp"), F.col("total_expected_settlement_amount"), 4, precision=38)
        .alias("reconciliation_match_rate"))


def funding_cost_summary(breaks: DataFrame) -> DataFrame:
    return breaks.groupBy("report_date", "industry", "region", "risk_tier").agg(
        F.count(F.lit(1)).alias("open_break_count"),
        money(F.sum("break_amount")).alias("total_break_amount"),
        money(F.sum(F.when(F.col("is_cash_at_risk"), F.col("break_amount")).otherwise(F.lit(0))))
        .alias("cash_at_risk_amount"),
        money(F.sum("funding_cost_estimate")).alias("total_funding_cost_estimate"))


def merchant_exception_trends(breaks: DataFrame, merchants: DataFrame) -> DataFrame:
    """Open-break rollup per merchant, on the merchant's *current* attributes."""
    mer = merchants.select("merchant_id", "business_name", "industry", "region", "risk_tier")
    br = breaks.select("merchant_id", "break_amount", "age_business_days", "is_cash_at_risk",
                       "funding_cost_estimate", "root_cause_hint")
    at_risk = F.col("is_cash_at_risk")
    g = br.join(mer, "merchant_id").groupBy("merchant_id", "business_name", "industry", "region", "risk_tier").agg(
        F.count(F.lit(1)).alias("open_break_count"),
        money(F.sum("break_amount")).alias("total_break_amount"),
        F.sum("age_business_days").alias("_age_sum"),
        F.sum(_i(at_risk)).alias("cash_at_risk_break_count"),
        money(F.sum(F.when(at_risk, F.col("break_amount")).otherwise(F.lit(0)))).alias("cash_at_risk_amount"),
        money(F.sum("funding_cost_estimate")).alias("total_funding_cost_estimate"),
        F.mode("root_cause_hint", deterministic=True).alias("most_common_root_cause"))
    return g.select(
        "merchant_id", "business_name", "industry", "region", "risk_tier", "open_break_count", "total_break_amount",
        half_up_ratio(F.col("_age_sum"), F.col("open_break_count"), 1, scale=0).alias("avg_age_business_days"),
        "cash_at_risk_break_count", "cash_at_risk_amount", "total_funding_cost_estimate", "most_common_root_cause")


def merchant_settlement_sla(matches: DataFrame, postings: DataFrame, cal: DataFrame, merchants: DataFrame,
                            run_id: str, as_of: date, settled: DataFrame | None = None) -> DataFrame:
    """On-time rate and business-day delay over *all* batches of each merchant.

    Settlement date of a matched batch = its last matched posting's date. The
    matcher's rows carry it; for rows that don't, it is taken from ``settled``
    or by joining the matched ids to the postings. Batches are summed per
    merchant (on the map side first) before the merchant's attributes join.
    """
    if "actual_settlement_date" in matches.columns:
        m = matches
    else:
        if settled is None:
            settled = (posting_claims(matches, matched_only=True)
                       .join(postings.select("posting_id", "posting_date"), "posting_id")
                       .groupBy("settlement_batch_id").agg(F.max("posting_date").alias("actual_settlement_date")))
        m = matches.join(settled, "settlement_batch_id", "left")
    m = m.select("merchant_id", "expected_payout_date", "expected_settlement_amount", "is_matched", "actual_settlement_date")
    m = cal_ops.add_seq(m, cal, "expected_payout_date", "_exp_seq")
    m = cal_ops.add_seq(m, cal, "actual_settlement_date", "_act_seq")
    matched = F.col("is_matched")
    delay = F.when(matched, F.col("_act_seq") - F.col("_exp_seq"))
    m = m.select("merchant_id", "expected_settlement_amount", "is_matched", delay.alias("delay"),
                 (matched & (F.coalesce(delay, F.lit(0)) <= 0)).alias("on_time"))
    mer = merchants.select("merchant_id", "business_name", "industry", "region", "state", "risk_tier",
                           F.col("settlement_speed_business_days").alias("contracted_settlement_speed_days"))
    g = m.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("settlement_batch_count"),
        F.sum(_i("on_time")).alias("on_time_batch_count"),
        F.sum(_i(~matched)).alias("exception_batch_count"),
        F.sum("delay").alias("_delay_sum"), F.count("delay").alias("_delay_n"),
        F.max("delay").alias("max_settlement_delay_business_days"),
        money(F.sum(F.when(~matched, F.col("expected_settlement_amount")).otherwise(F.lit(0))))
        .alias("exception_amount_usd"),
        money(F.sum("expected_settlement_amount")).alias("total_expected_settlement_amount"))
    return g.join(mer, "merchant_id").select(
        *mer.columns, "settlement_batch_count", "on_time_batch_count", "exception_batch_count",
        half_up_decimal(F.col("on_time_batch_count"), F.col("settlement_batch_count"), 6, precision=9, scale=0)
        .alias("on_time_settlement_rate"),
        half_up_decimal(F.col("_delay_sum"), F.col("_delay_n"), 2, precision=9, scale=0).alias("avg_settlement_delay_business_days"),
        F.col("max_settlement_delay_business_days").cast("long").alias("max_settlement_delay_business_days"),
        "exception_amount_usd", "total_expected_settlement_amount",
        F.lit(run_id).alias("run_id"), F.lit(as_of).alias("as_of_date"))


def duplicate_posting_exceptions(dups: DataFrame, merchants: DataFrame, policy: Policy = Policy()) -> DataFrame:
    mer = merchants.select("merchant_id", "business_name", "industry", "region")
    return dups.join(mer, "merchant_id").select(
        "unclaimed_posting_id", "merchant_id", "business_name", "industry", "region", "posting_date", "amount",
        "duplicated_posting_id", "duplicated_against_batch_id",
        F.when(F.col("amount") >= policy.critical_break_usd, "critical").otherwise("high").alias("severity"),
        F.lit("Treasury Ops").alias("suggested_owner_role"), F.lit("new").alias("triage_status"))


CARDS_TOTAL_PATH = "Total payments > Cards"


def payment_mix_context(transactions: DataFrame, frps: DataFrame, run_id: str, as_of: date,
                        cards_path: str = CARDS_TOTAL_PATH) -> DataFrame:
    """Internal card-sale mix by acceptance channel vs the national cards benchmark.

    Sales only. One aggregate rolls the sales up to one row per channel group
    and one for all; the benchmark, the cards total of the latest collection
    year, is one more row, and what a row needs of the others is looked up
    among these few.
    """
    group = (F.when(F.col("channel") == "card_present", "In-Person")
             .when(F.col("channel") == "ecommerce", "Online").otherwise("Other"))
    mix = (transactions.where(F.col("transaction_type") == "sale").select(group.alias("segment"), "amount").rollup("segment")
           .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("_gross"), F.grouping("segment").alias("_all"))
           .where("transaction_count > 0"))
    of_cards = F.col("category_path") == cards_path
    bench = frps.agg(F.max("collection_year").alias("_latest"), F.max_by(
        F.struct("collection_year", F.col("avg_transaction_amount_usd").alias("avg")),
        F.when(of_cards, F.struct("collection_year", "row_number"))).alias("_cards"))
    in_time = F.col("_cards.collection_year") == F.col("_latest")
    bench = bench.select(F.when(in_time, F.col("_cards.avg").cast("decimal(18,2)")).alias("_bench_avg"),
                         F.when(in_time, F.col("_cards.collection_year")).alias("_bench_year"))
    whole = Window.partitionBy(F.lit(0))                    # a handful of rows
    rows = mix.unionByName(bench, allowMissingColumns=True).withColumns({
        "_total": F.max(F.when(F.col("_all") == 1, F.col("_gross"))).over(whole),
        "_bench_avg": F.max("_bench_avg").over(whole), "_bench_year": F.max("_bench_year").over(whole)}).where("_all IS NOT NULL")
    internal_avg = half_up_decimal(F.col("_gross"), F.col("transaction_count"), 2, scale=2)
    share, one = half_up_decimal(F.col("_gross"), F.col("_total"), 6, precision=9), F.lit(1).cast("decimal(9,6)")
    overall = F.col("_all") == 1
    return rows.select(
        F.when(overall, "Cards (all)").otherwise(F.col("segment")).alias("segment"),
        F.when(overall, "roll_up").otherwise("acceptance_channel").alias("segment_kind"),
        "transaction_count", money(F.col("_gross")).alias("gross_volume_usd"),
        F.when(overall, one).otherwise(share).alias("internal_share_of_volume"),
        internal_avg.alias("internal_avg_ticket_usd"), F.col("_bench_avg").alias("benchmark_avg_ticket_usd"),
        F.when(overall, one).alias("benchmark_share_of_volume"),
        money(internal_avg - F.col("_bench_avg")).alias("avg_ticket_variance_usd"),
        F.col("_bench_year").alias("benchmark_collection_year"),
        F.lit(run_id).alias("run_id"), F.lit(as_of).alias("as_of_date"))


def bi_measures(daily_cash: DataFrame, breaks: DataFrame) -> DataFrame:
    """Executive-page measures in one row: one aggregate over each of the two marts, folded to a row."""
    expected = F.col("total_expected_settlement_amount")
    cash = daily_cash.agg(
        money(F.sum(expected)).alias("total_expected_settlement"),
        money(F.sum("total_actual_cash_received")).alias("total_actual_cash_received"),
        F.sum(F.col("reconciliation_match_rate").cast("double") * expected.cast("double")).alias("_w"),
        F.sum(expected.cast("double")).alias("_e"),
        money(F.max_by("unresolved_break_amount", "batch_date")).alias("unresolved_break_amount_latest_day"),
        F.max("batch_date").alias("as_of_date"))
    brk = breaks.agg(F.sum(F.col("is_cash_at_risk").cast("long")).alias("cash_at_risk_count"),
                     money(F.sum("funding_cost_estimate")).alias("funding_cost_estimate"))
    return one_row(cash, brk).select(
        "total_expected_settlement", "total_actual_cash_received",
        F.round(F.col("_w") / F.col("_e"), 4).alias("weighted_match_rate"), "unresolved_break_amount_latest_day",
        half_up_ratio(F.col("total_expected_settlement") - F.col("total_actual_cash_received"),
                      F.col("total_expected_settlement"), 4).alias("break_rate_dollar_net"),
        "cash_at_risk_count", "funding_cost_estimate", "as_of_date")


def risk_matrix(breaks: DataFrame) -> DataFrame:
    return breaks.groupBy("industry", "region").agg(
        F.count(F.lit(1)).alias("open_break_count"),
        money(F.sum("break_amount")).alias("total_break_amount"),
        F.sum(F.col("is_cash_at_risk").cast("long")).alias("cash_at_risk_count"),
        money(F.sum("funding_cost_estimate")).alias("funding_cost_estimate"))


def cash_trend(daily_cash: DataFrame) -> DataFrame:
    latest = daily_cash.agg(F.max("batch_date")).scalar()
    return daily_cash.select("batch_date", "total_expected_settlement_amount", "total_actual_cash_received",
                             "break_count", F.lit(latest).alias("as_of_date"))
