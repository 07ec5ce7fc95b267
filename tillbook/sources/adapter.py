"""Map the driver's star-schema test tables onto the Bronze shapes.

Deterministic (no randomness) so that the same mapping can be written a
second time as plain SQL for the DuckDB oracle (``tillbook.plans.oracle``).

* merchants    <- supplier x nation x region
* transactions <- lineitem (one row per line item)
* returns      <- drawn from lineitem by a rule, priced by the earlier day's volume
* bank postings and ground truth <- settlement batches + a hashed scenario
* run telemetry <- events
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.functions.calendar import day_digits
from tillbook.functions.money import MONEY, money
from tillbook.operators import calendar as cal_ops

# Fixed values (must equal the reference merchant reference data).
# Industry -> MCC pairs, in the reference's order.
INDUSTRY_MCC = [
    ("retail", "5311"),
    ("restaurant_food_service", "5812"),
    ("professional_services", "8742"),
    ("ecommerce_online_retail", "5964"),
    ("health_wellness", "8099"),
    ("home_trade_services", "1731"),
    ("auto_services", "7538"),
    ("other", "5999"),
]
# Employer size classes.
SIZE_CLASSES = ["1-4", "5-9", "10-19", "20-49", "50-99", "100-249", "250-499", "500+"]
# Risk tier -> (reserve_rate_bps, processing_fee_bps, settlement_speed_business_days).
TIER_PARAMS = {"standard": (500, 40, 1), "elevated": (800, 55, 2), "high": (1200, 75, 2)}

# Fixed values (must equal the reference): sales regions.  The test tables bring regions of their own.
SALES_REGIONS = ["South", "West", "Midwest", "Northeast"]
# Adapter constants (test-data mapping, not reference values).
REGIONS = [*SALES_REGIONS, "AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
CALENDAR_MONTHS_BEFORE, CALENDAR_MONTHS_AFTER = 1, 5
SNAPSHOT_1_AT = "1997-01-01 00:00:00"
SNAPSHOT_2_AT = "1999-01-01 00:00:00"
SCENARIO_EPOCH = date(1995, 1, 1)

# posting scenario by x = (k*7919 + days*104729) % 1000 -> upper bound (exclusive)
SCENARIOS = [
    (50, "bank_posting_delay"),
    (80, "reserve_timing_error"),
    (95, "missing_posting"),
    (105, "split_posting"),
    (110, "duplicate_posting"),
    (1000, "clean_match"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _months(day: date, n: int) -> date:
    """The first of the month ``n`` months on."""
    k = day.year * 12 + day.month - 1 + n
    return date(k // 12, k % 12 + 1, 1)


def calendar_span(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First day and end (exclusive) of a calendar around all transaction dates, payouts and windows included."""
    ship = F.col("l_shipdate").cast("date")
    lo, hi = table(spark, sf_dir, "lineitem").agg(F.min(ship), F.max(ship)).first()
    if lo is None:
        lo = hi = SCENARIO_EPOCH
    return _months(lo, -CALENDAR_MONTHS_BEFORE), _months(hi, CALENDAR_MONTHS_AFTER)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal_ops.dim_date(spark, *calendar_span(spark, sf_dir))


def merchant_id(k: Column) -> Column:
    n = k.cast("long")
    # format_string costs more than the rest of a transaction's row, so it is kept for what six digits don't hold
    return F.when(n.between(0, 999_999), F.concat(F.lit("MER-"), F.lpad(n.cast("string"), 6, "0"))).otherwise(F.format_string("MER-%06d", n))


def merchant_key(mid: Column) -> Column:
    return F.substring(mid, 5, 20).cast("long")


def _pick(options: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (idx + 1).cast("int"))


def merchants(spark: SparkSession, sf_dir: str, snapshot: int = 2) -> DataFrame:
    """Merchant reference data. Snapshot 2 (current) re-tiers k % 10 = 4 to elevated."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("s_suppkey")
    tier = (F.when(k % 20 == 0, "high").when((k % 20).isin(1, 2, 3), "elevated").otherwise("standard"))
    if snapshot >= 2:
        tier = F.when(k % 10 == 4, "elevated").otherwise(tier)
    base = (s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
            .withColumn("risk_tier", tier))

    def tier_param(i: int) -> Column:
        expr = None
        for name, params in TIER_PARAMS.items():
            expr = (F.when(F.col("risk_tier") == name, F.lit(params[i]).cast("long")) if expr is None
                    else expr.when(F.col("risk_tier") == name, F.lit(params[i]).cast("long")))
        return expr

    return base.select(
        merchant_id(k).alias("merchant_id"),
        F.col("s_name").alias("business_name"),
        _pick([i for i, _ in INDUSTRY_MCC], k % 8).alias("industry"),
        _pick([m for _, m in INDUSTRY_MCC], k % 8).alias("mcc"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("state"),
        _pick(SIZE_CLASSES, k % 8).alias("employer_size_class"),
        "risk_tier",
        F.date_add(F.lit(date(1994, 1, 1)), (k % 365).cast("int")).alias("onboarding_date"),
        tier_param(0).alias("reserve_rate_bps"),
        tier_param(1).alias("processing_fee_bps"),
        tier_param(2).alias("settlement_speed_business_days"),
        (F.lit(20) + k % 50).cast("double").alias("avg_ticket_usd"),
        F.lit(1.0).alias("daily_txn_volume_multiplier"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item; refunds are negative.

    ``transaction_id`` needs a row number inside (orderkey, linenumber) groups
    (that pair is not unique in lineitem). The window is partitioned by that
    key, and column pruning removes it whenever the id is not selected.
    """
    li = table(spark, sf_dir, "lineitem")
    order_rest = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus", "l_shipdate"]
    rn = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*order_rest))
    is_refund = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    price = money(F.col("l_extendedprice"))
    return li.select(
        F.concat_ws("-", F.lit("TXN"), F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string"), rn.cast("string")).alias("transaction_id"),
        merchant_id(F.col("l_suppkey")).alias("merchant_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        F.col("l_shipdate").alias("transaction_timestamp"),
        F.when(is_refund, "refund").otherwise("sale").alias("transaction_type"),
        F.when(F.col("l_linestatus") == "F", "card_present").otherwise("ecommerce").alias("channel"),
        F.when(is_refund, -price).otherwise(price).cast(MONEY).alias("amount"),
    )


# Fixed values (must equal the reference return reason codes).
REASON_CODES = ["chargeback", "customer_return", "billing_dispute"]


def drawn_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjustments that may come back: day, days back and share by a rule; the amount is looked up in the earlier volume."""
    li = table(spark, sf_dir, "lineitem").where(
        (F.col("l_returnflag") == "A") & (F.col("l_linenumber") <= 3) & (F.col("l_quantity") >= 30))
    return li.select(
        F.concat_ws("-", F.lit("ADJ"), *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
        .alias("adjustment_id"),
        merchant_id(F.col("l_suppkey")).alias("merchant_id"),
        F.col("l_shipdate").cast("date").alias("adjustment_date"),
        (F.lit(1) + F.col("l_quantity").cast("long") % 21).cast("int").alias("lag_days"),
        (F.lit(2) + F.col("l_partkey") % 7).cast("int").alias("pct_points"),
        _pick(REASON_CODES, F.col("l_partkey") % 3).alias("reason_code"),
    )


def scenario_x(k: Column, batch_date: Column) -> Column:
    return (k * F.lit(7919) + F.datediff(batch_date, F.lit(SCENARIO_EPOCH)).cast("long") * F.lit(104729)) % 1000


def scenario_of(x: Column) -> Column:
    expr = None
    for upper, name in SCENARIOS:
        expr = F.when(x < upper, name) if expr is None else expr.when(x < upper, name)
    return expr


def _posting_id(merchant: Column, day: Column, n: Column) -> Column:
    return F.concat_ws("-", F.lit("POST"), merchant_key(merchant).cast("string"), day_digits(day), n.cast("string"))


def bank_reference() -> Column:
    return F.upper(F.substring(F.sha2(F.col("posting_id"), 256), 1, 12))


def bank_movements_and_truth(batches: DataFrame, cal: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bank postings for each batch per its hashed scenario, plus the ground truth.

    Per batch: 0 (missing), 1 or 2 postings, built as an array and exploded, so
    the job is a map over batches plus one broadcast calendar lookup.
    """
    k = merchant_key(F.col("merchant_id"))
    x = scenario_x(k, F.col("batch_date"))
    b = batches.select("settlement_batch_id", "merchant_id", "batch_date", "expected_payout_date",
                       "expected_settlement_amount", "reserve_held") \
        .withColumn("_x", x).withColumn("scenario", scenario_of(F.col("_x")))
    shift = (F.when(F.col("scenario") == "bank_posting_delay", F.lit(1) + F.col("_x") % 3)
             .when((F.col("scenario") == "split_posting") & (F.col("_x") % 2 == 1), F.lit(1))
             .otherwise(F.lit(0)))
    b = b.withColumn("_shift", shift.cast("long"))
    b = cal_ops.next_business_day(b, cal, "expected_payout_date", F.col("_shift"), "_alt_date")

    exp = F.col("expected_settlement_amount")
    payout = F.col("expected_payout_date")
    reserve_error = money(F.round(F.lit(0.5).cast("decimal(2,1)") *
                                  F.greatest(F.col("reserve_held"), F.lit(0.01).cast("decimal(3,2)") * F.abs(exp),
                                             F.lit(5).cast("decimal(3,0)")), 2))
    first_split = money(F.round(F.lit(0.4).cast("decimal(2,1)") * exp, 2))

    def post(n: int, day: Column, amount: Column) -> Column:
        return F.struct(F.lit(n).alias("n"), day.alias("posting_date"), money(amount).alias("amount"))

    sc = F.col("scenario")
    postings = (
        F.when(sc == "bank_posting_delay", F.array(post(1, F.col("_alt_date"), exp)))
        .when(sc == "reserve_timing_error", F.array(post(1, payout, exp - reserve_error)))
        .when(sc == "missing_posting", F.array().cast("array<struct<n:int,posting_date:date,amount:decimal(18,2)>>"))
        .when(sc == "split_posting", F.array(post(1, payout, first_split),
                                              post(2, F.col("_alt_date"), exp - first_split)))
        .when(sc == "duplicate_posting", F.array(post(1, payout, exp), post(2, payout, exp)))
        .otherwise(F.array(post(1, payout, exp)))
    )
    exploded = b.where(payout.isNotNull()).select(
        "merchant_id", "batch_date", F.explode(postings).alias("p"))
    movements = exploded.select(
        _posting_id(F.col("merchant_id"), F.col("batch_date"), F.col("p.n")).alias("posting_id"),
        "merchant_id",
        F.col("p.posting_date").alias("posting_date"),
        F.col("p.amount").alias("amount"),
    ).withColumn("bank_reference", bank_reference())
    own_ids = F.when(payout.isNotNull(), F.transform(postings, lambda e: _posting_id(F.col("merchant_id"), F.col("batch_date"), e["n"])))
    truth = b.select("settlement_batch_id", "merchant_id", F.col("scenario").alias("injected_scenario"),
                     "expected_settlement_amount", F.coalesce(own_ids, F.array().cast("array<string>")).alias("injected_posting_ids"),
                     F.col("_shift").cast("int").alias("injected_delay_business_days"))
    return movements, truth


def run_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline run telemetry log, one row per (invocation, node) event."""
    ev = table(spark, sf_dir, "events")
    status = (F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "warn")
              .when(F.col("event_type") == "click", "pass").otherwise("success"))
    return ev.select(
        F.concat(F.lit("INV-"), F.col("ts").cast("date").cast("string")).alias("invocation_id"),
        F.col("ts").alias("run_started_at"),
        F.concat(F.lit("node_"), F.col("user_id").cast("string")).alias("node_name"),
        F.lit("model").alias("node_resource_type"),
        status.alias("status"),
        F.col("value").cast("double").alias("execution_time_seconds"),
        F.get_json_object("props", "$.k").cast("long").alias("rows_affected"),
        F.col("event_type").alias("message"),
    )
