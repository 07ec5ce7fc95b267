"""Run health: telemetry log, run summary, heartbeat (dead-man's switch).

One-row outputs are folded from one aggregate per input (``frames.one_row``):
every input is read once and nothing is joined.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions.frames import one_row
from tillbook.functions.money import money
from tillbook.policy import Policy
from tillbook.sources.landing import ts_ntz

TELEMETRY_SCHEMA = T.StructType([
    T.StructField("invocation_id", T.StringType()),
    T.StructField("run_started_at", T.TimestampNTZType()),
    T.StructField("node_name", T.StringType()),
    T.StructField("node_resource_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("execution_time_seconds", T.DoubleType()),
    T.StructField("rows_affected", T.LongType()),
    T.StructField("message", T.StringType()),
])
FAILED = ["fail", "error"]


def append_run_telemetry(spark: SparkSession, path: str, invocation_id: str, finished_at: datetime,
                         results: list[dict]) -> int:
    """Append one row per node result (stamped with the end-of-run time); no rows, no write."""
    if not results:
        return 0
    rows = [(invocation_id, finished_at, r["node_name"], r.get("node_resource_type", "model"), r["status"],
             float(r.get("execution_time_seconds", 0.0)), r.get("rows_affected"),
             r.get("message") or "") for r in results]
    spark.createDataFrame(rows, TELEMETRY_SCHEMA).write.mode("append").parquet(path)
    return len(rows)


def _last_invocation(telemetry: DataFrame) -> DataFrame:
    """One row: when the latest run ended, and how many of its nodes failed (nulls before the first run)."""
    runs = telemetry.groupBy("invocation_id").agg(
        F.max("run_started_at").alias("at"), F.coalesce(F.sum(F.col("status").isin(*FAILED).cast("long")), F.lit(0)).alias("failures"))
    return runs.agg(F.max(F.struct("at", "invocation_id", "failures")).alias("last")).select("last.at", "last.failures")


def pipeline_heartbeat(telemetry: DataFrame, now: datetime, policy: Policy = Policy()) -> DataFrame:
    """Last completed run and failures of the last invocation; age is computed at read time."""
    return _last_invocation(telemetry).select(
        F.col("at").alias("last_run_completed_at"), F.coalesce("failures", F.lit(0).cast("long")).alias("last_run_node_failures"),
        F.lit(policy.heartbeat_threshold_hours).alias("heartbeat_threshold_hours"), ts_ntz(now).alias("heartbeat_written_at"))


def hours_between(a, b):
    """Hour boundaries crossed from a to b (the warehouse's datediff(hour))."""
    return F.timestamp_diff("HOUR", F.date_trunc("hour", a), F.date_trunc("hour", b))


def pipeline_silence(heartbeat: DataFrame, now: datetime) -> DataFrame:
    """Rows only when the pipeline never ran, is older than the threshold, or last run failed."""
    age = hours_between(F.col("last_run_completed_at"), ts_ntz(now))
    return heartbeat.select("last_run_completed_at", age.alias("hours_since_last_run"),
                            "heartbeat_threshold_hours", "last_run_node_failures").where(
        F.col("last_run_completed_at").isNull() | (F.col("hours_since_last_run") > F.col("heartbeat_threshold_hours"))
        | (F.col("last_run_node_failures") > 0))


def run_summary(daily_cash: DataFrame, queue: DataFrame, telemetry: DataFrame,
                policy: Policy = Policy()) -> DataFrame:
    """The latest day, the queue and the last run in one row; no row without any day."""
    day = daily_cash.orderBy(F.col("batch_date").desc()).limit(1).select(
        F.col("batch_date").alias("latest_report_date"), "settlement_batch_count", "break_count", "break_rate_dollar_basis",
        "reconciliation_match_rate")
    exceptions = queue.agg(
        F.count(F.lit(1)).alias("open_exception_count"),
        F.sum((F.col("severity") == "critical").cast("long")).alias("critical_count"),
        F.sum((F.col("severity") == "high").cast("long")).alias("high_count"),
        money(F.sum("break_amount")).alias("total_open_break_amount"),
        money(F.sum("funding_cost_estimate")).alias("total_funding_cost_estimate"))
    last = _last_invocation(telemetry).select(F.col("at").alias("last_run_at"), F.col("failures").alias("last_run_test_failures"))
    return one_row(day, exceptions, last).where(F.col("latest_report_date").isNotNull()).select(
        "*",
        F.coalesce(F.col("break_rate_dollar_basis") > policy.break_rate_ceiling, F.lit(False))
        .alias("sla_flag_break_rate_ceiling_breached"),
        F.coalesce(F.col("critical_count") > 0, F.lit(False)).alias("sla_flag_critical_exceptions_open"),
        F.coalesce(F.col("last_run_test_failures") > 0, F.lit(False)).alias("sla_flag_last_run_had_failures"))
