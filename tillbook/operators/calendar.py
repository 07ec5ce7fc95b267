"""Business-day calendar (dim_date) and business-day arithmetic.

``business_day_seq`` is a running count of business days. A non-business day
shares the seq of the business day before it, so "n business days after d"
becomes an equi join on ``seq(d) + n`` instead of a per-row loop.

The calendar has one row per day of an explicit range, so its size is known
on the driver before any job runs (``MAX_DAYS`` caps it); that bound is what
makes broadcasting it safe at any fact-table size. The running sum is the one
unpartitioned window in the library and only ever sees those few thousand
calendar rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.functions.calendar import federal_holidays

MAX_DAYS = 100_000  # ~270 years; a calendar is broadcast, so its size is capped


def holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """Observed federal holidays for every year in [first_year, last_year]."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("year"))
    return years.select(F.explode(federal_holidays(F.col("year"))).alias("holiday_date")).distinct()


def dim_date(spark: SparkSession, start: date, end_exclusive: date, holiday_dates: DataFrame | None = None) -> DataFrame:
    """Daily calendar on [start, end_exclusive) with weekend/holiday/business flags."""
    n_days = (end_exclusive - start).days
    if not 0 < n_days <= MAX_DAYS:
        raise ValueError(f"calendar range must hold 1..{MAX_DAYS} days, got {n_days}")
    if holiday_dates is None:
        # the next year's New Year's Day may be observed on Dec 31 of this range
        holiday_dates = holidays(spark, start.year, end_exclusive.year + 1)
    days = spark.range(n_days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_day"))
    hol = F.broadcast(holiday_dates.select(F.col("holiday_date").cast("date").alias("holiday_date")).distinct())
    dow = F.dayofweek("date_day")  # Spark: 1 = Sunday .. 7 = Saturday
    is_weekend = dow.isin(1, 7)
    is_holiday = F.col("holiday_date").isNotNull()
    flagged = days.join(hol, days.date_day == hol.holiday_date, "left").select(
        "date_day",
        (dow - 1).alias("day_of_week_num"),  # 0 = Sunday, as in the reference warehouse
        F.dayname("date_day").alias("day_name"),
        is_weekend.alias("is_weekend"),
        is_holiday.alias("is_federal_holiday"),
        (~is_weekend & ~is_holiday).alias("is_business_day"),
        F.year("date_day").alias("year"),
        F.month("date_day").alias("month"),
        F.quarter("date_day").alias("quarter"),
    )
    running = Window.orderBy("date_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return flagged.withColumn(
        "business_day_seq", F.sum(F.col("is_business_day").cast("long")).over(running))


def seq_of(cal: DataFrame, date_alias: str = "date_day", seq_alias: str = "business_day_seq") -> DataFrame:
    """Broadcastable (date -> seq) lookup."""
    return F.broadcast(cal.select(F.col("date_day").alias(date_alias), F.col("business_day_seq").alias(seq_alias)))


def first_day_of_seq(cal: DataFrame, seq_alias: str = "_seq", day_alias: str = "_first_day") -> DataFrame:
    """seq -> first (business) day carrying it: the target of next_business_day."""
    return F.broadcast(cal.groupBy(F.col("business_day_seq").alias(seq_alias))
                       .agg(F.min("date_day").alias(day_alias)))


def last_day_of_seq(cal: DataFrame, seq_alias: str = "_seq", day_alias: str = "_last_day") -> DataFrame:
    """seq -> last day carrying it (a business day plus the weekend/holidays after it)."""
    return F.broadcast(cal.groupBy(F.col("business_day_seq").alias(seq_alias))
                       .agg(F.max("date_day").alias(day_alias)))


def add_seq(df: DataFrame, cal: DataFrame, date_col: str, seq_col: str, how: str = "left") -> DataFrame:
    lk = seq_of(cal, "_d", seq_col)
    return df.join(lk, df[date_col] == lk["_d"], how).drop("_d")


def next_business_day(df: DataFrame, cal: DataFrame, date_col: str, n: Column | int, out_col: str) -> DataFrame:
    """Add ``out_col`` = ``date_col`` moved ``n`` business days ahead (n = 0 keeps it).

    The start day itself is not counted; from a weekend, one business day
    ahead is the next business day.
    """
    n = F.lit(n) if isinstance(n, int) else n
    with_seq = add_seq(df, cal, date_col, "_from_seq")
    first = first_day_of_seq(cal)
    joined = with_seq.join(first, with_seq["_from_seq"] + n == first["_seq"], "left")
    return joined.withColumn(out_col, F.when(n == 0, F.col(date_col)).otherwise(F.col("_first_day"))) \
                 .drop("_from_seq", "_seq", "_first_day")


def business_days_between(df: DataFrame, cal: DataFrame, start_col: str, end_col: str, out_col: str) -> DataFrame:
    """Business days in (start, end]; 0 when end <= start."""
    a = add_seq(df, cal, start_col, "_s_seq")
    b = add_seq(a, cal, end_col, "_e_seq")
    return b.withColumn(out_col, F.greatest(F.col("_e_seq") - F.col("_s_seq"), F.lit(0))).drop("_s_seq", "_e_seq")
