"""How stored models lie: in order, range-partitioned, by month where they have a day.

``write`` samples the order columns, gives every task a range of them and sorts
inside, so that files follow each other in order and their statistics prune.
A model with a day goes to one folder a month (``_month=yyyymm``). ``read``
takes the folder column off again and, given days, reads the months between.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "_month"
# model -> (day that files it by month, order of its rows: column, descending)
LAYOUT: dict[str, tuple[str | None, list[tuple[str, bool]]]] = {
    "fct_daily_cash_position": ("batch_date", [("batch_date", False)]),
    "fct_merchant_exception_trends": (None, [("total_break_amount", True), ("merchant_id", False)]),
    "fct_merchant_settlement_sla": (None, [("on_time_settlement_rate", False), ("merchant_id", False)]),
    "fct_payment_mix_context": (None, [("segment_kind", False), ("gross_volume_usd", True)]),
    "fct_transaction": ("transaction_date", [("transaction_date", False), ("merchant_id", False)]),
    "fct_settlement_batch": ("batch_date", [("batch_date", False), ("merchant_id", False)]),
    "fct_bank_movement": ("posting_date", [("posting_date", False), ("merchant_id", False)]),
    "int_reconciliation_matches": ("batch_date", [("batch_date", False), ("merchant_id", False)]),
    "fct_reconciliation_breaks": ("batch_date", [("batch_date", False), ("merchant_id", False)]),
}


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def write(df: DataFrame, path: str, model: str, mode: str = "errorifexists") -> None:
    """Store a model in its layout; one without a layout is written as it comes."""
    if model not in LAYOUT:
        df.write.mode(mode).parquet(path)
        return
    day, order = LAYOUT[model]
    by = [F.col(c).desc() if down else F.col(c).asc() for c, down in order]
    if day:
        df, by = df.withColumn(MONTH, month_of(F.col(day))), [F.col(MONTH).asc(), *by]
    writer = df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode(mode)
    (writer.partitionBy(MONTH) if day else writer).parquet(path)


def read(spark: SparkSession, path: str, model: str = "", first: date | None = None, last: date | None = None) -> DataFrame:
    """A stored model, whole or from ``first`` to ``last`` (inclusive, by its day)."""
    df = spark.read.parquet(path)
    day = LAYOUT.get(model, (None, []))[0]
    if (first or last) and not day:
        raise ValueError(f"{model} isn't filed by a day")
    for bound, later in ((first, True), (last, False)):
        if bound:
            number, lit = F.lit(bound.year * 100 + bound.month), F.lit(bound)
            df = df.where((F.col(MONTH) >= number) & (F.col(day) >= lit) if later else (F.col(MONTH) <= number) & (F.col(day) <= lit))
    return df.drop(MONTH)
