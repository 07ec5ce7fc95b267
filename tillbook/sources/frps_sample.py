"""A landed sample of the payments-study "Table 1" in cell-row form.

Illustrative figures (count in billions, value in trillions USD, average
transaction in USD) for four collection years; they serve as the national
benchmark input of the payment-mix mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillbook.sources.macro import frps_cell_schema

# (row_number, indent level, label, then count/value/avg for 2015, 2018, 2021, 2024)
TABLE1_ROWS = [
    (6, 0, "Total payments", 144.0, 178.0, 1236.0, 174.2, 97.0, 557.0, 204.5, 128.5, 628.0, 226.0, 135.0, 597.0),
    (7, 1, "Cards", 103.5, 7.08, 68.41, 131.2, 8.67, 66.08, 153.3, 9.76, 63.67, 171.9, 11.31, 65.79),
    (8, 2, "Debit cards", 69.5, 2.56, 36.83, 82.5, 3.16, 38.30, 93.5, 3.67, 39.25, 103.2, 4.24, 41.09),
    (9, 2, "Credit cards", 34.0, 4.52, 132.94, 48.7, 5.51, 113.14, 59.8, 6.09, 101.84, 68.7, 7.07, 102.91),
    (10, 1, "ACH", 23.5, 145.3, 6182.98, 26.0, 167.1, 6426.92, 29.1, 190.4, 6542.96, 33.2, 218.5, 6581.33),
    (11, 1, "Checks", 17.3, 26.8, 1549.13, 14.5, 26.8, 1848.28, 11.2, 27.2, 2428.57, 9.6, 26.1, 2718.75),
    (12, 0, "Additional estimates", None, None, None, None, None, None, None, None, None, None, None, None),
]


def table1_cells(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TABLE1_ROWS, frps_cell_schema())


def values_sql() -> str:
    def lit(v):
        return "NULL" if v is None else (f"'{v}'" if isinstance(v, str) else repr(v))
    rows = ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in TABLE1_ROWS)
    cols = [f.name for f in frps_cell_schema().fields]
    return f"SELECT * FROM (VALUES\n  {rows}) t({', '.join(cols)})"
