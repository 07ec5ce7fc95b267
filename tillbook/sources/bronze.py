"""Append-only Bronze: every landing is a batch of its own, corrections included.

``<bronze>/<table>/batch=<id>/`` holds the rows of one landing and is never
written again. A ledger, one row per table and landing, is appended last and
is what commits a landing: readers follow the ledger, so all tables of a
landing appear at once and a landing that broke off is never seen.

A *full* batch replaces everything before it. A *correction* holds the rows
that changed, by key: of a key that several corrections hold the latest counts,
and rows of the full batch whose key was corrected give way by an anti join on
the (small) corrections. What was landed stays readable batch by batch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillbook.functions import spread

LEDGER = "bronze_batches"
LEDGER_SCHEMA = "landing long, table string, batch_id string, kind string, landed_at timestamp_ntz, row_count long"
FULL, CORRECTION = "full", "correction"
# What identifies a row of a Bronze table; tables without a key are only landed in full.
KEYS = {
    "merchants": ["merchant_id"],
    "transactions": ["transaction_id"],
    "settlement_batches": ["settlement_batch_id"],
    "bank_movements": ["posting_id"],
    "returns_adjustments": ["adjustment_id"],
    "ground_truth_breaks": ["settlement_batch_id"],
}


def ledger(spark: SparkSession, bronze_dir: str) -> DataFrame | None:
    """The committed landings, or None before the first."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{bronze_dir.rstrip('/')}/{LEDGER}")
    except AnalysisException:
        return None


def _path(bronze_dir: str, table: str, batch_id: str) -> str:
    return f"{bronze_dir.rstrip('/')}/{table}/batch={batch_id}"


def land(tables: dict[str, DataFrame], bronze_dir: str, batch_id: str, landed_at: datetime, kind: str = FULL) -> dict[str, int]:
    """Write one batch of every table, then commit them together; returns their row counts.

    A batch id that was landed before, and a correction of a table without a
    key, are refused. One writer at a time, as a daily landing is.
    """
    if kind not in (FULL, CORRECTION):
        raise ValueError(f"unknown kind of landing {kind!r}")
    unkeyed = [t for t in tables if kind == CORRECTION and t not in KEYS]
    if unkeyed:
        raise ValueError(f"no key to correct rows by: {unkeyed}")
    spark = next(iter(tables.values())).sparkSession
    before = ledger(spark, bronze_dir)
    number = 1 + ((before.agg(F.max("landing")).first()[0] or 0) if before is not None else 0)
    counts = {}
    for table, df in tables.items():
        path = _path(bronze_dir, table, batch_id)
        df.write.mode("errorifexists").parquet(path)
        counts[table] = spark.read.parquet(path).count()
    rows = [(number, t, batch_id, kind, landed_at, n) for t, n in counts.items()]
    spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(f"{bronze_dir.rstrip('/')}/{LEDGER}")
    return counts


def batches(spark: SparkSession, bronze_dir: str, table: str) -> list[tuple[int, str, str]]:
    """(landing, batch id, kind) of a table's batches, oldest first: one small row a landing."""
    known = ledger(spark, bronze_dir)
    if known is None:
        return []
    return [(r["landing"], r["batch_id"], r["kind"]) for r in known.where(F.col("table") == table).orderBy("landing").collect()]


def read_batch(spark: SparkSession, bronze_dir: str, table: str, batch_id: str) -> DataFrame:
    """Exactly what one landing wrote."""
    return spark.read.parquet(_path(bronze_dir, table, batch_id))


def read_current(spark: SparkSession, bronze_dir: str, table: str) -> DataFrame:
    """The table as it stands: the last full batch with all later corrections in place."""
    landed = batches(spark, bronze_dir, table)
    full = [i for i, (_, _, kind) in enumerate(landed) if kind == FULL]
    if not full:
        raise FileNotFoundError(f"no full batch of {table} was landed in {bronze_dir}")
    base = read_batch(spark, bronze_dir, table, landed[full[-1]][1])
    later = landed[full[-1] + 1:]
    if not later:
        return base
    keys = KEYS[table]
    parts = [read_batch(spark, bronze_dir, table, batch_id).withColumn("_landing", F.lit(n)) for n, batch_id, _ in later]
    corrections = parts[0]
    for part in parts[1:]:
        corrections = corrections.unionByName(part)
    newest = Window.partitionBy(*keys).orderBy(F.desc("_landing"))      # as many rows a key as corrections
    corrections = corrections.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age", "_landing")
    kept = spread.lookup(base, corrections.select(*keys), keys, keys, "left_anti")
    return kept.select(base.columns).unionByName(corrections)
