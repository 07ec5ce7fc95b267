"""Bronze landing: lineage stamping, landed Parquet, table load.

Every Bronze row carries ``_row_hash`` (64-bit content hash of the business
columns, 16 hex digits), ``_source_system``, ``_ingestion_timestamp`` and
``_batch_id`` (the run id).
"""

from __future__ import annotations

import logging
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillbook.functions.hashing import row_hash

log = logging.getLogger(__name__)

LINEAGE_COLUMNS = ["_row_hash", "_source_system", "_ingestion_timestamp", "_batch_id"]


def ts_ntz(value: datetime):
    """A TIMESTAMP_NTZ literal (wall-clock, no zone), as stored by the landing jobs."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def add_lineage(df: DataFrame, source_system: str, run_id: str, ingested_at: datetime) -> DataFrame:
    """Return ``df`` plus the lineage columns; the hash covers business columns only."""
    business = [c for c in df.columns if c not in LINEAGE_COLUMNS]
    return df.select(
        *business,
        row_hash(*business).alias("_row_hash"),
        F.lit(source_system).alias("_source_system"),
        ts_ntz(ingested_at).alias("_ingestion_timestamp"),
        F.lit(run_id).alias("_batch_id"),
    )


def landed_path(output_dir: str, table: str) -> str:
    return f"{output_dir.rstrip('/')}/{table}"


def write_landed(df: DataFrame, output_dir: str, table: str) -> str:
    """Full overwrite of ``<output_dir>/<table>``; returns the path."""
    path = landed_path(output_dir, table)
    df.write.mode("overwrite").parquet(path)
    return path


def load_table(spark: SparkSession, landing_dir: str, table: str, target_dir: str,
               known_tables: dict[str, list[str]]) -> int:
    """Load one landed table into ``target_dir`` and return its row count.

    Columns are matched by name, case-insensitively, against the declared
    list; a declared column missing from the file is an error. A missing
    landed file logs a warning and loads 0 rows; an unknown table raises.
    """
    if table not in known_tables:
        raise ValueError(f"unknown table {table!r}; known: {sorted(known_tables)}")
    try:
        df = spark.read.parquet(landed_path(landing_dir, table))
    except AnalysisException:
        log.warning("no landed file for %s under %s; loaded 0 rows", table, landing_dir)
        return 0
    by_lower = {c.lower(): c for c in df.columns}
    missing = [c for c in known_tables[table] if c.lower() not in by_lower]
    if missing:
        raise ValueError(f"{table}: landed file lacks columns {missing}")
    out = df.select(*[F.col(by_lower[c.lower()]).alias(c) for c in known_tables[table]])
    out.write.mode("overwrite").parquet(landed_path(target_dir, table))
    return spark.read.parquet(landed_path(target_dir, table)).count()


def layer_table(base_dir: str, layer: str, name: str) -> str:
    """Where a model of a layer lives: ``<base>/<layer>/<name>`` (layer names used verbatim)."""
    return f"{base_dir.rstrip('/')}/{layer.strip()}/{name}"


def write_with_manifest(tables: dict[str, DataFrame], output_dir: str, manifest_name: str = "manifest") -> DataFrame:
    """Land several tables and a CSV manifest (table, row_count, path); returns the manifest."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        path = write_landed(df, output_dir, name)
        rows.append((name, spark.read.parquet(path).count(), path))
    return write_manifest(spark, rows, output_dir, manifest_name)


def write_manifest(spark: SparkSession, rows: list[tuple[str, int, str]], output_dir: str, manifest_name: str = "manifest") -> DataFrame:
    """CSV of (table, row_count, path), a line a table."""
    manifest = spark.createDataFrame(rows, "table string, row_count long, path string")
    manifest.coalesce(1).write.mode("overwrite").option("header", True).csv(landed_path(output_dir, manifest_name))
    return manifest


def latest_batch(df: DataFrame) -> DataFrame:
    """Rows of the most recent landing run only (Bronze kept append-only, one ``_batch_id`` per run)."""
    latest = df.agg(F.max_by("_batch_id", "_ingestion_timestamp")).scalar()
    return df.where(F.col("_batch_id") == latest)
