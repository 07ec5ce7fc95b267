"""Publication of a run: one append switches every reader to it.

A run writes its models below ``<out>/runs/<run id>/`` where nobody looks.
Publishing appends one file to ``<out>/publications``, which lists the path of
every model of the run under the next publication number; readers follow the
highest number. A run that isn't published leaves no trace for readers, and an
older publication can be looked up or published again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillbook.sources import layout

SCHEMA = "publication long, run_id string, published_at timestamp_ntz, layer string, model string, path string"


def staged_path(out_dir: str, run_id: str, layer: str, model: str) -> str:
    return f"{out_dir.rstrip('/')}/runs/{run_id}/{layer}/{model}"


def _publications(spark: SparkSession, out_dir: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCHEMA).parquet(f"{out_dir.rstrip('/')}/publications")
    except AnalysisException:
        return None


def catalog(spark: SparkSession, out_dir: str, publication: int | None = None) -> dict[tuple[str, str], str]:
    """(layer, model) -> path of the latest (or a given) publication; empty before the first."""
    known = _publications(spark, out_dir)
    if known is None:
        return {}
    number = F.lit(publication) if publication is not None else known.agg(F.max("publication")).scalar()
    return {(r["layer"], r["model"]): r["path"] for r in known.where(F.col("publication") == number).collect()}   # a row a model


def publish(spark: SparkSession, out_dir: str, run_id: str, paths: dict[tuple[str, str], str], at: datetime) -> int:
    """Switch all readers to these paths; returns the publication number."""
    known = _publications(spark, out_dir)
    number = 1 + ((known.agg(F.max("publication")).first()[0] or 0) if known is not None else 0)
    rows = [(number, run_id, at, layer, model, path) for (layer, model), path in sorted(paths.items())]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{out_dir.rstrip('/')}/publications")
    return number


def read(spark: SparkSession, out_dir: str, layer: str, model: str, publication: int | None = None, **days) -> DataFrame | None:
    """A published model, or None if there is none; ``first`` and ``last`` as in ``layout.read``."""
    path = catalog(spark, out_dir, publication).get((layer, model))
    return layout.read(spark, path, model, **days) if path else None


def revise(spark: SparkSession, out_dir: str, layer: str, model: str, df: DataFrame, run_id: str, at: datetime) -> int:
    """Publish the current models with one of them replaced, as an analyst does with the queue between runs."""
    path = staged_path(out_dir, run_id, layer, model)
    layout.write(df, path, model)
    return publish(spark, out_dir, run_id, catalog(spark, out_dir) | {(layer, model): path}, at)
