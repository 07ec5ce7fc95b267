"""Land bank movements incrementally with Structured Streaming.

Files dropped into a landing folder are read as a stream. Every micro-batch is
stamped with lineage and appended to the Bronze folder without the postings
that Bronze already holds: a bank that re-sends a file, however late, creates
no second posting, and a posting that arrives late is landed all the same, for
nothing is dropped by age. A micro-batch that is run again after a failure
finds its rows landed and adds none, so the output is exactly-once.

A posting id is looked up among the landed ids of the days that occur in the
micro-batch (a re-sent posting keeps its day): Bronze is filed by month, so the
look-up reads the months concerned.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from tillbook.sources.landing import add_lineage
from tillbook.sources.layout import MONTH, month_of

BANK_MOVEMENT_SCHEMA = T.StructType([
    T.StructField("posting_id", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("posting_date", T.DateType()),
    T.StructField("amount", T.DecimalType(18, 2)),
    T.StructField("bank_reference", T.StringType()),
])
SOURCE_SYSTEM = "bank_stream"


def bank_movement_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BANK_MOVEMENT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landing_dir)


def land_batch(rows: DataFrame, bronze_dir: str, run_id: str, now: datetime | None = None) -> None:
    """Append the postings of ``rows`` that Bronze doesn't hold, one row a posting id and day."""
    fresh = rows.dropDuplicates(["posting_id", "posting_date"]).withColumn(MONTH, month_of(F.col("posting_date")))
    try:
        landed = rows.sparkSession.read.parquet(bronze_dir).select("posting_id", "posting_date", MONTH)
        fresh = fresh.join(landed, ["posting_id", "posting_date", MONTH], "left_anti")
    except AnalysisException:  # nothing landed yet
        pass
    stamped = add_lineage(fresh.drop(MONTH), SOURCE_SYSTEM, run_id, now or datetime.now().replace(microsecond=0))
    stamped.withColumn(MONTH, month_of(F.col("posting_date"))).write.mode("append").partitionBy(MONTH).parquet(bronze_dir)


def start_landing(stream: DataFrame, bronze_dir: str, checkpoint_dir: str, available_now: bool = True,
                  processing_time: str | None = None, run_id: str = "stream") -> StreamingQuery:
    """Start landing; each micro-batch gets ``<run_id>-<batch number>`` as its batch id."""
    w = stream.writeStream.option("checkpointLocation", checkpoint_dir).foreachBatch(
        lambda rows, number: land_batch(rows, bronze_dir, f"{run_id}-{number}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()
