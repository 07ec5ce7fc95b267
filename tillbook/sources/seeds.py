"""CSV seeds: holiday list and finance assumptions, read with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

HOLIDAY_SEED_SCHEMA = T.StructType([T.StructField("holiday_date", T.DateType(), False)])
ASSUMPTIONS_SEED_SCHEMA = T.StructType([
    T.StructField("assumption_key", T.StringType(), False),
    T.StructField("assumption_value", T.DecimalType(9, 4), False),
    T.StructField("description", T.StringType(), True),
    T.StructField("owner", T.StringType(), True),
])


def read_seed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A header CSV; typed by ``schema`` or, when none is given, by inference."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)
