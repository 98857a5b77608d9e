"""Generated sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def numbers(spark: SparkSession, start: int, stop: int, closed: bool = False) -> DataFrame:
    """``start`` up to ``stop``, which only belongs to the result if ``closed``."""
    return spark.range(start, stop + 1 if closed else stop).select(F.col("id").alias("n"))


def generated(spark: SparkSession, count: int, value: Column, name: str = "value") -> DataFrame:
    """``count`` rows of an expression over ``n`` = 0, 1, 2 …; an endless source needs a limit."""
    return numbers(spark, 0, count).select("n", value.alias(name))


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
