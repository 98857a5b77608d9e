"""Keyed event log: the frame a message broker's source and sink use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_log(df: DataFrame, key: str, topic: str) -> DataFrame:
    """``topic, key, value`` with the whole row as JSON."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )


def from_log(log: DataFrame, schema, topic: str | None = None) -> DataFrame:
    """Typed rows; a value that is not valid JSON gives nulls and ``_malformed``."""
    rows = log if topic is None else log.filter(F.col("topic") == topic)
    text = F.col("value").cast("string")
    parsed = rows.select(
        F.from_json(text, schema).alias("_row"),
        (text.isNull() | F.try_parse_json(text).isNull()).alias("_malformed"),
    )
    return parsed.select("_row.*", "_malformed")


def write_log(df: DataFrame, root: str, partitions: int = 8) -> None:
    """File form of the log, spread over ``partitions`` by key as a broker would."""
    place = F.pmod(F.xxhash64("key"), F.lit(partitions)).alias("partition")
    placed = df.withColumn("partition", place).hint("rebalance", F.col("topic"), F.col("partition"))
    placed.write.mode("append").partitionBy("topic", "partition").parquet(root)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root)
