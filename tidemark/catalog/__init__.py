"""Registered queries: one Spark callable each, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder); without ``sql`` only its rows are checked."""

    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(fn, sql)
        return fn

    return register


class Tables:
    """``Tables(spark, folder).orders`` scans one table."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder

    def spread(self, name: str) -> DataFrame:
        """A scan for costly work per row. One with fewer splits than cores (a few large
        row groups) is spread over all cores; any larger table is left as it is."""
        df = getattr(self, name)
        cores = self._spark.sparkContext.defaultParallelism
        return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")


def load_all() -> dict[str, Query]:
    from tidemark.catalog import (  # noqa: F401
        access,
        columns,
        ingest,
        library,
        relational,
        streams,
        warehouse,
        windowed,
    )

    return REGISTRY
