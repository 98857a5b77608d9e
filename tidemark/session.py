"""Session settings the operators are tuned for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local(cpus: int = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    defaults = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"),
    }
    return build(master=f"local[{cpus}]", **{**defaults, **extra})
