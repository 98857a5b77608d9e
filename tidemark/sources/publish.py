"""Slice replacement, quarantine and retention on plain parquet.

``publish_slice`` is the safe form: data of a run goes into a folder of this
attempt alone and becomes visible by one small append to the ledger, which names the
attempt. Readers take the latest published run of every slice, so they never see half
a slice, a failed attempt stays invisible, a repeated ``job_id`` changes nothing, and
an empty re-delivery empties its slice.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.skew import broadcast_if_small


def _paths(root: str) -> tuple[str, str]:
    return f"{root}/data", f"{root}/ledger"


def read_ledger(spark: SparkSession, root: str) -> DataFrame | None:
    """The ledger, or None before anything was published."""
    try:
        return spark.read.parquet(_paths(root)[1])
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _by_slice(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a slice together, so that a slice has few files; Spark splits large
    slices and merges small ones by their measured size."""
    return df.hint("rebalance", *[F.col(k) for k in keys])


def publish_slice(
    df: DataFrame,
    root: str,
    keys: Sequence[str],
    job_id: str,
    slices: DataFrame | None = None,
    published_at=None,
) -> None:
    """Replace the slices of ``df`` (and of ``slices``, which may be empty now).

    A ``job_id`` that the ledger already holds is not run again."""
    data, ledger = _paths(root)
    spark = df.sparkSession
    published = read_ledger(spark, root)
    if published is not None and not published.filter(F.col("job_id") == job_id).isEmpty():
        return
    # Only this attempt's folder is read back, however many runs the table has seen.
    attempt = uuid.uuid4().hex
    folder = f"{data}/attempt={attempt}"
    _by_slice(df, keys).write.partitionBy(*keys).parquet(folder)
    written = spark.read.schema(df.schema).parquet(folder)
    counts = written.groupBy(*keys).agg(F.count("*").alias("row_count"))
    if slices is not None:
        named = slices.select(*keys, F.lit(0).cast("long").alias("row_count"))
        counts = named.unionByName(counts).groupBy(*keys).agg(F.sum("row_count").alias("row_count"))
    stamp = F.current_timestamp() if published_at is None else F.lit(published_at).cast("timestamp")
    rows = counts.select(
        *keys,
        F.lit(job_id).alias("job_id"),
        F.lit(attempt).alias("attempt"),
        "row_count",
        F.lit("SUCCESS").alias("status"),
        stamp.alias("published_at"),
    )
    rows.coalesce(1).write.mode("append").parquet(ledger)


def current_jobs(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The run and attempt that currently stand for each slice."""
    ledger = spark.read.parquet(_paths(root)[1]).filter("status = 'SUCCESS'")
    latest = F.max_by(F.struct("job_id", "attempt"), F.struct("published_at", "job_id", "attempt"))
    return ledger.groupBy(*keys).agg(latest.alias("_run")).select(*keys, "_run.*")


def read_published(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """All current slices. The small ledger prunes the data folders at run time."""
    data, ledger = _paths(root)
    # Folder names have no types; the ledger has kept those of the slice keys.
    kinds = {f.name: f.dataType for f in spark.read.parquet(ledger).schema}
    found = spark.read.parquet(data).schema
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])
    rows = spark.read.schema(schema).parquet(data)
    jobs = current_jobs(spark, root, keys).withColumnRenamed("attempt", "_attempt")
    jobs = broadcast_if_small(jobs.select("_attempt", *[F.col(k).alias(f"_key_{k}") for k in keys]))
    cond = F.col("attempt") == F.col("_attempt")
    for key in keys:
        cond = cond & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return rows.join(jobs, cond, "left_semi").drop("attempt")


def replace_slice(df: DataFrame, root: str, keys: Sequence[str], slices: Sequence[dict] = ()) -> None:
    """Simple form: overwrite the partitions present in ``df`` in place.

    Not atomic for readers. Spark leaves partitions without incoming rows alone, so
    slices that became empty are named in ``slices`` and removed.
    """
    writer = _by_slice(df, keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(root)
    for values in slices:
        wanted = df
        for name, value in values.items():
            wanted = wanted.filter(F.col(name) == F.lit(value))
        if wanted.isEmpty():
            _delete(df.sparkSession, [root + "".join(f"/{k}={values[k]}" for k in keys)])


def write_quarantine(df: DataFrame, root: str, keys: Sequence[str] = ("file_type", "file_date")) -> None:
    """Rejected rows with their reasons, by file type and date."""
    _by_slice(df, keys).write.mode("append").partitionBy(*keys).parquet(root)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        system, target = _hadoop(spark, path)
        if system.exists(target):
            system.delete(target, True)


def expire_partitions(
    spark: SparkSession, root: str, days: int, today: dt.date, key: str = "file_date", dry_run: bool = True
) -> list[str]:
    """Partition folders older than ``days``; removed unless ``dry_run``."""
    system, target = _hadoop(spark, root)
    limit = today - dt.timedelta(days=days)
    expired = []
    for status in system.listStatus(target):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{key}="):
            if dt.date.fromisoformat(name.split("=", 1)[1]) < limit:
                expired.append(status.getPath().toString())
    if not dry_run:
        _delete(spark, expired)
    return sorted(expired)


def superseded_jobs(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Published runs that a later run has replaced."""
    ledger = spark.read.parquet(_paths(root)[1])
    newest = Window.partitionBy(*keys).orderBy(F.desc("published_at"), F.desc("job_id"))
    return ledger.withColumn("_n", F.row_number().over(newest)).filter("_n > 1").drop("_n")
