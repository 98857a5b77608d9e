"""Structured Streaming flows and their idempotent sinks.

Every sink writes an epoch under its own name and publishes it with one ledger
row, so a replayed epoch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.scratch import scratch_path
from tidemark.sources.publish import publish_slice, read_published
from tidemark.streaming.keyed import latest_by_key


def start(
    stream: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Start a flow with a checkpoint: ``each`` gets the micro-batches, or parquet goes to ``path``.

    ``every`` is the trigger interval; without it all available data is processed
    and the flow ends.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if each is not None:
        return writer.foreachBatch(each).start()
    return writer.format("parquet").option("path", path).start()


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a flow over everything available and return the table it wrote."""
    spark = stream.sparkSession
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    start(stream, checkpoint, path=path, mode=mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def meter(calls: DataFrame, by: Sequence[str], at: str = "ts", grain: str = "1 hour") -> DataFrame:
    """Usage counts per tumbling window and key of a batch or micro-batch."""
    windows = calls.withColumn(at, F.col(at).cast("timestamp")).groupBy(F.window(at, grain), *by)
    return windows.agg(F.count("*").alias("calls")).select(F.col("window.start").alias("period"), *by, "calls")


def sliding(df: DataFrame, by: Sequence[str], at: str, length: str, slide: str, sums: dict[str, Column]) -> DataFrame:
    """Sums per sliding window and key of a batch or micro-batch."""
    windows = df.withColumn(at, F.col(at).cast("timestamp")).groupBy(F.window(at, length, slide), *by)
    out = windows.agg(*[value.alias(name) for name, value in sums.items()])
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, *sums)


def partial_sink(root: str, aggregate: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Sink that keeps the counts and sums of each micro-batch under its epoch.

    ``read_partials`` adds them up, so rows may arrive in any order and at any time: there
    is no watermark, no state, and nothing late to drop. A replayed epoch overwrites itself."""

    def each(batch: DataFrame, epoch: int) -> None:
        aggregate(batch).write.mode("overwrite").parquet(f"{root}/epoch={epoch}")

    return each


def read_partials(spark: SparkSession, root: str, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Totals over all epochs, windows still open included."""
    return spark.read.parquet(root).groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])


def _arrived(*tables: DataFrame) -> None:
    if any(df.isStreaming for df in tables):
        raise ValueError("store the stream first (drain) and call this on what has arrived: a watermark would drop late rows")


def dedupe(df: DataFrame, id: str, at: str) -> DataFrame:
    """First event per id of what has arrived, in any order; a null id is an id, an event without a time comes last."""
    _arrived(df)
    rest = [c for c in df.columns if c != at]
    place = F.struct(F.col(at).isNull().alias("_untimed"), F.col(at), *rest)
    return df.groupBy(F.col(id).alias("_id")).agg(F.min(place).alias("_first")).select(*[F.col("_first")[c].alias(c) for c in df.columns])


def enrich_static(stream: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    return stream.join(table, list(on), how)


def join_within(
    left: DataFrame, right: DataFrame, on: str, left_at: str, right_at: str, bound: str
) -> DataFrame:
    """Join of what has arrived of two streams: same key, and the right event at most ``bound`` after the left one.

    Both sides are stored and joined on reading, so rows may arrive in any order and at any time.
    """
    _arrived(left, right)
    a = left.withColumn(left_at, F.col(left_at).cast("timestamp"))
    b = right.withColumn(right_at, F.col(right_at).cast("timestamp")).withColumnRenamed(on, "_right_on")
    near = (
        (F.col(on) == F.col("_right_on"))
        & (F.col(right_at) >= F.col(left_at))
        & (F.col(right_at) <= F.col(left_at) + F.expr(f"INTERVAL {bound}"))
    )
    return a.join(b, near).drop("_right_on")


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before anything was written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def upsert_sink(
    root: str, key: Sequence[str], order: Sequence[str], buckets: int = 256, flow: str = "flow"
) -> Callable[[DataFrame, int], None]:
    """Sink that keeps the newest row per key in a table cut into key buckets.

    A micro-batch rewrites only the buckets it touches and publishes them together. Each flow
    into the table needs a ``flow`` name of its own, kept over restarts: epochs are counted per flow.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        job = f"{flow}-epoch-{epoch:012d}"
        ledger = _table(spark, f"{root}/ledger")
        if ledger is not None and not ledger.filter(F.col("job_id") == job).isEmpty():
            return
        place = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
        fresh = latest_by_key(batch, key, order).withColumn("bucket", place).persist()
        touched = fresh.select("bucket").distinct()
        try:
            if fresh.isEmpty():
                return
            rows = fresh
            if ledger is not None:
                old = read_published(spark, root, ["bucket"]).select(*fresh.columns)
                rows = fresh.unionByName(old.join(F.broadcast(touched), "bucket", "left_semi"))
            merged = latest_by_key(rows, key, order)
            publish_slice(merged, root, ["bucket"], job, touched)
        finally:
            fresh.unpersist()

    return each


def read_upserted(spark: SparkSession, root: str) -> DataFrame:
    """Current rows of an ``upsert_sink`` table."""
    return read_published(spark, root, ["bucket"]).drop("bucket")


def once_sink(root: str, id: str, day: str, flow: str = "flow") -> Callable[[DataFrame, int], None]:
    """Append-only sink that lets every id in once, across batches, restarts and flows.

    ``day`` is a date that is the same on every copy of a message: only the earlier ids of the
    batch's days are read. Each flow needs a ``flow`` name of its own.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        target = f"{root}/rows"
        fresh = batch.dropDuplicates([id])
        seen = _table(spark, target)
        if seen is not None:
            seen = seen.filter((F.col("flow") != flow) | (F.col("epoch") < epoch))
            seen = seen.join(batch.select(day).distinct(), day, "left_semi")
            fresh = fresh.join(seen.select(id), id, "left_anti")
        fresh.write.mode("overwrite").partitionBy(day).parquet(f"{target}/flow={flow}/epoch={epoch}")

    return each


def read_once(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rows").drop("flow", "epoch")


def dead_letter_sink(split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], good_path: str, dead_path: str):
    """Sink that writes good and dead rows of a micro-batch from one kept frame."""

    def each(batch: DataFrame, epoch: int) -> None:
        kept = batch.persist()
        try:
            good, dead = split(kept)
            good.write.mode("overwrite").parquet(f"{good_path}/epoch={epoch}")
            dead.write.mode("overwrite").parquet(f"{dead_path}/epoch={epoch}")
        finally:
            kept.unpersist()

    return each
