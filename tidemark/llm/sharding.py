"""Contiguous shards of near-equal byte size from global prefix sums.

Rows are range-partitioned by their order key and sorted. Each partition adds
up its own sizes; one total per partition then gives every partition the bytes
and rows before it. A row goes to the shard whose share of the global byte line
holds the row's middle, so a shard misses its target by at most one row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import table, with_fields
from tidemark.plans.scratch import materialize


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    size = rows = 0
    for pdf in batches:
        total = pdf["_size"].cumsum()
        pdf["_before"] = total - pdf["_size"] + size
        pdf["_row"] = range(rows, rows + len(pdf))
        size, rows = size + int(total.iloc[-1]) if len(pdf) else size, rows + len(pdf)
        yield pdf


def assign_shards(df: DataFrame, order: Sequence[str], size: Column, shards: int) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in its shard).

    ``size`` is a whole number of bytes above 0. Shards are contiguous in the
    order of ``order`` (nulls first); equal keys are told apart by their place in
    the input, so repeated rows spread over partitions and shards like any other.
    Columns named ``shard`` or ``slot`` are replaced. An empty table gives no rows.
    Only the columns of ``df`` travel: pass the few that are wanted, not the texts.
    """
    # Columns travel under numbers, so no name of theirs can clash.
    kept = {c: f"c{i}" for i, c in enumerate(df.columns)}
    sized = df.select(
        *[F.col(f"`{c}`").alias(n) for c, n in kept.items()], size.cast("long").alias("_size"), F.monotonically_increasing_id().alias("_tie")
    )
    by = [*(kept[c] for c in order), "_tie"]
    placed = sized.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.withColumn("_part", F.spark_partition_id())
    schema = with_fields(placed, [("_before", T.LongType()), ("_row", T.LongType())])
    placed = materialize(placed.mapInPandas(_running, schema), "shard-order")

    # One row per partition, whatever the number of rows in the table.
    totals = placed.groupBy("_part").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
    )
    middle = "(2 * (_before + _bytes_before) + _size)"
    numbered = placed.join(F.broadcast(offsets), "_part").withColumns(
        {
            "shard": F.expr(f"cast(({middle} * {int(shards)}) div (2 * _total) as int)"),
            "_row": F.col("_row") + F.col("_rows_before"),
        }
    )
    # At most ``shards`` rows.
    first = numbered.groupBy("shard").agg(F.min("_row").alias("_first"))
    out = numbered.join(F.broadcast(first), "shard")
    back = [F.col(n).alias(c) for c, n in kept.items() if c not in ("shard", "slot")]
    return out.select(*back, "shard", (F.col("_row") - F.col("_first")).alias("slot"))


def write_shards(df: DataFrame, path: str) -> None:
    """Write rows that carry ``shard`` and ``slot`` as one folder per shard, in slot order."""
    df.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def byte_shards_query(spark, folder: str) -> DataFrame:
    """All documents in 40 shards under the law ``bytes``."""
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = assign_shards(docs, ["doc_id"], F.col("size"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
