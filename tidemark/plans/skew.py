"""Joins and groupings that stay balanced when one key owns much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordering import BROADCAST_ROWS, keyed_row_number


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting; beyond the bound Spark chooses the join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def paged_lists(
    df: DataFrame,
    by: Sequence[str],
    item: Column,
    order: Sequence,
    page_size: int,
    name: str = "items",
    limit: int | None = None,
) -> DataFrame:
    """Ordered list of ``item`` per key, split into pages of at most ``page_size``.

    A key of any size becomes several bounded rows (page 0, 1, …); all pages in
    order hold the whole list.
    """
    numbered = keyed_row_number(df, by, order, "_rn", limit)
    paged = numbered.withColumn("page", F.floor((F.col("_rn") - 1) / page_size))
    entry = F.struct(F.col("_rn"), item.alias("_item"))
    return (
        paged.groupBy(*by, "page")
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        .withColumn(name, F.col("_entries")["_item"])
        .drop("_entries")
    )

