"""Sorting, limits and paging with explicit order and null placement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordering import global_row_number, sort_columns


def sort_by(df: DataFrame, specs: Sequence) -> DataFrame:
    """Total order by ``(column, asc|desc, first|last)``; nulls go last unless asked."""
    return df.orderBy(*sort_columns(specs))


def take(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """First ``n`` rows: each task keeps ``n``, one task merges those."""
    return df.orderBy(*sort_columns(order)).limit(n)


def skip(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """All rows after the first ``n`` of a unique order.

    A plain OFFSET moves the whole table into one task; positions from range
    partitions do not.
    """
    return global_row_number(df, order, "_rn").filter(F.col("_rn") > n).drop("_rn")


def page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """Keyset page: rows with a key above ``after``. Cost does not grow with the page number."""
    rest = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(size)


def first_row(df: DataFrame, order: Sequence | None = None) -> DataFrame:
    """The first row in ``order``, or any row without one."""
    return df.limit(1) if order is None else take(df, 1, order)
