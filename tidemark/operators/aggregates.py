"""Grouped aggregation with explicit rules for empty input, ties and order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordering import join_keys, keyed_running
from tidemark.plans.skew import paged_lists


def money(col: Column | str) -> Column:
    """Two-place decimal: sums do not depend on the order partitions arrive in."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(18,2)")


def summary_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """count, sum, min, max and avg in one pass; sum and avg of nothing are 0."""
    value = F.col(col)
    return df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.coalesce(F.sum(value), F.lit(0)).alias("total"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.coalesce(F.avg(value), F.lit(0)).alias("mean"),
    )


def frequency(df: DataFrame, *key: str, name: str = "n") -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias(name))


def top_row(df: DataFrame, by: Sequence[str], val: str, seq: str, lowest: bool = False) -> DataFrame:
    """The whole row with the largest (or smallest) value per group, the earliest on ties."""
    rows = F.struct(*df.columns)
    if lowest:
        best = F.min_by(rows, F.struct(val, seq))
    else:
        best = F.max_by(rows, F.struct(F.col(val), -F.col(seq)))
    return df.groupBy(*by).agg(best.alias("_best")).select("_best.*")


def group_collect(df, by, val: str, order, distinct: bool = False, page_size: int = 10_000, name="items"):
    """Ordered list (or set) of values per group, in pages of bounded size."""
    if distinct:
        df = df.select(*by, val).distinct()
        order = [val]
    return paged_lists(df, by, F.col(val), order, page_size, name)


def partition_by(df: DataFrame, cond: Column, *aggs: Column, name: str = "flag") -> DataFrame:
    """Aggregates of the rows that satisfy ``cond`` and of the others; both rows always exist."""
    flagged = df.groupBy(F.coalesce(cond, F.lit(False)).alias(name)).agg(*aggs)
    both = df.sparkSession.range(2).select((F.col("id") == 1).alias(name))
    return both.join(flagged, name, "left")


def join_strings(
    df: DataFrame,
    by: Sequence[str],
    col: str,
    sep: str,
    order: Sequence,
    prefix: str = "",
    suffix: str = "",
    page_size: int = 10_000,
    name: str = "joined",
) -> DataFrame:
    """Ordered concatenation per group, one row per page of at most ``page_size`` parts.

    The prefix opens page 0, the suffix closes the last page and later pages begin
    with the separator, so the pages of a group read in order form the whole string.
    """
    pages = paged_lists(df, by, F.col(col).cast("string"), order, page_size, "_items")
    last = pages.groupBy(*by).agg(F.max("page").alias("_last"))
    pages = join_keys(pages, last, by, "left")
    head = F.when(F.col("page") == 0, F.lit(prefix)).otherwise(F.lit(sep))
    tail = F.when(F.col("page") == F.col("_last"), F.lit(suffix)).otherwise(F.lit(""))
    text = F.concat(head, F.array_join("_items", sep), tail)
    return pages.withColumn(name, text).drop("_items", "_last")


def to_map(df: DataFrame, key: str, val: str, on_dup: str = "error", order: Sequence[str] = ()) -> DataFrame:
    """Key to value, one row per key. ``error`` fails on a repeated key, ``first`` keeps the earliest."""
    if on_dup == "first":
        return df.groupBy(key).agg(F.min_by(val, F.struct(*order)).alias(val))
    once = F.assert_true(F.count("*") <= 1, F.concat(F.lit("duplicate key "), F.first(key).cast("string")))
    checked = df.groupBy(key).agg(F.first(val).alias(val), once.alias("_ok"))
    # The check only runs if a later step reads it.
    return checked.filter(F.col("_ok").isNull()).drop("_ok")


def distinct_by_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The earliest row of each key."""
    first = F.min_by(F.struct(*df.columns), F.struct(*order_by))
    return df.groupBy(*key).agg(first.alias("_first")).select("_first.*")


def first_non_repeating(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The key that occurs once and comes first in ``order_by``."""
    counted = df.groupBy(key).agg(F.count("*").alias("_n"), F.min(F.struct(*order_by)).alias("_at"))
    return counted.filter("_n = 1").orderBy("_at").limit(1).select(key, "_at.*")


def subtotals(df: DataFrame, how: str, levels: Sequence[str], sums: Mapping[str, Column], sets=None):
    """ROLLUP, CUBE or GROUPING SETS of sums; ``level_id`` tells a subtotal from a real null.

    Rows are summed to the finest level first, so that only those few groups are
    copied once per grouping set.
    """
    finest = df.groupBy(*levels).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    if how == "sets":
        grouped = finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in levels])
    else:
        grouped = getattr(finest, how)(*levels)
    return grouped.agg(F.grouping_id().alias("level_id"), *[F.sum(name).alias(name) for name in sums])


def count_distinct(df: DataFrame, by: Sequence[str], col: str, approx: bool = False, name: str = "n"):
    """Exact distinct count, or a constant-size sketch with ``approx``."""
    counted = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.groupBy(*by).agg(counted.alias(name))


def percentile_sla(df: DataFrame, by: Sequence[str], col: str, p: float, name: str = "pct") -> DataFrame:
    """Exact interpolated percentile per group, without holding a group in one task.

    Values are counted first, then a running count finds the two neighbours of the
    target rank.
    """
    values = df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("_c"))
    running = keyed_running(values, by, [col], "_c", "_upto")
    totals = values.groupBy(*by).agg(F.sum("_c").alias("_total"))
    rank = (F.col("_total") - 1) * F.lit(float(p))
    return (
        join_keys(running, totals, by)
        .groupBy(*by)
        .agg(
            F.min(F.when(F.col("_upto") > F.floor(rank), F.col(col))).alias("_low"),
            F.min(F.when(F.col("_upto") > F.ceil(rank), F.col(col))).alias("_high"),
            F.max(rank - F.floor(rank)).alias("_part"),
        )
        .withColumn(name, F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part"))
        .select(*by, name)
    )


def pct_of_group(df: DataFrame, key: str, val: str, name: str = "pct", places: int = 2) -> DataFrame:
    """Each row's share of its group's total, in percent."""
    totals = df.groupBy(key).agg(F.sum(val).alias("_total"))
    share = F.round(F.col(val) * 100 / F.nullif(F.col("_total"), F.lit(0)), places)
    return join_keys(df, totals, [key], "left").withColumn(name, share).drop("_total")


def pivot_env(df: DataFrame, ids: Sequence[str], env: str, val: Column, envs: Sequence[str]) -> DataFrame:
    """One row per id with a column per environment; the fixed list saves a job."""
    return df.groupBy(*ids).pivot(env, list(envs)).agg(val)

