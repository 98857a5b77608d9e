"""Sort specifications, global positions and per-key ordered scans.

Three facts shape this module:

* a window without PARTITION BY moves the whole table into one task;
* a window with PARTITION BY moves each key into one task, which fails when one
  key owns a large share of the rows;
* after a range exchange and a sort, ``monotonically_increasing_id`` already
  holds the partition number and the position inside it.

So a global position is "position inside the partition + rows in earlier
partitions", where the second part comes from a table with one row per
partition. Keys above ``HOT_ROWS`` rows go the same way, all other keys through
an ordinary window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.scratch import materialize

# Rows of one key a single task may sort in a window.
HOT_ROWS = 2_000_000
# As a limit: the caller has already found that no key is hot.
CHECKED = float("inf")
# Rows a side may have before it loses its broadcast hint.
BROADCAST_ROWS = 100_000

_POS = "_pos"
_PART = "_part"

Spec = str | tuple


def _parts(spec: Spec) -> tuple[str, str, str]:
    if isinstance(spec, str):
        return spec, "asc", "last"
    name, *rest = spec
    direction = rest[0] if rest else "asc"
    nulls = rest[1] if len(rest) > 1 else "last"
    return name, direction, nulls


def names(order: Sequence[Spec]) -> list[str]:
    return [_parts(s)[0] for s in order]


def sort_columns(order: Sequence[Spec]) -> list[Column]:
    """``(column, asc|desc, first|last)`` to sort columns; nulls go last by default."""
    out = []
    for spec in order:
        name, direction, nulls = _parts(spec)
        out.append(getattr(F.col(name), f"{direction}_nulls_{nulls}")())
    return out


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on all keys."""
    cond = F.lit(True)
    for key in keys:
        cond = cond & left[key].eqNullSafe(right[key])
    return cond


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a null key matches a null key; keys come from the left."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    cond = F.lit(True)
    for key in keys:
        cond = cond & left[key].eqNullSafe(renamed[f"_r_{key}"])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def lay_out(df: DataFrame, order: Sequence[Spec], label: str = "ordered") -> DataFrame:
    """Write ``df`` range-partitioned and sorted, with ``_pos`` and ``_part``.

    ``order`` must be unique, so that no value is too large for one partition.
    """
    cols = sort_columns(order)
    laid = (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright(_POS, 33))
    )
    return materialize(laid, label)


def _offsets(laid: DataFrame, amount: Column) -> DataFrame:
    """One row per range partition: the sum of ``amount`` over all earlier ones, or null.

    The collected rows are partitions, not data rows, so their number is fixed by
    the exchange.
    """
    sums = laid.groupBy(_PART).agg(amount.alias("_before"))
    rows, before = [], None
    for part, n in sorted(sums.collect()):
        rows.append((part, before))
        if n is not None:
            before = n if before is None else before + n
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in sums.schema])
    return laid.sparkSession.createDataFrame(rows, schema)


def global_row_number(df: DataFrame, order: Sequence[Spec], name: str = "rn") -> DataFrame:
    """1, 2, 3 … over the whole table in a unique ``order``, without one big task."""
    laid = lay_out(df, order, "row-number")
    before = F.broadcast(_offsets(laid, F.count("*")))
    local = F.col(_POS).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        laid.join(before, _PART)
        .withColumn(name, F.coalesce("_before", F.lit(0)) + local + 1)
        .drop(_POS, _PART, "_before")
    )


def check_hot(df: DataFrame, by: Sequence[str], limit: int | None = None):
    """Limit for several scans of the same keys, so that they are counted once.

    Also right for anything derived from ``df`` that has no more rows per key.
    """
    limit = HOT_ROWS if limit is None else limit
    if limit == CHECKED:
        return limit
    largest = df.groupBy(*by).agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0]
    return CHECKED if (largest or 0) <= limit else limit


def split_hot(df: DataFrame, by: Sequence[str], limit: int | None = None):
    """``None`` if every key fits one task, else ``(cold, hot)`` parts of ``df``.

    At most rows/limit keys can be hot; they are written, and broadcast only below
    ``BROADCAST_ROWS``.
    """
    limit = HOT_ROWS if limit is None else limit
    if limit == CHECKED:
        return None
    hot = df.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") > limit).drop("_n")
    n_hot = hot.count()
    if n_hot == 0:
        return None
    hot = materialize(hot, "hot-keys")
    if n_hot <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    return (
        join_keys(df, hot, by, "left_anti"),
        join_keys(df, hot, by, "left_semi"),
    )


# How per-partition results of one running aggregate combine.
_MERGE = {
    "sum": (F.sum, F.sum, lambda before, here: before + here),
    "count": (F.count, F.sum, lambda before, here: before + here),
    "max": (F.max, F.max, F.greatest),
    "min": (F.min, F.min, F.least),
}


def _hot_scan(hot: DataFrame, by, order, name: str, local, segment: Column, kind: str) -> DataFrame:
    """Scan each (key, range partition) on its own and add what came before it."""
    _, merge, combine = _MERGE[kind]
    laid = lay_out(hot, [*by, *order], "hot-scan")
    scanned = laid.withColumn("_local", local(Window.partitionBy(*by, _PART).orderBy(_POS)))
    earlier = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        laid.groupBy(*by, _PART)
        .agg(segment.alias("_seg"))
        .select(*by, _PART, merge("_seg").over(earlier).alias("_before"))
    )
    before, here = F.col("_before"), F.col("_local")
    total = F.when(before.isNull(), here).when(here.isNull(), before).otherwise(combine(before, here))
    return (
        join_keys(scanned, carry, [*by, _PART], "left")
        .withColumn(name, total.cast(scanned.schema["_local"].dataType))
        .drop("_local", "_before", _POS, _PART)
    )


def keyed_row_number(df, by, order, name="rn", limit=None) -> DataFrame:
    """Row number inside each key; ``order`` unique inside the key."""

    def number(window):
        return F.row_number().over(window).cast("long")

    plain = number(Window.partitionBy(*by).orderBy(*sort_columns(order)))
    parts = split_hot(df, by, limit)
    if parts is None:
        return df.withColumn(name, plain)
    cold, hot = parts
    scanned = _hot_scan(hot, by, order, name, number, F.count("*"), "count")
    return cold.withColumn(name, plain).unionByName(scanned)


def keyed_running(df, by, order, value: str, name="running", kind="sum", limit=None) -> DataFrame:
    """Aggregate from the key's first row to this row; ``order`` unique inside the key."""
    aggregate, _, _ = _MERGE[kind]

    def upto(window):
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return aggregate(value).over(frame)

    plain = upto(Window.partitionBy(*by).orderBy(*sort_columns(order)))
    parts = split_hot(df, by, limit)
    if parts is None:
        return df.withColumn(name, plain)
    cold, hot = parts
    scanned = _hot_scan(hot, by, order, name, upto, aggregate(value), kind)
    return cold.withColumn(name, plain).unionByName(scanned)


def global_running(df, order, value: str, name="running") -> DataFrame:
    """Running sum over the whole table in a unique ``order``."""
    laid = lay_out(df, order, "running")
    before = F.broadcast(_offsets(laid, F.sum(value)))
    frame = Window.partitionBy(_PART).orderBy(_POS)
    here = F.sum(value).over(frame.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    earlier = F.col("_before")
    return (
        laid.withColumn(name, here)
        .join(before, _PART)
        .withColumn(name, F.coalesce(earlier + F.col(name), earlier, F.col(name)))
        .drop(_POS, _PART, "_before")
    )


def keyed_neighbor(df, by, order, value: str, name: str, step: int = -1, limit=None) -> DataFrame:
    """Value of the previous (``step=-1``) or next (``step=1``) row of the same key.

    For hot keys the edge rows of each range partition take their neighbour from
    the touching partition: one value per key and partition.
    """
    plain = Window.partitionBy(*by).orderBy(*sort_columns(order))
    shift = (lambda w: F.lag(value).over(w)) if step < 0 else (lambda w: F.lead(value).over(w))
    parts = split_hot(df, by, limit)
    if parts is None:
        return df.withColumn(name, shift(plain))
    cold, hot = parts
    laid = lay_out(hot, [*by, *order], "hot-neighbor")
    window = Window.partitionBy(*by, _PART).orderBy(_POS)
    ends = laid.groupBy(*by, _PART).agg(
        F.min(_POS).alias("_first"),
        F.max(_POS).alias("_last"),
        (F.max_by(value, _POS) if step < 0 else F.min_by(value, _POS)).alias("_edge"),
    )
    across = Window.partitionBy(*by).orderBy(_PART)
    edge = (F.lag("_edge") if step < 0 else F.lead("_edge")).over(across)
    ends = ends.withColumn("_edge", edge)
    at_edge = F.col(_POS) == (F.col("_first") if step < 0 else F.col("_last"))
    scanned = (
        join_keys(laid.withColumn("_near", shift(window)), ends, [*by, _PART], "left")
        .withColumn(name, F.when(at_edge, F.col("_edge")).otherwise(F.col("_near")))
        .drop("_near", "_edge", "_first", "_last", _POS, _PART)
    )
    return cold.withColumn(name, shift(plain)).unionByName(scanned)
