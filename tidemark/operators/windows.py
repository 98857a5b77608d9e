"""Ranking, neighbours, running, moving and trailing aggregates.

None of these puts a whole key (or the whole table) into one task when it is
large: see ``tidemark.plans.ordering``. Peers and RANGE frames are computed on
pre-aggregated values and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans import ordering
from tidemark.plans.ordering import join_keys, names, sort_columns


def ranked(df, by, order, kind="row", name="rnk", limit=None) -> DataFrame:
    """``row`` number, ``rank`` or ``dense`` rank per key; ties only matter for the last two."""
    if kind == "row":
        return ordering.keyed_row_number(df, by, order, name, limit)
    window = Window.partitionBy(*by).orderBy(*sort_columns(order))
    place = (F.dense_rank() if kind == "dense" else F.rank()).over(window).cast("long")
    parts = ordering.split_hot(df, by, limit)
    if parts is None:
        return df.withColumn(name, place)
    cold, hot = parts
    # Hot keys: rank the counted values, then hand the rank to the rows.
    peers = names(order)
    values = hot.groupBy(*by, *peers).agg(F.count("*").cast("long").alias("_peers"))
    if kind == "dense":
        placed = ordering.keyed_row_number(values, by, order, name, limit)
    else:
        placed = ordering.keyed_running(values, by, order, "_peers", name, "sum", limit)
        placed = placed.withColumn(name, F.col(name) - F.col("_peers") + 1)
    placed = join_keys(hot, placed.drop("_peers"), [*by, *peers])
    return cold.withColumn(name, place).unionByName(placed)


def top_n(df, by, order, n, ties=True, name="rnk") -> DataFrame:
    """First ``n`` rows (or, with ties, distinct values) per key.

    Spark applies the limit before the exchange, so a task sends at most ``n`` rows
    per key. With ties that holds for the distinct values, which then select rows.
    """
    window = Window.partitionBy(*by).orderBy(*sort_columns(order))

    def first_n(rows):
        kept = rows.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
        return kept.withColumn(name, F.col(name).cast("long"))

    if not ties:
        return first_n(df)
    peers = names(order)
    best = first_n(df.select(*by, *peers).distinct())
    return join_keys(df, best, [*by, *peers])


def neighbors(df, by, order, cols: Sequence[str], default=None, limit=None) -> DataFrame:
    """``prev_<col>`` and ``next_<col>`` inside the key."""
    out, limit = df, ordering.check_hot(df, by, limit)
    for col in cols:
        for name, step in ((f"prev_{col}", -1), (f"next_{col}", 1)):
            out = ordering.keyed_neighbor(out, by, order, col, name, step, limit)
            if default is not None:
                out = out.withColumn(name, F.coalesce(name, F.lit(default)))
    return out


def running(df, by, order, col, frame="rows", name="running", limit=None) -> DataFrame:
    """Running sum; ``rows`` counts row by row, ``range`` gives peers the same value."""
    if frame == "rows":
        return ordering.keyed_running(df, by, order, col, name, "sum", limit)
    upto = Window.partitionBy(*by).orderBy(*sort_columns(order))
    plain = F.sum(col).over(upto.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    parts = ordering.split_hot(df, by, limit)
    if parts is None:
        return df.withColumn(name, plain)
    cold, hot = parts
    peers = names(order)
    sums = hot.groupBy(*by, *peers).agg(F.sum(col).alias("_sum"))
    scanned = ordering.keyed_running(sums, by, order, "_sum", name, "sum", limit).drop("_sum")
    scanned = join_keys(hot, scanned, [*by, *peers])
    return cold.withColumn(name, plain).unionByName(scanned)


_AGGS = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def _range_over(points, by, t, value, before: int, after: int, kind: str, name: str, width: int):
    """Aggregate ``value`` over times ``[t-before, t+after]`` (``after <= 0``), one row per (key, t).

    Time is cut into tiles; a row also enters the next tile if that tile's frames
    can reach back to it. Every task then holds one tile of one key.
    """
    width = max(width, before + 1)
    tile = F.floor(F.col(t) / width)
    reaches = F.floor((F.col(t) + before) / width)
    tiled = points.withColumn("_home", tile).withColumn("_tile", F.explode(F.sequence(tile, reaches)))
    frame = Window.partitionBy(*by, "_tile").orderBy(t).rangeBetween(-before, after)
    return (
        tiled.withColumn(name, _AGGS[kind](value).over(frame))
        .filter(F.col("_tile") == F.col("_home"))
        .drop("_home", "_tile")
    )


def moving(
    df, by, t, col, back: int, kind="sum", name="moving", width: int = 4096, upto: int = 0
) -> DataFrame:
    """Aggregate over ``[t-back, t+upto]`` with peers included; ``t`` is an integer (days, seconds).

    ``upto=-1`` leaves out the row's own time.
    """
    first = {"sum": F.sum(col), "count": F.count(col), "max": F.max(col), "min": F.min(col)}[kind]
    points = df.groupBy(*by, t).agg(first.alias("_v"))
    merge = "sum" if kind == "count" else kind
    spread = _range_over(points, by, t, "_v", back, upto, merge, name, width).drop("_v")
    return join_keys(df, spread, [*by, t])


def first_last(df, by, order, cols: Sequence[str]) -> DataFrame:
    """``first_<col>`` and ``last_<col>`` of the whole group on every row."""
    place = F.struct(*names(order))
    aggs = []
    for col in cols:
        aggs += [
            F.min_by(col, place).alias(f"first_{col}"),
            F.max_by(col, place).alias(f"last_{col}"),
        ]
    return join_keys(df, df.groupBy(*by).agg(*aggs), by, "left")


def _bucket(rn: Column, total: Column, n: int) -> Column:
    """NTILE from position and total: the first ``total mod n`` buckets get one row more."""
    size = F.floor(total / n)
    extra = F.pmod(total, F.lit(n))
    wide = extra * (size + 1)
    in_wide = F.floor((rn - 1) / (size + 1)) + 1
    in_narrow = extra + F.floor((rn - 1 - wide) / F.nullif(size, F.lit(0))) + 1
    return F.when(rn <= wide, in_wide).otherwise(in_narrow).cast("long")


def ntile(df, n, order, by: Sequence[str] = (), name="tile", limit=None) -> DataFrame:
    """NTILE over the table or per key, from row numbers and totals."""
    if by:
        numbered = ordering.keyed_row_number(df, by, order, "_rn", limit)
        totals = df.groupBy(*by).agg(F.count("*").alias("_total"))
        sized = join_keys(numbered, totals, by)
    else:
        numbered = ordering.global_row_number(df, order, "_rn")
        total = numbered.agg(F.count("*")).scalar()
        sized = numbered.withColumn("_total", total)
    return sized.withColumn(name, _bucket(F.col("_rn"), F.col("_total"), n)).drop("_rn", "_total")


def nth_highest(df, col, n, distinct=True) -> DataFrame:
    """The n-th largest value; empty if there are fewer. Only n rows leave each task."""
    values = df.select(col).filter(F.col(col).isNotNull())
    values = values.distinct() if distinct else values
    return values.orderBy(F.desc(col)).offset(n - 1).limit(1)


def global_rank(df, order, kind="row", name="rnk") -> DataFrame:
    """Row number, rank or dense rank over the whole table."""
    if kind == "row":
        return ordering.global_row_number(df, order, name)
    peers = names(order)
    values = df.groupBy(*peers).agg(F.count("*").cast("long").alias("_peers"))
    if kind == "dense":
        placed = ordering.global_row_number(values, order, name)
    else:
        placed = ordering.global_running(values, order, "_peers", name)
        placed = placed.withColumn(name, F.col(name) - F.col("_peers") + 1)
    return join_keys(df, placed.drop("_peers"), peers)


def trailing_agg(
    df, t, col, k, seq, kind="sum", key: Sequence[str] = (), name="trailing", width=86_400, limit=None
) -> DataFrame:
    """Aggregate of the events in ``[t-k+1, t]`` as seen when each event arrives.

    Events of the same second accumulate in ``seq`` order; earlier seconds count in
    full. So: running aggregate among the peers, combined with the pre-aggregated
    earlier seconds of the frame.
    """
    key = list(key)
    first = {"sum": F.sum(col), "count": F.count(col), "max": F.max(col), "min": F.min(col)}[kind]
    points = df.groupBy(*key, t).agg(first.alias("_v"))
    merge = "sum" if kind == "count" else kind
    if k > 1:
        earlier = _range_over(points, key, t, "_v", k - 1, -1, merge, "_earlier", width).drop("_v")
    else:
        earlier = points.withColumn("_earlier", F.lit(None).cast(points.schema["_v"].dataType)).drop("_v")
    peers = ordering.keyed_running(df, [*key, t], [seq], col, "_peers", kind, limit)
    old, new = F.col("_earlier"), F.col("_peers")
    combine = {"max": F.greatest, "min": F.least}.get(kind, lambda a, b: a + b)
    total = F.when(old.isNull(), new).when(new.isNull(), old).otherwise(combine(old, new))
    return join_keys(peers, earlier, [*key, t]).withColumn(name, total).drop("_earlier", "_peers")


def hits_at(df, queries, t, k, name="hits", width=86_400) -> DataFrame:
    """Number of events in ``[t-k+1, t]`` at each query time; query times join as zero weights."""
    weights = df.select(t, F.lit(1).alias("_w")).unionByName(queries.select(t, F.lit(0).alias("_w")))
    points = weights.groupBy(t).agg(F.sum("_w").alias("_w"))
    counted = _range_over(points, [], t, "_w", k - 1, 0, "sum", name, width).drop("_w")
    return queries.join(counted, t)
