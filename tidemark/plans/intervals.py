"""Joins of points with ranges per key, where one key may hold much of both sides.

An equi-join on the key leaves the range to be compared row by row, so a key with many
points and many ranges is one task with the product of both. Such keys are cut into
tiles of their axis (time, mostly): a point lies in one tile, a range is carried
once for each tile it reaches, and the tile joins the key. Every tile a range reaches
between its first and last holds points it covers, so what is carried stays below what
is joined. Tiles that are still too full are cut once more by their own extent, and points
that share a value are dealt out over copies of the tile's ranges.

Keys with few ranges are left alone: Spark splits their points at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.ordering import HOT_ROWS
from tidemark.plans.scratch import materialize
from tidemark.plans.skew import broadcast_if_small

MANY_RANGES = 1000


def _axis(df: DataFrame, value: Column) -> Column:
    """The value as a number in the same order."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def _cut(
    points: DataFrame, ranges: DataFrame, on: Sequence[tuple[str, str]], tile: str, tile_rows: int, many: int
) -> tuple[DataFrame, DataFrame] | None:
    """Both sides with a column ``tile`` of full keys' tiles, 0 for other keys; None if no key is full."""
    names = [f"_k{i}" for i in range(len(on))]
    counted = ranges.groupBy(*[F.col(r).alias(n) for n, (_, r) in zip(names, on)]).agg(F.count(F.lit(1)).alias("_ranges"))
    full = materialize(counted.where(F.col("_ranges") > many), "full-keys")
    if full.isEmpty():
        return None
    full = broadcast_if_small(full)
    mine = points.select(*[F.col(p).alias(n) for n, (p, _) in zip(names, on)], "_x").join(full, names)
    grid = mine.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_points"), F.max("_ranges").alias("_ranges"), F.min("_x").alias("_low"), F.max("_x").alias("_high")
    )
    tiles = F.ceil(F.greatest(F.col("_points") / tile_rows, F.col("_ranges") / many)).cast("int")
    # A key with few points is joined as it is.
    grid = grid.where((F.col("_high") > F.col("_low")) & (F.col("_points") > many)).select(
        *names, "_low", tiles.alias("_tiles"), ((F.col("_high") - F.col("_low")) / tiles).alias("_width")
    )
    grid = materialize(grid, "tile-grid")
    if grid.isEmpty():
        return None
    grid = broadcast_if_small(grid)

    def place(x: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.col("_tiles") - 1, F.floor((x - F.col("_low")) / F.col("_width")))).cast("int")

    def meet(df: DataFrame, side: int) -> DataFrame:
        same = F.lit(True)
        for name, pair in zip(names, on):
            same = same & (F.col(pair[side]) == F.col(name))
        return df.join(grid, same, "left")

    helpers = [*names, "_low", "_tiles", "_width"]
    cut_points = meet(points, 0).withColumn(tile, F.coalesce(place(F.col("_x")), F.lit(0))).drop(*helpers)
    reached = F.sequence(place(F.col("_from")), place(F.col("_to")))
    cut_ranges = meet(ranges, 1).withColumn(tile, F.explode(F.when(F.col("_tiles").isNull(), F.array(F.lit(0))).otherwise(reached)))
    return cut_points, cut_ranges.drop(*helpers)


def tiled(
    points: DataFrame, ranges: DataFrame, on: Sequence[tuple[str, str]], at: Column, start: Column, end: Column,
    tile_rows: int = HOT_ROWS, many: int = MANY_RANGES,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the columns that join besides the keys: tiles of two levels, and the copy of a tile."""
    cut_points = points.withColumn("_x", _axis(points, at))
    cut_ranges = ranges.withColumns({"_from": _axis(ranges, start), "_to": F.coalesce(_axis(ranges, end), F.lit(float("inf")))})
    cut_ranges = cut_ranges.where("_from IS NOT NULL AND _from <= _to")
    on, added = list(on), []
    for level in range(2):
        # The first level cuts keys to the wanted size; the second only what came out far too full.
        slack = 1 if level == 0 else 4
        found = _cut(cut_points, cut_ranges, on, f"_tile{level}", slack * tile_rows, slack * many)
        if found is None:
            break
        cut_points, cut_ranges = (df.withColumnRenamed(f"_tile{level}", f"_{s}tile{level}") for s, df in zip("pr", found))
        added.append(f"tile{level}")
        on.append((f"_ptile{level}", f"_rtile{level}"))
    if added:
        names = [f"_k{i}" for i in range(len(on))]
        counted = cut_points.groupBy(*[F.col(p).alias(n) for n, (p, _) in zip(names, on)]).agg(F.count(F.lit(1)).alias("_n"))
        crowded = counted.where(F.col("_n") > 2 * tile_rows).withColumn("_copies", F.ceil(F.col("_n") / tile_rows).cast("int"))
        crowded = materialize(crowded.drop("_n"), "crowded-tiles")
        if not crowded.isEmpty():
            crowded = broadcast_if_small(crowded)
            for side in (0, 1):
                same = F.lit(True)
                for name, pair in zip(names, on):
                    same = same & (F.col(pair[side]) == F.col(name))
                copies = F.coalesce("_copies", F.lit(1))
                if side == 0:
                    dealt = F.pmod(F.monotonically_increasing_id(), copies).cast("int")
                    cut_points = cut_points.join(crowded, same, "left").withColumn("_pcopy", dealt).drop(*names, "_copies")
                else:
                    each = F.explode(F.sequence(F.lit(0), copies - 1))
                    cut_ranges = cut_ranges.join(crowded, same, "left").withColumn("_rcopy", each).drop(*names, "_copies")
            added.append("copy")
    return cut_points.drop("_x"), cut_ranges.drop("_from", "_to"), added


def interval_join(
    points: DataFrame, ranges: DataFrame, on: Sequence[tuple[str, str]], at: Column, start: Column, end: Column,
    condition: Column, how: str = "inner", tile_rows: int = HOT_ROWS, many: int = MANY_RANGES,
) -> DataFrame:
    """``points.join(ranges, condition, how)`` that stays balanced when a key is hot on both sides.

    ``condition`` holds the equality of the pairs ``on`` and implies ``start <= at <= end``, a null ``end`` being open. A key
    counts as hot from ``many`` ranges on; its tiles hold about ``tile_rows`` points. ``how`` is inner, left, left_semi or
    left_anti: a point lies in one tile only. Without a hot key this is the plain join, after one count of the ranges."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} would need every range in one tile")
    on = list(on)
    counted = ranges.groupBy(*[r for _, r in on]).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > many)
    if counted.isEmpty():
        return points.join(ranges, condition, how)
    points, ranges, added = tiled(points, ranges, on, at, start, end, tile_rows, many)
    for name in added:
        condition = condition & (F.col(f"_p{name}") == F.col(f"_r{name}"))
    return points.join(ranges, condition, how).drop(*[f"_{s}{name}" for s in "pr" for name in added])
