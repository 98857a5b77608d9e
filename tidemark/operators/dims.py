"""Slowly changing dimensions, upserts, surrogate keys, normal forms and hierarchies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import row_checksum
from tidemark.plans.ordering import check_hot, join_keys, keyed_neighbor
from tidemark.plans.scratch import materialize


def upsert(current: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delta rows replace rows of the same key and add new ones.

    ``delta`` must not repeat a key; see ``repeated_keys``. To limit the rewrite, pass
    only the touched partitions as ``current``.
    """
    return join_keys(current, delta, keys, "left_anti").unionByName(delta.select(*current.columns))


def repeated_keys(delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    return delta.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def scd1(current: DataFrame, delta: DataFrame, slice_keys: Sequence[str]) -> DataFrame:
    """Slices named in ``delta`` are replaced whole, so vanished rows vanish."""
    touched = delta.select(*slice_keys).distinct()
    return join_keys(current, touched, slice_keys, "left_anti").unionByName(delta.select(*current.columns))


def open_versions(delta: DataFrame, key: str, attrs: Sequence[str], effective: str) -> DataFrame:
    """History table built from a first delta."""
    empty = delta.limit(0).select(
        key, *attrs, F.col(effective).alias("effective_from"), F.col(effective).alias("effective_to")
    )
    return scd2(empty, delta, key, attrs, effective)


def scd2(
    current: DataFrame, delta: DataFrame, key: str, attrs: Sequence[str], effective: str, limit=None
) -> DataFrame:
    """New history: versions with ``effective_from``, ``effective_to`` (null = open), ``is_current``.

    The history of touched keys is laid out again from old and new versions: equal
    neighbours merge and every version ends where the next begins. So several
    changes per key, late effective dates and replays need no special case, and a
    replay changes nothing. Of two versions with the same date the delta's wins. A
    late change lasts until the next stored version; observations that confirmed a
    state without changing it are not stored.
    """
    columns = [key, *attrs, "effective_from"]
    old = current.select(*columns, F.lit(0).alias("_new"))
    fresh = delta.select(key, *attrs, F.col(effective).alias("effective_from"), F.lit(1).alias("_new"))
    touched = delta.select(key).distinct()
    versions = join_keys(old, touched, [key], "left_semi").unionByName(fresh)
    # Among repeated delta rows of one date the largest state wins, so that reruns agree.
    best = F.max(F.struct("_new", F.struct(*attrs).alias("_state")))
    versions = (
        versions.groupBy(key, "effective_from").agg(best.alias("_best"))
        .select(key, "effective_from", F.col("_best._state").alias("_state"))
    )
    order = ["effective_from"]
    limit = check_hot(versions, [key], limit)
    versions = keyed_neighbor(versions, [key], order, "_state", "_prev", -1, limit)
    # Compared as values, which a hash would only do up to collisions.
    versions = versions.filter(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(F.col("_state")))
    versions = versions.select(key, "effective_from", "_state.*")
    versions = keyed_neighbor(versions, [key], order, "effective_from", "effective_to", 1, limit)
    kept = join_keys(current, touched, [key], "left_anti").select(*columns, "effective_to")
    return kept.unionByName(versions.select(*columns, "effective_to")).withColumn(
        "is_current", F.col("effective_to").isNull()
    )


def scd3(current: DataFrame, delta: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Keep one earlier value per attribute in ``previous_<attr>``."""
    new = delta.select(key, *[F.col(a).alias(f"_new_{a}") for a in attrs], F.lit(True).alias("_seen"))
    known = F.col("_in_current")
    joined = current.withColumn("_in_current", F.lit(True)).join(new, key, "full")
    out = {}
    for a in attrs:
        incoming, prev = F.col(f"_new_{a}"), f"previous_{a}"
        changed = F.coalesce(F.col("_seen"), F.lit(False)) & ~incoming.eqNullSafe(F.col(a))
        before = F.col(prev) if prev in current.columns else F.lit(None).cast(current.schema[a].dataType)
        out[prev] = F.when(changed & known.isNotNull(), F.col(a)).otherwise(before)
        out[a] = F.when(F.col("_seen"), incoming).otherwise(F.col(a))
    return joined.withColumns(out).select(key, *[c for a in attrs for c in (a, f"previous_{a}")])


def surrogate(df: DataFrame, cols: Sequence[str], name: str = "sk") -> DataFrame:
    """Key that only depends on the row's natural key, so reruns give the same.

    Nulls are marked, so that a value moved to another column changes the key."""
    return df.withColumn(name, row_checksum(cols))


def surrogate_collisions(df: DataFrame, cols: Sequence[str], name: str = "sk") -> DataFrame:
    return df.select(name, *cols).distinct().groupBy(name).agg(F.count("*").alias("n")).filter("n > 1")


def normalize(wide: DataFrame, spec: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One table per entry: its key (first column) and the attributes that depend on it."""
    return {name: wide.select(*cols).distinct() for name, cols in spec.items()}


def broken_dependencies(wide: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Keys with more than one set of attribute values."""
    return wide.select(key, *attrs).distinct().groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def hierarchy(df: DataFrame, id: str, parent: str, max_depth: int | None = None) -> DataFrame:
    """Depth, root and path of every node reachable from a root.

    One join per level; each level is written, so the plan does not grow and lost
    executors do not repeat earlier levels. A node that is already on its path is
    not followed again, so the walk ends at the deepest level. A tree deeper than
    ``max_depth`` is an error, never cut.
    """
    edges = df.select(F.col(id).alias("_id"), F.col(parent).alias("_parent"))
    level = edges.filter(F.col("_parent").isNull()).select(
        F.col("_id").alias(id),
        F.col("_id").alias("root"),
        F.lit(0).alias("depth"),
        F.array("_id").alias("path"),
    )
    level = materialize(level, "hierarchy")
    result, depth = level, 0
    while True:
        depth += 1
        below = edges.join(level, edges["_parent"] == level[id])
        below = below.filter(~F.array_contains("path", F.col("_id"))).select(
            F.col("_id").alias(id),
            "root",
            F.lit(depth).alias("depth"),
            F.concat("path", F.array("_id")).alias("path"),
        )
        level = materialize(below, "hierarchy")
        if level.isEmpty():
            return result
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"{id} has nodes below level {max_depth}")
        result = result.unionByName(level)
