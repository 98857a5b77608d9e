"""Row-level filters, predicates and masking."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordering import join_keys


def explode_list(df: DataFrame, col: str, keep_empty: bool = False) -> DataFrame:
    """One row per element of an array column; nested arrays are flattened first."""
    kind = df.schema[col].dataType
    nested = getattr(kind, "elementType", None)
    items = F.flatten(col) if nested is not None and nested.typeName() == "array" else F.col(col)
    return df.withColumn(col, F.explode_outer(items) if keep_empty else F.explode(items))


def present(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def _holds(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def take_while(
    df: DataFrame,
    cond: Column,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    drop: bool = False,
) -> DataFrame:
    """Rows before the first one (in ``order_by``) that fails ``cond``; ``drop`` gives the rest.

    The first failing position is one aggregate, so no key is ever sorted. A null
    predicate fails. ``order_by`` must be unique and not null.
    """
    place = F.struct(*order_by)
    failing = df.filter(~_holds(cond))
    if not partition_by:
        stop = failing.agg(F.min(place)).scalar()
        before = _holds(place < stop) | F.isnull(stop)
        return df.filter(~before if drop else before)
    stops = failing.groupBy(*partition_by).agg(F.min(place).alias("_stop"))
    joined = join_keys(df, stops, partition_by, "left")
    before = F.col("_stop").isNull() | (place < F.col("_stop"))
    return joined.filter(~before if drop else before).select(*df.columns)


def drop_while(df, cond, order_by, partition_by=()) -> DataFrame:
    return take_while(df, cond, order_by, partition_by, drop=True)


def any_match(df: DataFrame, cond: Column, name: str = "matched") -> DataFrame:
    """One row; false on empty input. Stops at the first hit."""
    return df.filter(cond).limit(1).agg((F.count("*") > 0).alias(name))


def none_match(df: DataFrame, cond: Column, name: str = "matched") -> DataFrame:
    """One row; true on empty input."""
    return df.filter(cond).limit(1).agg((F.count("*") == 0).alias(name))


def all_match(df: DataFrame, cond: Column, name: str = "matched") -> DataFrame:
    """One row; true on empty input. A null predicate counts as a failure."""
    return none_match(df, ~_holds(cond), name)


def observed(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """Attach metrics that are filled in when an action runs (no per-row side effects)."""
    return df.observe(name, *[column.alias(key) for key, column in metrics.items()])


def mask_columns(df: DataFrame, roles: Iterable[str], rules: Mapping[str, Mapping]) -> DataFrame:
    """Mask columns the given roles may not read.

    ``rules[column] = {"allowed": {role, …}, "how": "mask" | "null" | "hash" | Column}``.
    """
    held = set(roles)
    out = {}
    for name, rule in rules.items():
        if held & set(rule["allowed"]):
            continue
        how = rule.get("how", "mask")
        if isinstance(how, Column):
            out[name] = how
        elif how == "null":
            out[name] = F.lit(None).cast(df.schema[name].dataType)
        elif how == "hash":
            out[name] = F.sha2(F.col(name).cast("string"), 256)
        else:
            out[name] = F.mask(F.col(name).cast("string"))
    return df.withColumns(out) if out else df
