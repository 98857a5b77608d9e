"""Joins, lookups, nesting and interval joins.

No join here carries a broadcast hint: Spark picks one from table statistics or,
at run time, from measured sizes, and splits skewed sides of sort-merge joins.
Details are aggregated before they are joined wherever only their totals matter.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import top_n
from tidemark.plans.intervals import MANY_RANGES, interval_join
from tidemark.plans.ordering import HOT_ROWS, join_keys, keyed_neighbor
from tidemark.plans.skew import paged_lists


def count_with_zeros(
    master: DataFrame, detail: DataFrame, key: str, detail_key: str, name: str = "n"
) -> DataFrame:
    """Every master row with its number of details, zeros kept."""
    counts = detail.groupBy(F.col(detail_key).alias("_k")).agg(F.count("*").alias("_n"))
    return (
        master.join(counts, master[key] == counts["_k"], "left")
        .withColumn(name, F.coalesce("_n", F.lit(0)))
        .drop("_k", "_n")
    )


def spine(df: DataFrame, keys: Sequence[str], name: str, values: Column) -> DataFrame:
    """All combinations of the distinct ``keys`` with the array ``values``.

    The second dimension is an array literal or a ``sequence`` of dates, so the
    combinations come from an explode, not from a product join.
    """
    return df.select(*keys).distinct().withColumn(name, F.explode(values))


def above_group_avg(df: DataFrame, key: str, val: str, name: str = "above") -> DataFrame:
    """Flag rows above their group's average; averages are pre-aggregated and joined back."""
    means = df.groupBy(key).agg(F.avg(val).alias("_mean"))
    return join_keys(df, means, [key], "left").withColumn(name, F.col(val) > F.col("_mean")).drop("_mean")


def asof_dim_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    date: str,
    start: str = "effective_from",
    end: str = "effective_to",
    how: str = "left",
    tile_rows: int = HOT_ROWS,
    many: int = MANY_RANGES,
) -> DataFrame:
    """The dimension version valid at the fact's date: ``start <= date < end``, null end open.

    Keys with more than ``many`` versions are joined tile by tile, ``tile_rows`` facts each.
    """
    versions = dim.withColumnRenamed(key, "_dim_key")
    valid = (
        (fact[key] == versions["_dim_key"])
        & (versions[start] <= fact[date])
        & (versions[end].isNull() | (fact[date] < versions[end]))
    )
    pair, until = [(key, "_dim_key")], versions[end]
    return interval_join(fact, versions, pair, fact[date], versions[start], until, valid, how, tile_rows, many).drop("_dim_key")


def overlapping_ranges(dim: DataFrame, key: str, start: str, end: str, limit=None) -> DataFrame:
    """Versions that begin before the previous version of their key has ended."""
    span = dim.withColumn("_span", F.struct(F.col(start).alias("start"), F.col(end).alias("end")))
    stepped = keyed_neighbor(span, [key], [start], "_span", "_prev", -1, limit)
    still_open = F.col("_prev.end").isNull() | (F.col("_prev.end") > F.col(start))
    return stepped.filter(F.col("_prev").isNotNull() & still_open).drop("_span", "_prev")


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], how: str = "inner") -> DataFrame:
    """Join dimensions one after the other: ``(dimension, column so far, dimension key)``.

    Chaining a dimension on a column of an earlier one gives the snowflake form.
    """
    out = fact
    for dim, left, right in dims:
        out = out.join(dim, out[left] == dim[right], how)
        if left != right:
            out = out.drop(dim[right])
    return out


def to_wide(fact: DataFrame, dims, columns: Sequence[Column | str]) -> DataFrame:
    """Denormalize to one row per fact; facts without a dimension row stay."""
    return star_join(fact, dims, "left").select(*columns)


def batch_lookup(df: DataFrame, key: str, ref: DataFrame, ref_key: str, name: str) -> DataFrame:
    """Attach the referenced row as a struct; a null or unknown id gives a null struct."""
    entry = ref.select(F.col(ref_key).alias("_ref"), F.struct(*ref.columns).alias(name))
    return df.join(entry, df[key] == entry["_ref"], "left").drop("_ref")


def nest(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    order: Sequence,
    fields: Sequence[str],
    name: str = "children",
    page_size: int = 10_000,
) -> DataFrame:
    """Children as ordered arrays under their parent; childless parents get one empty page."""
    pages = paged_lists(
        child.filter(F.col(child_key).isNotNull()).withColumn("_fk", F.col(child_key)),
        ["_fk"],
        F.struct(*fields),
        order,
        page_size,
        name,
    )
    empty = F.array().cast(pages.schema[name].dataType)
    return (
        parent.join(pages, parent[parent_key] == pages["_fk"], "left")
        .drop("_fk")
        .withColumn("page", F.coalesce("page", F.lit(0).cast("long")))
        .withColumn(name, F.coalesce(name, empty))
    )


def enrich(
    df: DataFrame,
    key: str,
    reference: DataFrame | Callable[[DataFrame], DataFrame],
    reason: str = "reject_reason",
) -> DataFrame:
    """Add reference columns by distinct key; rows without a match carry a reason.

    ``reference`` is a frame keyed by ``key`` or a function from the distinct keys
    to such a frame, so an outside service is asked once per key, not once per row.
    """
    if callable(reference):
        reference = reference(df.select(key).filter(F.col(key).isNotNull()).distinct())
    found = reference.withColumn("_found", F.lit(True))
    return (
        df.join(found, key, "left")
        .withColumn(reason, F.when(F.col("_found").isNull(), F.lit(f"{key}:no_reference")))
        .drop("_found")
    )


def entitled(
    requests: DataFrame,
    consents: DataFrame,
    keys: Sequence[str] = ("customer_id", "partner_id"),
    at: str = "requested_at",
    scope: str = "scope",
    how: str = "left_semi",
    tile_rows: int = HOT_ROWS,
    many: int = MANY_RANGES,
) -> DataFrame:
    """Requests covered by a consent that was granted, unexpired, unrevoked and in scope.

    A semi-join, so overlapping consents do not multiply a request. Keys with more than ``many``
    consents are joined tile by tile.
    """
    consents = consents.withColumnsRenamed({key: f"_held_{key}" for key in keys})
    cond = F.lit(True)
    for key in keys:
        cond = cond & (requests[key] == consents[f"_held_{key}"])
    cond = (
        cond
        & (requests[at] >= consents["granted_at"])
        & (requests[at] <= consents["expires_at"])
        & (consents["revoked_at"].isNull() | (requests[at] <= consents["revoked_at"]))
        & F.array_contains(consents["granted_scopes"], requests[scope])
    )
    held = [(key, f"_held_{key}") for key in keys]
    start, end = consents["granted_at"], consents["expires_at"]
    found = interval_join(requests, consents, held, requests[at], start, end, cond, how, tile_rows, many)
    return found.drop(*[name for _, name in held])


def assemble(
    keys: DataFrame,
    key: str,
    parts: Mapping[str, tuple[DataFrame, Sequence, Sequence[str], int]],
) -> DataFrame:
    """One row per entity with the newest rows of several sources.

    ``parts[name] = (source, order, fields, newest)``; the per-key top-N runs before
    the lists are built, so every list has at most ``newest`` entries. A source
    without rows gives an empty array.
    """
    out = keys
    for name, (source, order, fields, newest) in parts.items():
        kept = top_n(source, [key], order, newest, ties=False, name="_place")
        entry = F.struct("_place", *fields)
        lists = kept.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_list"))
        items = F.transform("_list", lambda e: F.struct(*[e[f].alias(f) for f in fields]))
        lists = lists.select(key, items.alias(name))
        out = out.join(lists, key, "left").withColumn(
            name, F.coalesce(name, F.array().cast(lists.schema[name].dataType))
        )
    return out


def applicable(
    docs: DataFrame,
    apps: DataFrame,
    doc_id: str,
    app_id: str,
    tags: str = "tags",
    wildcard: str = "All",
) -> DataFrame:
    """(document, application) pairs that share a tag; the wildcard tag fits every application."""
    doc_tags = docs.select(doc_id, F.explode(F.array_distinct(tags)).alias("_tag"))
    own = F.array_distinct(F.concat(F.col(tags), F.array(F.lit(wildcard))))
    app_tags = apps.select(app_id, F.explode(own).alias("_tag"))
    return doc_tags.join(app_tags, "_tag").select(doc_id, app_id).distinct()
