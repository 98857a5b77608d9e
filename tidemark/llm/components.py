"""Connected components of an edge list by alternating large-star and small-star steps.

Each step replaces the edges by as many or fewer, so nothing grows with the size
of a component. Edges are written between rounds; both sides of the join are
plain exchanges, which Spark splits where one node has very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scratch import materialize


def _step(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        near = edges.unionByName(turned)
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = materialize(near.groupBy("a").agg(F.min("b").alias("low")), "lowest")
    joined = near.join(lowest.withColumn("low", F.least("a", "low")), "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            lowest.select("a", F.least("a", "low").alias("b"))
        )
    return materialize(out.where("a <> b").distinct(), "edges")


def _state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component_id`` (the smallest id reachable) for every id that is not its own component.

    ``edges`` has two long columns ``a`` and ``b``; direction, repeats and loops do not matter."""
    edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = _step(_step(edges, True), False)
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
