"""Exact top-k search by distributed selection on score histograms.

All scores of a query against all candidates are integers. A round counts them in
bins of the range that is known to hold the query's kth highest score, adds the
counts of all tasks up, and goes on inside the bin where the count from above
reaches k. When the range is one value wide, that value is the kth score; one more
pass keeps what lies above it and as many of its ties, by smallest key, as are missing.

Queries and candidates meet in tiles of bounded size, so no task holds more than
two blocks, and each tile sends at most k bins or rows per query: from a tile's own
kth highest score down, nothing can matter. Scores are computed anew in every pass
and never written.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.blocks import map_sorted_groups
from tidemark.llm.common import finite, table
from tidemark.plans.scratch import materialize

SLAB = 256  # queries scored at a time
EXACT = 1 << 53  # products of whole doubles below this are exact
LARGEST = 1 << 62

TILE = ["_d", "_cb", "_qb"]


def _scores(pdf: pd.DataFrame):
    """Slabs of a tile: queries, candidates, scores; a query's own row scores below everything."""
    asks = pdf["_ask"].to_numpy()
    queries, others = pdf[asks], pdf[~asks]
    if not len(queries) or not len(others):
        return
    reach = int(queries["_reach"].max())
    kind = np.float64 if reach < EXACT else np.int64
    right = np.stack(others["_v"].to_numpy()).astype(kind).T
    rows = others["_row"].to_numpy()
    for at in range(0, len(queries), SLAB):
        some = queries.iloc[at : at + SLAB]
        scores = (np.stack(some["_v"].to_numpy()).astype(kind) @ right).astype(np.int64)
        scores[some["_row"].to_numpy()[:, None] == rows[None, :]] = -LARGEST
        yield some, others, scores


def histogram(pdf: pd.DataFrame, k: int, bins: int) -> pd.DataFrame | None:
    """Counts per query and bin of one tile, from the top down to where the tile alone has k scores."""
    out = []
    for some, _, scores in _scores(pdf):
        low, span = some["_low"].to_numpy(np.int64), some["_span"].to_numpy(np.int64)
        width = -(-span // bins)
        q, c = np.nonzero((scores >= low[:, None]) & (scores < (low + span)[:, None]))
        at = (scores[q, c] - low[q]) // width[q]
        counts = np.bincount(q * bins + at, minlength=len(some) * bins).reshape(len(some), bins)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k))
        out.append(pd.DataFrame({"_row": some["_row"].to_numpy()[q], "_bin": b, "_n": counts[q, b]}))
    return pd.concat(out, ignore_index=True) if out else None


def select(pdf: pd.DataFrame, k: int) -> pd.DataFrame | None:
    """Candidates of one tile above the query's kth score, and of its ties those with the smallest keys."""
    out = []
    for some, others, scores in _scores(pdf):
        q, c = np.nonzero(scores >= some["_low"].to_numpy(np.int64)[:, None])
        if not len(q):
            continue
        found = pd.DataFrame(
            {
                "_row": some["_row"].to_numpy()[q], "query_id": some["_id"].to_numpy()[q], "id": others["_id"].to_numpy()[c],
                "other": others["_row"].to_numpy()[c], "score": scores[q, c],
            }
        ).sort_values(["_row", "score", "id", "other"], ascending=[True, False, True, True])
        out.append(found.groupby("_row", sort=False).head(k))
    return pd.concat(out, ignore_index=True) if out else None


def top_products(
    vectors: DataFrame, asks: Column, key: str = "vec_id", vector: str = "embedding",
    k: int = 5, scale: int = 256, tile: int = 8192, bins: int = 512,
) -> DataFrame:
    """The ``k`` rows with the highest inner product for each row where ``asks`` (of ``key``) is true.

    Components become floor(``scale`` * x). Returns ``query_id``, ``rank`` (from 1), ``key``, ``score``; ties go to the
    smaller key. A row is no candidate of its own; a row that repeats it is, and rows with repeated keys are asked for one
    by one. With fewer than ``k`` candidates all are returned. Rows take no part if their key is null, or their vector is null
    or holds null or non-finite components, and vectors of different lengths do not meet. Scores that may not fit a
    long are an error. An empty table gives no rows; other columns are not read, whatever their names."""
    rows = vectors.select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_x"), asks.alias("_asks"))
    rows = rows.where(F.col("_id").isNotNull() & finite("_x"))
    whole = F.transform("_x", lambda x: F.floor(x * scale).cast("long"))
    rows = rows.select(
        "_id", whole.alias("_v"), F.coalesce("_asks", F.lit(False)).alias("_asks"), F.size("_x").alias("_d"),
        F.monotonically_increasing_id().alias("_row"),
        F.sqrt(F.aggregate("_x", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * scale).cast("double"), 2))).alias("_norm"),
    )
    rows = materialize(rows, "whole-vectors")
    sizes = rows.groupBy("_d").agg(
        F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("_cbs"),
        F.greatest(F.ceil(F.count_if("_asks") / tile).cast("int"), F.lit(1)).alias("_qbs"),
        F.max("_norm").alias("_most"),
    )
    sizes = materialize(sizes, "vector-sizes")
    placed = rows.join(sizes, "_d")
    # No score is above the product of the two lengths; the margin covers the rounding of the roots.
    reach = F.ceil(F.col("_norm") * F.col("_most") * 1.000001).cast("decimal(38,0)") + 1
    queries = placed.where("_asks").withColumn("_reach", reach)
    widest = queries.agg(F.max("_reach")).first()[0]
    if widest is not None and widest >= LARGEST // 2:
        raise ValueError("scores may not fit a long")
    queries = queries.withColumn("_reach", F.col("_reach").cast("long"))
    state = queries.select("_row", (-F.col("_reach")).alias("_low"), (2 * F.col("_reach") + 1).alias("_span"), F.lit(0).cast("long").alias("_above"))

    def tiles(state: DataFrame) -> DataFrame:
        own_c, own_q = (F.pmod(F.xxhash64(F.col("_row"), F.lit(n)), F.col(c)).cast("int") for n, c in ((1, "_cbs"), (2, "_qbs")))
        all_c, all_q = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("_cbs", "_qbs"))
        nothing = F.lit(0).cast("long")
        others = placed.select("_d", own_c.alias("_cb"), all_q.alias("_qb"), F.lit(False).alias("_ask"), "_row", "_id", "_v",
                               nothing.alias("_reach"), nothing.alias("_low"), nothing.alias("_span"))
        asked = queries.join(state, "_row").select("_d", all_c.alias("_cb"), own_q.alias("_qb"), F.lit(True).alias("_ask"), "_row", "_id", "_v",
                                                   "_reach", "_low", "_span")
        return others.unionByName(asked)

    span = 2 * int(widest) + 1 if widest is not None else 1
    while span > 1:
        counts = map_sorted_groups(tiles(state), TILE, lambda pdf: histogram(pdf, k, bins), "_row long, _bin long, _n long")
        counts = counts.groupBy("_row", "_bin").agg(F.sum("_n").alias("_n"))
        down = Window.partitionBy("_row").orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reached = counts.withColumn("_sum", F.sum("_n").over(down)).join(state, "_row").where(F.col("_above") + F.col("_sum") >= k)
        # The highest bin that reaches k.
        here = reached.groupBy("_row").agg(F.max_by(F.struct("_bin", (F.col("_sum") - F.col("_n")).alias("_over")), "_bin").alias("_at"))
        width = F.ceil(F.col("_span") / bins).cast("long")
        found = F.col("_at").isNotNull()
        # Without one there are fewer than k candidates, and all of them are wanted.
        state = state.join(here, "_row", "left").select(
            "_row", F.when(found, F.col("_low") + F.col("_at._bin") * width).otherwise(F.col("_low")).alias("_low"),
            F.when(found, width).otherwise(F.lit(1)).cast("long").alias("_span"),
            (F.col("_above") + F.when(found, F.col("_at._over")).otherwise(0)).alias("_above"),
        )
        state = materialize(state, "kth-ranges")
        span = math.ceil(span / bins)

    schema = "_row long, query_id long, id long, other long, score long"
    found = map_sorted_groups(tiles(state), TILE, lambda pdf: select(pdf, k), schema)
    best = Window.partitionBy("_row").orderBy(F.col("score").desc(), "id", "other")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", F.col("id").alias(key), "score")


def top_query(spark, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


TOP_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""
