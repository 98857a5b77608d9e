"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A vector is rotated by three rounds of random signs and a Hadamard transform; its
hash is the axis, with sign, of the largest coordinate. A cell joins the hashes of
``polytopes`` rotations, and each of ``tables`` tables has rotations of its own. A
vector is at home in one cell per table and also looks into the cells whose hashes
its coordinates almost chose. Two vectors are candidates where one looks into the
other's home; candidates are verified by cosine in double precision.

Pairs are not written out. A block of a cell counts the links of its vectors and
returns a spanning forest; a pair that meets in several cells counts in the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import block_pairs, forest, map_sorted_groups
from tidemark.llm.common import table
from tidemark.llm.components import connected_components
from tidemark.plans.scratch import materialize

NEAR = 4  # axes per rotation that a probe may use


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of signs and fast Hadamard transforms; columns are a power of two."""
    size = x.shape[1]
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (3, size))
    for round_ in range(3):
        x = x * signs[round_]
        half = 1
        while half < size:
            pairs = x.reshape(len(x), size // (2 * half), 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
            half *= 2
        x = x / np.sqrt(size)
    return x


def cells(x: np.ndarray, tables: int, polytopes: int, probes: int) -> np.ndarray:
    """(rows, tables, probes): the cells each unit vector looks into; the first is its home."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    out = np.empty((len(x), tables, probes), np.int64)
    near = min(NEAR, size)
    for t in range(tables):
        code, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for k in range(polytopes):
            z = rotate(x, 1000 * t + k)
            height = np.abs(z)
            best = np.argsort(-height, axis=1, kind="stable")[:, :near]
            top = np.take_along_axis(height, best, 1)
            axis = 2 * best + (np.take_along_axis(z, best, 1) < 0)
            code = (code[:, :, None] * (2 * size) + axis[:, None, :]).reshape(len(x), -1)
            cost = (cost[:, :, None] + ((top[:, :1] - top) ** 2)[:, None, :]).reshape(len(x), -1)
        order = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        chosen = np.take_along_axis(code, order, 1)
        out[:, t] = np.pad(chosen, ((0, 0), (0, probes - chosen.shape[1])), mode="edge")
    return out


def _unit(column: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in column])
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _links(pdf: pd.DataFrame, least: float, tables: int, polytopes: int, probes: int) -> pd.DataFrame | None:
    """Links of one block pair that no earlier cell has counted: counts per node, and forest edges."""
    if len(pdf) < 2 or not pdf["home"].any():
        return None
    pdf = pdf.sort_values("node")
    x = _unit(pdf["vector"])
    node, weight, side = (pdf[c].to_numpy() for c in ("node", "weight", "_side"))
    t, cell = int(pdf["t"].iat[0]), int(pdf["cell"].iat[0])
    within = pdf["_i"].iat[0] == pdf["_j"].iat[0]
    looks = None
    found_a, found_b = [], []
    for at in range(0, len(x), 256):
        close = x[at : at + 256] @ x.T >= least
        rows, cols = np.nonzero(close)
        rows = rows + at
        keep = (rows < cols) & (True if within else side[rows] != side[cols])
        rows, cols = rows[keep], cols[keep]
        if not len(rows):
            continue
        if looks is None:
            looks = cells(x, tables, polytopes, probes)
        fresh = np.ones(len(rows), bool)
        for earlier in range(t):
            fresh &= ~(looks[rows, earlier, :1] == looks[cols, earlier]).any(axis=1)
            fresh &= ~(looks[cols, earlier, :1] == looks[rows, earlier]).any(axis=1)
        # In this table the pair meets at the home of its smaller node, or else of its larger.
        small = (looks[rows, t, :1] == looks[cols, t]).any(axis=1)
        meets = np.where(small, looks[rows, t, 0] == cell, (looks[cols, t, 0] == cell) & (looks[rows, t] == cell).any(axis=1))
        fresh &= meets
        found_a.append(rows[fresh])
        found_b.append(cols[fresh])
    if not found_a:
        return None
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    if not len(a):
        return None
    counts = np.bincount(a, weights=weight[b], minlength=len(x)) + np.bincount(b, weights=weight[a], minlength=len(x))
    low = forest(len(x), a, b)
    some = np.flatnonzero(counts)
    return pd.DataFrame({"a": node[some], "b": node[low[some]], "links": counts[some].astype(np.int64)})


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    least: float = 0.98, tables: int = 8, polytopes: int = 2, probes: int = 4,
) -> DataFrame:
    """One row per vector: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Vectors of one label and length are linked if their cosine is at least ``least``. Null vectors, vectors with null or
    non-finite components, zero vectors and those with a null label or key have no links. Rows with equal label and
    vector are linked to each other. Labels may be of any type that can be grouped; vectors under one id are rows of their own. With the defaults a pair at cosine 0.98 in 64
    dimensions is missed by a table with a chance of 0.07, by all eight with less than 1 in 10^9. More ``polytopes`` make
    cells smaller for larger tables. An empty table gives no rows; other columns are not read.
    """
    columns = [F.col(key).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label")]
    rows = materialize(vectors.select(F.monotonically_increasing_id().alias("row"), *columns), "vectors")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    good = rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    good = good.where(finite).where(F.exists("vector", lambda v: v != 0))
    reps = good.groupBy("label", "vector").agg(
        F.min("row").alias("node"), F.min("id").alias("first"), F.count(F.lit(1)).alias("weight")
    )
    # A label is known by the first row that has it.
    known = good.groupBy("label").agg(F.min("row").alias("of"))
    reps = materialize(reps.join(known, "label").withColumn("d", F.size("vector")), "vectors-distinct")
    cell_schema = "of long, d int, node long, t int, cell long, home boolean"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, part in pdf.groupby("d"):
                for at in range(0, len(part), 4096):
                    some = part.iloc[at : at + 4096]
                    looks = cells(_unit(some["vector"]), tables, polytopes, probes)
                    each = tables * probes
                    out = pd.DataFrame(
                        {
                            "of": np.repeat(some["of"].to_numpy(), each),
                            "d": np.repeat(some["d"].to_numpy(), each),
                            "node": np.repeat(some["node"].to_numpy(), each),
                            "t": np.tile(np.repeat(np.arange(tables), probes), len(some)),
                            "cell": looks.reshape(-1),
                            "home": np.tile(np.arange(probes) == 0, len(some) * tables),
                        }
                    )
                    yield out.drop_duplicates(["node", "t", "cell"])

    by = ["of", "d", "t", "cell"]
    looks = reps.select("of", "d", "node", "vector").mapInPandas(place, cell_schema)
    looks = materialize(looks, "cells")
    busy = looks.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("h")).where("n > 1 AND h").drop("h")
    busy = materialize(busy, "cells-busy")
    meeting = looks.join(busy, by)
    meeting = block_pairs(meeting, "node", "n")
    meeting = meeting.join(reps.select("node", "vector", "weight"), "node")
    found = map_sorted_groups(
        meeting, [*by, "_i", "_j"], lambda pdf: _links(pdf, least, tables, polytopes, probes), "a long, b long, links long"
    )
    found = materialize(found, "vector-links")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("a", "b")).join(reps.select(F.col("node").alias("id"), "first"), "id", "right")
    parts = parts.select("id", "first", F.coalesce("component_id", "id").alias("part"))
    parts = materialize(parts, "vector-parts")
    lowest = parts.groupBy("part").agg(F.min("first").alias("component_id"))
    parts = parts.join(lowest, "part").select("id", "component_id")

    of_rep = reps.join(links, reps["node"] == links["a"], "left").join(parts, reps["node"] == parts["id"])
    of_rep = of_rep.select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    of_rep = materialize(of_rep, "vector-results")
    out = rows.join(of_rep, ["label", "vector"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def vectors_query(spark, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


VECTORS_SQL = r"""
WITH good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
walk AS (
  WITH RECURSIVE reach(id, node) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT id, y FROM reach JOIN links ON node = x)
  SELECT id, min(node) AS component_id FROM reach GROUP BY id),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN walk ON id = vec_id LEFT JOIN counted ON x = vec_id
"""
