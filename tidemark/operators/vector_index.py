"""A stored vector index: inverted lists under learned centroids, probed and ranked exactly.

Centroids are fitted on a bounded sample; every vector is then filed under the
centroid it is closest to, in a folder of its list. A query looks into the lists of its nearest
centroids only, and what it finds there is ranked by the exact cosine. Probing all
lists gives the exact answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.retrieval import CELL_BYTES, MAX_QUERIES, _scorer
from tidemark.operators.windows import top_n
from tidemark.plans.skew import broadcast_if_small

SAMPLE = 65_536  # vectors that centroids are fitted on, all of the driver's share
MAX_LISTS = 4096


def _sampled(vectors: DataFrame, count: int, size: int) -> np.ndarray:
    """At most ``size`` vectors, chosen by a hash of their id."""
    rows = vectors
    if count > size:
        rows = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < int(size / count * 1_000_003) + 1)
    found = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).select("embedding").collect()
    return np.array([r[0] for r in found], np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm == 0, 1, norm)


def fit(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids of the sample by rounds of assignment and mean; a list left empty takes the worst placed vector."""
    x = _unit(sample)
    centres = x[np.linspace(0, len(x) - 1, lists).astype(int)]
    for _ in range(rounds):
        scores = x @ centres.T
        near, best = scores.argmax(axis=1), scores.max(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        empty = np.flatnonzero(np.bincount(near, minlength=lists) == 0)
        sums[empty] = x[np.argsort(best, kind="stable")[: len(empty)]]
        centres = _unit(sums)
    return centres


def _usable(vectors: DataFrame) -> DataFrame:
    number = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(number)


def build(vectors: DataFrame, root: str, lists: int | None = None, sample: int = SAMPLE) -> None:
    """Fit centroids and file all of ``vectors`` (vec_id long, embedding) under ``root``.

    ``lists`` is the square root of the number of vectors unless given, at most 4,096. Vectors that are null, empty or
    hold null or non-finite components are not filed. All vectors have one length."""
    vectors = _usable(vectors)
    count = vectors.count()
    if not count:
        raise ValueError("no vectors to fit centroids on")
    taken = _sampled(vectors, count, sample)
    centres = fit(taken, min(lists or max(1, round(math.sqrt(count))), MAX_LISTS, len(taken)))
    rows = [(i, c.tolist()) for i, c in enumerate(centres)]
    spark = vectors.sparkSession
    spark.createDataFrame(rows, "cell int, centroid array<double>").coalesce(1).write.mode("overwrite").parquet(f"{root}/centroids")
    add(vectors, root)


def _centroids(spark: SparkSession, root: str) -> np.ndarray:
    """As many as there are lists: at most 4,096."""
    rows = spark.read.parquet(f"{root}/centroids").orderBy("cell").collect()
    return np.array([r["centroid"] for r in rows])


def _nearest(df: DataFrame, id: str, centres: np.ndarray, probes: int) -> DataFrame:
    """``id``, ``embedding`` and ``cell``: one row for each of the ``probes`` nearest centroids."""

    # A local function travels by value, so executors need numpy but not this package.
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.array([np.asarray(v, np.float64) for v in pdf["embedding"]])
            scores = x @ centres.T  # the vector's own length changes no order
            some = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
            at = np.repeat(np.arange(len(pdf)), some.shape[1])
            yield pdf.iloc[at].assign(cell=some.reshape(-1).astype(np.int32))

    kinds = dict(df.dtypes)
    return df.select(id, "embedding").mapInPandas(place, f"{id} {kinds[id]}, embedding {kinds['embedding']}, cell int")


def add(vectors: DataFrame, root: str) -> None:
    """File more vectors under the centroids that are there."""
    filed = _nearest(_usable(vectors), "vec_id", _centroids(vectors.sparkSession, root), 1)
    # Lists are spread over tasks and files by their measured size.
    filed.hint("rebalance", F.col("cell")).write.mode("append").partitionBy("cell").parquet(f"{root}/lists")


def search(spark: SparkSession, root: str, queries: DataFrame, k: int = 10, probes: int = 8) -> DataFrame:
    """The ``k`` nearest by cosine in the ``probes`` closest lists: query_id, vec_id, score, rnk; ties by vec_id.

    Only the folders of probed lists are read. Large lists are cut into slices, and many queries of a list into
    blocks, so that a task holds one bounded cell; it passes on its k best per query."""
    centres = _centroids(spark, root)
    probed = _nearest(_usable(queries), "query_id", centres, min(probes, len(centres)))
    asked = probed.groupBy("cell").agg(F.count(F.lit(1)).alias("_asked"))
    cells = [r["cell"] for r in asked.select("cell").collect()]  # at most one per list
    stored = spark.read.parquet(f"{root}/lists").where(F.col("cell").isin(cells))
    filed = stored.groupBy("cell").agg(F.count(F.lit(1)).alias("_filed"))
    row_bytes = 8 * (centres.shape[1] + MAX_QUERIES)
    sizes = asked.join(filed, "cell").select(
        "cell", F.ceil(F.col("_filed") * row_bytes / CELL_BYTES).cast("int").alias("_slices"),
        F.ceil(F.col("_asked") / MAX_QUERIES).cast("int").alias("_blocks"),
    )
    sizes = broadcast_if_small(sizes)
    unit, best_of, _ = _scorer(k)

    def spread(df, id, own, own_count, other, other_count):
        return df.join(sizes, "cell").select(
            id, "embedding", "cell", F.pmod(F.xxhash64(id), F.col(own_count)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)).alias(other),
        )

    left = spread(stored, "vec_id", "_slice", "_slices", "_block", "_blocks")
    right = spread(probed, "query_id", "_block", "_blocks", "_slice", "_slices")

    def score(vec: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(vec) or not len(ask):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best_of(vec["vec_id"], vec["embedding"], ask["query_id"], unit(ask["embedding"]))

    by = ["cell", "_slice", "_block"]
    near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(score, "query_id long, vec_id long, score double")
    return top_n(near, ["query_id"], [("score", "desc"), "vec_id"], k, ties=False)
