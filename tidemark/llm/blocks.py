"""Work on groups of any size in bounded pieces.

A group above ``size`` rows is cut into blocks by a hash and handed out as block
pairs, so that every two of its rows meet in one task call and no call holds more
than two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024


def block_pairs(rows: DataFrame, row: str, count: str, size: int = BLOCK) -> DataFrame:
    """Adds ``_i``, ``_j`` (the block pair, ``_i <= _j``) and ``_side`` (0: the row is of block ``_i``, 1: of ``_j``).

    ``count`` is the number of rows of the row's group. A row of a group with n blocks appears n times."""
    blocks = F.ceil(F.col(count) / size).cast("int")
    cut = rows.withColumn("_blocks", F.greatest(blocks, F.lit(1)))
    cut = cut.withColumn("_own", F.pmod(F.xxhash64(row), F.col("_blocks")).cast("int"))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return cut.withColumns(
        {
            "_i": F.least("_own", "_other"),
            "_j": F.greatest("_own", "_other"),
            "_side": (F.col("_own") > F.col("_other")).cast("int"),
        }
    ).drop("_blocks", "_own", "_other")


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``count`` nodes the smallest index reachable by the links."""
    low = np.arange(count)
    while True:
        before = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == before).all():
            return low


def map_sorted_groups(
    df: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame | None], schema
) -> DataFrame:
    """``work`` on each group of ``keys``, many groups per Arrow batch.

    ``applyInPandas`` costs about a millisecond a group; here groups are cut from sorted batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            values = [pdf[k].to_numpy() for k in keys]
            new = np.zeros(len(pdf), bool)
            for v in values:
                new[1:] |= v[1:] != v[:-1]
            cuts = np.concatenate([[0], np.flatnonzero(new), [len(pdf)]])
            found = [work(pdf.iloc[a:b]) for a, b in zip(cuts[:-2], cuts[1:-1])]
            rest = pdf.iloc[cuts[-2] :]
            found = [f for f in found if f is not None and len(f)]
            if found:
                yield pd.concat(found, ignore_index=True)
        if rest is not None and len(rest):
            last = work(rest)
            if last is not None and len(last):
                yield last

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
