"""Quality classifier on learned subword embeddings.

Every word, every character n-gram of a word and every pair of neighbouring
words is hashed to a bucket with a learned vector. A document is the average of
its vectors, followed by a softmax layer; both are trained by stochastic
gradient descent in numpy on a bounded sample of labelled rows.

The softmax of an average is linear before its last step, so scoring needs one
number per bucket: how far its vector moves the score. Scores cover whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import hashed_sample, table


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    size: int = 16
    low: int = 3
    high: int = 5
    epochs: int = 5
    rate: float = 0.5
    sample: int = 4_000
    longest: int = 60_000
    seed: int = 11


_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def _bucket(hashes: np.ndarray, s: Settings) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(29))) * _MIX >> np.uint64(40)).astype(np.int64) % s.buckets


def features(text: str | None, s: Settings) -> np.ndarray:
    """Buckets of all words, word pairs and character n-grams of a text, repeats included.

    N-grams stay inside a word, whose two ends count as characters. All hashes are
    polynomials over code points, taken over the whole text at once."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    space = np.isin(codes, _SPACES)
    inside = ~space
    first = np.flatnonzero(inside & np.concatenate([[True], space[:-1]])) if len(codes) else np.empty(0, np.int64)
    if not len(first):
        return np.empty(0, np.int64)
    last = np.flatnonzero(inside & np.concatenate([space[1:], [True]])) + 1
    lengths = last - first
    # Each word with a mark (1) before and (2) after it; `word` numbers the characters' words.
    starts = np.concatenate([[0], np.cumsum(lengths + 2)])
    word = np.repeat(np.arange(len(first)), lengths + 2)
    chars = np.zeros(starts[-1], np.uint64)
    place = np.arange(starts[-1]) - starts[word]
    body = (place > 0) & (place <= lengths[word])
    chars[body] = codes[inside]
    chars[starts[:-1]] = 1
    chars[starts[1:] - 1] = 2
    chars = (chars + np.uint64(7)) * _MIX
    powers = np.cumprod(np.full(int(lengths.max()) + 2, _BASE, np.uint64))
    words = np.add.reduceat(chars * powers[place], starts[:-1])
    a, b = words[:-1], words[1:]
    # A word beside itself has one bucket, whatever the word.
    pairs = np.where(a == b, 0, _bucket(a * _BASE + (b ^ np.uint64(0x5BD1E995)), s))
    found = [_bucket(words, s), pairs]
    gram = chars
    for n in range(2, s.high + 1):
        if len(gram) < 2:
            break
        gram = gram[:-1] * _BASE + chars[n - 1 :]
        if n >= s.low:
            found.append(_bucket(gram[word[: len(gram)] == word[n - 1 :]], s))
    return np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """``pull``: what a bucket adds to the log odds of label 1 as part of the average; ``base``: log odds of no words."""

    settings: Settings
    pull: np.ndarray
    base: float


def train(texts: list[str], labels: np.ndarray, s: Settings = Settings()) -> Model:
    """Fit vectors and softmax; with one class only, every score is that class's prior."""
    rng = np.random.default_rng(s.seed)
    vectors = rng.uniform(-1 / s.size, 1 / s.size, (s.buckets, s.size)).astype(np.float32)
    out = np.zeros((2, s.size), np.float32)
    bias = np.zeros(2, np.float32)
    share = (float(labels.sum()) + 1) / (len(labels) + 2)
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(s, np.zeros(s.buckets), prior)
    bias[:] = (0.0, prior)
    rows = []
    for t in texts:
        ids, counts = np.unique(features(t, s), return_counts=True)
        rows.append((ids, counts.astype(np.float32)))
    steps, done = s.epochs * len(rows), 0
    for _ in range(s.epochs):
        for i in rng.permutation(len(rows)):
            rate = s.rate * (1 - done / steps)
            done += 1
            ids, counts = rows[i]
            if not len(ids):
                continue
            weights = counts / counts.sum()
            mean = weights @ vectors[ids]
            score = out @ mean + bias
            p = np.exp(score - score.max())
            p /= p.sum()
            p[labels[i]] -= 1
            step = out.T @ p
            out -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
            # The average spreads a step thinly; scaled by the number of distinct buckets it moves each one.
            vectors[ids] -= rate * weights[:, None] * len(ids) ** 0.5 * step[None, :]
    pull = (vectors @ (out[1] - out[0])).astype(np.float64)
    return Model(s, pull, float(bias[1] - bias[0]))


def log_odds(text: str | None, model: Model) -> float:
    ids = features(text, model.settings)
    return model.base + (float(model.pull[ids].mean()) if len(ids) else 0.0)


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", s: Settings = Settings()) -> Model:
    """Train on at most ``s.sample`` labelled rows outside the held-out fold, the first by a hash of their key.

    Only to bound the driver's memory, texts of more than ``s.longest`` characters are not trained on."""
    labelled = labels.where(F.col("quality").isNotNull() & ~held_out(key))
    labelled = labelled.groupBy(key).agg(F.min("quality").alias("_quality"))
    chosen = hashed_sample(labelled, key, s.sample)
    texts = docs.select(key, "text").where(F.coalesce(F.length("text"), F.lit(0)) <= s.longest)
    rows = chosen.join(texts, key).select(key, "text", "_quality").toPandas().sort_values([key, "text"])
    return train([t or "" for t in rows["text"]], rows["_quality"].to_numpy(np.int64), s)


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key`` and ``score`` (0 to 1, higher is better) for every row; null and empty texts get the model's base."""
    schema = T.StructType([docs.schema[key], T.StructField("score", T.DoubleType())])
    # One number per bucket: a fixed size. Plain values, as executors need not have this package.
    settings, base = model.settings, model.base
    shared = docs.sparkSession.sparkContext.broadcast(model.pull)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Model(settings, shared.value, base)
        for pdf in batches:
            odds = np.array([log_odds(t, known) for t in pdf["text"]], float)
            yield pd.DataFrame({key: pdf[key], "score": 1 / (1 + np.exp(-np.clip(odds, -50, 50)))})

    return docs.select(key, "text").mapInPandas(run, schema)


def classify_query(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs, table(spark, folder, "labels"))
    scored = score(docs, model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
