"""Stored vector and text indexes against the exact operators."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import retrieval, text_index, vector_index


def ranked(df, id):
    return sorted((r["query_id"], r["rnk"], r[id], round(r["score"], 5)) for r in df.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 4000)] + 0.35 * rng.normal(size=(4000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001, None), (9002, []), (9003, [float("nan")] * 24), (9004, [None] * 24), (9005, [0.0] * 24)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8).cache()


def test_recall_of_probed_lists(spark, vectors, tmp_path):
    root = str(tmp_path / "index")
    good = vectors.where("vec_id < 9000 OR vec_id = 9005")
    vector_index.build(vectors.where("vec_id % 2 = 0"), root, sample=1000)
    vector_index.add(vectors.where("vec_id % 2 <> 0"), root)
    lists = spark.read.parquet(f"{root}/lists")
    assert lists.count() == 4001 and lists.select("vec_id").distinct().count() == 4001  # every vector, once
    asked = vectors.where("vec_id < 9000 AND vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = ranked(retrieval.knn(good, asked, 10), "vec_id")
    assert ranked(vector_index.search(spark, root, asked, 10, probes=vector_index.MAX_LISTS), "vec_id") == exact
    found = ranked(vector_index.search(spark, root, asked, 10, probes=8), "vec_id")
    hit = {(q, v) for q, _, v, _ in found} & {(q, v) for q, _, v, _ in exact}
    print("recall", len(hit) / len(exact))
    assert len(hit) >= 0.9 * len(exact)
    one = vector_index.search(spark, root, asked.limit(1), 10, probes=3)
    assert len(ranked(one, "vec_id")) == 10
    scans = [x for x in one._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert any("cell#" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)


def test_nothing_to_search(spark, vectors, tmp_path):
    root = str(tmp_path / "index")
    vector_index.build(vectors.where("vec_id < 5"), root)
    assert vector_index.search(spark, root, vectors.where("vec_id > 9000 AND vec_id < 9005").withColumnRenamed("vec_id", "query_id")).count() == 0
    with pytest.raises(ValueError):
        vector_index.build(vectors.where("vec_id = 9001"), str(tmp_path / "none"))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(3000)]
    docs = []
    for i in range(3000):
        words = rng.choices(common, k=rng.randrange(5, 60)) + rng.sample(rare, rng.randrange(4))
        docs.append((i, " ".join(words)))
    return docs + [(5000, None), (5001, ""), (5002, " , ")]


ASKED = [(1, "r5 r77 c1"), (2, "c1 c2 c3"), (3, "R9 r9, r10!"), (4, "nowhere"), (5, ""), (6, "c4 r1500 r1501 r1502")]


def frames(spark, docs):
    return spark.createDataFrame(docs, "id long, text string").repartition(4), spark.createDataFrame(ASKED, "query_id long, query_text string")


def test_same_ranks_as_bm25_after_deltas(spark, texts, tmp_path):
    root = str(tmp_path / "index")
    docs, asked = frames(spark, texts)
    text_index.add(docs, root, 0, "id", "text", block=100, buckets=32)
    assert ranked(text_index.search(spark, root, asked, 10, "id", 32), "id") == ranked(retrieval.bm25(docs, asked, 10, "id", "text"), "id")
    changed = [(i, "r5 r9 " + (t or "")) for i, t in texts if i % 50 == 0] + [(7000, "r77 r77 r1501"), (7001, "c1")]
    gone = {i for i, _ in texts if i % 70 == 3}
    one, _ = frames(spark, changed)
    for _ in range(2):  # a batch that is added again changes nothing
        text_index.add(one, root, 1, "id", "text", docs.where(F.col("id").isin(list(gone))).select("id"), block=100, buckets=32)
    back = [(i, t) for i, t in texts if i in sorted(gone)[:3]] + [(7000, "c1 c2 r5")]
    two, _ = frames(spark, back)
    text_index.add(two, root, 2, "id", "text", block=100, buckets=32)
    now = {i: t for i, t in texts if i not in gone} | dict(changed) | dict(back)
    now, _ = frames(spark, list(now.items()))
    assert ranked(text_index.search(spark, root, asked, 10, "id", 32), "id") == ranked(retrieval.bm25(now, asked, 10, "id", "text"), "id")


def test_only_the_folders_of_the_terms_are_read(spark, texts, tmp_path, monkeypatch):
    root = str(tmp_path / "index")
    docs, asked = frames(spark, texts)
    text_index.add(docs, root, 0, "id", "text", block=100, buckets=32)
    every = spark.read.parquet(f"{root}/postings").inputFiles()
    kept, plain = {}, text_index.materialize

    def watched(df, label):
        kept[label] = df
        return plain(df, label)  # what is written is watched, not changed

    monkeypatch.setattr(text_index, "materialize", watched)
    found = text_index.search(spark, root, asked.where("query_id = 1"), 2, "id", 32)
    assert found.count() == 2
    buckets = {r[0] for r in spark.createDataFrame([("r5",), ("r77",), ("c1",)], "t string").select(text_index._bucket(F.col("t"), 32)).collect()}
    plan = kept["posting-heads"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "postings" not in plan.split("ReadSchema")[1].split("\n")[0]
    wanted = [f for f in every if any(f"bucket={b}/" in f for b in buckets)]
    assert 0 < len(wanted) <= len(every) / 8
    # Two documents with rare words leave few of the 30 blocks to score.
    assert kept["block-bounds"].count() >= 25
    assert kept["blocks-left"].count() <= 15


def plain_bm25(docs, asked, k):
    """Scores by the definition; texts of equal id and length count as one, a repeated question counts twice."""
    bags, n, words = {}, 0, 0
    for id, text in docs:
        if text is not None:
            bag = re.findall(r"[a-z0-9]+", text.lower())
            bags.setdefault((id, len(bag)), []).extend(bag)
            n, words = n + 1, words + len(bag)
    counts = {key: Counter(bag) for key, bag in bags.items()}
    df = Counter(t for c in counts.values() for t in c)
    scores = Counter()
    for query, text in asked:
        for term in set(re.findall(r"[a-z0-9]+", text.lower())):
            for (id, length), c in counts.items():
                if c[term]:
                    idf = math.log1p((n - df[term] + 0.5) / (df[term] + 0.5))
                    scores[query, id] += idf * c[term] * 2.2 / (c[term] + 1.2 * (0.25 + 0.75 * length / (words / n)))
    out = []
    for query in {q for q, _ in asked}:
        best = sorted(((-round(s, 9), id is None, id) for (q, id), s in scores.items() if q == query))[:k]
        out += [(query, i + 1, id, round(-s, 5)) for i, (s, _, id) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("most, cells", [(1 << 19, 4 << 20), (4, 300)])
def test_bm25_scores_in_the_tasks_without_joining_words(spark, texts, monkeypatch, most, cells):
    monkeypatch.setattr(retrieval, "MAX_ASKED", most)
    monkeypatch.setattr(retrieval, "SCORE_CELLS", cells)
    rows = texts[::3] + texts[:40:3] + [(0, "r5 c1 c1"), (3, "r77"), (None, "r5 r9 r9")]
    asked = [*ASKED, (2, "c1 c2 c3")]
    docs, _ = frames(spark, rows)
    questions = spark.createDataFrame(asked, "query_id long, query_text string")
    kept, plain = {}, retrieval.materialize

    def watched(df, label):
        kept.setdefault(label, []).append(df)
        return plain(df, label)

    monkeypatch.setattr(retrieval, "materialize", watched)
    found = retrieval.bm25(docs, questions, 10, "id", "text")
    assert ranked(found, "id") == plain_bm25(rows, asked, 10)
    # What is kept of a text is one row, not one per word, and no exchange was needed for it.
    assert kept["term-counts"][0].count() == len(rows)
    assert "Exchange hashpartitioning" not in kept["term-counts"][0]._jdf.queryExecution().executedPlan().toString()


def test_a_posting_is_read_once_however_many_ask_for_it(spark, texts, tmp_path, monkeypatch):
    root = str(tmp_path / "index")
    docs, _ = frames(spark, texts)
    text_index.add(docs, root, 0, "id", "text", block=100, buckets=32)
    asked = spark.createDataFrame([(q, f"c1 c2 c3 r{q}") for q in range(60)], "query_id long, query_text string")
    kept, plain = {}, text_index.materialize

    def watched(df, label):
        kept[label] = plain(df, label)
        return kept[label]

    monkeypatch.setattr(text_index, "materialize", watched)
    found = text_index.search(spark, root, asked, 5, "id", 32)
    assert ranked(found, "id") == ranked(retrieval.bm25(docs, asked, 5, "id", "text"), "id")
    # Pairs of query and document would be 60 times the documents of the blocks.
    assert kept["seed-scores"].count() < 60 * 200
