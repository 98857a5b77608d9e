"""Remove long word runs that also start earlier, by compacted De Bruijn paths.

The edges of the graph are runs of ``width`` words, its nodes the runs of one word
less. Only repeated edges matter, so the graph is built around anchors: every edge
is named by the smallest hash among its shorter runs (its minimizer), and equal
edges have equal anchors. Neighbouring edges with one anchor form a path without
branches, carried as one row. Joins keep the paths whose anchor occurs twice, and
compact those with equal content to one path with its first source coordinates.
Edges are looked at one by one only where different paths meet at an anchor, that
is, at the ends and branches of repeats. Every result is exact on the 128 bits of
anchor and edge hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import table
from tidemark.llm.wordhash import mix, run_hashes, word_hashes
from tidemark.plans.scratch import materialize

ANCHOR = 6


def anchors(words: np.ndarray, width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest hash of each edge's shorter runs, and the hashes of all shorter runs."""
    runs = run_hashes(words, anchor)
    span = width - anchor + 1
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64), runs
    low, reach = runs, 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    return np.minimum(low[:count], low[span - reach : span - reach + count]), runs


def _new(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def outlines(docs: DataFrame, width: int, anchor: int, key: str) -> DataFrame:
    """``id``, ``n_words``, ``whole`` (sha256 of all words) and ``anchors``; an anchor found twice is listed twice."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[key].dataType), T.StructField("n_words", T.LongType()),
            T.StructField("whole", T.StringType()), T.StructField("anchors", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, text in zip(pdf[key], pdf["text"]):
                raw = _raw(text)
                split = raw.split()
                lowest, runs = anchors(word_hashes(raw), width, anchor)
                own = np.unique(lowest[np.flatnonzero(_new(lowest))])
                at = np.minimum(np.searchsorted(own, runs), max(len(own) - 1, 0))
                counts = np.bincount(at[own[at] == runs], minlength=len(own)) if len(own) else own
                listed = np.repeat(own, np.minimum(counts, 2).astype(np.int64)).view(np.int64)
                rows.append((name, len(split), hashlib.sha256(b" ".join(split)).hexdigest(), listed))
            yield pd.DataFrame(rows, columns=schema.names).astype({"id": pdf[key].dtype})

    return docs.select(key, "text").mapInPandas(run, schema)


def paths(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    """One row per path of ``id``, ``text`` whose anchor is in ``found``: its anchor, content hash, place and edges.

    ``inner``: an edge occurs twice within the path."""
    schema = "anchor long, path long, id long, start long, n long, inner boolean, edges array<long>"

    def of_text(name: int, text: str | None, found: list[int]) -> pd.DataFrame | None:
        words = word_hashes(_raw(text))
        lowest, _ = anchors(words, width, anchor)
        if not len(lowest):
            return None
        # Edges are hashed apart from anchors, so that the two together have 128 bits.
        edges = run_hashes(mix(words + np.uint64(0x632BE59BD9B4E019)), width)
        start = np.flatnonzero(_new(lowest))
        size = np.diff(np.append(start, len(lowest)))
        place = np.arange(len(lowest)) - np.repeat(start, size)
        powers = np.cumprod(np.full(int(size.max()) + 1, 0xD6E8FEB86659FD93, np.uint64))
        content = mix(np.add.reduceat(edges * powers[place], start))
        path = np.repeat(np.arange(len(start)), size)
        order = np.lexsort((edges, path))
        twice = (edges[order][1:] == edges[order][:-1]) & (path[order][1:] == path[order][:-1])
        inner = np.zeros(len(start), bool)
        inner[path[order][1:][twice]] = True
        names = lowest[start].view(np.int64)
        kept = np.flatnonzero(np.isin(names, np.asarray(found, np.int64)))
        signed = edges.view(np.int64)
        return pd.DataFrame(
            {
                "anchor": names[kept], "path": content.view(np.int64)[kept], "id": name, "start": start[kept],
                "n": size[kept], "inner": inner[kept],
                "edges": [signed[start[k] : start[k] + size[k]] for k in kept],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at : at + 500]
                rows = [of_text(*r) for r in zip(part["id"], part["text"], part["found"])]
                rows = [r for r in rows if r is not None and len(r)]
                if rows:
                    yield pd.concat(rows, ignore_index=True)

    return docs.select("id", "text", "found").mapInPandas(run, schema)


def repeated_runs(
    docs: DataFrame, outline: DataFrame, width: int, anchor: int, key: str, unique: bool
) -> tuple[DataFrame, DataFrame]:
    """(``id``, ``ranges`` of edges that start earlier elsewhere) and (``id``, ``text``) of the documents looked at.

    ``outline`` lists the documents to compare, without later exact copies."""
    listed = outline.select(F.explode("anchors").alias("anchor"))
    often = listed.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    often = materialize(often, "anchors-often")
    shared = outline.select("id", F.explode(F.array_distinct("anchors")).alias("anchor")).join(often, "anchor")
    wanted = shared.groupBy("id").agg(F.collect_list("anchor").alias("found"))
    texts = docs.select(F.col(key).alias("id"), "text").join(wanted, "id")
    texts = materialize(texts if unique else texts.dropDuplicates(["id"]), "texts-shared")

    found = materialize(paths(texts, width, anchor), "paths")
    place = F.struct("id", "start")
    by = ["anchor", "path", "n"]
    first = found.groupBy(*by).agg(F.min(place).alias("first"), F.max("inner").alias("inner"))
    first = materialize(first, "paths-first")
    slim = found.select(*by, "id", "start").join(first.drop("inner"), by)
    later = slim.where(F.struct("id", "start") != F.col("first")).select("id", "start", "n")

    # Edges of the first instances, where paths of different content meet or one repeats itself.
    per_anchor = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.max("inner").alias("x"))
    meeting = materialize(per_anchor.where("c > 1 OR x").select("anchor"), "anchors-meeting")
    ends = first.join(meeting, "anchor").select(*by, "first.id", "first.start")
    ends = ends.join(found.select(*by, "id", "start", "edges"), [*by, "id", "start"])
    ends = materialize(ends.select("anchor", "id", "start", "edges"), "paths-meeting")
    edges = ends.select("anchor", "id", "start", F.posexplode("edges").alias("at", "edge"))
    edges = edges.select("anchor", "edge", "id", (F.col("start") + F.col("at")).alias("start"))
    shared_edges = edges.groupBy("anchor", "edge").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c"))
    shared_edges = materialize(shared_edges.where("c > 1").drop("c"), "edges-first")
    single = edges.join(shared_edges, ["anchor", "edge"]).where(F.struct("id", "start") != F.col("first"))
    ranges = later.unionByName(single.select("id", "start", F.lit(1).cast("long").alias("n")))
    return ranges.groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("ranges")), texts


def _cut(docs: DataFrame, width: int) -> DataFrame:
    schema = "id long, n_removed long, kept_sha256 string, kept_text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, text, ranges in zip(pdf["id"], pdf["text"], pdf["ranges"]):
                words = _raw(text).split()
                edge = np.zeros(len(words) + 1, np.int64)
                for r in ranges:
                    edge[r["start"]] += 1
                    edge[r["start"] + r["n"] + width - 1] -= 1
                keep = np.cumsum(edge)[:-1] == 0
                left = b" ".join(compress(words, keep))
                rows.append((name, int((~keep).sum()), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["id", "n_removed", "kept_sha256", "kept_text"])

    return docs.mapInPandas(run, schema)


def remove_repeats(docs: DataFrame, width: int = 20, key: str = "doc_id", anchor: int = ANCHOR) -> DataFrame:
    """One row per document: ``key``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` (null: nothing removed).

    A word goes if it is covered by a run of ``width`` words that also starts earlier: in a
    document with a smaller id, or before in its own. Runs are judged on the input. Null and empty texts have no
    words. Rows of one id are one document: each gets the result of the same runs, and is no copy of the other. A row without
    an id is never cut and cuts nothing. An empty table gives no rows. ``key`` is a long; other columns are not read.
    """
    outline = materialize(outlines(docs, width, anchor, key), "outlines")
    long_enough = outline.where((F.col("n_words") >= width) & F.col("id").isNotNull())
    # Texts with the same words as an earlier one go whole and take no further part.
    whole = materialize(long_enough.groupBy("whole").agg(F.min("id").alias("first")), "whole-first")
    compared = long_enough.join(whole, "whole").where("id = first")
    unique = long_enough.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    compared = compared if unique else compared.dropDuplicates(["id"])
    compared = materialize(compared.select("id", "anchors"), "compared")
    ranges, texts = repeated_runs(docs, compared, width, anchor, key, unique)
    cut = _cut(texts.select("id", "text").join(ranges, "id"), width)

    out = outline.drop("anchors").join(whole, "whole", "left").join(cut, "id", "left")
    copy = (F.col("n_words") >= width) & (F.col("id") > F.col("first"))
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("id").alias(key),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def substring_query(spark, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).drop("kept_text")


SUBSTRING_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM words WHERE len(w) >= 20),
named AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS run FROM runs),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS n FROM named) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, w,
    list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(gone, []), i)) AS stays
  FROM words LEFT JOIN lists USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(stays, lambda i: w[i]), ' ')) AS kept_sha256 FROM kept
"""
