"""Near-duplicate documents by a multi-index Hamming join on b-bit MinHash signatures.

A signature has ``4 * chunks`` symbols of 16 bits, one per hash function. By the
pigeonhole principle two signatures that differ in at most ``2 * chunks - 1``
symbols have a chunk of four with at most one difference. The allowed errors of a
chunk are enumerated by leaving out each of its symbols in turn, so such a pair
always shares one of ``4 * chunks`` keys. Pairs under the distance threshold are
then confirmed on the full shingle sets.

Equal sets are one representative first. Inside a key's bucket every member is
compared with the bucket's smallest id only; after the components of those links
are known, only members of different components are still compared, in blocks.

Before the full sets are read, a parity sketch (Mitzenmacher, Pagh and Pham, 2014)
rules pairs out: each element flips one bit, so two sketches differ in at most as many
bits as the sets in elements. That bound never rules out a link, and what passes
is linked or very nearly so; inside a block it works without writing pairs out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.blocks import block_pairs, forest, map_sorted_groups
from tidemark.llm.common import table
from tidemark.llm.components import connected_components
from tidemark.llm.wordhash import mix, shingles
from tidemark.plans.scratch import materialize

CHUNK = 4


def _functions(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(found: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """16 bits of the smallest hash under each function."""
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 8192):
        low = np.minimum(low, np.multiply.outer(factors, found[at : at + 8192]).min(axis=1))
    return (mix(low) & np.uint64(0xFFFF)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature the keys of all chunks with each symbol left out in turn."""
    count, symbols = signatures.shape
    keys = []
    for chunk in range(symbols // CHUNK):
        part = signatures[:, chunk * CHUNK : (chunk + 1) * CHUNK].astype(np.uint64)
        for left_out in range(CHUNK):
            others = [part[:, i] for i in range(CHUNK) if i != left_out]
            name = np.full(count, chunk * CHUNK + left_out + 1, np.uint64)
            for symbol in others:
                name = (name << np.uint64(16)) | symbol
            keys.append(mix(name))
    return np.stack(keys, axis=1).view(np.int64)


def sketch(found: np.ndarray) -> bytes:
    """Parity of the elements per cell, with at least two cells (a power of two) per element."""
    cells = 1 << max(6, (2 * len(found) - 1).bit_length())
    places = (found >> np.uint64(7)).astype(np.int64) & (cells - 1)
    return np.packbits((np.bincount(places, minlength=cells) & 1).astype(np.uint8), bitorder="little").tobytes()


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """The same sketch with fewer cells: halves are combined until ``size`` 64-bit words are left."""
    while words.shape[-1] > size:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def most_apart(total, percent: int):
    """Largest symmetric difference of two linked sets with ``total`` elements together."""
    return total * (100 - percent) // (100 + percent)


def signatures(docs: DataFrame, width: int, chunks: int, key: str = "doc_id") -> DataFrame:
    """``id``, ``n_shingles``, ``digest`` of the set (null if empty), ``sig`` and ``sketch`` (binary)."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[key].dataType), T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()), T.StructField("sig", T.BinaryType()),
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    factors = _functions(chunks * CHUNK)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, text in zip(pdf[key], pdf["text"]):
                found = shingles(text, width)
                if len(found):
                    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    rows.append((name, len(found), digest, signature(found, factors).tobytes(), sketch(found)))
                else:
                    rows.append((name, 0, None, None, None))
            yield pd.DataFrame(rows, columns=schema.names).astype({"id": pdf[key].dtype})

    return docs.select(key, "text").mapInPandas(run, schema)


def _keys(reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 4096):
                part = pdf.iloc[at : at + 4096]
                sigs = np.frombuffer(b"".join(part["sig"]), np.uint16).reshape(len(part), -1)
                keys = chunk_keys(sigs)
                yield pd.DataFrame({"key": keys.ravel(), "id": np.repeat(part["id"].to_numpy(), keys.shape[1])})

    return reps.select("id", "sig").mapInPandas(run, "key long, id long")


def _may_link(pdf: pd.DataFrame, percent: int, most: int) -> np.ndarray:
    """Which pairs neither sizes, signatures nor sketches rule out."""
    keep = np.zeros(len(pdf), bool)
    columns = (pdf[c] for c in ("na", "nb", "sa", "sb", "ka", "kb"))
    for i, (na, nb, sa, sb, ka, kb) in enumerate(zip(*columns)):
        if 100 * min(na, nb) < percent * max(na, nb):
            continue
        if (np.frombuffer(sa, np.uint16) != np.frombuffer(sb, np.uint16)).sum() > most:
            continue
        x, y = np.frombuffer(ka, np.uint64), np.frombuffer(kb, np.uint64)
        size = min(len(x), len(y))
        keep[i] = np.bitwise_count(fold(x, size) ^ fold(y, size)).sum() <= most_apart(na + nb, percent)
    return keep


def confirm(pairs: DataFrame, docs: DataFrame, sigs: DataFrame, width: int, percent: int, most: int, key: str) -> DataFrame:
    """Those distinct ``a``, ``b`` with 100 * shared >= percent * union; signatures and sketches first, then the full sets."""
    a = sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa"), F.col("sketch").alias("ka"), F.col("n_shingles").alias("na"))
    b = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb"), F.col("sketch").alias("kb"), F.col("n_shingles").alias("nb"))

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.loc[_may_link(pdf, percent, most), ["a", "b"]]

    close = materialize(pairs.join(a, "a").join(b, "b").mapInPandas(test, "a long, b long"), "close-pairs")
    wanted = close.select(F.col("a").alias("id")).unionByName(close.select(F.col("b").alias("id"))).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [shingles(t, width).view(np.int64) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf[key], "found": sets})

    texts = docs.select(key, "text").join(wanted, docs[key] == wanted["id"]).select(key, "text")
    texts = texts.dropDuplicates([key]) if sigs.count() != sigs.select("id").distinct().count() else texts
    sets = materialize(texts.mapInPandas(run, "id long, found array<long>"), "shingle-sets")
    left = sets.select(F.col("id").alias("a"), F.col("found").alias("fa"))
    right = sets.select(F.col("id").alias("b"), F.col("found").alias("fb"))
    both = close.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("fa", "fb"))
    union = F.size("fa") + F.size("fb") - shared
    return materialize(both.where(100 * shared >= percent * union).select("a", "b"), "links")


def _spanning(edges: pd.DataFrame, each: int) -> np.ndarray:
    """Which edges, sorted by closeness, to try: for each end ``each`` of them, and enough that all that hangs together still does."""
    ends, number = np.unique(edges[["x", "y"]].to_numpy().ravel(), return_inverse=True)
    x, y = number.reshape(-1, 2).T
    both = pd.Series(np.concatenate([x, y]))
    places = both.iloc[np.argsort(np.tile(np.arange(len(x)), 2), kind="stable")].groupby(both).cumcount().sort_index().to_numpy()
    keep = np.minimum(places[: len(x)], places[len(x) :]) < each
    while True:
        low = forest(len(ends), x[keep], y[keep])
        apart = np.flatnonzero(low[x] != low[y])
        if not len(apart):
            return keep
        # The closest edge out of each tree; the edges are in the order of closeness.
        for side in (x, y):
            _, first = np.unique(low[side[apart]], return_index=True)
            keep[apart[first]] = True


def _cross_pairs(pdf: pd.DataFrame, percent: int, most: int, each: int) -> pd.DataFrame | None:
    """Pairs of one block pair that are in different components and that nothing rules out.

    Only so many that they join all the components that all pairs would, and the ``each`` closest of a component, more in small
    blocks; a row with equal ids says that there are others."""
    if len(pdf) < 2:
        return None
    ids, parts, side, sizes = (pdf[c].to_numpy() for c in ("id", "component_id", "_side", "n_shingles"))
    names, number = np.unique(parts, return_inverse=True)
    if len(names) < 2:
        return None
    # Of two components one is not the largest, so rows of the others are enough to start from.
    others = number != np.bincount(number).argmax()
    within = pdf["_i"].iat[0] == pdf["_j"].iat[0]
    sigs = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), -1)
    raw = [np.frombuffer(k, np.uint64) for k in pdf["sketch"]]
    lengths = np.array([len(k) for k in raw])
    shapes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    found = []
    for r in np.flatnonzero(others):
        mask = (number != number[r]) & (~others | (ids > ids[r]))
        mask &= (100 * np.minimum(sizes, sizes[r]) >= percent * np.maximum(sizes, sizes[r]))
        if not within:
            mask &= side != side[r]
        mask[mask] = (sigs[mask] != sigs[r]).sum(axis=1) <= most
        for at in np.unique(np.minimum(lengths[mask], lengths[r])):
            if at not in shapes:
                rows = np.flatnonzero(lengths >= at)
                shapes[at] = rows, np.stack([fold(raw[i], at) for i in rows])
            rows, table_ = shapes[at]
            chosen = mask[rows] & (np.minimum(lengths[rows], lengths[r]) == at)
            apart = np.bitwise_count(table_[chosen] ^ fold(raw[r], at)).sum(axis=1)
            near = rows[chosen]
            ok = apart <= most_apart(sizes[near] + sizes[r], percent)
            if ok.any():
                near = near[ok]
                pair = np.sort(np.stack([ids[near], np.full(len(near), ids[r])]), axis=0)
                both = np.sort(np.stack([parts[near], np.full(len(near), parts[r])]), axis=0)
                found.append(pd.DataFrame({"a": pair[0], "b": pair[1], "x": both[0], "y": both[1], "apart": apart[ok]}))
    if not found:
        return None
    rows = pd.concat(found, ignore_index=True).sort_values(["apart", "a", "b"], ignore_index=True)
    tried = _spanning(rows, max(each, 4096 // len(names)))
    key = pdf["key"].iat[0]
    out = rows.loc[tried, ["a", "b"]].assign(key=key)
    return out if tried.all() else pd.concat([out, pd.DataFrame({"a": [0], "b": [0], "key": [key]})])


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, chunks: int = 14, key: str = "doc_id"
) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if the Jaccard similarity of their sets of ``width``-word shingles is at least ``percent``
    in 100. At 80 and 14 chunks a linked pair differs in 11 of 56 symbols on average and is found up to 27;
    the chance to miss one is below 1 in a million. ``component_id`` is the smallest id reachable. Null, empty and wordless
    texts have 0 shingles and no links. Repeated rows share their id's result. A row without an
    id has a set but is no one's component. An empty table gives no rows. ``key`` is a long; other columns are not read.
    """
    most = 2 * chunks - 1
    sigs = materialize(signatures(docs, width, chunks, key), "signatures")
    named = sigs.where("digest IS NOT NULL AND id IS NOT NULL")
    reps = named.groupBy("digest").agg(F.min(F.struct("id", "sig", "sketch", "n_shingles")).alias("r")).select("digest", "r.*")
    reps = materialize(reps, "representatives")

    keys = _keys(reps)
    centres = keys.groupBy("key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(keys.join(centres, "key"), "buckets")
    stars = members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    links = confirm(stars, docs, reps, width, percent, most, key)
    found = materialize(connected_components(links), "components")

    each, more = 4, True
    while more:
        placed = members.where("n > 2").join(found, "id", "left")
        placed = materialize(placed.withColumn("component_id", F.coalesce("component_id", "id")), "placed")
        mixed = placed.groupBy("key").agg(F.min("component_id").alias("x"), F.max("component_id").alias("y"))
        mixed = materialize(mixed.where("x <> y").select("key"), "mixed")
        rows = placed.join(mixed, "key").join(reps.select("id", "sig", "sketch", "n_shingles"), "id")
        rows = block_pairs(rows.select("key", "id", "component_id", "n", "sig", "sketch", "n_shingles"), "id", "n")
        compare = partial(_cross_pairs, percent=percent, most=most, each=each)
        rest = materialize(map_sorted_groups(rows, ["key", "_i", "_j"], compare, "a long, b long, key long"), "cross-pairs")
        tried = rest.where("a <> b").select("a", "b").distinct()
        links = links.unionByName(confirm(tried, docs, reps, width, percent, most, key))
        found = materialize(connected_components(links), "components")
        # Pairs that were left out matter only where a pair of the same bucket was tried and is no link.
        of_a, of_b = (found.select(F.col("id").alias(c), F.col("component_id").alias(f"of_{c}")) for c in "ab")
        ends = rest.where("a <> b").join(of_a, "a", "left").join(of_b, "b", "left")
        apart = ends.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("key").distinct()
        others = materialize(rest.where("a = b").select("key").distinct().join(apart, "key", "left_semi"), "buckets-open")
        more = not others.isEmpty()
        if more:
            members = materialize(members.join(others, "key", "left_semi"), "buckets-left")
        each = max(1024, 16 * each)  # few components are left

    of_set = reps.join(found, "id", "left").select("digest", F.coalesce("component_id", "id").alias("component_id"))
    out = sigs.join(of_set, "digest", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def minhash_query(spark, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=3, percent=85, chunks=12)


MINHASH_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS c
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * c >= 85 * (nx + ny - c)),
walk AS (
  WITH RECURSIVE reach(id, node) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT id, CASE WHEN node = x THEN y ELSE x END FROM reach JOIN links ON node = x OR node = y)
  SELECT id, min(node) AS component_id FROM reach GROUP BY id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN walk ON id = doc_id
"""
