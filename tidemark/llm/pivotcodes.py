"""Short codes for vectors: one codebook index per part, found with LAESA pivots.

A vector becomes integers and is cut into parts; each part position has a small
codebook that a fixed number of rounds moves to the middle of the parts it is
nearest to. A few entries of the first codebook stay as pivots: every part's
distance to them is computed once and written with the part. A round then only
measures its entries against the pivots, and by the triangle inequality the two
distances bound that of part and entry from below. Entries are tried in the
order of this bound, and those whose bound is above the best distance so far are
never evaluated. Distances and bounds are integers, so nothing is approximate.

What a round gathers is one sum per codebook component, whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import finite, matrix, table
from tidemark.plans.scratch import materialize
from tidemark.plans.skew import broadcast_if_small

# Largest integer component: sums of squares of up to 64 differences then fit a long.
LARGEST = 1 << 27


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as integers."""
    out = np.floor(x * scale)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is above {LARGEST // scale} in size")
    return out.astype(np.int64)


def bounds(width: int, parts: int) -> list[slice]:
    """Where the parts begin and end: equal, or one component apart if ``parts`` does not divide ``width``."""
    return [slice(p * width // parts, (p + 1) * width // parts) for p in range(parts)]


def root(squares: np.ndarray) -> np.ndarray:
    """The whole part of the square roots, exactly."""
    r = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    r -= r * r > squares
    return r + ((r + 1) * (r + 1) <= squares)


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Whole Euclidean distances, rows of ``x`` by rows of ``points``."""
    out = np.empty((len(x), len(points)), np.int64)
    for i, point in enumerate(points):
        gap = x - point
        out[:, i] = root((gap * gap).sum(axis=1))
    return out


def spread(points: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the points, each the farthest from those before; the first comes first."""
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def nearest(x: np.ndarray, near: np.ndarray, book: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry (ties: the lower), its squared distance, and how many distances were evaluated.

    ``near`` are the distances of ``x`` to the pivots and ``marks`` those of ``book``, rounded down: two true
    distances differ by more than their whole parts less one."""
    low = np.zeros((len(x), len(book)), np.int64)
    for p in range(near.shape[1]):
        np.maximum(low, np.abs(near[:, p, None] - marks[None, :, p]) - 1, out=low)
    order = np.argsort(low, axis=1, kind="stable")
    best, at = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(book))
    alive, evaluated = np.arange(len(x)), 0
    for place in range(len(book)):
        entry = order[alive, place]
        bound = low[alive, entry]
        go = bound * bound <= best[alive]
        alive, entry = alive[go], entry[go]
        if not len(alive):
            break
        evaluated += len(alive)
        gap = x[alive] - book[entry]
        square = (gap * gap).sum(axis=1)
        better = (square < best[alive]) | ((square == best[alive]) & (entry < at[alive]))
        best[alive[better]], at[alive[better]] = square[better], entry[better]
    return at, best, evaluated


def _assigned(batch: pa.RecordBatch, books: list[np.ndarray], pivots: list[np.ndarray], cuts: list[slice]):
    """Integer components of a written batch and, per part, the nearest entries with their squared distances."""
    width = cuts[-1].stop if cuts else 0
    x = matrix(batch.column("x"), width).astype(np.int64)
    near = matrix(batch.column("near"), sum(map(len, pivots))).astype(np.int64)
    found, at = [], 0
    for book, pivot, cut in zip(books, pivots, cuts):
        own = near[:, at : at + len(pivot)]
        found.append(nearest(x[:, cut], own, book, distances(book, pivot))[:2])
        at += len(pivot)
    return x, found


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, pivots: int = 4,
) -> DataFrame:
    """One row per kept vector: ``key``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Rows whose vector is null or holds null or non-finite components are dropped, and those whose vector has another
    length than that of the smallest kept ``key``. Codebooks start with the ``entries`` smallest keys, nulls last, repeated
    keys by their vectors; with fewer rows they are shorter. Equal rows get equal codes. Labels are compared as they are, nulls
    together. A component above 2^27 / ``scale`` in size is an error, as its distances need not fit a long. An empty table
    gives no rows; columns other than the three are not read, so their names do not matter."""
    kept = vectors.select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x")
    ).where(finite("x"))
    order = [F.col("id").asc_nulls_last(), F.col("x")]
    first = kept.orderBy(*order).limit(entries).collect()
    width = len(first[0]["x"]) if first else 0
    kept = kept.where(F.size("x") == width)
    if any(len(r["x"]) != width for r in first):
        first = kept.orderBy(*order).limit(entries).collect()
    start = whole(np.array([r["x"] for r in first], np.float64).reshape(len(first), width), scale)
    cuts = bounds(width, parts)
    books = [start[:, cut] for cut in cuts]
    fixed = [spread(book, pivots) if len(book) else book for book in books]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole(matrix(batch.column("x"), width), scale)
            near = np.concatenate([distances(x[:, cut], p) for cut, p in zip(cuts, fixed)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), _lists(x), _lists(near)], ["id", "label", "x", "near"]
            )

    types = dict(kept.dtypes)
    measured = kept.mapInArrow(
        measure, f"id {types['id']}, label {types['label']}, x array<int>, near array<int>"
    )
    measured = materialize(measured, "part-pivots")

    for _ in range(rounds):
        books = _moved(measured, books, fixed, cuts)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, found = _assigned(batch, books, fixed, cuts)
            marks = np.array([at for at, _ in found], np.uint8).T
            code = [row.tobytes().hex() for row in np.ascontiguousarray(marks)]
            error = np.sum([square for _, square in found], axis=0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)],
                ["id", "label", "code", "error"],
            )

    coded = measured.mapInArrow(encode, f"id {types['id']}, label {types['label']}, code string, error long")
    coded = materialize(coded, "codes")
    totals = materialize(
        coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors"
    )
    listed = ",".join(str(v) for book in books for v in book.reshape(-1).tolist())
    out = coded.join(broadcast_if_small(totals), F.col("label").eqNullSafe(F.col("_label")))
    return out.select(
        F.col("id").alias(key), "code", "error", "label_error",
        F.lit(hashlib.sha256(listed.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def _lists(x: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.reshape(-1).astype(np.int32)))


def _moved(measured: DataFrame, books: list[np.ndarray], fixed: list[np.ndarray], cuts: list[slice]) -> list[np.ndarray]:
    """The codebooks after one round: each used entry at the middle of its parts, rounded down."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(book.shape, np.int64) for book in books]
        count = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            x, found = _assigned(batch, books, fixed, cuts)
            for p, (at, _) in enumerate(found):
                np.add.at(total[p], at, x[:, cuts[p]])
                count[p] += np.bincount(at, minlength=len(books[p]))
        rows = [
            (p, int(e), i, int(total[p][e, i]), int(count[p][e]))
            for p in range(len(books)) for e in np.flatnonzero(count[p]) for i in range(total[p].shape[1])
        ]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["part", "entry", "place", "total", "n"])

    found = measured.mapInArrow(sums, "part long, entry long, place long, total long, n long")
    found = found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    out = [book.copy() for book in books]
    for r in found.collect():  # as many rows as the codebooks have components
        out[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return out


def codes_query(spark, folder: str) -> DataFrame:
    return compress(table(spark, folder, "embeddings"))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = [
        """kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) AS r(p))""",
        f"""book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM parts QUALIFY e < {entries})""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT vec_id, p, any_value(x) AS x, min(d * {entries} + e) // {entries} AS d, min(d * {entries} + e) % {entries} AS e FROM (
    SELECT vec_id, p, a.x, e, list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts a JOIN book{r} b USING (p)) GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM (
      SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM near{r}, range(1, len(x) + 1) AS q(i) GROUP BY p, e, i)
    GROUP BY p, e) m USING (p, e))""")
    steps.append(f"""coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id)""")
    steps.append(f"""listed AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM book{rounds})""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (vec_id), listed
"""


CODES_SQL = _codes_sql()
