"""Whole-text statistics of a document, one row each, for quality rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_distinct", "n_top_word", "n_upper", "n_letters", "n_digits", "n_marks", "n_ended"]


def repeated_words(ids: np.ndarray, width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur at least twice; the first occurrence counts too."""
    count = len(ids) - width + 1
    if count < 2:
        return 0
    name = ids[:count].astype(np.int64)
    for shift in range(1, width):
        _, name = np.unique(name * (int(ids.max()) + 1) + ids[shift : shift + count], return_inverse=True)
    often = np.bincount(name)[name] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:count] += often
    edge[width : width + count] -= often
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts named in ``COUNTS``; all 0 for a null or empty text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    codes = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(codes, minlength=256)
    upper, lower = int(kinds[65:91].sum()), int(kinds[97:123].sum())
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(int(kinds[ord(c)]) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        len(numbers),
        int(np.bincount(ids).max()) if words else 0,
        upper,
        upper + lower,
        int(kinds[48:58].sum()),
        int(kinds[33] + kinds[63]),
        sum(1 for w in words if w[-1] in b".,"),
    )


def _counter(text: str, carried: list[str]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = pd.DataFrame([text_counts(t) for t in pdf[text]], columns=COUNTS, index=pdf.index)
            yield pd.concat([pdf[carried], rows], axis=1)

    return count


def add_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the counts of ``text`` as longs. Only these two columns are read."""
    schema = T.StructType([docs.schema[key], *[T.StructField(c, T.LongType()) for c in COUNTS]])
    return docs.select(key, text).mapInPandas(_counter(text, [key]), schema)


def filter_by_counts(docs: DataFrame, keep: Column, text: str = "text") -> DataFrame:
    """The rows of ``docs`` for which ``keep``, an expression of the counts, holds; columns of any name are kept."""
    names = docs.columns
    carried = [f"_{i}" for i in range(len(names))]
    fields = [T.StructField(c, f.dataType) for c, f in zip(carried, docs.schema.fields)]
    schema = T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])
    counted = docs.toDF(*carried).mapInPandas(_counter(carried[names.index(text)], carried), schema)
    return counted.where(keep).select(*[F.col(c).alias(n) for c, n in zip(carried, names)])
