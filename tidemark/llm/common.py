"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A word as the contracts define it; `bytes.split()` cuts UTF-8 at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_column(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words as a long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def finite(name: str) -> Column:
    """Whether a list column is there and all its components are finite numbers."""
    number = F.forall(name, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return F.col(name).isNotNull() & number


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` numbers, none of them null, as rows."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_fields(df: DataFrame, fields: Iterable[tuple[str, T.DataType]]) -> T.StructType:
    """The schema of ``df`` with the named fields replaced or added at the end."""
    new = dict(fields)
    old = [f for f in df.schema.fields if f.name not in new]
    return T.StructType(old + [T.StructField(n, t) for n, t in new.items()])


def hashed_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """At most ``size`` rows, the first by a hash of their key.

    A threshold on the hash, set from the number of rows, leaves about twice as many to sort."""
    rows = df.count()
    at = F.xxhash64(key)
    if rows > 2 * size:
        df = df.where(F.pmod(at, F.lit(1_000_003)) < int(2 * size / rows * 1_000_003) + 1)
    return df.orderBy(at, *df.columns).limit(size)
