"""Delimited, fixed-width and columnar scans, and facts about the files read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import parse

BAD_TYPES = "_bad_types"
RAGGED = "_ragged"


def _typed(raw: DataFrame, schema: T.StructType, keep: Sequence[str]) -> DataFrame:
    """Cast text columns; the names of values that did not parse go to ``_bad_types``."""
    typed = {f.name: parse(f.name, f.dataType.simpleString()) for f in schema}
    bad = [
        F.when((F.trim(F.col(f.name)) != "") & typed[f.name].isNull(), F.lit(f.name)) for f in schema
    ]
    return raw.select(
        *[typed[f.name].alias(f.name) for f in schema],
        F.array_compact(F.array(*bad)).alias(BAD_TYPES),
        *keep,
    )


def read_delimited(spark: SparkSession, path, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Header file with an explicit schema. A bad value or a ragged row never fails the scan.

    Missing trailing optional columns read as null; ragged rows keep their text in
    ``_ragged``.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = (
        spark.read.schema(text.add(RAGGED, T.StringType()))
        .option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", RAGGED)
        .csv(path)
    )
    return _typed(with_file_meta(raw), schema, [RAGGED, *FILE_COLUMNS])


WRONG_HEADER = "_wrong_header"


def wrong_headers(spark: SparkSession, path, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Files whose header does not name the schema's columns in order: ``file_path``, ``header``.

    Trailing optional columns may be missing; case and blanks around names do not matter."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.monotonically_increasing_id().alias("_at")
    )
    # Lines of one file are numbered in its order, also across its splits.
    first = lines.groupBy("file_path").agg(F.min_by("value", "_at").alias("header"))
    names = F.transform(F.split("header", f"\\Q{sep}\\E", -1), lambda n: F.lower(F.trim(F.regexp_replace(n, '^"|"$', ""))))
    wanted = F.array(*[F.lit(f.name.lower()) for f in schema])
    least = 1 + max((i for i, f in enumerate(schema) if not f.nullable), default=-1)
    right = (F.size(names) >= max(least, 1)) & (names == F.slice(wanted, 1, F.size(names)))
    return first.filter(~right)


def mark_headers(df: DataFrame, wrong: DataFrame) -> DataFrame:
    """Add ``_wrong_header`` to the rows of a delimited scan; see ``quality.well_headed``."""
    marked = wrong.select("file_path", F.lit(True).alias(WRONG_HEADER))
    return df.join(marked, "file_path", "left").withColumn(WRONG_HEADER, F.coalesce(WRONG_HEADER, F.lit(False)))


def list_files(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """One row per file of a folder, empty ones included, with the columns of ``with_file_meta``."""
    reader = spark.read.format("binaryFile")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    # Contents are not read: only columns of the listing are asked for.
    return with_file_meta(reader.load(path).select("path", "_metadata")).select(*FILE_COLUMNS)


def read_fixed_width(spark: SparkSession, path, layout: Sequence[tuple[str, int, int, str]]) -> DataFrame:
    """``layout``: (name, first position from 1, length, type)."""
    lines = with_file_meta(spark.read.text(path))
    raw = lines.select(
        *[F.trim(F.substring("value", start, length)).alias(name) for name, start, length, _ in layout],
        *FILE_COLUMNS,
    )
    fields = [T.StructField(name, T._parse_datatype_string(kind)) for name, _, _, kind in layout]
    return _typed(raw, T.StructType(fields), FILE_COLUMNS)


def read_curated(spark: SparkSession, root: str, **slices) -> DataFrame:
    """Parquet scan limited to the named partitions, e.g. ``file_date="2024-01-15"``."""
    df = spark.read.parquet(root)
    for name, value in slices.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


FILE_COLUMNS = ("file_path", "file_name", "file_size", "file_modified", "file_type", "file_date")


def with_file_meta(df: DataFrame) -> DataFrame:
    """Path, name, size and time of the scanned file, and type and business date from its name.

    The name ends in ``<source>_<type>_<yyyyMMdd>.<suffix>``; a folder named after the
    type and date may hold several parts of one delivery.
    """
    path = F.col("_metadata.file_path")
    found = F.regexp_extract(path, r"([a-z]+)_(\d{8})\.[a-z]+", 1)
    day = F.regexp_extract(path, r"_(\d{8})\.[a-z]+", 1)
    return df.select(
        *df.columns,
        path.alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
        F.nullif(found, F.lit("")).alias("file_type"),
        F.try_to_date(F.nullif(day, F.lit("")), "yyyyMMdd").alias("file_date"),
    )
