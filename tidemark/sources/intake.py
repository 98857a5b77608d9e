"""Which files still have to be processed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_files_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", per_batch: int = 1000, **options):
    """Stream over a folder; its checkpoint remembers the files already taken."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_batch)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(path)


def idempotency_key(*cols: str):
    """``source|file_type|file_date|file_name``; the path is no part of it."""
    return F.concat_ws("|", *(cols or ("source", "file_type", "file_date", "file_name")))


def unprocessed(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files whose key has no finished ledger row; a file loaded in part is finished."""
    done = ledger.filter("status IN ('SUCCESS', 'PARTIAL')").select("file_key")
    return listing.join(done, "file_key", "left_anti")
