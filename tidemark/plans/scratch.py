"""Tables written between two passes of one job.

A written table cuts the lineage and outlives lost executors, which neither a
cached frame nor a local checkpoint does. The folder is the one the cluster
names in ``spark.checkpoint.dir``; only a local session without that setting
gets a temporary one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOTS[app]


_SCOPE: ContextVar[str] = ContextVar("scratch_scope", default="")


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app}/{_SCOPE.get()}{label}-{uuid.uuid4().hex}"


@contextmanager
def scope(spark: SparkSession, name: str) -> Iterator[str]:
    """What is written inside lies in a folder of its own, which ``drop`` can remove; gives the folder."""
    inner = f"{name}-{uuid.uuid4().hex}"
    token = _SCOPE.set(f"{_SCOPE.get()}{inner}/")
    try:
        yield f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{_SCOPE.get()}".rstrip("/")
    finally:
        _SCOPE.reset(token)


def reads_from(df: DataFrame, folder: str) -> bool:
    """Whether ``df`` still reads files of a scratch folder."""
    tail = "/" + "/".join(folder.split("/")[-2:]) + "/"
    return any(tail in f for f in df.inputFiles())


def drop(spark: SparkSession, folder: str) -> None:
    """Remove a scope's folder, once all that was made from it is written elsewhere."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
