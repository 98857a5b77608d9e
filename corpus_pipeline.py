"""From raw documents to packed sequences, in five stages.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet and
read again as the next stage's documents. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import lines, minhash, mixing, packing, rules
from tidemark.llm.common import table, unused
from tidemark.plans.scratch import drop, materialize, reads_from, scope

# Folders of intermediate tables of stages that have been called.
_FOLDERS: list[tuple[str, str]] = []


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Intermediate tables of a stage go once a later stage reads what was written from them."""

    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        left = []
        for owner, folder in _FOLDERS:
            if owner != app:
                continue
            if reads_from(docs, folder):
                left.append((owner, folder))
            else:
                drop(spark, folder)
        with scope(spark, work.__name__) as folder:
            out = work(spark, docs, sf_dir)
        _FOLDERS[:] = [*left, (app, folder)]
        return out

    return run


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject."""
    return rules.filter_quality(docs, table(spark, sf_dir, "labels"))


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; a document goes only if no line with a word is left of it."""
    found = lines.line_dedup(docs)
    left = found.where("n_removed = 0 OR n_removed < n_lines")
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@stage
def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest id, one without an id only if none has one.

    Rows are told apart by number: null and repeated ids are rows like any other, and only their texts make them copies."""
    row = unused(docs, "_row")
    base = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-docs")
    found = minhash.near_duplicates(base, width=5, percent=80, chunks=14, key=row).select(row, "component_id")
    named = found.join(base.select(row, "doc_id"), row)
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", row)
    first = named.groupBy("component_id").agg(F.min(place).alias("first"))
    kept = materialize(first.select(F.col("first")[row].alias(row)), "kept-rows")
    return base.join(kept, row, "left_semi").select(*docs.columns)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix of sources takes it, 0 to 3 times; null and repeated ids are rows like any other."""
    return mixing.mixed_documents(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 4,096 tokens."""
    import public_tokenizers

    return packing.pack(packing.tokenize(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Rules are learned and tokens come from a vocabulary file; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
