"""A stored inverted index for keyword ranking, with block bounds and document deltas.

Postings lie in folders by a hash of the term, so a query opens the folders of its
terms only. A row holds the postings of one term in one block of documents, with the highest
term count and the shortest document in it: together they bound what the term can add
to any score in the block, whatever the collection's mean length is by then. A query first
scores its most promising blocks; the k-th score found there rules out every block whose bounds
add up to less.

A batch of documents is appended. Where it replaces or removes documents, their earlier postings
are marked dead and their terms are counted off, so results are those of an index built anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.retrieval import B, K1, score_lists, tokens_of
from tidemark.operators.windows import top_n
from tidemark.plans.scratch import materialize
from tidemark.plans.skew import broadcast_if_small

BLOCK = 1024  # documents of a block, about
BUCKETS = 256
SEEDS = 4  # blocks per query that are scored first
MARGIN = 1e-6  # bounds and scores are rounded


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def add(
    docs: DataFrame, root: str, batch: int, id: str = "chunk_id", text: str = "chunk_text", removed: DataFrame | None = None,
    block: int = BLOCK, buckets: int = BUCKETS,
) -> None:
    """Index ``docs``; those already there are replaced, and those of ``removed`` (``id``) taken out.

    Batches are numbered from 0 by the caller; a batch that is added again overwrites itself. ``buckets`` is the same for all
    batches. Documents without a text have no postings and are not counted."""
    spark = docs.sparkSession
    sized = docs.select(F.col(id).alias("id"), tokens_of(F.col(text)).alias("tokens")).where("tokens IS NOT NULL")
    sized = sized.withColumn("len", F.size("tokens"))
    gone = docs.select(F.col(id).alias("id"))
    gone = gone if removed is None else gone.unionByName(removed.select(F.col(id).alias("id")))
    earlier = _read(spark, f"{root}/documents")
    if earlier is not None:
        dead = _read(spark, f"{root}/dead")
        old = earlier.where(F.col("batch") < batch)
        if dead is not None:
            old = old.join(dead.where(F.col("by") < batch), ["id", "batch"], "left_anti")
        old = materialize(old.join(gone.distinct(), "id", "left_semi"), "replaced")
        old.select("id", "batch").write.mode("overwrite").parquet(f"{root}/dead/by={batch}")
        off = old.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg((-F.count(F.lit(1))).alias("n"))
        off = off.withColumn("bucket", _bucket(F.col("term"), buckets))
        off.coalesce(1).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/counted_off/by={batch}")
        totals = old.agg((-F.count(F.lit(1))).alias("docs"), (-F.sum("len")).alias("words"))
        totals.coalesce(1).write.mode("overwrite").parquet(f"{root}/totals/kind=off/batch={batch}")

    kept = sized.select("id", "len", F.array_distinct("tokens").alias("terms"))
    kept.write.mode("overwrite").parquet(f"{root}/documents/batch={batch}")
    written = spark.read.schema(kept.schema).parquet(f"{root}/documents/batch={batch}").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("len").alias("words")
    )
    totals = materialize(written, "index-totals")
    blocks = max(1, -(-totals.first()["docs"] // block))
    totals.write.mode("overwrite").parquet(f"{root}/totals/kind=on/batch={batch}")

    place = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    # Texts go to the task of their block, about 16 blocks each; their words are grouped there, without another exchange.
    tasks = max(-(-blocks // 16), min(blocks, spark.sparkContext.defaultParallelism))
    placed = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).select("id", "text", place).repartition(tasks, "block")
    placed = placed.select("id", "block", tokens_of(F.col("text")).alias("tokens")).withColumn("len", F.size("tokens"))
    counted = placed.select("id", "len", "block", F.explode("tokens").alias("term")).groupBy("term", "block", "id", "len")
    counted = counted.agg(F.count(F.lit(1)).cast("int").alias("tf"))
    # A block has a bounded number of documents, so no list grows with the collection.
    rows = counted.groupBy("term", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("max_tf"), F.min("len").alias("min_len"),
        F.collect_list(F.struct("id", "tf", "len")).alias("postings"),
    )
    rows = rows.withColumn("bucket", _bucket(F.col("term"), buckets)).hint("rebalance", F.col("bucket"))
    rows.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/postings/batch={batch}")


def _gain(idf: Column, tf: Column, length: Column, mean: float) -> Column:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def search(
    spark: SparkSession, root: str, queries: DataFrame, k: int = 10, id: str = "chunk_id", buckets: int = BUCKETS, seeds: int = SEEDS,
) -> DataFrame:
    """The ``k`` best documents per query (query_id, query_text): query_id, ``id``, score, rnk, as ``bm25`` gives them.

    ``buckets`` is that of the index."""
    asked = queries.select("query_id", F.explode(F.array_distinct(tokens_of(F.col("query_text")))).alias("term"))
    asked = materialize(asked.withColumn("bucket", _bucket(F.col("term"), buckets)), "asked-terms")
    opened = [r["bucket"] for r in asked.select("bucket").distinct().collect()]  # at most ``buckets``
    totals = spark.read.parquet(f"{root}/totals").agg(F.sum("docs").alias("n"), F.sum("words").alias("words")).first()
    n, mean = totals["n"] or 0, (totals["words"] or 0) / (totals["n"] or 1) or 1.0
    wanted = broadcast_if_small(asked.select("bucket", "term").distinct())
    postings = spark.read.parquet(f"{root}/postings").where(F.col("bucket").isin(opened)).join(wanted, ["bucket", "term"])
    heads = materialize(postings.select("term", "batch", "block", "n", "max_tf", "min_len"), "posting-heads")
    counts = heads.groupBy("term").agg(F.sum("n").alias("df"))
    off = _read(spark, f"{root}/counted_off")
    if off is not None:
        off = off.where(F.col("bucket").isin(opened)).groupBy("term").agg(F.sum("n").alias("df"))
        counts = counts.unionByName(off.join(counts.select("term"), "term", "left_semi")).groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = materialize(asked.select("query_id", "term").join(counts.select("term", idf.alias("idf")), "term"), "asked-weights")

    best = _gain(F.col("idf"), F.col("max_tf"), F.col("min_len"), mean)
    bounds = heads.join(weighed, "term").groupBy("query_id", "batch", "block").agg(F.sum(best).alias("bound"))
    bounds = materialize(bounds, "block-bounds")
    dead = _read(spark, f"{root}/dead")

    def scored(blocks: DataFrame) -> DataFrame:
        """The best of the documents in ``blocks``, for every query: each posting is read once, however many ask for it."""
        needed = broadcast_if_small(blocks.select("batch", "block").distinct())
        hits = postings.join(needed, ["batch", "block"]).select("term", "batch", F.explode("postings").alias("p"))
        hits = hits.select("term", "batch", "p.*")
        if dead is not None:
            hits = hits.join(dead.select("id", "batch"), ["id", "batch"], "left_anti")
        # A document's list is bounded by the words asked for.
        whole = hits.groupBy("id", "batch").agg(F.collect_list(F.struct("term", "tf", "len")).alias("l"))
        whole = whole.select("id", F.col("l.term").alias("terms"), F.col("l.tf").alias("tfs"), F.col("l.len").alias("lens"))
        return score_lists(materialize(whole, "block-terms"), weighed, mean, k)

    place = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "batch", "block")
    ranked = bounds.withColumn("place", F.row_number().over(place)).where(F.col("place") <= seeds)
    seeded = ranked.drop("place")
    first = materialize(scored(seeded), "seed-scores")
    low = top_n(first, ["query_id"], [("score", "desc"), "id"], k, ties=False).where(F.col("rnk") == k)
    low = low.select("query_id", (F.col("score") - MARGIN).alias("low"))
    rest = bounds.join(seeded, ["query_id", "batch", "block"], "left_anti").join(low, "query_id", "left")
    rest = materialize(rest.where("low IS NULL OR bound >= low").drop("low"), "blocks-left")
    # A block may have been a seed of one query and be left for another.
    both = first.unionByName(scored(rest)).groupBy("query_id", "id").agg(F.max("score").alias("score"))
    found = top_n(both, ["query_id"], [("score", "desc"), "id"], k, ties=False)
    return found.withColumnRenamed("id", id)
