"""Mix sources to target weights along a low-discrepancy schedule.

Sizes are words. Each source's documents are shuffled (by a hash) and laid end
to end; its line, repeated up to ``max_passes`` times, is cut into blocks of
``block`` words. The mix is a row of slots of one block each. Slot t maps the
golden-ratio point frac(t * phi) through the cumulative target weights, which
names its source; the k-th slot of a source takes that source's k-th block.
DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table, unused, word_count
from tidemark.plans.scratch import materialize

# frac(t * phi) in whole numbers: (t * STEP mod RING) / RING. An odd STEP visits every point.
RING = 1 << 31
STEP = 1327217885
# Slots drawn beyond the total, so that a source the points reach late still fills its target.
OVERDRAW = 1.02
OVERDRAW_SLOTS = 256
CELLS = 1024
# Hex digits of the shuffle hash that split a source's line: 4,096 pieces of any one source.
DIGITS = 3


def source_targets(sized: DataFrame, source: str, weights: Sequence[float], max_passes: int) -> DataFrame:
    """One row per source: ``_source_no``, ``source_size``, ``target``, ``_from``, ``_limit``.

    Weights repeat over the sources in code-point order, null last. The total of
    all sizes is shared by weight; a target stops at ``max_passes`` times its
    source's size and the excess goes to the others by weight. Sorted by size per
    weight, the stopped sources are a prefix, found with running sums.
    The table has one row per source name, so its windows need no key.
    """
    sources = sized.groupBy(source).agg(F.sum("_size").alias("source_size"))
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    sources = sources.withColumn("_source_no", F.row_number().over(by_name))
    choice = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumns(
        {
            "_weight": F.element_at(choice, (F.col("_source_no") - 1) % len(weights) + 1),
            "_cap": (F.col("source_size") * max_passes).cast("double"),
        }
    )
    order = Window.orderBy((F.col("_cap") / F.col("_weight")).asc(), F.col("_source_no"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole)
    sources = sources.withColumns(
        {
            "_order": F.row_number().over(order),
            "_level": (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(after),
        }
    )
    is_open = F.col("_cap") > F.col("_level") * F.col("_weight")
    first_open = F.min(F.when(is_open, F.struct("_order", "_level"))).over(whole)
    sources = sources.withColumn("_open", first_open)
    stopped = F.col("_open").isNull() | (F.col("_order") < F.col("_open")["_order"])
    target = F.when(stopped, F.col("_cap")).otherwise(F.least("_cap", F.col("_open")["_level"] * F.col("_weight")))
    sources = sources.withColumn("target", target)
    sources = sources.withColumn("_limit", F.floor("target").cast("long"))
    by_number = Window.orderBy("_source_no").rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumn("_from", F.coalesce(F.sum("_limit").over(by_number), F.lit(0)))
    return sources.withColumn("_total", F.sum("_limit").over(whole)).select(
        F.col(source).alias("_source"), "_source_no", "source_size", "target", "_limit", "_from", "_total"
    )


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """``slot``, ``_source_no`` and ``_block``: which source fills a slot, with which of its blocks."""
    spark = targets.sparkSession
    total = targets.agg(F.max("_total")).first()[0] or 0
    slots = -(-total // block) if total else 0
    count = int(slots * OVERDRAW) + OVERDRAW_SLOTS if slots else 0
    point = (F.col("slot") % RING * STEP) % RING
    drawn = spark.range(count).select(F.col("id").alias("slot")).withColumn("_u", point / F.lit(float(RING)))
    drawn = drawn.withColumns({"_x": F.col("_u") * float(total), "_cell": F.floor(F.col("_u") * CELLS)})
    low, high = F.col("_from").cast("double"), (F.col("_from") + F.col("_limit")).cast("double")
    ranges = targets.where("_limit > 0").select("_source_no", low.alias("_low"), high.alias("_high"))
    cells = ranges.withColumn(
        "_cell",
        F.explode(
            F.sequence(
                F.greatest(F.lit(0), F.floor(F.col("_low") / float(total or 1) * CELLS) - 1),
                F.least(F.lit(CELLS - 1), F.floor(F.col("_high") / float(total or 1) * CELLS) + 1),
            )
        ),
    )
    hit = (F.col("_x") >= F.col("_low")) & (F.col("_x") < F.col("_high"))
    named = drawn.join(cells, "_cell").where(hit).select("slot", "_source_no")
    # Rank per source in two steps, as one source may own most slots: within a stretch, and by stretch.
    stretch = max(1, int(count**0.5))
    named = named.withColumn("_stretch", F.floor(F.col("slot") / stretch))
    counts = named.groupBy("_source_no", "_stretch").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_source_no").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_source_no", "_stretch").orderBy("slot")
    ranked = named.withColumn("_rank", F.row_number().over(inside)).join(counts, ["_source_no", "_stretch"])
    return ranked.select("slot", "_source_no", (F.col("_before") + F.col("_rank") - 1).alias("_block"))


def shuffled_line(sized: DataFrame, key: str) -> DataFrame:
    """``_start``: words before the document on its source's shuffled line.

    The hash cuts a line into 4,096 pieces, so no task holds a whole source."""
    hashed = sized.withColumn("_hash", F.md5(F.col(key).cast("string")))
    hashed = hashed.withColumn("_piece", F.coalesce(F.substring("_hash", 1, DIGITS), F.lit("")))
    sums = hashed.groupBy("_source_no", "_piece").agg(F.sum("_size").alias("_n"))
    earlier = Window.partitionBy("_source_no").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_piece_from", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_source_no", "_piece").orderBy("_hash", key, "_row")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = hashed.withColumn("_local", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    placed = local.join(sums, ["_source_no", "_piece"])
    return placed.withColumn("_start", F.col("_piece_from") + F.col("_local")).drop("_local", "_piece_from")


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: Sequence[float] = (5, 2, 1),
    max_passes: int = 3,
    block: int = 32,
    row: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Documents with what the mix takes of them, and the mix itself.

    The first frame has one row per document: ``key``, ``size``, ``source_size``,
    ``target``, ``taken``. The second has one row per document and slot: ``slot``,
    ``key``, ``pass`` (from 0), ``first_word``, ``words``. Null and empty texts have size 0 and
    are never taken. A null source is a source of its own; a null key sorts first.
    Repeated rows are taken one by one; ``_row`` of both frames tells them apart, from the column ``row`` if one is given. An empty table gives two empty frames. Columns
    other than key and source, whatever their names, are not read once sizes are known.
    """
    size = word_count(F.col("text")) if size is None else size
    sized = docs.select(
        F.col(key), F.col(source).alias("_source"), size.cast("long").alias("_size"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("_row"),
    )
    sized = materialize(sized, "mix-sizes")
    targets = materialize(source_targets(sized, "_source", weights, max_passes), "mix-targets")
    slots = materialize(schedule(targets, block), "mix-slots")

    reached = slots.groupBy("_source_no").agg(F.count(F.lit(1)).alias("_slots"))
    ends = targets.join(reached, "_source_no", "left").withColumn(
        "_end", F.least("_limit", F.coalesce("_slots", F.lit(0)) * block)
    )
    known = sized.join(ends.select("_source", "_source_no", "source_size", "target", "_end"),
                       sized["_source"].eqNullSafe(ends["_source"])).drop("_source")
    lined = materialize(shuffled_line(known, key), "mix-line")

    passes = lined.where("_size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1))))
    low = F.col("pass") * F.col("source_size") + F.col("_start")
    passes = passes.withColumn("_low", low).withColumn("_high", F.least(F.col("_low") + F.col("_size"), "_end"))
    pieces = passes.where("_high > _low").withColumn(
        "_block", F.explode(F.expr(f"sequence(_low div {block}, (_high - 1) div {block})"))
    )
    pieces = pieces.select(
        "_row", F.col(key), "_source_no", "_block", "pass",
        (F.greatest("_low", F.col("_block") * block) - F.col("_low")).alias("first_word"),
        (F.least("_high", (F.col("_block") + 1) * block) - F.greatest("_low", F.col("_block") * block)).alias("words"),
    )
    mixed = pieces.join(slots, ["_source_no", "_block"])
    taken = mixed.groupBy("_row").agg(F.sum("words").alias("taken"))
    per_doc = lined.join(taken, "_row", "left").select(
        F.col(key), F.col("_size").alias("size"), "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "_row",
    )
    return per_doc, mixed.select("slot", F.col(key), "pass", "first_word", "words", "_row")


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, in whole passes; all columns are kept.

    A source's coverage is one stretch of its line, so at most one document per source is taken in part; it
    counts as a whole pass from half on. Rows are told apart by number, so ``key`` may be null or repeat."""
    row, passes, one = (unused(docs, name) for name in ("_mix_row", "_mix_passes", "_mix_pass"))
    # Row numbers must not change between the two reads.
    base = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mix-docs")
    taken, _ = mix(base, key, source, **options, row=row)
    often = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    often = taken.select(F.col("_row").alias(row), often.alias(passes)).where(F.col(passes) > 0)
    drawn = base.join(often, row)
    return drawn.withColumn(one, F.explode(F.sequence(F.lit(1), F.col(passes)))).select(*docs.columns)


def mix_query(spark, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))[0].drop("_row")


MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(no - 1) % 3 + 1] AS w, (s * 3)::DOUBLE AS cap FROM named),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, no) AS o,
    ((SELECT sum(size)::DOUBLE FROM sized) - coalesce(sum(cap) OVER (ORDER BY cap / w, no
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
opened AS (SELECT min(o) AS first_open, arg_min(level, o) AS lvl FROM ordered WHERE cap > level * w),
targets AS (
  SELECT source, no, s, CASE WHEN first_open IS NULL OR o < first_open THEN cap ELSE least(cap, lvl * w) END AS target
  FROM ordered, opened),
spans AS (
  SELECT *, floor(target)::BIGINT AS lim, coalesce(sum(floor(target)::BIGINT) OVER (ORDER BY no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo FROM targets),
whole AS (SELECT sum(lim)::BIGINT AS total FROM spans),
drawn AS (
  SELECT t, (t % {RING} * {STEP} % {RING}) / {float(RING)} * total::DOUBLE AS x
  FROM (SELECT total, unnest(range(CASE WHEN total > 0
    THEN (((total + 31) // 32) * {OVERDRAW}::DOUBLE)::BIGINT + {OVERDRAW_SLOTS} ELSE 0 END)) AS t FROM whole)),
reached AS (
  SELECT no, count(*) AS k FROM drawn JOIN spans ON x >= lo::DOUBLE AND x < (lo + lim)::DOUBLE GROUP BY no),
ends AS (SELECT spans.*, least(lim, coalesce(k, 0) * 32) AS stop FROM spans LEFT JOIN reached USING (no)),
lined AS (
  SELECT doc_id, size, s, target, stop, coalesce(sum(size) OVER (PARTITION BY no ORDER BY md5(doc_id::VARCHAR), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized JOIN ends ON sized.source IS NOT DISTINCT FROM ends.source)
SELECT doc_id, size, s AS source_size, target,
  (greatest(0, least(size, stop - start)) + greatest(0, least(size, stop - s - start))
   + greatest(0, least(size, stop - 2 * s - start)))::BIGINT AS taken
FROM lined
"""
