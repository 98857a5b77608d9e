"""Delete later copies of repeated line runs with a suffix array over line ids.

A document is its sequence of lines with a word; a line's id is a 128-bit hash. The
suffixes of all sequences are sorted by distributed prefix doubling: a rank orders
them by their first 2^k lines, and the pair (rank here, rank 2^k lines on) orders them
by twice as many. Suffixes that share a rank after k rounds are an interval of the
suffix array whose longest common prefix is 2^k lines or more. Suffixes alone in their
interval leave the doubling, which ends when none is shared any more.

Between two levels, ``earlier_runs`` finds how many lines of a suffix stand earlier in the
corpus: the rank at a place and the rank some lines on name an interval of any prefix
length, so that length is halved step by step, for all suffixes at once. A maximal run is
one that no run from an earlier place of its document covers. DataFrame operations only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.plans.scratch import drop, materialize, scope

HAS_WORD = r"[^\x20\x09-\x0D]"


def positions(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``_pos``: place of each row in the global order, from 0; ``order`` must tell rows apart to spread them."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = F.col("_at").bitwiseAND((1 << 33) - 1)
    out = placed.join(F.broadcast(offsets), "_part").withColumn("_pos", F.col("_offset") + inside)
    return out.drop("_part", "_offset", "_at")


def line_table(docs: DataFrame, long_line: int) -> DataFrame:
    """``_row``, ``_key``, ``pos`` (among lines with a word), ``rest`` (lines from there on), ``idx`` (among all),
    the id ``h1``, ``h2``, and ``long``."""
    numbered = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("idx"), line.alias("line")))
    worded = F.filter(numbered, lambda s: s["line"].rlike(HAS_WORD))
    lines = docs.select("_row", "_key", worded.alias("_lines"))
    lines = lines.select("_row", "_key", F.size("_lines").alias("_n"), F.posexplode("_lines").alias("pos", "s"))
    return lines.select(
        "_row", "_key", "pos", (F.col("_n") - F.col("pos")).alias("rest"), F.col("s.idx").alias("idx"),
        F.xxhash64("s.line").alias("h1"), F.xxhash64(F.lit("second"), "s.line").alias("h2"),
        (F.length("s.line") >= long_line).alias("long"),
    )


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """``_row``, ``pos``, ``rest`` and the new ``rank`` of rows that share their values of ``by`` with another row."""
    groups = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    order = positions(groups, by, "suffix-order").withColumnRenamed("_pos", "_rank")
    return rows.join(order, by).select("_row", "pos", "rest", F.col("_rank").alias("rank"))


def suffix_ranks(lines: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ... the suffixes (``_row``, ``pos``, ``rest``, ``rank``) whose first 2^k lines another has too.

    Ranks number the intervals of a level in the order of the suffix array. The last frame is the last in which
    any suffix is still shared. A suffix is shared in the next level only if what follows 2^k lines on is shared in
    this one, so the lookups stay among shared suffixes."""
    alive = materialize(_ranked(lines.select("_row", "pos", "rest", "h1", "h2"), ["h1", "h2"]), "suffix-ranks")
    levels, shift = [alive], 1
    while True:
        ahead = alive.where(F.col("pos") >= shift)
        ahead = ahead.select("_row", (F.col("pos") - shift).alias("pos"), F.col("rank").alias("second"))
        paired = alive.where(F.col("rest") >= 2 * shift).join(ahead, ["_row", "pos"])
        alive = materialize(_ranked(materialize(paired, "suffix-pairs"), ["rank", "second"]), "suffix-ranks")
        if alive.isEmpty():
            return levels
        levels.append(alive)
        shift *= 2


def _levels(levels: list[DataFrame], least: int) -> DataFrame:
    parts = [shared.drop("rest").withColumn("level", F.lit(k)) for k, shared in enumerate(levels) if k >= least]
    return reduce(DataFrame.unionByName, parts)


def earlier_runs(lines: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``_row``, ``pos``, ``n_same``: the most lines from ``pos`` on that start earlier in the corpus too, if any do.

    The corpus is ordered by ``_key``, ``_row`` and ``pos``. An entry asks for its length or only stands for those of
    its interval; ``group`` is the first place of the interval of prefix length ``m``. Of the entries that share a
    longer prefix, only the first is still needed for the shorter ones, so at most one entry per interval is added."""
    shared = levels[0].select("_row", "pos").join(lines.select("_row", "_key", "pos"), ["_row", "pos"])
    places = positions(shared, ["_key", "_row", "pos"], "suffix-places").drop("_key").withColumnRenamed("_pos", "place")
    members = materialize(_levels(levels, 0).join(places, ["_row", "pos"]), "interval-members")
    first = materialize(members.groupBy("level", "rank").agg(F.min("place").alias("group")), "interval-first")
    members = members.join(first, ["level", "rank"]).withColumn("asks", F.col("place") != F.col("group"))
    # Up to the deepest level where a suffix is a copy, an earlier one stands for it.
    top = F.max(F.when(F.col("asks"), F.col("level"))).over(Window.partitionBy("place"))
    entries = members.withColumn("_top", top).where("_top IS NULL OR level >= _top")
    length = F.expr("shiftleft(1, level)")
    columns = ["level", "place", "_row", "pos", "group", "m", "asks"]
    waiting = materialize(entries.withColumn("m", length).select(*columns), "run-entries")
    entries = waiting.where(F.lit(False))
    for j in reversed(range(len(levels) - 1)):
        on = F.col("pos") + F.col("m") + (1 << j) - length
        ahead = _levels(levels, j + 1).select("level", "_row", F.col("pos").alias("_on"), F.col("rank").alias("second"))
        # Entries of a level take part from the step that halves its lengths on.
        entries = entries.unionByName(waiting.where(F.col("level") == j + 1))
        tried = entries.withColumn("_on", on).join(ahead, ["level", "_row", "_on"], "left").drop("_on")
        tried = materialize(tried, "run-tries")
        found = tried.where("second IS NOT NULL").groupBy("m", "group", "second").agg(
            F.count(F.lit(1)).alias("n"), F.min("place").alias("head"), F.max("asks").alias("wanted")
        )
        found = materialize(found.where("n > 1").drop("n"), "run-groups")
        tried = tried.join(found, ["m", "group", "second"], "left")
        leads = F.col("head").isNull() | (F.col("place") == F.col("head"))
        stays = F.struct("group", "m", "asks")
        longer = (F.col("m") + (1 << j)).alias("m")
        moves = F.struct(F.col("head").alias("group"), longer, (F.col("asks") & ~leads).alias("asks"))
        after = F.array_compact(F.array(F.when(leads, stays), F.when(F.col("wanted"), moves)))
        entries = tried.select("level", "place", "_row", "pos", F.explode(after).alias("_s"))
        entries = materialize(entries.select("level", "place", "_row", "pos", "_s.*"), "run-entries")
    entries = entries.unionByName(waiting.where("level = 0"))
    return entries.where("asks").select("_row", "pos", F.col("m").alias("n_same"))


def line_dedup(docs: DataFrame, key: str = "doc_id", min_lines: int = 2, long_line: int = 20) -> DataFrame:
    """``docs`` without later copies, plus ``n_lines`` (with a word), ``n_removed`` and ``n_runs`` removed.

    A maximal repeated run counts if it has ``min_lines`` lines or starts with a line of at least ``long_line``
    characters; it is a copy if the same lines start earlier, in a smaller ``key``, in an
    earlier one of repeated rows, or further up in the same document. So a shorter line, such as a lone brace
    or a one-word heading, goes only within a run. ``n_runs`` counts the maximal runs, which may overlap. A null
    key comes first. Lines are compared as they are; lines without a word are skipped in runs and stay in the
    text. Null texts stay null with no lines. Columns named like the three counts are replaced; all others are
    kept. An empty table gives no rows.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be at least 1")
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed", "n_runs")]
    # Columns travel under other names, so that none can clash.
    carried = [F.col(c).alias(f"_{i}") for i, c in enumerate(kept)]
    # Row numbers must not change between the two reads of the texts.
    base = docs.select(*carried, F.col("text").alias("text"), F.col(key).alias("_key"))
    base = materialize(base.withColumn("_row", F.monotonically_increasing_id()).drop(f"_{kept.index('text')}"), "docs")
    lines = materialize(line_table(base, long_line), "lines")
    with scope(docs.sparkSession, "suffix-array") as folder:
        runs = earlier_runs(lines, suffix_ranks(lines))
    runs = materialize(runs, "line-runs").join(lines, ["_row", "pos"])
    drop(docs.sparkSession, folder)
    reach = F.when((F.col("n_same") >= min_lines) | F.col("long"), F.col("pos") + F.col("n_same"))
    # Every line of a run is one that stands earlier too, so these rows hold all that a run covers.
    before = Window.partitionBy("_row").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn("_reach", reach).withColumn("_covered", F.max("_reach").over(before))
    gone = runs.where(F.col("_covered") > F.col("pos"))
    # A run that another covers ends where that ends.
    starts = F.lag("_covered").over(Window.partitionBy("_row").orderBy("pos"))
    gone = gone.withColumn("_starts", (~F.col("_covered").eqNullSafe(starts)).cast("int"))
    per_doc = gone.groupBy("_row").agg(
        F.collect_list("idx").alias("_gone"), F.count(F.lit(1)).alias("n_removed"), F.sum("_starts").alias("n_runs")
    )
    counts = lines.groupBy("_row").agg(F.count(F.lit(1)).alias("n_lines"))
    out = base.join(counts.join(per_doc, "_row", "left"), "_row", "left")
    # Kept places by a set difference and a lookup: linear in the number of lines.
    parts = F.split("text", "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
    cut = F.array_join(F.transform(places, lambda i: F.get(F.col("_parts"), i)), "\n")
    out = out.withColumn("_parts", F.when(F.col("_gone").isNotNull(), parts))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(cut)
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    named = [text.alias(c) if c == "text" else F.col(f"_{i}").alias(c) for i, c in enumerate(kept)]
    return out.select(*named, count("n_lines"), count("n_removed"), count("n_runs"))


def line_query(spark, folder: str) -> DataFrame:
    found = line_dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "n_runs", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


LINE_SQL = r"""
WITH RECURSIVE split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
flat AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS idx, unnest(parts) AS line FROM split),
lines AS (
  SELECT doc_id, idx, line, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS pos FROM flat
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
placed AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, pos) AS place, dense_rank() OVER (ORDER BY line) AS name
  FROM lines),
same AS (
  SELECT 1 AS m, doc_id, pos, place, min(place) OVER (PARTITION BY line) AS head, count(*) OVER (PARTITION BY line) AS n
  FROM placed
  UNION ALL
  SELECT m + 1, s.doc_id, s.pos, s.place, min(s.place) OVER (PARTITION BY head, name),
    count(*) OVER (PARTITION BY head, name)
  FROM same s JOIN placed p ON p.doc_id = s.doc_id AND p.pos = s.pos + m WHERE n > 1),
runs AS (SELECT doc_id, pos, max(m) AS n_same FROM same WHERE head < place GROUP BY doc_id, pos),
reached AS (
  SELECT doc_id, pos, idx, max(CASE WHEN n_same >= 2 OR length(line) >= 20 THEN pos + n_same END) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS covered
  FROM runs JOIN placed USING (doc_id, pos)),
cut AS (
  SELECT doc_id, count(*) AS n_removed, count(DISTINCT covered) AS n_runs, list(idx) AS idxs
  FROM reached WHERE covered > pos GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n_lines FROM lines GROUP BY doc_id),
texts AS (
  SELECT split.doc_id, string_agg(parts[i], chr(10) ORDER BY i) AS text
  FROM split LEFT JOIN cut ON split.doc_id = cut.doc_id, unnest(range(1, len(parts) + 1)) AS u(i)
  WHERE NOT list_contains(coalesce(idxs, []), i) GROUP BY split.doc_id)
SELECT split.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_runs, 0)::BIGINT AS n_runs, md5(coalesce(text, '')) AS text_md5
FROM split LEFT JOIN counts ON split.doc_id = counts.doc_id LEFT JOIN cut ON split.doc_id = cut.doc_id
  LEFT JOIN texts ON split.doc_id = texts.doc_id
"""
