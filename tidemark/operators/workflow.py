"""Config-driven record stages, retries of work, partition plans and status roll-ups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import parse, row_checksum, row_text
from tidemark.operators.joins import enrich
from tidemark.operators.quality import REASONS, validate
from tidemark.plans.ordering import global_row_number, keyed_running
from tidemark.plans.scratch import materialize, scratch_path

# What becomes of a failure class.
FAILURE_ACTIONS = {
    "transient": "retry",
    "rate_limit": "retry",
    "business_validation": "bad_record",
    "poison": "dead_letter",
    "permanent": "dead_letter",
}


def run_stages(
    df: DataFrame,
    workflow: Sequence[Mapping],
    refs: Mapping[str, DataFrame] | None = None,
    keep_outputs: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Run the listed stages; returns (finished rows, rows left behind with stage and reasons).

    Stage kinds: ``validate`` (rules), ``filter`` (condition), ``enrich`` (ref, key),
    ``transform`` (columns), ``finalize`` (columns to keep). A stage that drops rows marks
    them, writes all rows once, and splits the written table; so nothing runs twice, and later
    stages survive lost executors. Without ``keep_outputs`` the plan stays one piece.
    """
    written = (lambda frame, name: materialize(frame, f"stage-{name.lower()}")) if keep_outputs else (lambda frame, _: frame)
    current, left = df, []
    for stage in workflow:
        kind, name = stage["kind"], stage.get("name", stage["kind"].upper())
        dropped = None
        if kind == "validate":
            checked = written(validate(current, stage["rules"], stage.get("unique", ())), name)
            dropped = checked.filter(F.size(REASONS) > 0)
            current = checked.filter(F.size(REASONS) == 0).drop(REASONS)
        elif kind == "filter":
            marked = written(current.withColumn("_passes", F.coalesce(stage["condition"], F.lit(False))), name)
            dropped = marked.filter("NOT _passes").drop("_passes").withColumn(REASONS, F.array(F.lit(f"{name}:filtered")))
            current = marked.filter("_passes").drop("_passes")
        elif kind == "enrich":
            looked = written(enrich(current, stage["key"], (refs or {})[stage["ref"]], "_reason"), name)
            dropped = looked.filter(F.col("_reason").isNotNull()).withColumn(REASONS, F.array("_reason"))
            dropped = dropped.drop("_reason")
            current = looked.filter(F.col("_reason").isNull()).drop("_reason")
        elif kind == "transform":
            current = current.withColumns(dict(stage["columns"]))
        elif kind == "finalize":
            current = current.select(*stage["columns"])
        else:
            raise ValueError(f"unknown stage kind {kind}")
        if dropped is not None:
            left.append(dropped.withColumn("stage", F.lit(name)))
    rest = left[0] if left else current.limit(0).withColumns({REASONS: F.array().cast("array<string>"), "stage": F.lit("")})
    for frame in left[1:]:
        rest = rest.unionByName(frame, allowMissingColumns=True)
    return current, rest


def branch(df: DataFrame, routes: Mapping[str, tuple[Column, Callable[[DataFrame], DataFrame]]]):
    """Send rows to the first matching route; merge the results. (merged, unmatched rows).

    The routed rows are written once, by route, so a route reads its own rows only."""
    choice = F.lit(None).cast("string")
    for name, (cond, _) in reversed(list(routes.items())):
        choice = F.when(cond, F.lit(name)).otherwise(choice)
    path = scratch_path(df.sparkSession, "routed")
    kinds = df.withColumn("route", choice)
    kinds.write.partitionBy("route").parquet(path)
    routed = df.sparkSession.read.schema(kinds.schema).parquet(path)
    merged = None
    for name, (_, step) in routes.items():
        part = step(routed.filter(F.col("route") == name))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    unmatched = routed.filter(F.col("route").isNull()).withColumn(REASONS, F.array(F.lit("route:none")))
    return merged, unmatched.drop("route")


def stage_key(feed="feed_id", file="file_id", row="row_number", stage="stage_name") -> Column:
    """``feed:file:ROW_n:stage`` — one key per record and stage."""
    return F.concat_ws(":", F.col(feed), F.col(file), F.concat(F.lit("ROW_"), F.col(row)), F.col(stage))


def pending_stages(work: DataFrame, ledger: DataFrame) -> DataFrame:
    """Record-stages whose key is not COMPLETED yet."""
    done = ledger.filter("status = 'COMPLETED'").select("idempotency_key")
    return work.withColumn("idempotency_key", stage_key()).join(done, "idempotency_key", "left_anti")


def plan_partitions(df: DataFrame, order: Sequence, size: int = 50_000) -> DataFrame:
    """Row ranges of ``size`` over the ordered table: partition_id, record_start, record_end, records."""
    numbered = global_row_number(df, order, "_rn")
    part = F.floor((F.col("_rn") - 1) / size) + 1
    return numbered.groupBy(part.alias("partition_id")).agg(
        F.min("_rn").alias("record_start"), F.max("_rn").alias("record_end"), F.count("*").alias("records")
    )


def hash_partitions(df: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """Partition sizes if rows were placed by key hash."""
    return df.groupBy((row_checksum(keys) % count).alias("partition_id")).agg(F.count("*").alias("records"))


def rollup_status(stages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stage rows to record, partition and job status.

    A record fails with any failed stage and completes when all its stages have; a
    partition or job with both kinds is PARTIALLY_FAILED.
    """

    def settle(total, failed, completed):
        return (
            F.when(F.col(completed) == F.col(total), "COMPLETED")
            .when(F.col(failed) == F.col(total), "FAILED")
            .when(F.col(failed) + F.col(completed) < F.col(total), "IN_PROGRESS")
            .otherwise("PARTIALLY_FAILED")
        )

    status = F.col("status")
    record_status = (
        F.when(F.max(F.when(status == "FAILED", 1).otherwise(0)) == 1, "FAILED")
        .when(F.min(F.when(status == "COMPLETED", 1).otherwise(0)) == 1, "COMPLETED")
        .otherwise("IN_PROGRESS")
    )
    records = stages.groupBy("job_id", "partition_id", "record_id").agg(record_status.alias("status"))
    counts = [
        F.count("*").alias("total_records"),
        F.count_if(status == "FAILED").alias("failed_records"),
        F.count_if(status == "COMPLETED").alias("completed_records"),
    ]
    verdict = settle("total_records", "failed_records", "completed_records")
    partitions = records.groupBy("job_id", "partition_id").agg(*counts).withColumn("status", verdict)
    jobs = (
        partitions.groupBy("job_id")
        .agg(*[F.sum(c).alias(c) for c in ("total_records", "failed_records", "completed_records")])
        .withColumn("status", verdict)
    )
    return records, partitions, jobs


def ops_views(
    jobs: DataFrame | None = None,
    partitions: DataFrame | None = None,
    stages: DataFrame | None = None,
    dead: DataFrame | None = None,
    now: Column | None = None,
    stuck_minutes: int = 60,
) -> dict[str, DataFrame]:
    """Dashboard tables, one per input that is given."""
    now = F.current_timestamp() if now is None else now
    views = {}
    if jobs is not None:
        views["jobs_by_status"] = jobs.groupBy("status").agg(F.count("*").alias("n"))
        if "created_at" in jobs.columns:
            taken = F.timestamp_diff("SECOND", F.col("created_at"), F.col("updated_at"))
            views["feed_sla"] = jobs.groupBy("feed_id").agg(
                F.count("*").alias("jobs"), F.avg(taken).alias("mean_seconds"), F.max(taken).alias("worst_seconds")
            )
    if partitions is not None and "updated_at" in partitions.columns:
        idle = F.timestamp_diff("MINUTE", F.col("updated_at"), now)
        views["stuck_partitions"] = (
            partitions.filter(F.col("status") == "IN_PROGRESS").withColumn("idle_minutes", idle)
            .filter(F.col("idle_minutes") > stuck_minutes)
        )
    if stages is not None:
        views["retry_trend"] = stages.groupBy("stage_name").agg(
            F.sum("retry_count").alias("retries"), F.max("retry_count").alias("most_retries")
        )
        if "completed_at" in stages.columns:
            taken = F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at"))
            views["stage_latency"] = stages.groupBy("stage_name").agg(
                F.avg(taken).alias("mean_seconds"), F.max(taken).alias("worst_seconds")
            )
    if dead is not None:
        views["dead_by_type"] = dead.groupBy("failure_type").agg(F.count("*").alias("n"))
    return views


def evolve(df: DataFrame, schema) -> DataFrame:
    """Shape ``df`` to ``schema``: new optional columns become null, extra ones go."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def split_name(df: DataFrame, col: str, first: str = "first_name", last: str = "last_name"):
    """Split a full name put into the first-name column. (corrected table, audit of changes).

    The first word stays, the rest becomes the last name where that is empty.
    """
    text = F.trim(F.col(col))
    wrong = text.contains(" ") & (F.coalesce(F.trim(F.col(last)), F.lit("")) == "")
    head = F.substring_index(text, " ", 1)
    tail = F.trim(F.substring(text, F.length(head) + 2, F.length(text)))
    marked = df.withColumns({"_wrong": F.coalesce(wrong, F.lit(False)), "_old": F.col(col)})
    fixed = marked.withColumns(
        {
            first: F.when(F.col("_wrong"), head).otherwise(F.col(col)),
            last: F.when(F.col("_wrong"), tail).otherwise(F.col(last)),
        }
    )
    changes = fixed.filter("_wrong").withColumnRenamed("_old", "old_value").drop("_wrong")
    return fixed.drop("_wrong", "_old"), changes


def normalize_records(df: DataFrame, config: Mapping[str, Mapping]) -> DataFrame:
    """Trim, upper-case, parse or derive columns as the feed's config says.

    ``{"amount": {"from": "amt", "type": "decimal(18,2)"}, "ccy": {"upper": True}}``
    """
    out = {}
    for name, rule in config.items():
        value = F.trim(F.col(rule.get("from", name)).cast("string"))
        if rule.get("upper"):
            value = F.upper(value)
        if "type" in rule:
            value = parse(value, rule["type"])
        if "default" in rule:
            value = F.coalesce(value, F.lit(rule["default"]))
        out[name] = value
    return df.withColumns(out)


def limit_checks(orders: DataFrame, max_size, max_position, by, order, amount: str, limit=None) -> DataFrame:
    """Orders above the size limit, or that move the running position beyond its limit."""
    running = keyed_running(orders, by, order, amount, "position", "sum", limit)
    return running.withColumns(
        {
            "size_breach": F.abs(F.col(amount)) > F.lit(max_size),
            "position_breach": F.abs(F.col("position")) > F.lit(max_position),
        }
    )


def with_lineage(df: DataFrame, job_id: str, source: str, keys: Sequence[str]) -> DataFrame:
    """Where a record came from: run, source and a stable record id that keeps nulls and borders apart."""
    return df.withColumns(
        {
            "lineage_job": F.lit(job_id),
            "lineage_source": F.lit(source),
            "record_id": F.sha2(row_text(keys), 256),
        }
    )
