"""Validation rules, quarantine split, audit, reconciliation and delivery checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import file_checksum
from tidemark.operators.windows import moving
from tidemark.plans.ordering import join_keys, keyed_neighbor
from tidemark.plans.scratch import materialize

REASONS = "reject_reasons"

# File states and the moves between them.
FILE_MOVES = {
    "PENDING": ("SUCCESS", "PARTIAL", "FAILED"),
    "FAILED": ("PENDING",),
    "PARTIAL": ("PENDING",),
}

# Order states and the moves between them.
ORDER_MOVES = {
    "New": ("Validated", "Rejected"),
    "Validated": ("Routed", "Rejected", "Cancelled"),
    "Routed": ("Live", "Rejected", "Cancelled"),
    "Live": ("Partially filled", "Filled", "Cancelled", "Expired"),
    "Partially filled": ("Partially filled", "Filled", "Cancelled", "Expired"),
}


@dataclass(frozen=True)
class Rule:
    """A named check. It fails where ``ok`` is false; a null result passes, so only
    ``mandatory`` complains about missing values."""

    column: str
    name: str
    ok: Column


def mandatory(column: str) -> Rule:
    return Rule(column, "mandatory", F.col(column).isNotNull())


def not_blank(column: str) -> Rule:
    return Rule(column, "not_blank", F.trim(F.col(column).cast("string")) != "")


def well_typed(column: str) -> Rule:
    """The scan could read the value (see ``sources.files``)."""
    return Rule(column, "type", ~F.array_contains("_bad_types", column))


def whole_row() -> Rule:
    """The row has as many values as the schema has columns (see ``sources.files``)."""
    return Rule("row", "columns", F.col("_ragged").isNull())


def well_headed() -> Rule:
    """The row's file names its columns as the schema does (see ``sources.files.mark_headers``)."""
    return Rule("file", "header", ~F.col("_wrong_header"))


def at_least(column: str, bound, strict: bool = False) -> Rule:
    value = F.col(column)
    return Rule(column, f"min_{bound}", value > bound if strict else value >= bound)


def one_of(column: str, values: Sequence[str]) -> Rule:
    return Rule(column, "enum", F.col(column).isin(*values))


def not_before(column: str, other: str) -> Rule:
    return Rule(column, f"not_before_{other}", F.col(column) >= F.col(other))


def validate(df: DataFrame, rules: Sequence[Rule], unique: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Add every failing ``column:rule`` in one pass, then the uniqueness rules.

    All rows of a repeated key fail. Repeated keys come from an aggregate, so a key
    with very many rows is never gathered in one task.
    """
    failed = [F.when(~r.ok, F.lit(f"{r.column}:{r.name}")) for r in rules]
    # Read once for the repeated keys and once for the rows, not planned from its sources twice.
    df = materialize(df, "unchecked") if unique else df
    out = df.withColumn(REASONS, F.array_compact(F.array(*failed)))
    for keys in unique:
        complete = F.lit(True)
        for key in keys:
            complete = complete & F.col(key).isNotNull()
        repeated = (
            df.filter(complete).groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
            .withColumn("_repeated", F.lit(True)).drop("_n")
        )
        reason = F.array(F.lit(f"{','.join(keys)}:unique"))
        out = out.join(repeated, list(keys), "left")
        out = out.withColumn(
            REASONS, F.when(F.col("_repeated"), F.concat(REASONS, reason)).otherwise(F.col(REASONS))
        ).drop("_repeated")
    return out


def split(checked: DataFrame, keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). The checked rows are written once and both parts read that
    table; without ``keep`` each part runs the checks again."""
    if keep:
        checked = materialize(checked, "checked")
    good = F.size(REASONS) == 0
    return checked.filter(good).drop(REASONS), checked.filter(~good)


def reject_counts(checked: DataFrame) -> DataFrame:
    """Failures per rule."""
    return checked.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def audit(
    checked: DataFrame, by: Sequence[str], data_columns: Sequence[str], job_id: str, at=None, files: DataFrame | None = None
) -> DataFrame:
    """One audit row per file: counts, order-free checksum and status.

    ``files`` lists what was delivered by the columns ``by``; a file without rows then has
    a row with zero counts and the status SUCCESS."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp_ntz")
    rejected = F.count_if(F.size(REASONS) > 0)
    counted = checked.groupBy(*by).agg(
        F.count("*").alias("read_count"),
        rejected.alias("reject_count"),
        file_checksum(data_columns).alias("checksum"),
    )
    if files is not None:
        listed = join_keys(files.select(*by).distinct(), counted, by, "left")
        counted = listed.fillna(0, ["read_count", "reject_count"]).fillna("0:0", ["checksum"])
    valid = F.col("read_count") - F.col("reject_count")
    status = F.when(F.col("reject_count") == 0, "SUCCESS").when(valid == 0, "FAILED").otherwise("PARTIAL")
    return counted.withColumns(
        {
            "record_count": valid,
            "status": status,
            "job_id": F.lit(job_id),
            "processed_at": stamp,
        }
    )


def latest_state(ledger: DataFrame, key: str = "file_key", at: str = "processed_at") -> DataFrame:
    return ledger.groupBy(key).agg(F.max_by("status", at).alias("status"))


def intake(files: DataFrame, ledger: DataFrame, mode: str = "skip") -> DataFrame:
    """Decide per file: ``process``, or ``skip`` if it already succeeded.

    ``overwrite`` processes everything again. PARTIAL counts as finished under
    ``skip``.
    """
    state = latest_state(ledger).withColumnRenamed("status", "last_status")
    done = F.col("last_status").isin("SUCCESS", "PARTIAL")
    action = F.lit("process") if mode == "overwrite" else F.when(done, "skip").otherwise("process")
    return files.join(state, "file_key", "left").withColumn("action", action)


def check_transitions(
    history: DataFrame, by: Sequence[str], order: Sequence, status: str, moves: dict, limit=None
) -> DataFrame:
    """Changes of ``status`` that the table of moves does not allow."""
    pairs = F.array(*[F.lit(f"{a}>{b}") for a, targets in moves.items() for b in targets])
    prev = f"prev_{status}"
    stepped = keyed_neighbor(history, by, order, status, prev, -1, limit)
    move = F.concat(F.col(prev), F.lit(">"), F.col(status))
    return stepped.filter(F.col(prev).isNotNull() & ~F.array_contains(pairs, move))


def dedupe_files(files: DataFrame, keys=("source", "feed", "checksum"), order=("received_at", "file_name")):
    """Mark files whose source, feed and checksum were seen before; the first one stays."""
    first = files.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    marked = join_keys(files, first, keys)
    return marked.withColumn("duplicate", F.struct(*order) != F.col("_first")).drop("_first")


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str], tolerance=0.01):
    """Keys that differ between two sides: missing on one, or apart by more than ``tolerance``."""
    left = a.groupBy(*keys).agg(*[F.sum(m).alias(f"a_{m}") for m in measures], F.lit(1).alias("_a"))
    right = b.groupBy(*keys).agg(*[F.sum(m).alias(f"b_{m}") for m in measures], F.lit(1).alias("_b"))
    both = left.join(right, list(keys), "full")
    apart = F.lit(False)
    for m in measures:
        gap = F.coalesce(f"a_{m}", F.lit(0)) - F.coalesce(f"b_{m}", F.lit(0))
        apart = apart | (F.abs(gap) > tolerance)
    verdict = (
        F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(apart, "differs")
    )
    return both.withColumn("verdict", verdict).filter("verdict IS NOT NULL").drop("_a", "_b")


def pnl_breaks(pnl: DataFrame, tolerance=0.01) -> DataFrame:
    """Rows whose P&L is not value change + rebate + fee; a missing part counts as 0."""

    def part(name):
        return F.coalesce(name, F.lit(0))

    expected = (
        part("mtm_value_current_usd") - part("mtm_value_prev_usd")
        + part("rebate_income_usd") + part("fee_income_usd")
    )
    return pnl.withColumn("expected_pnl_usd", expected).filter(
        F.abs(F.col("pnl_usd") - F.col("expected_pnl_usd")) > tolerance
    )


def count_balance(audits: DataFrame) -> DataFrame:
    """Files where valid and rejected rows do not add up to the rows read."""
    return audits.filter(F.col("record_count") + F.col("reject_count") != F.col("read_count"))


def freshness(ledger: DataFrame, hours: float = 12, event: str = "event_at", done: str = "processed_at"):
    """Minutes from file event to processing, late beyond ``hours`` or after 6:00 of the next day."""
    minutes = F.timestamp_diff("MINUTE", F.col(event), F.col(done))
    deadline = F.date_add(F.to_date(event), 1).cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")
    return ledger.withColumns(
        {
            "latency_minutes": minutes,
            "over_alarm": minutes > F.lit(hours * 60),
            "missed_deadline": F.col(done) > deadline,
        }
    )


def completeness(received: DataFrame, types: Sequence[str], first: Column, last: Column, expected: int = 1):
    """Files per day and type against the expected number, days without any included.

    ``received`` has ``file_date`` and ``file_type``. The calendar is exploded from
    its two ends, not joined as a product.
    """
    calendar = (
        received.sparkSession.range(1)
        .select(F.explode(F.sequence(first, last)).alias("file_date"))
        .withColumn("file_type", F.explode(F.array(*[F.lit(t) for t in types])))
    )
    counts = received.groupBy("file_date", "file_type").agg(F.count("*").alias("received"))
    return (
        calendar.join(counts, ["file_date", "file_type"], "left")
        .withColumn("received", F.coalesce("received", F.lit(0)))
        .withColumn("complete", F.col("received") >= expected)
    )


def reject_spike(audits: DataFrame, back: int, factor: float, by: Sequence[str] = ("file_type",)):
    """Days whose reject rate exceeds ``factor`` times the mean rate of the ``back`` days before.

    ``audits`` has ``day`` (integer), ``read_count`` and ``reject_count``.
    """
    days = audits.groupBy(*by, "day").agg(
        F.sum("read_count").alias("read_count"), F.sum("reject_count").alias("reject_count")
    )
    rate = F.col("reject_count") / F.nullif(F.col("read_count"), F.lit(0))
    days = days.withColumn("rate", rate)
    summed = moving(days, by, "day", "rate", back, "sum", "_sum", upto=-1)
    counted = moving(summed, by, "day", "rate", back, "count", "_days", upto=-1)
    mean = F.col("_sum") / F.nullif(F.col("_days"), F.lit(0))
    return (
        counted.withColumn("trailing_rate", mean)
        .withColumn("spike", F.coalesce(F.col("rate") > F.col("trailing_rate") * factor, F.lit(False)))
        .drop("_sum", "_days")
    )
