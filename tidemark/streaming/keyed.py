"""Per-key event operators that work on batches and inside ``foreachBatch``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quality import REASONS, Rule, validate
from tidemark.operators.workflow import FAILURE_ACTIONS
from tidemark.plans.ordering import keyed_neighbor

# Write limits of one shard per second, and tries before giving up.
SHARD_RECORDS = 1000
SHARD_BYTES = 1024 * 1024
MAX_ATTEMPTS = 3


def latest_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key by ``order``; an older event that arrives later never wins."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*key).agg(newest.alias("_newest")).select("_newest.*")


def compact(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, tombstones: bool = False):
    """Last record per key; a null ``value`` deletes the key unless ``tombstones`` are kept."""
    latest = latest_by_key(df, key, order)
    return latest if tombstones else latest.filter(F.col(value).isNotNull())


def lag_report(latest: DataFrame, committed: DataFrame, threshold: int) -> DataFrame:
    """Messages behind per group, topic and partition, and per group and topic in total.

    ``latest``: topic, partition, earliest, latest. ``committed``: group, topic,
    partition, offset. A group without a commit on a partition starts at earliest.
    """
    groups = committed.select("group", "topic").distinct()
    wanted = groups.join(latest, "topic")
    joined = wanted.join(committed, ["group", "topic", "partition"], "left")
    behind = F.col("latest") - F.coalesce(F.col("offset"), F.col("earliest"))
    parts = joined.withColumn("lag", F.greatest(behind, F.lit(0)))
    return (
        parts.groupingSets(
            [[F.col("group"), F.col("topic"), F.col("partition")], [F.col("group"), F.col("topic")]],
            F.col("group"), F.col("topic"), F.col("partition"),
        )
        .agg(F.sum("lag").alias("lag"), (F.grouping("partition") == 1).alias("is_total"))
        .withColumn("over", F.col("lag") > threshold)
    )


def shard_audit(df: DataFrame, shard: Column, second: Column, payload: Column) -> DataFrame:
    """Records and bytes per shard and second; throttled beyond either write limit."""
    load = df.groupBy(shard.alias("shard"), second.alias("second")).agg(
        F.count("*").alias("records"), F.sum(F.octet_length(payload)).alias("bytes")
    )
    return with_throttle(load)


def with_throttle(load: DataFrame) -> DataFrame:
    """Why a shard-second is throttled: too many records, too many bytes, or not at all."""
    reason = F.when(F.col("records") > SHARD_RECORDS, "records").when(F.col("bytes") > SHARD_BYTES, "bytes")
    return load.withColumn("throttled_by", reason).withColumn("throttled", reason.isNotNull())


def hot_keys(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` keys with most rows: their share of all rows and how far they exceed the mean key."""
    keys = df.groupBy(key).agg(F.count("*").alias("rows"))
    total = keys.agg(F.sum("rows").cast("double").alias("_total"), F.count("*").alias("_keys"))
    top = keys.orderBy(F.desc("rows"), key).limit(k)
    # One row of totals, as two scalars.
    rows, names = total.select("_total").scalar(), total.select("_keys").scalar()
    return top.withColumns({"share": F.col("rows") / rows, "skew": F.col("rows") * names / rows})


def order_check(df: DataFrame, key: Sequence[str], arrival: Sequence, seq: str, limit=None) -> DataFrame:
    """Events whose sequence number does not follow the one before: ``gap``, ``repeat`` or ``backwards``."""
    prev = f"prev_{seq}"
    stepped = keyed_neighbor(df, key, arrival, seq, prev, -1, limit)
    step = F.col(seq) - F.col(prev)
    issue = F.when(step < 0, "backwards").when(step == 0, "repeat").when(step > 1, "gap")
    return stepped.withColumn("issue", issue).filter("issue IS NOT NULL")


def replay(df: DataFrame, key: Sequence[str], at: str, until, sums: Sequence[str] = (), last: Sequence[str] = (), order=()):
    """State per key as of ``until``: additive columns summed, others taken from the last event."""
    folded = [F.sum(c).alias(c) for c in sums]
    folded += [F.max_by(c, F.struct(*(order or (at,)))).alias(c) for c in last]
    return df.filter(F.col(at) <= F.lit(until)).groupBy(*key).agg(*folded, F.count("*").alias("events"))


def split_dead(df: DataFrame, rules: Sequence[Rule], malformed: str | None = None):
    """(good rows, dead rows with reasons). Malformed payloads carry only that reason."""
    checked = validate(df, rules)
    if malformed:
        checked = checked.withColumn(
            REASONS, F.when(F.col(malformed), F.array(F.lit("payload:malformed"))).otherwise(F.col(REASONS))
        )
    good = F.size(REASONS) == 0
    return checked.filter(good).drop(REASONS), checked.filter(~good)


def retry_split(failed: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(to retry with a raised count, dead letters, bad records) by failure class and tries so far."""
    action = F.lit("dead_letter")
    for failure, what in FAILURE_ACTIONS.items():
        action = F.when(F.col("failure_class") == failure, F.lit(what)).otherwise(action)
    sorted_out = failed.withColumn("_action", action)
    may_retry = (F.col("_action") == "retry") & (F.col("retry_count") < max_attempts)
    retry = sorted_out.filter(may_retry).withColumn("retry_count", F.col("retry_count") + 1)
    bad = sorted_out.filter(F.col("_action") == "bad_record")
    dead = sorted_out.filter(~may_retry & (F.col("_action") != "bad_record")).withColumn(
        "failure_type",
        F.when(F.col("_action") == "retry", "MAX_RETRIES_EXCEEDED").otherwise(F.upper("failure_class")),
    )
    return retry.drop("_action"), dead.drop("_action"), bad.drop("_action")


def redrive(ledger: DataFrame, source: DataFrame, key: str, statuses=("FAILED",), approved: str | None = None):
    """Source rows whose ledger state asks for another run (and is approved, if that is required)."""
    wanted = ledger.filter(F.col("status").isin(*statuses))
    if approved:
        wanted = wanted.filter(F.col(approved))
    return source.join(wanted.select(key).distinct(), key, "left_semi")


def route(events: DataFrame, subs: DataFrame, key: str = "symbol") -> DataFrame:
    """(event, subscriber) deliveries: same symbol, and the price beyond the subscriber's bound if it has one."""
    above = F.col("above").isNull() | (F.col("price") > F.col("above"))
    below = F.col("below").isNull() | (F.col("price") < F.col("below"))
    return events.join(subs, key).filter(above & below)


def envelope(sources: Mapping[str, tuple[DataFrame, str, str, Sequence[str]]]) -> DataFrame:
    """Unify several kinds of events as ``kind, key, at, payload``; name → (frame, key, time, fields)."""
    out = None
    for kind, (df, key, at, fields) in sources.items():
        part = df.select(
            F.lit(kind).alias("kind"),
            F.col(key).cast("string").alias("key"),
            F.col(at).alias("at"),
            F.to_json(F.struct(*fields)).alias("payload"),
        )
        out = part if out is None else out.unionByName(part)
    return out
