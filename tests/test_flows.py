"""Ingestion end to end, history tables, stream restarts, decisions and retrieval against brute force."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalars
from tidemark.operators import dims, joins, policy, quality, reports, retrieval, rows, usage, windows, workflow
from tidemark.operators.policy import Field, Policy, When
from tidemark.sources import files, intake, log, publish
from tidemark.streaming import flows, keyed

POSITIONS = T.StructType(
    [
        T.StructField("loan_id", T.StringType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("settle_date", T.DateType()),
        T.StructField("security_id", T.StringType()),
        T.StructField("borrower_id", T.StringType()),
        T.StructField("quantity", T.DecimalType(18, 4)),
        T.StructField("loan_value_usd", T.DecimalType(18, 2)),
        T.StructField("collateral_type", T.StringType()),
    ]
)
GOOD = "{id}|2024-01-10|2024-01-12|S1|B1|10.5|1000.00|CASH"


def rules():
    return [
        *[quality.well_typed(f.name) for f in POSITIONS],
        quality.mandatory("loan_id"), quality.mandatory("trade_date"), quality.not_blank("security_id"),
        quality.at_least("quantity", 0, strict=True), quality.at_least("loan_value_usd", 0),
        quality.not_before("settle_date", "trade_date"), quality.one_of("collateral_type", ["CASH", "NON_CASH", "MIXED"]),
    ]


def deliver(folder, day, lines):
    path = folder / f"lending_positions_{day}.csv"
    path.write_text("|".join(POSITIONS.names) + "\n" + "\n".join(lines) + ("\n" if lines else ""))
    return str(path)


def test_ingestion(spark, tmp_path):
    lines = [
        GOOD.format(id="L1"), GOOD.format(id="L2"), GOOD.format(id="L2"),
        "L3|2024-01-10|2024-01-09|S1|B1|0|-5|GOLD", "L4|soon|2024-01-12|S1|B1|many|1|CASH", "|2024-01-10|2024-01-12|  |B1|1|1|CASH",
    ]
    path = deliver(tmp_path, "20240115", lines)
    read = files.read_delimited(spark, path, POSITIONS, "|")
    checked = quality.validate(read, rules(), [["loan_id"]])
    valid, rejected = quality.split(checked, keep=True)
    assert valid.count() + rejected.count() == len(lines)
    assert [r.loan_id for r in valid.collect()] == ["L1"]
    reasons = {r.loan_id: r.reject_reasons for r in rejected.collect()}
    assert reasons["L2"] == ["loan_id:unique"]
    assert reasons["L3"] == [
        "quantity:min_0", "loan_value_usd:min_0", "settle_date:not_before_trade_date", "collateral_type:enum"
    ]
    assert reasons["L4"] == ["trade_date:type", "quantity:type", "trade_date:mandatory"]
    assert set(reasons[None]) == {"loan_id:mandatory", "security_id:not_blank"}

    audit = quality.audit(checked, ["file_type", "file_date"], POSITIONS.names, "job-1", "2024-01-15 06:00:00").first()
    assert (audit.file_type, str(audit.file_date)) == ("positions", "2024-01-15")
    assert (audit.read_count, audit.record_count, audit.reject_count, audit.status) == (6, 1, 5, "PARTIAL")
    same = quality.audit(checked.repartition(5), ["file_type", "file_date"], POSITIONS.names, "job-1").first()
    assert same.checksum == audit.checksum

    root = str(tmp_path / "curated")
    publish.publish_slice(valid.select(*POSITIONS.names, "file_date"), root, ["file_date"], "job-1", published_at="2024-01-15 06:00:00")
    publish.write_quarantine(rejected, str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 5

    # A corrected delivery in which one row has gone and others are right.
    path = deliver(tmp_path, "20240115", [GOOD.format(id="L2"), GOOD.format(id="L5")])
    again = files.read_delimited(spark, path, POSITIONS, "|")
    valid, _ = quality.split(quality.validate(again, rules(), [["loan_id"]]), keep=True)
    publish.publish_slice(valid.select(*POSITIONS.names, "file_date"), root, ["file_date"], "job-2", published_at="2024-01-15 09:00:00")
    assert {r.loan_id for r in publish.read_published(spark, root, ["file_date"]).collect()} == {"L2", "L5"}
    assert [r.job_id for r in publish.superseded_jobs(spark, root, ["file_date"]).collect()] == ["job-1"]


def test_empty_and_ragged_files(spark, tmp_path):
    path = deliver(tmp_path, "20240116", [])
    assert files.read_delimited(spark, path, POSITIONS, "|").count() == 0
    path = deliver(tmp_path, "20240117", [GOOD.format(id="L1") + "|extra|more"])
    assert files.read_delimited(spark, path, POSITIONS, "|").first()["_ragged"] is not None


def test_failed_publish_stays_invisible(spark, tmp_path):
    root = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1)], "k string, v int")
    publish.publish_slice(first, root, ["k"], "job-1")
    # The data of an attempt that died before its ledger row, and the same job started again.
    df = spark.createDataFrame([("a", 9)], "k string, v int")
    df.write.partitionBy("k").parquet(f"{root}/data/attempt=0123456789e00000")
    assert [r.v for r in publish.read_published(spark, root, ["k"]).collect()] == [1]
    for _ in range(2):
        publish.publish_slice(df, root, ["k"], "job-2")
        assert [r.v for r in publish.read_published(spark, root, ["k"]).collect()] == [9]


def test_slice_keys_keep_type_and_nulls(spark, tmp_path):
    root = str(tmp_path / "typed")
    df = spark.createDataFrame([("001", 1), (None, 2), ("2024-01-01", 3)], "k string, v int")
    publish.publish_slice(df, root, ["k"], "job-1", published_at="2024-01-01 00:00:00")
    publish.publish_slice(df.filter("v = 1"), root, ["k"], "job-2", df.filter("v <> 3"), "2024-01-02 00:00:00")
    assert {(r.k, r.v) for r in publish.read_published(spark, root, ["k"]).collect()} == {("001", 1), ("2024-01-01", 3)}
    publish.publish_slice(df.filter("v = 2"), root, ["k"], "job-3", published_at="2024-01-03 00:00:00")
    assert {r.v for r in publish.read_published(spark, root, ["k"]).collect()} == {1, 2, 3}


def test_retention_and_slices(spark, tmp_path):
    root = str(tmp_path / "landing")
    days = [dt.date(2024, 1, d) for d in (1, 10, 20)]
    df = spark.createDataFrame([(d.isoformat(), i) for i, d in enumerate(days)], "file_date string, v int")
    publish.replace_slice(df, root, ["file_date"])
    listed = publish.expire_partitions(spark, root, 15, dt.date(2024, 1, 22))
    assert len(listed) == 1 and "2024-01-01" in listed[0]
    assert spark.read.parquet(root).count() == 3
    publish.expire_partitions(spark, root, 15, dt.date(2024, 1, 22), dry_run=False)
    assert spark.read.parquet(root).count() == 2
    publish.replace_slice(df.filter("v = 2"), root, ["file_date"], [{"file_date": "2024-01-10"}])
    assert [str(r.file_date) for r in spark.read.parquet(root).collect()] == ["2024-01-20"]


def test_intake_modes(spark):
    listing = spark.createDataFrame([("src", "positions", "2024-01-15", n) for n in ("a", "b", "c")], "source string, file_type string, file_date string, file_name string")
    listing = listing.withColumn("file_key", intake.idempotency_key())
    ledger = spark.createDataFrame(
        [("src|positions|2024-01-15|a", "PENDING", 1), ("src|positions|2024-01-15|a", "SUCCESS", 2), ("src|positions|2024-01-15|b", "FAILED", 3)],
        "file_key string, status string, processed_at int",
    )
    skip = {r.file_name: r.action for r in quality.intake(listing, ledger).collect()}
    assert skip == {"a": "skip", "b": "process", "c": "process"}
    assert {r.action for r in quality.intake(listing, ledger, "overwrite").collect()} == {"process"}
    assert {r.file_name for r in intake.unprocessed(listing, ledger).collect()} == {"b", "c"}


# ---------------------------------------------------------------- history


def brute_history(deltas):
    """Apply deltas one by one to lists of (day, state) per key, keeping only changes."""
    stored = {}
    for delta in deltas:
        for key in {k for k, _, _ in delta}:
            days = dict(stored.get(key, []))
            days.update({d: a for k, d, a in delta if k == key})
            states = sorted(days.items())
            stored[key] = [s for i, s in enumerate(states) if i == 0 or states[i - 1][1] != s[1]]
    return sorted(
        (
            (key, attr, day, kept[i + 1][0] if i + 1 < len(kept) else None)
            for key, kept in stored.items()
            for i, (day, attr) in enumerate(kept)
        ),
        key=repr,
    )


@pytest.mark.parametrize("limit", [None, 3])
def test_scd2(spark, limit):
    rng = random.Random(5)
    changes = {}
    for _ in range(200):
        changes[(rng.randrange(12), rng.randrange(60))] = rng.choice(["x", "y", None])
    rows = [(k, d, a) for (k, d), a in changes.items()]
    rng.shuffle(rows)
    schema = "k int, day int, attr string"
    parts = [spark.createDataFrame(rows[i::3], schema) for i in range(3)]
    history = dims.open_versions(parts[0], "k", ["attr"], "day")
    for part in parts[1:]:
        history = dims.scd2(history, part, "k", ["attr"], "day", limit)
    got = sorted([(r.k, r.attr, r.effective_from, r.effective_to) for r in history.collect()], key=repr)
    assert got == brute_history([rows[i::3] for i in range(3)])
    replayed = dims.scd2(history, parts[2], "k", ["attr"], "day", limit)
    assert sorted(replayed.collect(), key=repr) == sorted(history.collect(), key=repr)
    assert joins.overlapping_ranges(history, "k", "effective_from", "effective_to", limit).count() == 0


def test_scd3_and_upsert(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    delta = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    out = {r.k: (r.v, r.previous_v) for r in dims.scd3(current, delta, "k", ["v"]).collect()}
    assert out == {1: ("a", None), 2: ("c", "b"), 3: ("d", None)}
    again = {r.k: (r.v, r.previous_v) for r in dims.scd3(dims.scd3(current, delta, "k", ["v"]), delta, "k", ["v"]).collect()}
    assert again == out
    assert {(r.k, r.v) for r in dims.upsert(current, delta, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}


def test_hierarchy_stops_at_cycles(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 5), (5, 4)], "id int, parent int")
    out = {r.id: (r.depth, r.path) for r in dims.hierarchy(df, "id", "parent").collect()}
    assert out == {1: (0, [1]), 2: (1, [1, 2]), 3: (2, [1, 2, 3])}


def test_hierarchy_of_any_depth(spark):
    df = spark.createDataFrame([(i, i - 1 if i else None) for i in range(41)], "id int, parent int")
    assert dims.hierarchy(df, "id", "parent").count() == 41
    with pytest.raises(ValueError):
        dims.hierarchy(df, "id", "parent", max_depth=32)


def test_null_keys_are_keys(spark):
    old = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    new = spark.createDataFrame([(None, "z")], "k int, v string")
    assert {tuple(r) for r in dims.upsert(old, new, ["k"]).collect()} == {(None, "z"), (1, "y")}
    history = dims.open_versions(old.withColumn("day", F.lit("2024-01-01")), "k", ["v"], "day")
    history = dims.scd2(history, new.withColumn("day", F.lit("2024-01-02")), "k", ["v"], "day")
    assert {(r.k, r.v) for r in history.filter("is_current").collect()} == {(None, "z"), (1, "y")}
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 0), (None, 3, 5)], "k int, seq int, v int")
    assert [r.seq for r in rows.take_while(df, F.col("v") > 1, ["seq"], ["k"]).collect()] == [1]
    loans = spark.createDataFrame([(None, "a", 3), (None, "b", 1)], "day string, who string, loan_value_usd int")
    shares = reports.exposure(loans, ["who"], within=["day"]).collect()
    assert {r.who: float(r.share_pct) for r in shares} == {"a": 75.0, "b": 25.0}


def test_surrogates_and_checksums_mark_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    assert dims.surrogate(df, ["x", "y"]).select("sk").distinct().count() == 3
    sums = [df.limit(1), df.filter("x IS NULL")]
    assert len({d.agg(scalars.file_checksum(["x", "y"])).first()[0] for d in sums}) == 2


def test_partner_without_quota_stays(spark):
    calls = spark.createDataFrame([("p", dt.datetime(2024, 1, 1)), ("q", dt.datetime(2024, 1, 2))], "partner_id string, ts timestamp_ntz")
    quotas = spark.createDataFrame([("p", 10)], "partner_id string, quota int")
    assert {r.partner_id: r.state for r in usage.quota_state(calls, quotas).collect()} == {"p": "ok", "q": "no_quota"}


def test_policies_fail_closed_on_missing_fields(spark):
    requests = spark.createDataFrame(
        [(1, None, None, None), (2, "open", "me", "me"), (3, "suspended", "me", "you"), (4, "1.0", None, "x")],
        "id int, status string, owner string, caller string",
    )

    def decided(*conditions):
        rules = [policy.Policy("p", "permit", conditions=conditions)]
        return [r.id for r in policy.evaluate_policies(requests, rules).filter("decision = 'ALLOW'").orderBy("id").collect()]

    assert decided(policy.When("status", "ne", "suspended")) == [2, 4]
    assert decided(policy.When("owner", "eq", policy.Field("caller"))) == [2]
    assert decided(policy.When("nothing", "eq", policy.Field("absent"))) == []
    assert decided(policy.When("nothing", "ne", "x")) == []
    assert decided(policy.When("status", "eq", 1)) == [4]
    assert decided(policy.When("status", "missing")) == [1]
    rules = [policy.Policy("all", "permit"), policy.Policy("no", "forbid", conditions=[policy.When("owner", "ne", policy.Field("caller"))])]
    assert [r.id for r in policy.evaluate_policies(requests, rules).filter("decision = 'DENY'").collect()] == [3]


# ---------------------------------------------------------------- streams


def test_partials_of_unordered_files_lose_nothing(spark, tmp_path):
    """Files one per batch, newest first, over a restart: every call is counted, open windows too."""
    rng = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    calls = [(rng.choice("ab"), start + dt.timedelta(minutes=rng.randrange(60 * 24 * 9))) for _ in range(400)]
    calls.sort(key=lambda c: c[1], reverse=True)
    schema = "k string, ts timestamp_ntz"
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    sink = flows.partial_sink(root, lambda df: flows.meter(df, ["k"]))
    for part in range(4):
        spark.createDataFrame(calls[part * 100 : part * 100 + 100], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        flows.start(stream, checkpoint, each=sink).awaitTermination()
    got = {(r.k, r.period): r.calls for r in flows.read_partials(spark, root, ["period", "k"], ["calls"]).collect()}
    want = {}
    for k, at in calls:
        hour = (k, at.replace(minute=0))
        want[hour] = want.get(hour, 0) + 1
    assert {(k, p.replace(tzinfo=None)): n for (k, p), n in got.items()} == want
    # A replayed epoch overwrites itself.
    sink(spark.createDataFrame(calls[:100], schema), 0)
    assert flows.read_partials(spark, root, ["k"], ["calls"]).agg(F.sum("calls")).first()[0] == 400


def test_unordered_deliveries_lose_no_event_and_no_pair(spark, tmp_path):
    """One file per batch, newest first and years apart: first events and pairs are found all the same."""
    schema, day = "k long, at timestamp_ntz", dt.datetime(2024, 1, 1)
    source = str(tmp_path / "in")
    for years in (3, 2, 1, 0):
        rows = [(k, day + dt.timedelta(days=365 * years, hours=k)) for k in range(10 + years)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    arrived = flows.drain(stream)
    first = {r.k: r.at for r in flows.dedupe(arrived, "k", "at").collect()}
    assert first == {k: day + dt.timedelta(days=365 * max(0, k - 9), hours=k) for k in range(13)}
    right = arrived.withColumn("after", F.col("at") + F.expr("INTERVAL 1 HOUR")).select("k", "after")
    assert flows.join_within(arrived, right, "k", "at", "after", "2 HOURS").count() == 10 + 11 + 12 + 13
    with pytest.raises(ValueError):
        flows.dedupe(stream, "k", "at")


def test_two_flows_into_one_table(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k string, seq long"
    for flow, row in (("east", ("a", 1)), ("west", ("b", 1)), ("west", ("b", 9))):
        flows.upsert_sink(root, ["k"], ["seq"], 4, flow)(spark.createDataFrame([row], schema), 0)
    # The last call replays epoch 0 of its flow and changes nothing.
    assert {(r.k, r.seq) for r in flows.read_upserted(spark, root).collect()} == {("a", 1), ("b", 1)}
    root = str(tmp_path / "o")
    for flow, ids in (("east", [1, 2]), ("west", [2, 3]), ("west", [2, 3])):
        df = spark.createDataFrame([(i, "2024-01-01") for i in ids], "id int, day string")
        flows.once_sink(root, "id", "day", flow)(df, 0)
    assert sorted(r.id for r in flows.read_once(spark, root).collect()) == [1, 2, 3]


def test_latest_survives_restart_and_order(spark, tmp_path):
    rng = random.Random(2)
    quotes = [(rng.choice(["A", "B", "C"]), s, float(s)) for s in range(60)]
    want = {}
    for symbol, seq, price in quotes:
        want[symbol] = max(want.get(symbol, (0, 0.0)), (seq, price))
    rng.shuffle(quotes)
    schema = "symbol string, seq long, price double"
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    for i in range(3):
        spark.createDataFrame(quotes[i::3], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        flows.start(stream, checkpoint, each=flows.upsert_sink(root, ["symbol"], ["seq"], 4)).awaitTermination()
    table = flows.read_upserted(spark, root)
    assert {r.symbol: (r.seq, r.price) for r in table.collect()} == want


def test_once_sink_across_restarts(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    for ids in ([1, 2, 2], [2, 3], [1, 4]):
        df = spark.createDataFrame([(i, f"2024-01-0{i}") for i in ids], "id int, day string")
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id int, day string").parquet(source)
        flows.start(stream, checkpoint, each=flows.once_sink(root, "id", "day")).awaitTermination()
    assert sorted(r.id for r in flows.read_once(spark, root).collect()) == [1, 2, 3, 4]


def test_log_round_trip(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    lines = log.to_log(df, "id", "t")
    back = log.from_log(lines.unionByName(spark.createDataFrame([("t", "9", "{oops")], lines.schema)), df.schema)
    assert sorted(back.filter("NOT _malformed").drop("_malformed").collect()) == sorted(df.collect())
    assert back.filter("_malformed").count() == 1


def test_quote_order(spark):
    quotes = spark.createDataFrame([("A", 1, 1001), ("A", 2, 1002), ("A", 3, 1005), ("A", 4, 1004), ("A", 5, 1004)], "symbol string, at int, seq int")
    issues = {r["at"]: r.issue for r in keyed.order_check(quotes, ["symbol"], ["at"], "seq").collect()}
    assert issues == {3: "gap", 4: "backwards", 5: "repeat"}


# ---------------------------------------------------------------- workflow


def test_status_rollup(spark):
    rows = [
        ("J1", 1, 1, "COMPLETED"), ("J1", 1, 1, "FAILED"), ("J1", 1, 2, "COMPLETED"), ("J1", 2, 3, "COMPLETED"),
        ("J2", 1, 4, "FAILED"), ("J3", 1, 5, "COMPLETED"), ("J3", 1, 6, "IN_PROGRESS"),
    ]
    stages = spark.createDataFrame(rows, "job_id string, partition_id int, record_id int, status string")
    records, partitions, jobs = workflow.rollup_status(stages)
    assert {r.record_id: r.status for r in records.collect()}[1] == "FAILED"
    assert {r.job_id: r.status for r in jobs.collect()} == {"J1": "PARTIALLY_FAILED", "J2": "FAILED", "J3": "IN_PROGRESS"}
    assert {(r.job_id, r.partition_id): r.status for r in partitions.collect()}[("J1", 2)] == "COMPLETED"


def test_ops_views(spark):
    t = dt.datetime(2024, 1, 15, 12)
    m = dt.timedelta(minutes=1)
    jobs = spark.createDataFrame([("F", "COMPLETED", t, t + m), ("F", "FAILED", t, t + 3 * m)], "feed_id string, status string, created_at timestamp, updated_at timestamp")
    parts = spark.createDataFrame([(1, "IN_PROGRESS", t), (2, "IN_PROGRESS", t + 90 * m), (3, "COMPLETED", t)], "partition_id int, status string, updated_at timestamp")
    stages = spark.createDataFrame([("ENRICH", 2, t, t + m), ("ENRICH", 0, t, t + 2 * m)], "stage_name string, retry_count int, started_at timestamp, completed_at timestamp")
    dead = spark.createDataFrame([("POISON",), ("POISON",)], "failure_type string")
    views = workflow.ops_views(jobs, parts, stages, dead, now=F.lit(t + 100 * m))
    assert views["jobs_by_status"].count() == 2
    assert tuple(views["feed_sla"].first()) == ("F", 2, 120.0, 180)
    assert [r.partition_id for r in views["stuck_partitions"].collect()] == [1]
    assert tuple(views["stage_latency"].first()) == ("ENRICH", 90.0, 120)
    assert tuple(views["retry_trend"].first()) == ("ENRICH", 2, 2)
    assert tuple(views["dead_by_type"].first()) == ("POISON", 2)


def test_evolution_lineage_and_names(spark):
    df = spark.createDataFrame([(1, "Ada King", ""), (2, "Bob", "Ray")], "id int, first_name string, last_name string")
    fixed, changes = workflow.split_name(df, "first_name")
    assert {(r.first_name, r.last_name) for r in fixed.collect()} == {("Ada", "King"), ("Bob", "Ray")}
    assert [(r.id, r.old_value) for r in changes.collect()] == [(1, "Ada King")]
    traced = workflow.with_lineage(df, "job-1", "feed", ["id"])
    assert traced.select("record_id").distinct().count() == 2


def test_generated_sources(spark):
    from tidemark.sources import generate

    assert [r.n for r in generate.numbers(spark, 1, 4).collect()] == [1, 2, 3]
    assert generate.numbers(spark, 1, 4, closed=True).count() == 4
    assert generate.empty(spark, "a int").count() == 0


def test_partition_plan(spark):
    plan = workflow.plan_partitions(spark.range(120).select("id"), ["id"], 50).orderBy("partition_id").collect()
    assert [(r.record_start, r.record_end) for r in plan] == [(1, 50), (51, 100), (101, 120)]


def test_retry_classes(spark):
    failed = spark.createDataFrame(
        [(1, "transient", 0), (2, "transient", 3), (3, "poison", 0), (4, "business_validation", 0), (5, "odd", 0)],
        "id int, failure_class string, retry_count int",
    )
    retry, dead, bad = keyed.retry_split(failed)
    assert [(r.id, r.retry_count) for r in retry.collect()] == [(1, 1)]
    assert {r.id: r.failure_type for r in dead.collect()} == {2: "MAX_RETRIES_EXCEEDED", 3: "POISON", 5: "ODD"}
    assert [r.id for r in bad.collect()] == [4]


# ---------------------------------------------------------------- access


def test_policies(spark):
    schema = "id int, principal string, action string, roles array<string>, hour string, balance double, amount string"
    rows = [
        (1, "ann", "withdraw", ["teller"], "14", 0.0, "0"), (2, "ann", "withdraw", ["teller"], "20", 0.0, "0"),
        (3, "bob", "withdraw", ["customer"], "14", 0.0, "0"), (4, "bob", "transfer", ["customer"], "10", 2000.0, "500"),
        (5, "bob", "transfer", ["customer"], "10", 2000.0, "2500"), (6, "bob", "transfer", None, "10", 2000.0, "500"),
        (7, "ann", "withdraw", ["teller"], "late", 0.0, "0"), (8, "bob", "transfer", ["customer"], "10", None, "500"),
    ]
    requests = spark.createDataFrame(rows, schema).withColumn("resource", F.struct("balance"))
    policies = [
        Policy("after-hours", "forbid", action="withdraw", conditions=(When("hour", "outside", (9, 17)),)),
        Policy("teller", "permit", action="withdraw", roles=("teller",)),
        Policy("transfer", "permit", action="transfer", roles=("customer", "teller"),
               conditions=(When("resource.balance", "ge", 1000), When("amount", "le", Field("resource.balance")))),
        Policy("no-such-field", "forbid", conditions=(When("resource.colour", "gt", 1),)),
    ]
    out = {r.id: r.decision for r in policy.evaluate_policies(requests, policies).collect()}
    assert out == {1: "ALLOW", 2: "DENY", 3: "DENY", 4: "ALLOW", 5: "DENY", 6: "DENY", 7: "ALLOW", 8: "DENY"}
    assert {r.decision for r in policy.evaluate_policies(requests, []).collect()} == {"DENY"}


@pytest.mark.parametrize("limit", [None, 2])
def test_decisions(spark, limit):
    t = dt.datetime(2024, 1, 15, 12)
    hour = dt.timedelta(hours=1)
    consents = spark.createDataFrame(
        [("c1", 1, 7, t - hour, t + hour, None, ["read"]), ("c2", 1, 7, t - hour, t + hour, t, ["pay"])],
        "consent_id string, customer_id int, partner_id int, granted_at timestamp_ntz, expires_at timestamp_ntz, revoked_at timestamp_ntz, granted_scopes array<string>",
    )
    tick = dt.timedelta(milliseconds=1)
    rows = [
        (1, 7, 1, "read", t, True, t + hour), (2, 7, 1, "read", t, False, t + hour), (3, 7, 1, "read", t, True, t - hour),
        (4, 7, 2, "read", t, True, t + hour), (5, 7, 1, "pay", t + tick, True, t + hour), (6, 7, 1, "read", t + 2 * tick, True, t + hour),
        (7, 7, 1, "pay", t, True, t + hour), (8, 7, 1, "read", t + 2 * hour, True, t + 3 * hour),
    ]
    requests = spark.createDataFrame(
        rows, "request_id int, partner_id int, customer_id int, scope string, requested_at timestamp_ntz, token_valid boolean, token_expires_at timestamp_ntz"
    )
    out = {r.request_id: r.decision for r in usage.decide(requests, consents, per_second=6, limit=limit).collect()}
    assert out == {
        1: "ALLOW", 2: "401 invalid_token", 3: "401 token_expired", 4: "403 consent_revoked", 5: "403 insufficient_scope",
        6: "429 rate_limited", 7: "ALLOW", 8: "403 consent_revoked",
    }
    assert {r.request_id for r in joins.entitled(requests, consents).collect()} == {1, 2, 3, 6, 7}


def test_rate_windows(spark):
    t = dt.datetime(2024, 1, 15, 12)
    calls = [(1, t + dt.timedelta(seconds=s), "payment") for s in (0, 30, 95)]
    df = spark.createDataFrame(calls, "customer_id int, ts timestamp_ntz, api string")
    out = usage.rate_violations(df, [("payment", ("customer_id",), 60, 1, "payment")]).collect()
    assert [(r.calls) for r in out] == [2]


# ---------------------------------------------------------------- retrieval


@pytest.mark.parametrize("words,chunks", [(1, 1), (600, 1), (601, 2), (1100, 2), (1101, 3)])
def test_chunk_counts(spark, words, chunks):
    text = " ".join(f"w{i}" for i in range(words))
    out = retrieval.chunk(spark.createDataFrame([(1, text)], "id int, text string"), "id", "text").orderBy("chunk_no").collect()
    assert len(out) == chunks
    rebuilt = out[0].chunk_text.split() + [w for c in out[1:] for w in c.chunk_text.split()[100:]]
    assert " ".join(rebuilt) == text


def test_blank_text_has_no_chunk(spark):
    docs = spark.createDataFrame([(1, "  "), (2, None)], "id int, text string")
    assert retrieval.chunk(docs, "id", "text").count() == 0


@pytest.mark.parametrize("cells", [False, True])
def test_knn_against_brute_force(spark, monkeypatch, cells):
    if cells:
        monkeypatch.setattr(retrieval, "MAX_QUERIES", 4)
        monkeypatch.setattr(retrieval, "CELL_BYTES", 90 * 8 * 12)
    rng = np.random.default_rng(1)
    vectors, asked = rng.normal(size=(250, 8)), rng.normal(size=(11, 8))
    vectors[7] = vectors[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id long, embedding array<double>")
    got = {}
    for r in retrieval.knn(df, q, 6).collect():
        got.setdefault(r.query_id, {})[r.rnk] = r.vec_id
    for i, v in enumerate(asked):
        scores = np.round(vectors @ v / np.linalg.norm(vectors, axis=1) / np.linalg.norm(v), 6)
        best = sorted(range(250), key=lambda j: (-scores[j], j))[:6]
        assert [got[i][n] for n in range(1, 7)] == best


def test_bm25_against_brute_force(spark):
    texts = {1: "loan loan security", 2: "security policy for the loan desk", 3: "unrelated words", 4: "Policy, POLICY!"}
    docs = spark.createDataFrame(list(texts.items()), "chunk_id int, chunk_text string")
    queries = spark.createDataFrame([(1, "loan policy"), (2, "nothing here")], "query_id int, query_text string")
    bags = {k: [w for w in "".join(c if c.isalnum() else " " for c in v.lower()).split()] for k, v in texts.items()}
    mean = sum(map(len, bags.values())) / len(bags)
    want = {}
    for k, bag in bags.items():
        score = 0.0
        for term in ("loan", "policy"):
            df = sum(term in b for b in bags.values())
            tf = bag.count(term)
            if tf:
                score += math.log(1 + (4 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / mean))
        if score:
            want[k] = round(score, 6)
    got = {(r.query_id, r.chunk_id): round(r.score, 6) for r in retrieval.bm25(docs, queries).collect()}
    assert got == {(1, k): v for k, v in want.items()}


def test_fusion(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 20, 2)], "query_id int, id int, rnk int")
    b = spark.createDataFrame([(1, 20, 1), (1, 30, 2)], "query_id int, id int, rnk int")
    out = [(r.id, round(r.score, 6)) for r in retrieval.fuse(a, b, id="id").orderBy("rnk").collect()]
    assert out == [(20, round(1 / 62 + 1 / 61, 6)), (10, round(1 / 61, 6)), (30, round(1 / 62, 6))]


def test_wrong_headers_and_empty_files(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, b int")
    for name, text in {"x_1": "a,b\n1,2\n", "x_2": "b,a\n1,2\n3,4\n", "x_3": "a,b\n", "x_4": '"A", b\n5,6,7\n'}.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(text)
    paths = [str(tmp_path / f"x_{i}") for i in range(1, 5)]
    wrong = files.wrong_headers(spark, paths, schema)
    assert [r.header for r in wrong.collect()] == ["b,a"]
    read = files.mark_headers(files.read_delimited(spark, paths, schema), wrong)
    checked = quality.validate(read, [quality.well_headed(), quality.whole_row()]).cache()
    reasons = sorted((r.a, tuple(r.reject_reasons)) for r in checked.collect())
    assert reasons == [(1, ()), (1, ("file:header",)), (3, ("file:header",)), (5, ("row:columns",))]
    listed = files.list_files(spark, paths)
    audit = quality.audit(checked, ["file_path"], ["a", "b"], "job", files=listed).collect()
    assert sorted((r.file_path[-10], r.read_count, r.status) for r in audit) == [
        ("1", 1, "SUCCESS"), ("2", 2, "FAILED"), ("3", 0, "SUCCESS"), ("4", 1, "FAILED"),
    ]
