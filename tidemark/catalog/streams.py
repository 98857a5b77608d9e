"""Event-stream operators: streaming flows run to completion over the file source, and their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import Tables, query
from tidemark.catalog.windowed import _CLICKS, clicks
from tidemark.operators import windows
from tidemark.operators.aggregates import frequency, money
from tidemark.operators.quality import Rule, one_of
from tidemark.plans.scratch import scratch_path
from tidemark.sources import log
from tidemark.sources.intake import new_files_stream
from tidemark.streaming import eventtime, flows, keyed


def _stream(spark, sf, table="events"):
    schema = getattr(Tables(spark, sf), table).schema
    return new_files_stream(spark, sf, schema, pathGlobFilter=f"{table}.parquet")


def _in_files(spark, df, part, parts=4):
    """``df`` written as ``parts`` deliveries, one after the other; streamed one per micro-batch."""
    path = scratch_path(spark, "deliveries")
    for i in range(parts):
        df.filter(part == i).coalesce(2).write.mode("append").parquet(path)
    return new_files_stream(spark, path, df.schema, per_batch=2)


def _delivered(spark, df, part, run, parts=3):
    """``run(stream)`` after each of ``parts`` deliveries of ``df``: every time a new start on the same checkpoints."""
    path = scratch_path(spark, "deliveries")
    for i in range(parts):
        df.filter(part == i).coalesce(2).write.mode("append").parquet(path)
        run(new_files_stream(spark, path, df.schema, per_batch=2))


def _run(stream, each, mode="append"):
    flows.start(stream, scratch_path(stream.sparkSession, "flow-state"), each=each, mode=mode).awaitTermination()


@query(
    "t01_micro_batches",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
)
def _(spark, sf):
    bought = _stream(spark, sf).filter("event_type = 'purchase'").select("event_id", "user_id", "value")
    return flows.drain(bought)


@query(
    "t02_report_grain",
    """SELECT l_suppkey, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY l_suppkey""",
)
def _(spark, sf):
    items = Tables(spark, sf).lineitem.select("l_orderkey", "l_suppkey", money("l_extendedprice").alias("price"))
    stream = _in_files(spark, items, F.pmod("l_orderkey", F.lit(3)), 3)
    sums = stream.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("price").alias("value"))
    root = scratch_path(spark, "report")
    _run(sums, flows.upsert_sink(root, ["l_suppkey"], ["n"], 8), "update")
    return flows.read_upserted(spark, root).withColumn("value", F.col("value").cast("double"))


_LATEST = """SELECT user_id, event_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("t03_latest_by_key", _LATEST)
def _(spark, sf):
    events = Tables(spark, sf).events.select("user_id", "ts", "event_id", "event_type", "value")
    return keyed.latest_by_key(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("t03_latest_stream", _LATEST)
def _(spark, sf):
    events = Tables(spark, sf).events.select("user_id", "ts", "event_id", "event_type", "value")
    # Newest events first, so that older ones arrive later and must not win.
    stream = _in_files(spark, events, 3 - F.floor(F.dayofmonth("ts") / 8))
    root = scratch_path(spark, "latest")
    _run(stream, flows.upsert_sink(root, ["user_id"], ["ts", "event_id"], 8))
    return flows.read_upserted(spark, root).drop("ts")


@query(
    "t04_compact",
    f"SELECT user_id, event_id, value FROM ({_LATEST}) WHERE event_type <> 'error'",
)
def _(spark, sf):
    kept = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    events = Tables(spark, sf).events.select("user_id", "ts", "event_id", kept)
    return keyed.compact(events, ["user_id"], ["ts", "event_id"], "value").drop("ts")


@query("t05_once", "SELECT event_id, value FROM events")
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "value", F.to_date("ts").alias("day"))
    twice = events.withColumn("part", F.pmod("event_id", F.lit(2))).unionByName(
        events.withColumn("part", F.pmod(F.col("event_id") + 1, F.lit(2)))
    )
    stream = _in_files(spark, twice, F.col("part"), 2)
    root = scratch_path(spark, "once")
    _run(stream.drop("part"), flows.once_sink(root, "event_id", "day"))
    return flows.read_once(spark, root).drop("day")


@query("t05_dedupe", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", "ts")
    # Deliveries out of time order, most of each later than the allowed two days; copies come in two of them.
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    twice = events.withColumn("part", part).unionByName(events.withColumn("part", (part + 1) % 3))
    first = eventtime.FirstPerId(scratch_path(spark, "first-events"), events.schema, "event_id", "ts", "1 DAY", "2 DAYS", 16)
    _delivered(spark, twice, F.col("part"), lambda stream: first.cycle(stream.drop("part")))
    return first.read(spark).drop("ts")


@query("t06_replayed_sink", _LATEST)
def _(spark, sf):
    events = Tables(spark, sf).events.select("user_id", "ts", "event_id", "event_type", "value")
    root = scratch_path(spark, "replayed")
    sink = flows.upsert_sink(root, ["user_id"], ["ts", "event_id"], 8)
    early = events.filter(F.dayofmonth("ts") <= 15)
    for epoch, batch in ((0, early), (1, events.filter(F.dayofmonth("ts") > 15)), (1, events), (0, early)):
        sink(batch, epoch)
    return flows.read_upserted(spark, root).drop("ts")


@query(
    "t07_trailing_stream",
    f"""WITH c AS ({_CLICKS}) SELECT a.event_id, CAST(sum(b.clicks) AS DOUBLE) AS trailing FROM c a JOIN c b
       ON a.event_type = b.event_type AND b.t >= a.t - 29 AND (b.t < a.t OR (b.t = a.t AND b.event_id <= a.event_id))
       GROUP BY a.event_id""",
)
def _(spark, sf):
    cents = (F.col("clicks") * 100).cast("long").alias("cents")
    events = clicks(spark, sf).select("event_id", "event_type", "t", cents, F.timestamp_seconds(F.col("t") + 1_704_067_200).alias("at"))
    # Up to five time units out of order, and every fortieth event in the last delivery: later than allowed.
    part = F.when(F.col("event_id") % 40 == 0, 2).otherwise(F.least(F.floor((F.col("t") + F.col("event_id") % 5) / 1440), F.lit(2)))
    flow = eventtime.TrailingSum(scratch_path(spark, "trailing"), events.schema, "event_type", "event_id", "at", "cents", 30, "60 SECONDS")
    _delivered(spark, events, part, flow.cycle)

    def sums(rows):
        out = windows.trailing_agg(rows, "t", "cents", 30, "event_id", key=["event_type"], name="trailing")
        return out.select(F.col("event_id").alias("id"), F.col("trailing").cast("long").alias("trailing"))

    out = flow.read(spark, sums)
    money_ = (F.col("trailing").cast("decimal(20,2)") / 100).cast("decimal(20,2)").cast("double")
    return out.select(F.col("id").alias("event_id"), money_.alias("trailing"))


@query(
    "t08_sliding",
    """WITH w AS (SELECT date_trunc('hour', ts) - to_hours(CAST(i AS INT)) AS s, event_type, value FROM events, (SELECT unnest(range(0, 3)) AS i))
       SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM w GROUP BY 1, 2""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("ts", "event_id", "event_type", money("value").alias("value"))
    # Deliveries out of time order.
    stream = _in_files(spark, events, F.pmod(F.xxhash64("event_id"), F.lit(3)), 3)
    root, by = scratch_path(spark, "sliding"), ["start", "end", "event_type"]
    sums = {"n": F.count("*"), "total": F.sum("value")}
    _run(stream, flows.partial_sink(root, lambda df: flows.sliding(df, ["event_type"], "ts", "3 hours", "1 hour", sums)))
    out = flows.read_partials(spark, root, by, list(sums))
    return out.select(
        F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total")
    )


@query(
    "t09_meter",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS period, user_id, event_type, count(*) AS calls FROM events
       GROUP BY ALL""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("ts", "event_id", "user_id", "event_type")
    stream = _in_files(spark, events, F.pmod(F.xxhash64("event_id"), F.lit(3)), 3)
    root, by = scratch_path(spark, "meter"), ["user_id", "event_type"]
    _run(stream, flows.partial_sink(root, lambda df: flows.meter(df, by)))
    out = flows.read_partials(spark, root, ["period", *by], ["calls"])
    return out.withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm:ss"))


@query(
    "t10_lag",
    """WITH l AS (SELECT event_type AS topic, user_id % 4 AS p, count(*) AS latest FROM events GROUP BY 1, 2),
       c AS (SELECT event_type AS topic, user_id % 4 AS p, count(*) AS off FROM events WHERE value < 40 AND user_id % 4 <> 3 GROUP BY 1, 2),
       x AS (SELECT l.topic, l.p, latest - coalesce(off, 0) AS lag FROM l LEFT JOIN c USING (topic, p))
       SELECT 'billing' AS "group", topic, p AS "partition", lag, false AS is_total, lag > 500 AS "over" FROM x UNION ALL
       SELECT 'billing', topic, NULL, CAST(sum(lag) AS BIGINT), true, sum(lag) > 500 FROM x GROUP BY topic""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), "value"
    )
    latest = events.groupBy("topic", "partition").agg(F.count("*").alias("latest"), F.lit(0).cast("long").alias("earliest"))
    committed = (
        events.filter("value < 40 AND partition <> 3").groupBy("topic", "partition")
        .agg(F.count("*").alias("offset")).withColumn("group", F.lit("billing"))
    )
    return keyed.lag_report(latest, committed, 500)


@query(
    "t11_shard_audit",
    """SELECT event_type AS shard, month(ts) AS second, count(*) AS records, CAST(sum(strlen(props)) AS BIGINT) AS bytes,
         CASE WHEN count(*) > 1000 THEN 'records' WHEN sum(strlen(props)) > 1048576 THEN 'bytes' END AS throttled_by,
         count(*) > 1000 OR sum(strlen(props)) > 1048576 AS throttled FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    events = Tables(spark, sf).events
    return keyed.shard_audit(events, F.col("event_type"), F.month("ts").cast("long"), F.col("props"))


@query(
    "t12_hot_keys",
    """WITH k AS (SELECT user_id, count(*) AS rows FROM events GROUP BY user_id), s AS (SELECT sum(rows) AS total, count(*) AS keys FROM k)
       SELECT user_id, rows, rows / CAST(total AS DOUBLE) AS share, rows * keys / CAST(total AS DOUBLE) AS skew FROM k, s
       QUALIFY row_number() OVER (ORDER BY rows DESC, user_id) <= 20""",
)
def _(spark, sf):
    return keyed.hot_keys(Tables(spark, sf).events, "user_id", 20)


@query(
    "t13_order_check",
    """WITH s AS (SELECT event_id, user_id, event_id % 50 AS seq FROM events), p AS (SELECT *, seq - lag(seq) OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM s)
       SELECT event_id, CASE WHEN step < 0 THEN 'backwards' WHEN step = 0 THEN 'repeat' ELSE 'gap' END AS issue FROM p WHERE step <= 0 OR step > 1""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", (F.col("event_id") % 50).alias("seq"))
    return keyed.order_check(events, ["user_id"], ["event_id"], "seq").select("event_id", "issue")


@query(
    "t14_replay",
    """SELECT user_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value, arg_max(event_type, event_id) AS event_type, count(*) AS events
       FROM events WHERE event_id <= (SELECT (min(event_id) + max(event_id)) // 2 FROM events) GROUP BY user_id""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.withColumn("value", money("value"))
    middle = events.agg(F.expr("(min(event_id) + max(event_id)) div 2")).first()[0]
    out = keyed.replay(events, ["user_id"], "event_id", middle, ["value"], ["event_type"])
    return out.withColumn("value", F.col("value").cast("double"))


@query(
    "t15_dead_letters",
    """SELECT CASE WHEN event_id % 9 = 0 THEN 'payload:malformed' WHEN value > 150 THEN 'value:limit' WHEN event_type = 'error' THEN 'event_type:enum' ELSE 'good' END AS reason,
         count(*) AS n FROM (SELECT *, CASE WHEN event_type = 'error' AND value > 150 THEN 0 END FROM events WHERE NOT (event_type = 'error' AND value > 150 AND event_id % 9 <> 0)) GROUP BY 1
       UNION ALL SELECT 'value:limit;event_type:enum', count(*) FROM events WHERE event_type = 'error' AND value > 150 AND event_id % 9 <> 0 HAVING count(*) > 0""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", "event_type", "value")
    lines = log.to_log(events, "user_id", "usage")
    broken = F.when(F.get_json_object("value", "$.event_id").cast("long") % 9 == 0, F.concat(F.lit("{"), "value")).otherwise(F.col("value"))
    stream = _in_files(spark, lines.withColumn("value", broken), F.lit(0), 1)
    parsed = log.from_log(stream, events.schema)
    rules = [Rule("value", "limit", F.col("value") <= 150), one_of("event_type", ["click", "purchase", "signup", "view"])]
    good, dead = scratch_path(spark, "good"), scratch_path(spark, "dead")
    _run(parsed, flows.dead_letter_sink(lambda df: keyed.split_dead(df, rules, "_malformed"), good, dead))
    reasons = spark.read.parquet(dead).select(F.concat_ws(";", "reject_reasons").alias("reason"))
    return frequency(reasons.unionByName(spark.read.parquet(good).select(F.lit("good").alias("reason"))), "reason")


@query(
    "t16_retry_split",
    """SELECT CASE WHEN k = 2 THEN 'bad' WHEN k < 2 AND event_id % 5 < 3 THEN 'retry' ELSE 'dead' END AS part,
         CASE WHEN k = 2 THEN NULL WHEN k < 2 AND event_id % 5 >= 3 THEN 'MAX_RETRIES_EXCEEDED' WHEN k = 3 THEN 'POISON' WHEN k = 4 THEN 'PERMANENT' END AS failure_type,
         count(*) AS n FROM (SELECT *, event_id % 7 % 5 AS k FROM events) GROUP BY 1, 2""",
)
def _(spark, sf):
    kinds = F.array(*[F.lit(k) for k in ("transient", "rate_limit", "business_validation", "poison", "permanent")])
    failed = Tables(spark, sf).events.select(
        "event_id", F.element_at(kinds, (F.col("event_id") % 7 % 5 + 1).cast("int")).alias("failure_class"),
        (F.col("event_id") % 5).alias("retry_count"),
    )
    retry, dead, bad = keyed.retry_split(failed)
    nothing = F.lit(None).cast("string").alias("failure_type")
    rows = dead.select(F.lit("dead").alias("part"), "failure_type")
    rows = rows.unionByName(retry.select(F.lit("retry").alias("part"), nothing))
    return frequency(rows.unionByName(bad.select(F.lit("bad").alias("part"), nothing)), "part", "failure_type")


@query(
    "t17_redrive",
    "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000) GROUP BY 1",
)
def _(spark, sf):
    t = Tables(spark, sf)
    ledger = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
        (F.col("o_totalprice") > 300000).alias("approved"),
    )
    return frequency(keyed.redrive(ledger, t.lineitem, "l_orderkey", approved="approved"), "l_orderkey")


@query(
    "t18_route",
    """WITH s AS (SELECT n_name, list_value('click', 'error', 'purchase', 'signup', 'view')[1 + n_nationkey % 5] AS symbol, n_nationkey * 4 AS above FROM nation)
       SELECT n_name, count(*) AS n FROM events JOIN s ON event_type = symbol AND (n_name LIKE '%3' OR value > above) GROUP BY n_name""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    above = F.when(~F.col("n_name").endswith("3"), F.col("n_nationkey") * 4)
    subs = t.nation.select(
        "n_name", F.element_at(kinds, F.col("n_nationkey") % 5 + 1).alias("symbol"), above.alias("above"),
        F.lit(None).cast("double").alias("below"),
    )
    quotes = _stream(spark, sf).select("event_id", F.col("event_type").alias("symbol"), F.col("value").alias("price"))
    return frequency(flows.drain(keyed.route(quotes, subs).select("event_id", "n_name")), "n_name")


@query(
    "t19_envelope",
    """SELECT 'event' AS kind, CAST(user_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS payload FROM events
       UNION ALL SELECT 'order', CAST(o_custkey AS VARCHAR), '{"o_orderkey":' || o_orderkey || '}' FROM orders""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    sources = {
        "event": (t.events, "user_id", "ts", ["event_id", "event_type"]),
        "order": (t.orders, "o_custkey", "o_orderdate", ["o_orderkey"]),
    }
    return keyed.envelope(sources).drop("at")


@query(
    "t20_stream_static",
    "SELECT event_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey",
)
def _(spark, sf):
    customers = Tables(spark, sf).customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    joined = flows.enrich_static(_stream(spark, sf).select("event_id", "user_id"), customers, ["user_id"])
    return flows.drain(joined.drop("user_id"))


@query(
    "t20_stream_stream",
    """SELECT a.event_id AS click_id, b.event_id AS purchase_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click'
       AND b.event_type = 'purchase' AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 6 HOUR""",
)
def _(spark, sf):
    side = F.when(F.col("event_type") == "click", "left").when(F.col("event_type") == "purchase", "right")
    events = Tables(spark, sf).events.select("event_id", "user_id", "ts", side.alias("side")).where("side IS NOT NULL")
    fields = {"click_id": ("left", "event_id"), "purchase_id": ("right", "event_id")}
    join = eventtime.StreamJoin(scratch_path(spark, "stream-join"), events.schema, "user_id", "ts", "6 HOURS", "2 DAYS", fields)
    # Deliveries out of time order: a tenth of each is later than the allowed two days.
    days = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 864_000)
    part = F.when(F.col("event_id") % 10 == 0, F.pmod(F.xxhash64("event_id"), F.lit(3))).otherwise(F.pmod(days, F.lit(3)))
    _delivered(spark, events, part, join.cycle)
    return join.read(spark)
