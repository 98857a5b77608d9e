"""File scans, publishing, validation, audit, delivery checks and record workflows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalog import Tables, query
from tidemark.catalog.shapes import PNL, POSITIONS, pnl, positions
from tidemark.operators import quality, workflow
from tidemark.operators.aggregates import frequency, money
from tidemark.plans.scratch import materialize, scratch_path
from tidemark.sources import files, generate, intake, log, publish

# ---------------------------------------------------------------- sources and sinks

_ITEM_SUMS = """SELECT 'positions' AS file_type, '2024-01-15' AS file_date, l_returnflag, count(*) AS n,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, {bad} AS bad FROM lineitem GROUP BY l_returnflag"""


def _item_sums(df):
    return df.groupBy("file_type", F.col("file_date").cast("string").alias("file_date"), "l_returnflag").agg(
        F.count("*").alias("n"),
        F.sum("l_extendedprice").cast("double").alias("total"),
        F.count_if(F.size(files.BAD_TYPES) > 0).alias("bad"),
    )


@query("s01_delimited", _ITEM_SUMS.format(bad="count(*) FILTER (l_linenumber = 7)"))
def _(spark, sf):
    path = scratch_path(spark, "csv") + "/lending_positions_20240115.csv"
    quantity = F.when(F.col("l_linenumber") == 7, F.lit("many")).otherwise(F.col("l_quantity").cast("string"))
    items = Tables(spark, sf).lineitem.select("l_orderkey", quantity.alias("l_quantity"), "l_extendedprice", "l_returnflag")
    items.write.option("header", True).option("sep", "|").csv(path)
    schema = T.StructType.fromDDL("l_orderkey long, l_quantity double, l_extendedprice decimal(18,2), l_returnflag string")
    return _item_sums(files.read_delimited(spark, path, schema, "|"))


@query("s02_fixed_width", _ITEM_SUMS.format(bad="CAST(0 AS BIGINT)"))
def _(spark, sf):
    path = scratch_path(spark, "fixed") + "/lending_positions_20240115.txt"
    layout = [("l_orderkey", 1, 12, "long"), ("l_extendedprice", 13, 16, "decimal(18,2)"), ("l_returnflag", 29, 1, "string")]
    fields = [F.lpad(F.col(n).cast("string"), size, " ") for n, _, size, _ in layout]
    Tables(spark, sf).lineitem.withColumn("l_extendedprice", money("l_extendedprice")).select(
        F.concat(*fields).alias("value")
    ).write.text(path)
    return _item_sums(files.read_fixed_width(spark, path, layout))


@query(
    "s03_curated_scan",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def _(spark, sf):
    root = scratch_path(spark, "curated")
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    publish.replace_slice(orders, root, ["o_orderpriority"])
    return files.read_curated(spark, root, o_orderpriority="1-URGENT").select("o_orderkey", "o_totalprice")


@query(
    "s04_publish_slice",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       WHERE CASE o_orderstatus WHEN 'P' THEN false WHEN 'F' THEN o_totalprice < 200000 ELSE true END""",
)
def _(spark, sf):
    root = scratch_path(spark, "published")
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    publish.publish_slice(orders, root, ["o_orderstatus"], "job-1", published_at="2024-01-15 06:00:00")
    # A corrected delivery: F lost rows, P came back empty, O was not delivered again.
    again = orders.filter("o_orderstatus = 'F' AND o_totalprice < 200000")
    redone = orders.filter("o_orderstatus IN ('F', 'P')")
    # The first job is run again, too: it has been published and changes nothing.
    for job, df, at in (("job-2", again, "09:00:00"), ("job-2", again, "09:30:00"), ("job-1", orders, "10:00:00")):
        publish.publish_slice(df, root, ["o_orderstatus"], job, redone, published_at=f"2024-01-15 {at}")
    return publish.read_published(spark, root, ["o_orderstatus"])


@query(
    "s05_quarantine",
    f"""SELECT CAST(file_date AS VARCHAR) AS file_date, count(*) AS n FROM ({POSITIONS})
        WHERE settle_date < trade_date GROUP BY 1""",
)
def _(spark, sf):
    root = scratch_path(spark, "quarantine")
    checked = quality.validate(positions(spark, sf), [quality.not_before("settle_date", "trade_date")])
    _, rejected = quality.split(checked)
    publish.write_quarantine(rejected.withColumn("file_type", F.lit("positions")), root)
    found = spark.read.parquet(root)
    return frequency(found.select(F.col("file_date").cast("string").alias("file_date")), "file_date")


@query(
    "s06_file_meta",
    """SELECT o_orderpriority[1:1] AS part, 'pnl' AS file_type, '2024-02-0' || o_orderpriority[1:1] AS file_date, count(*) AS n,
         true AS has_size, true AS is_parquet FROM orders GROUP BY 1, 3""",
)
def _(spark, sf):
    root = scratch_path(spark, "meta")
    orders = Tables(spark, sf).orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("part"))
    named = orders.withColumn("file", F.concat(F.lit("lending_pnl_2024020"), "part", F.lit(".parquet")))
    publish.replace_slice(named, root, ["file"])
    meta = files.with_file_meta(spark.read.parquet(root))
    return meta.groupBy("part", "file_type", F.col("file_date").cast("string").alias("file_date")).agg(
        F.count("*").alias("n"), F.bool_and(F.col("file_size") > 0).alias("has_size"),
        F.bool_and(F.col("file_name").endswith(".parquet")).alias("is_parquet"),
    )


@query(
    "s07_unprocessed",
    """WITH f AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events),
       done AS (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events WHERE value > 150)
       SELECT 'app|' || event_type || '|' || d || '|f' AS file_key FROM f
       WHERE NOT EXISTS (SELECT 1 FROM done WHERE done.event_type = f.event_type AND done.d = f.d)""",
)
def _(spark, sf):
    events = Tables(spark, sf).events
    named = events.select(
        F.lit("app").alias("source"), F.col("event_type").alias("file_type"),
        F.to_date("ts").cast("string").alias("file_date"), F.lit("f").alias("file_name"), "value",
    ).withColumn("file_key", intake.idempotency_key())
    status = F.when(F.col("value") > 180, "PARTIAL").otherwise("SUCCESS")
    ledger = named.filter("value > 150").select("file_key", status.alias("status"))
    return intake.unprocessed(named.select("file_key").distinct(), ledger)


@query("s08_generated", "SELECT n, n * n AS value FROM (SELECT unnest(range(0, (SELECT count(*) FROM orders))) AS n)")
def _(spark, sf):
    rows = Tables(spark, sf).orders.count()
    return generate.generated(spark, rows, F.col("n") * F.col("n"))


@query(
    "s09_event_log",
    """SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY user_id""",
)
def _(spark, sf):
    root = scratch_path(spark, "log")
    events = Tables(spark, sf).events.select("event_id", "user_id", money("value").alias("value"))
    log.write_log(log.to_log(events, "user_id", "usage"), root)
    back = log.from_log(log.read_log(spark, root), "event_id long, user_id long, value decimal(18,2)", "usage")
    return back.filter("NOT _malformed").groupBy("user_id").agg(
        F.count("*").alias("n"), F.sum("value").cast("double").alias("total")
    )


@query(
    "s10_serving_copy",
    """SELECT CAST(date_trunc('year', o_orderdate) AS DATE)::VARCHAR AS file_date, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders WHERE year(o_orderdate) <> 1996 OR o_orderstatus = 'F' GROUP BY 1, 2""",
)
def _(spark, sf):
    root = scratch_path(spark, "serving")
    orders = Tables(spark, sf).orders.withColumn("file_date", F.trunc(F.to_date("o_orderdate"), "year").cast("string"))

    def report(rows):
        return rows.groupBy("file_date", "o_custkey").agg(F.sum(money("o_totalprice")).alias("total"))

    publish.publish_slice(report(orders), root, ["file_date"], "build-1", published_at="2024-01-15 06:00:00")
    redone = orders.filter("file_date = '1996-01-01' AND o_orderstatus = 'F'")
    named = orders.filter("file_date = '1996-01-01'")
    publish.publish_slice(report(redone), root, ["file_date"], "build-2", named, "2024-01-16 06:00:00")
    out = publish.read_published(spark, root, ["file_date"])
    return out.select(F.col("file_date").cast("string").alias("file_date"), "o_custkey", F.col("total").cast("double").alias("total"))


@query("s11_retention", "SELECT o_orderkey, strftime(o_orderdate, '%Y') || '-01-01' AS file_date FROM orders WHERE year(o_orderdate) >= 1995")
def _(spark, sf):
    root = scratch_path(spark, "landing")
    year = F.trunc(F.to_date("o_orderdate"), "year").cast("string")
    publish.replace_slice(Tables(spark, sf).orders.select("o_orderkey", year.alias("file_date")), root, ["file_date"])
    publish.expire_partitions(spark, root, 365, dt.date(1996, 1, 1), dry_run=False)
    return spark.read.parquet(root).withColumn("file_date", F.col("file_date").cast("string"))


# ---------------------------------------------------------------- validation


def _rules():
    return [
        quality.mandatory("borrower_id"),
        quality.at_least("quantity", 0, strict=True),
        quality.at_least("loan_value_usd", 5000),
        quality.not_before("settle_date", "trade_date"),
        quality.one_of("collateral_type", ["CASH", "NON_CASH", "MIXED"]),
    ]


_REASONS = f"""SELECT p.*, concat_ws(';',
    CASE WHEN borrower_id IS NULL THEN 'borrower_id:mandatory' END,
    CASE WHEN NOT quantity > 0 THEN 'quantity:min_0' END,
    CASE WHEN NOT loan_value_usd >= 5000 THEN 'loan_value_usd:min_5000' END,
    CASE WHEN settle_date < trade_date THEN 'settle_date:not_before_trade_date' END,
    CASE WHEN collateral_type NOT IN ('CASH', 'NON_CASH', 'MIXED') THEN 'collateral_type:enum' END,
    CASE WHEN count(*) OVER (PARTITION BY loan_id) > 1 THEN 'loan_id:unique' END) AS reasons
  FROM ({POSITIONS}) p"""


def _checked(spark, sf):
    return quality.validate(positions(spark, sf), _rules(), [["loan_id"]])


@query("q01_rules", f"SELECT reasons, count(*) AS n FROM ({_REASONS}) GROUP BY reasons")
def _(spark, sf):
    checked = _checked(spark, sf).select(F.concat_ws(";", quality.REASONS).alias("reasons"))
    return frequency(checked, "reasons")


@query(
    "q02_unique",
    f"SELECT loan_id, count(*) AS n FROM ({POSITIONS}) GROUP BY loan_id HAVING count(*) > 1",
)
def _(spark, sf):
    checked = quality.validate(positions(spark, sf), [], [["loan_id"]])
    return frequency(checked.filter(F.size(quality.REASONS) > 0), "loan_id")


@query(
    "q03_split",
    f"""SELECT 'valid' AS part, count(*) AS n FROM ({_REASONS}) WHERE reasons = ''
        UNION ALL SELECT 'rejected', count(*) FROM ({_REASONS}) WHERE reasons <> ''""",
)
def _(spark, sf):
    valid, rejected = quality.split(_checked(spark, sf), keep=True)
    counts = [p.agg(F.lit(n).alias("part"), F.count("*").alias("n")) for n, p in (("valid", valid), ("rejected", rejected))]
    return counts[0].unionByName(counts[1])


@query(
    "q03_reasons",
    f"SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ';')) AS reason FROM ({_REASONS}) WHERE reasons <> '') GROUP BY reason",
)
def _(spark, sf):
    return quality.reject_counts(_checked(spark, sf))


@query(
    "q04_audit",
    f"""SELECT CAST(file_date AS VARCHAR) AS file_date, count(*) AS read_count, count(*) FILTER (reasons <> '') AS reject_count,
         count(*) FILTER (reasons = '') AS record_count, CASE WHEN count(*) FILTER (reasons <> '') = 0 THEN 'SUCCESS'
         WHEN count(*) FILTER (reasons = '') = 0 THEN 'FAILED' ELSE 'PARTIAL' END AS status, 'job-7' AS job_id,
         count(*) || ':' || CAST(sum(CAST('0x' || md5(length(loan_id) || ':' || loan_id || coalesce(length(security_id) || ':' || security_id, '~')
           || coalesce(length(CAST(quantity AS DECIMAL(18,4))::VARCHAR) || ':' || CAST(quantity AS DECIMAL(18,4))::VARCHAR, '~'))[1:15] AS BIGINT)) AS VARCHAR) AS checksum
       FROM ({_REASONS}) GROUP BY 1""",
)
def _(spark, sf):
    checked = _checked(spark, sf).withColumn("file_date", F.col("file_date").cast("string"))
    checked = checked.withColumn("quantity", F.col("quantity").cast("decimal(18,4)"))
    audit = quality.audit(checked, ["file_date"], ["loan_id", "security_id", "quantity"], "job-7", "2024-01-15")
    return audit.drop("processed_at")


@query(
    "q04_deliveries",
    """WITH f AS (SELECT DISTINCT o_orderpriority AS kind FROM orders),
       x AS (SELECT o_orderpriority AS kind, o_orderkey, CASE WHEN o_orderpriority[1:1] = '1' THEN 'file:header' WHEN o_orderkey % 11 = 0 THEN 'row:columns' ELSE '' END AS reason
         FROM orders WHERE o_orderpriority[1:1] <> '5')
       SELECT kind, count(o_orderkey) AS read_count, count(*) FILTER (reason <> '') AS reject_count, count(*) FILTER (reason LIKE '%header%') AS wrong_header,
         CASE WHEN count(*) FILTER (reason <> '') = 0 THEN 'SUCCESS' WHEN count(*) FILTER (reason <> '') = count(*) THEN 'FAILED' ELSE 'PARTIAL' END AS status
       FROM f LEFT JOIN x USING (kind) GROUP BY kind""",
)
def _(spark, sf):
    """Files by priority: one with its columns exchanged, one without rows, others with ragged rows."""
    orders = Tables(spark, sf).orders.select(F.col("o_orderpriority").alias("kind"), "o_orderkey", "o_totalprice")
    root = scratch_path(spark, "deliveries")
    kinds = sorted(r[0] for r in orders.select("kind").distinct().collect())
    for i, kind in enumerate(kinds):
        # A delivery is one file with one header, so its lines are numbered and written together.
        own = orders.filter(F.col("kind") == kind)
        extra = F.when(F.col("o_orderkey") % 11 == 0, "|more").otherwise("")
        line = F.concat_ws("|", "kind", "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)"))
        lines = own.select(F.lit(1).alias("n"), F.concat(line, extra).alias("value"))
        if kind.startswith("1"):
            lines = own.select(F.lit(1).alias("n"), F.concat_ws("|", "kind", F.col("o_totalprice").cast("long"), "o_orderkey").alias("value"))
        if kind.startswith("5"):
            lines = lines.limit(0)
        names = "kind|price|order_id" if kind.startswith("1") else "kind|order_id|price"
        header = spark.createDataFrame([(0, names)], "n int, value string")
        header.unionByName(lines).coalesce(1).sortWithinPartitions("n").select("value").write.text(f"{root}/orders_{i}")
    schema = T.StructType.fromDDL("kind string, order_id long, price decimal(18,2)")
    paths = [f"{root}/orders_{i}" for i in range(len(kinds))]
    rows = files.read_delimited(spark, paths, schema, "|")
    rows = files.mark_headers(rows, files.wrong_headers(spark, paths, schema, "|"))
    checked = materialize(quality.validate(rows, [quality.well_headed(), quality.whole_row()]), "checked")
    folder = F.regexp_extract("file_path", r"orders_(\d+)", 1).cast("int")
    names = spark.createDataFrame(list(enumerate(kinds)), "_no int, _kind string")
    checked = checked.withColumn("_no", folder).join(names, "_no").withColumn("kind", F.col("_kind"))
    listed = files.list_files(spark, paths).withColumn("_no", folder).join(names, "_no").select(F.col("_kind").alias("kind"))
    wrong = checked.groupBy("kind").agg(F.count_if("_wrong_header").alias("wrong_header"))
    audit = quality.audit(checked, ["kind"], ["order_id"], "job-8", "2024-01-15", listed)
    audit = audit.join(wrong, "kind", "left").fillna(0, ["wrong_header"])
    return audit.select("kind", "read_count", "reject_count", "wrong_header", "status")


_STATES = ["PENDING", "SUCCESS", "PARTIAL", "FAILED"]
_STATE_SQL = "list_value('PENDING', 'SUCCESS', 'PARTIAL', 'FAILED')[1 + event_id % 4]"


def _ledger(spark, sf):
    events = Tables(spark, sf).events
    state = F.element_at(F.array(*[F.lit(s) for s in _STATES]), (F.col("event_id") % 4 + 1).cast("int"))
    return events.select(
        F.concat_ws("|", "event_type", F.to_date("ts")).alias("file_key"), state.alias("status"),
        F.col("ts").alias("processed_at"), "event_id",
    )


@query(
    "q05_intake",
    f"""WITH l AS (SELECT event_type || '|' || CAST(ts AS DATE) AS file_key, {_STATE_SQL} AS status, ts FROM events),
       f AS (SELECT DISTINCT file_key FROM l), s AS (SELECT file_key, arg_max(status, ts) AS last_status FROM l GROUP BY file_key)
       SELECT file_key, last_status, CASE WHEN last_status IN ('SUCCESS', 'PARTIAL') THEN 'skip' ELSE 'process' END AS action
       FROM f LEFT JOIN s USING (file_key)""",
)
def _(spark, sf):
    ledger = _ledger(spark, sf)
    return quality.intake(ledger.select("file_key").distinct(), ledger)


@query(
    "q06_transitions",
    f"""SELECT event_id, prev_status, status FROM (SELECT event_id, {_STATE_SQL} AS status,
         lag({_STATE_SQL}) OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS prev_status FROM events)
       WHERE prev_status IS NOT NULL AND prev_status || '>' || status NOT IN ('PENDING>SUCCESS', 'PENDING>PARTIAL',
         'PENDING>FAILED', 'FAILED>PENDING', 'PARTIAL>PENDING')""",
)
def _(spark, sf):
    order = ["processed_at", "event_id"]
    bad = quality.check_transitions(_ledger(spark, sf), ["file_key"], order, "status", quality.FILE_MOVES)
    return bad.select("event_id", "prev_status", "status")


@query(
    "q07_duplicate_files",
    """SELECT doc_id, row_number() OVER (PARTITION BY source, lang, md5(text) ORDER BY doc_id) > 1 AS duplicate FROM documents""",
)
def _(spark, sf):
    docs = Tables(spark, sf).documents.select(
        "source", F.col("lang").alias("feed"), F.md5("text").alias("checksum"), "doc_id"
    )
    return quality.dedupe_files(docs, order=["doc_id"]).select("doc_id", "duplicate")


@query(
    "q08_reconcile",
    """SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN l.k IS NULL THEN 'only_a' WHEN o_orderkey IS NULL THEN 'only_b'
         WHEN abs(a - coalesce(b, 0)) > 250000 THEN 'differs' END AS verdict FROM
         (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS a FROM orders WHERE o_orderstatus <> 'P') o FULL JOIN
         (SELECT l_orderkey AS k, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS b FROM lineitem GROUP BY 1) l ON o_orderkey = k)
       WHERE verdict IS NOT NULL GROUP BY verdict""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    a = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), money("o_totalprice").alias("usd"))
    b = t.lineitem.select(F.col("l_orderkey").alias("k"), money("l_extendedprice").alias("usd"))
    return frequency(quality.reconcile(a, b, ["k"], ["usd"], 250000), "verdict")


@query(
    "q08_pnl_breaks",
    f"""SELECT book_id, count(*) AS n, CAST(sum(pnl_usd) AS DOUBLE) AS pnl FROM ({PNL}) WHERE abs(pnl_usd - (mtm_value_current_usd
        - coalesce(mtm_value_prev_usd, 0) + coalesce(rebate_income_usd, 0) + coalesce(fee_income_usd, 0))) > 0.01 GROUP BY book_id""",
)
def _(spark, sf):
    breaks = quality.pnl_breaks(pnl(spark, sf))
    return breaks.groupBy("book_id").agg(F.count("*").alias("n"), F.sum("pnl_usd").cast("double").alias("pnl"))


@query(
    "q08_pnl_without_position",
    f"""SELECT loan_id, count(*) AS n FROM ({PNL}) p WHERE NOT EXISTS
        (SELECT 1 FROM ({POSITIONS}) q WHERE q.loan_id = p.loan_id AND q.file_date = p.file_date) GROUP BY loan_id""",
)
def _(spark, sf):
    known = positions(spark, sf).select("loan_id", "file_date")
    return frequency(pnl(spark, sf).join(known, ["loan_id", "file_date"], "left_anti"), "loan_id")


@query(
    "q09_freshness",
    """SELECT event_id, (event_id % 40) * 60 AS latency_minutes, (event_id % 40) > 12 AS over_alarm,
         ts + to_hours(CAST(event_id % 40 AS INT)) > CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) + INTERVAL 6 HOUR AS missed_deadline FROM events""",
)
def _(spark, sf):
    late = F.make_dt_interval(hours=(F.col("event_id") % 40).cast("int"))
    ledger = Tables(spark, sf).events.select(
        "event_id", F.col("ts").alias("event_at"), (F.col("ts") + late).alias("processed_at")
    )
    return quality.freshness(ledger).drop("event_at", "processed_at")


@query(
    "q10_completeness",
    """WITH r AS (SELECT CAST(ts AS DATE) AS d, event_type AS t, count(*) AS n FROM events WHERE value > 100 GROUP BY 1, 2)
       SELECT CAST(c.d AS VARCHAR) AS file_date, y.t AS file_type, coalesce(n, 0) AS received, coalesce(n, 0) >= 2 AS complete
       FROM (SELECT CAST(unnest(range((SELECT min(CAST(ts AS DATE)) FROM events), (SELECT max(CAST(ts AS DATE)) + INTERVAL 1 DAY FROM events), INTERVAL 1 DAY)) AS DATE) AS d) c,
         (SELECT DISTINCT event_type AS t FROM events) y LEFT JOIN r ON r.d = c.d AND r.t = y.t""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("value", F.to_date("ts").alias("file_date"), F.col("event_type").alias("file_type"))
    seen = events.agg(F.min("file_date"), F.max("file_date"), F.collect_set("file_type")).first()
    first, last = (F.lit(d).cast("date") for d in seen[:2])
    days = quality.completeness(events.filter("value > 100"), sorted(seen[2]), first, last, 2)
    return days.withColumn("file_date", F.col("file_date").cast("string"))


@query(
    "q11_reject_spike",
    """WITH d AS (SELECT event_type AS file_type, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, count(*) AS read_count,
         count(*) FILTER (value > 60) AS reject_count FROM events GROUP BY 1, 2),
       r AS (SELECT *, reject_count / read_count AS rate FROM d)
       SELECT file_type, day, round(trailing_rate, 6) AS trailing_rate, coalesce(rate > trailing_rate * 1.5, false) AS spike FROM
         (SELECT *, avg(rate) OVER (PARTITION BY file_type ORDER BY day RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS trailing_rate FROM r)""",
)
def _(spark, sf):
    audits = Tables(spark, sf).events.groupBy(
        F.col("event_type").alias("file_type"), F.unix_date(F.to_date("ts")).cast("long").alias("day")
    ).agg(F.count("*").alias("read_count"), F.count_if(F.col("value") > 60).alias("reject_count"))
    spikes = quality.reject_spike(audits, 7, 1.5)
    return spikes.select("file_type", "day", F.round("trailing_rate", 6).alias("trailing_rate"), "spike")


# ---------------------------------------------------------------- record workflow


@query(
    "q12_stages",
    """WITH l AS (SELECT l_orderkey, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_shipdate < TIMESTAMP '1992-06-01' AS early FROM lineitem),
       s AS (SELECT CASE WHEN early THEN 'VALIDATE' WHEN NOT amount > 20000 THEN 'FILTER' WHEN p_partkey IS NULL THEN 'ENRICH'
         ELSE 'FINALIZE' END AS stage, amount FROM l LEFT JOIN (SELECT * FROM part WHERE p_size <= 45) ON l_partkey = p_partkey)
       SELECT stage, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM s GROUP BY stage""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    records = t.lineitem.select(
        "l_orderkey", F.col("l_partkey").alias("p_partkey"), money("l_extendedprice").alias("amount"), "l_shipdate"
    )
    started = F.lit("1992-06-01").cast("timestamp_ntz")
    stages = [
        {"kind": "validate", "rules": [quality.Rule("l_shipdate", "min", F.col("l_shipdate") >= started)]},
        {"kind": "filter", "condition": F.col("amount") > 20000},
        {"kind": "enrich", "key": "p_partkey", "ref": "part"},
        {"kind": "transform", "columns": {"label": F.upper("p_brand")}},
        {"kind": "finalize", "columns": ["l_orderkey", "amount", "label"]},
    ]
    refs = {"part": t.part.filter("p_size <= 45").select("p_partkey", "p_brand")}
    done, left = workflow.run_stages(records, stages, refs)
    both = done.select(F.lit("FINALIZE").alias("stage"), "amount").unionByName(left.select("stage", "amount"))
    return both.groupBy("stage").agg(F.count("*").alias("n"), F.sum("amount").cast("double").alias("total"))


@query(
    "q13_branch",
    """SELECT route, detail, count(*) AS n FROM (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'secured'
         WHEN c_mktsegment = 'MACHINERY' THEN 'unsecured' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'commercial' ELSE 'none' END AS route,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'N' || c_nationkey WHEN 'MACHINERY' THEN CASE WHEN c_acctbal < 0 THEN 'high' ELSE 'low' END
         WHEN 'HOUSEHOLD' THEN c_mktsegment END AS detail FROM customer) GROUP BY route, detail""",
)
def _(spark, sf):
    segment = F.col("c_mktsegment")
    routes = {
        "secured": (segment == "BUILDING", lambda d: d.withColumn("detail", F.concat(F.lit("N"), "c_nationkey"))),
        "unsecured": (
            segment == "MACHINERY",
            lambda d: d.withColumn("detail", F.when(F.col("c_acctbal") < 0, "high").otherwise("low")),
        ),
        "commercial": (segment == "HOUSEHOLD", lambda d: d.withColumn("detail", segment)),
    }
    merged, rest = workflow.branch(Tables(spark, sf).customer, routes)
    rest = rest.select(F.lit("none").alias("route"), F.lit(None).cast("string").alias("detail"))
    return frequency(merged.select("route", "detail").unionByName(rest), "route", "detail")


@query(
    "q14_pending_stages",
    """SELECT 'FEED:' || l_orderkey || ':ROW_' || l_linenumber || ':ENRICH' AS idempotency_key, count(*) AS n FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    work = t.lineitem.select(
        F.lit("FEED").alias("feed_id"), F.col("l_orderkey").alias("file_id"),
        F.col("l_linenumber").alias("row_number"), F.lit("ENRICH").alias("stage_name"),
    )
    finished = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("file_id"))
    ledger = work.join(finished, "file_id", "left_semi").select(
        workflow.stage_key().alias("idempotency_key"), F.lit("COMPLETED").alias("status")
    )
    return frequency(workflow.pending_stages(work, ledger), "idempotency_key")


@query(
    "q15_plan_partitions",
    """SELECT (rn - 1) // 500 + 1 AS partition_id, min(rn) AS record_start, max(rn) AS record_end, count(*) AS records
       FROM (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) GROUP BY 1""",
)
def _(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderdate", "o_orderkey")
    return workflow.plan_partitions(orders, ["o_orderdate", "o_orderkey"], 500)


@query(
    "q15_hash_partitions",
    """SELECT CAST('0x' || md5(length(CAST(o_custkey AS VARCHAR)) || ':' || o_custkey)[1:15] AS BIGINT) % 12 AS partition_id, count(*) AS records
       FROM orders GROUP BY 1""",
)
def _(spark, sf):
    return workflow.hash_partitions(Tables(spark, sf).orders, ["o_custkey"], 12)


def _stage_rows(spark, sf):
    status = F.when(F.col("l_quantity") < 3, "FAILED").when(F.col("l_quantity") > 48, "IN_PROGRESS").otherwise("COMPLETED")
    t = Tables(spark, sf)
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat(F.lit("J"), F.col("o_custkey")).alias("job_id"), F.col("o_orderpriority").alias("partition_id"),
        F.col("l_orderkey").alias("record_id"), F.concat(F.lit("S"), F.col("l_linenumber")).alias("stage_name"),
        status.alias("status"), (F.col("l_quantity") % 4).cast("int").alias("retry_count"),
    )


_STAGE_ROWS = """SELECT 'J' || o_custkey AS job_id, o_orderpriority AS partition_id, l_orderkey AS record_id,
  'S' || l_linenumber AS stage_name, CASE WHEN l_quantity < 3 THEN 'FAILED' WHEN l_quantity > 48 THEN 'IN_PROGRESS' ELSE 'COMPLETED' END AS status,
  CAST(l_quantity AS INT) % 4 AS retry_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_RECORD_ROWS = f"""SELECT job_id, partition_id, record_id, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED'
  WHEN bool_and(status = 'COMPLETED') THEN 'COMPLETED' ELSE 'IN_PROGRESS' END AS status FROM ({_STAGE_ROWS}) GROUP BY ALL"""


@query(
    "q16_job_status",
    f"""SELECT job_id, total_records, failed_records, completed_records, CASE WHEN completed_records = total_records THEN 'COMPLETED'
         WHEN failed_records = total_records THEN 'FAILED' WHEN failed_records + completed_records < total_records THEN 'IN_PROGRESS'
         ELSE 'PARTIALLY_FAILED' END AS status FROM (SELECT job_id, count(*) AS total_records, count(*) FILTER (status = 'FAILED') AS failed_records,
         count(*) FILTER (status = 'COMPLETED') AS completed_records FROM ({_RECORD_ROWS}) GROUP BY job_id)""",
)
def _(spark, sf):
    return workflow.rollup_status(_stage_rows(spark, sf))[2]


@query(
    "q17_retry_trend",
    f"SELECT stage_name, CAST(sum(retry_count) AS BIGINT) AS retries, max(retry_count) AS most_retries FROM ({_STAGE_ROWS}) GROUP BY stage_name",
)
def _(spark, sf):
    return workflow.ops_views(stages=_stage_rows(spark, sf))["retry_trend"]


@query(
    "q17_jobs_by_status",
    f"""SELECT CASE WHEN done = total THEN 'COMPLETED' WHEN failed = total THEN 'FAILED' WHEN failed + done < total THEN 'IN_PROGRESS'
         ELSE 'PARTIALLY_FAILED' END AS status, count(*) AS n FROM (SELECT job_id, count(*) AS total, count(*) FILTER (status = 'FAILED') AS failed,
         count(*) FILTER (status = 'COMPLETED') AS done FROM ({_RECORD_ROWS}) GROUP BY job_id) GROUP BY 1""",
)
def _(spark, sf):
    jobs = workflow.rollup_status(_stage_rows(spark, sf))[2]
    return workflow.ops_views(jobs=jobs)["jobs_by_status"]


@query(
    "q17_feed_sla",
    """SELECT o_orderpriority AS feed_id, count(*) AS jobs, round(avg(s), 6) AS mean_seconds, max(s) AS worst_seconds FROM (SELECT o_orderpriority,
         date_diff('second', CAST(o_orderdate AS TIMESTAMP), CAST(l_shipdate AS TIMESTAMP)) AS s FROM orders JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY 1""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    at = {"created_at": F.col("o_orderdate").cast("timestamp_ntz"), "updated_at": F.col("l_shipdate").cast("timestamp_ntz")}
    jobs = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("feed_id"), F.lit("COMPLETED").alias("status"), *[c.alias(n) for n, c in at.items()]
    )
    return workflow.ops_views(jobs=jobs)["feed_sla"].withColumn("mean_seconds", F.round("mean_seconds", 6))


@query(
    "q17_stuck_partitions",
    """WITH n AS (SELECT max(ts) AS now FROM events) SELECT event_id, date_diff('minute', ts, now) AS idle_minutes FROM events, n
       WHERE event_type = 'view' AND date_diff('minute', ts, now) > 1440""",
)
def _(spark, sf):
    events = Tables(spark, sf).events
    now = events.agg(F.max(F.date_trunc("minute", F.col("ts")))).first()[0]
    state = F.when(F.col("event_type") == "view", "IN_PROGRESS").otherwise("COMPLETED")
    partitions = events.select("event_id", state.alias("status"), F.date_trunc("minute", F.col("ts")).alias("updated_at"))
    stuck = workflow.ops_views(partitions=partitions, now=F.lit(now), stuck_minutes=1440)["stuck_partitions"]
    return stuck.select("event_id", "idle_minutes")


@query(
    "q17_stage_latency",
    """SELECT 'S' || l_linenumber AS stage_name, round(avg(s), 6) AS mean_seconds, max(s) AS worst_seconds FROM (SELECT l_linenumber,
         date_diff('second', CAST(o_orderdate AS TIMESTAMP), CAST(l_shipdate AS TIMESTAMP)) AS s FROM orders JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY 1""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    stages = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("S"), "l_linenumber").alias("stage_name"), F.lit(0).alias("retry_count"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("started_at"), F.col("l_shipdate").cast("timestamp_ntz").alias("completed_at"),
    )
    return workflow.ops_views(stages=stages)["stage_latency"].withColumn("mean_seconds", F.round("mean_seconds", 6))


@query("q17_dead_by_type", "SELECT event_type AS failure_type, count(*) AS n FROM events WHERE value > 150 GROUP BY 1")
def _(spark, sf):
    dead = Tables(spark, sf).events.filter("value > 150").select(F.col("event_type").alias("failure_type"))
    return workflow.ops_views(dead=dead)["dead_by_type"]


@query(
    "q18_evolve",
    "SELECT r_regionkey, r_name, CAST(NULL AS VARCHAR) AS r_comment FROM region",
)
def _(spark, sf):
    schema = T.StructType.fromDDL("r_regionkey int, r_name string, r_comment string")
    return workflow.evolve(Tables(spark, sf).region.withColumn("extra", F.lit(1)), schema)


@query(
    "q19_split_name",
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS first_name, CASE WHEN strpos(p_name, ' ') > 0
         THEN trim(substr(p_name, strpos(p_name, ' ') + 1)) ELSE '' END AS last_name FROM part""",
)
def _(spark, sf):
    people = Tables(spark, sf).part.select("p_partkey", F.col("p_name").alias("first_name"), F.lit("").alias("last_name"))
    return workflow.split_name(people, "first_name")[0]


@query(
    "q19_changes",
    """SELECT p_partkey, p_name AS old_value, split_part(p_name, ' ', 1) AS first_name FROM part WHERE strpos(p_name, ' ') > 0""",
)
def _(spark, sf):
    people = Tables(spark, sf).part.select("p_partkey", F.col("p_name").alias("first_name"), F.lit("").alias("last_name"))
    return workflow.split_name(people, "first_name")[1].select("p_partkey", "old_value", "first_name")


@query(
    "q21_lineage",
    """SELECT o_orderkey, 'job-9' AS lineage_job, 'orders' AS lineage_source,
         sha256(length(CAST(o_orderkey AS VARCHAR)) || ':' || o_orderkey || coalesce(length(CAST(nullif(o_custkey % 5, 0) AS VARCHAR)) || ':' || nullif(o_custkey % 5, 0), '~')) AS record_id
       FROM orders""",
)
def _(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", F.nullif(F.col("o_custkey") % 5, F.lit(0)).alias("group"))
    return workflow.with_lineage(orders, "job-9", "orders", ["o_orderkey", "group"]).drop("group")


_LIFE = ["New", "Validated", "Routed", "Live", "Partially filled", "Filled", "Cancelled", "Rejected", "Expired"]


@query(
    "q20_order_lifecycle",
    """WITH s AS (SELECT event_id, user_id, ts, list_value('New', 'Validated', 'Routed', 'Live', 'Partially filled', 'Filled',
         'Cancelled', 'Rejected', 'Expired')[1 + event_id % 9] AS status FROM events),
       p AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_status FROM s)
       SELECT prev_status, status, count(*) AS n FROM p WHERE prev_status IS NOT NULL AND prev_status || '>' || status NOT IN (
         'New>Validated', 'New>Rejected', 'Validated>Routed', 'Validated>Rejected', 'Validated>Cancelled', 'Routed>Live',
         'Routed>Rejected', 'Routed>Cancelled', 'Live>Partially filled', 'Live>Filled', 'Live>Cancelled', 'Live>Expired',
         'Partially filled>Partially filled', 'Partially filled>Filled', 'Partially filled>Cancelled', 'Partially filled>Expired')
       GROUP BY 1, 2""",
)
def _(spark, sf):
    state = F.element_at(F.array(*[F.lit(s) for s in _LIFE]), (F.col("event_id") % 9 + 1).cast("int"))
    history = Tables(spark, sf).events.select("event_id", "user_id", "ts", state.alias("status"))
    bad = quality.check_transitions(history, ["user_id"], ["ts", "event_id"], "status", quality.ORDER_MOVES)
    return frequency(bad, "prev_status", "status")


@query(
    "q21_limit_checks",
    """SELECT o_orderkey, amt > 300000 OR amt < -300000 AS size_breach, abs(sum(amt) OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)) > 800000 AS position_breach FROM
         (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END * CAST(o_totalprice AS DECIMAL(18,2)) AS amt FROM orders)""",
)
def _(spark, sf):
    side = F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1)
    orders = Tables(spark, sf).orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", (side * money("o_totalprice")).alias("amt")
    )
    checked = workflow.limit_checks(orders, 300000, 800000, ["o_custkey"], ["o_orderdate", "o_orderkey"], "amt")
    return checked.select("o_orderkey", "size_breach", "position_breach")


@query(
    "q22_normalize",
    """SELECT o_orderkey, CAST(o_totalprice AS INT) AS amount, upper(o_orderpriority) AS priority, 'USD' AS ccy FROM
         (SELECT o_orderkey, floor(o_totalprice) AS o_totalprice, o_orderpriority FROM orders)""",
)
def _(spark, sf):
    raw = Tables(spark, sf).orders.select(
        "o_orderkey", F.concat(F.lit(" "), F.floor("o_totalprice").cast("string")).alias("amt"),
        F.lower("o_orderpriority").alias("pri"), F.lit(None).cast("string").alias("ccy"),
    )
    config = {
        "amount": {"from": "amt", "type": "int"},
        "priority": {"from": "pri", "upper": True},
        "ccy": {"default": "USD"},
    }
    return workflow.normalize_records(raw, config).select("o_orderkey", "amount", "priority", "ccy")
