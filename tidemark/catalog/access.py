"""Usage metering, quotas, consent decisions, abuse signals and policy decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import Tables, query
from tidemark.catalog.shapes import CALLS, CONSENTS, calls, consents
from tidemark.operators import joins, usage
from tidemark.operators.policy import Field, Policy, When, evaluate_policies


def _as_requests(spark, sf):
    return calls(spark, sf).select(
        F.col("event_id").alias("request_id"), "partner_id", "customer_id", F.col("api").alias("scope"),
        F.col("ts").alias("requested_at"), (F.col("event_id") % 17 != 0).alias("token_valid"),
        (F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 13 - 1).cast("int"))).alias("token_expires_at"),
    )


_COVERED = "c.granted_at <= r.ts AND r.ts <= c.expires_at AND (c.revoked_at IS NULL OR r.ts <= c.revoked_at)"


@query(
    "j16_entitled",
    f"""SELECT r.event_id AS request_id FROM ({CALLS}) r JOIN ({CONSENTS}) c ON r.customer_id = c.customer_id AND r.partner_id = c.partner_id
        WHERE {_COVERED} AND list_contains(string_split(c.scopes, ','), r.api)""",
)
def _(spark, sf):
    return joins.entitled(_as_requests(spark, sf), consents(spark, sf)).select("request_id")


@query(
    "m01_usage",
    f"""SELECT partner_id, customer_id, api, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS period, count(*) AS calls FROM ({CALLS}) GROUP BY ALL""",
)
def _(spark, sf):
    used = usage.usage(calls(spark, sf), "hour", ["partner_id", "customer_id", "api"])
    return used.withColumn("period", F.date_format("period", "yyyy-MM-dd HH:mm:ss"))


@query(
    "m01_call_charges",
    f"""SELECT partner_id, api, count(*) AS calls, round(count(*) * CASE api WHEN 'balance' THEN 0.01 WHEN 'transactions' THEN 0.05 WHEN 'identity' THEN 0.25
         WHEN 'payment' THEN 1.5 END, 2)::DOUBLE AS amount, api = 'error' AS unpriced FROM ({CALLS}) GROUP BY partner_id, api""",
)
def _(spark, sf):
    used = usage.usage(calls(spark, sf), "month", ["partner_id", "api"])
    charged = usage.call_charges(used)
    return charged.select("partner_id", "api", "calls", F.col("amount").cast("double").alias("amount"), "unpriced")


@query(
    "m02_invoice",
    f"""WITH u AS (SELECT partner_id, count(*) AS calls, CASE WHEN partner_id < 5 THEN 'startup' ELSE 'growth' END AS plan,
           CASE partner_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1.5 ELSE 3 END AS factor FROM ({CALLS}) GROUP BY partner_id),
       o AS (SELECT *, CASE plan WHEN 'startup' THEN 500 ELSE 2000 END AS base_fee,
           greatest(calls - CASE plan WHEN 'startup' THEN 100 ELSE 400 END, 0) AS overage_calls FROM u),
       f AS (SELECT *, CASE plan WHEN 'startup' THEN 0.05 * least(overage_calls, 200) + 0.03 * greatest(overage_calls - 200, 0) ELSE 0.02 * overage_calls END AS fee FROM o)
       SELECT partner_id, calls, overage_calls, CAST(fee AS DOUBLE) AS overage_fee, CAST(round((base_fee + fee) * factor, 2) AS DOUBLE) AS total FROM f""",
)
def _(spark, sf):
    used = usage.usage(calls(spark, sf), "month", ["partner_id"])
    partner = F.col("partner_id")
    contracts = used.select("partner_id").distinct().select(
        "partner_id",
        F.when(partner < 5, "startup").otherwise("growth").alias("plan"),
        F.element_at(F.array(F.lit("standard"), F.lit("premium"), F.lit("mission_critical")), (partner % 3 + 1).cast("int")).alias("sla"),
    )
    plans = spark.createDataFrame([("startup", 500, 100), ("growth", 2000, 400)], "plan string, base_fee int, included_calls long")
    tiers = spark.createDataFrame(
        [("startup", 0, 200, "0.05"), ("startup", 200, None, "0.03"), ("growth", 0, None, "0.02")],
        "plan string, from_call long, to_call long, price string",
    ).withColumn("price", F.col("price").cast("decimal(9,4)"))
    out = usage.invoice(used, contracts, plans, tiers)
    return out.select("partner_id", "calls", "overage_calls", *[F.col(c).cast("double").alias(c) for c in ("overage_fee", "total")])


@query(
    "m03_quota",
    f"""WITH r AS (SELECT partner_id, ts, count(*) OVER (PARTITION BY partner_id ORDER BY ts) AS used, CASE WHEN partner_id % 4 <> 3 THEN 950 + partner_id * 10 END AS quota FROM ({CALLS})),
       q AS (SELECT partner_id, max(used) AS calls, max(quota) AS quota, min(ts) FILTER (used / quota >= 0.9) AS w, min(ts) FILTER (used / quota >= 1) AS e FROM r GROUP BY partner_id)
       SELECT partner_id, calls, quota, strftime(w, '%Y-%m-%d %H:%M:%S') AS warned_at, strftime(e, '%Y-%m-%d %H:%M:%S') AS exceeded_at,
         CASE WHEN e IS NOT NULL THEN 'exceeded' WHEN w IS NOT NULL THEN 'warning' WHEN quota IS NULL THEN 'no_quota' ELSE 'ok' END AS state FROM q""",
)
def _(spark, sf):
    made = calls(spark, sf)
    # Some partners have no quota.
    quotas = made.filter("partner_id % 4 <> 3").select("partner_id").distinct().withColumn("quota", 950 + F.col("partner_id") * 10)
    out = usage.quota_state(made, quotas).drop("month")
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("warned_at", "exceeded_at")})


_SLIDING = """SELECT DISTINCT '{name}' AS limit_name, CAST(a.{key} AS VARCHAR) AS key, a.t, count(*) OVER (PARTITION BY a.{key}
  ORDER BY a.t RANGE BETWEEN {back} PRECEDING AND CURRENT ROW) AS calls FROM s a {where}"""


@query(
    "m04_rate_violations",
    f"""WITH s AS (SELECT *, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS t FROM ({CALLS}))
       SELECT * FROM ({_SLIDING.format(name='partner', key='partner_id', back=3599, where='')}) WHERE calls > 4
       UNION ALL SELECT * FROM ({_SLIDING.format(name='customer', key='customer_id', back=7199, where='')}) WHERE calls > 2
       UNION ALL SELECT * FROM ({_SLIDING.format(name='payment', key='customer_id', back=86399, where="WHERE api = 'payment'")}) WHERE calls > 1""",
)
def _(spark, sf):
    limits = [
        ("partner", ("partner_id",), 3600, 4, None),
        ("customer", ("customer_id",), 7200, 2, None),
        ("payment", ("customer_id",), 86400, 1, "payment"),
    ]
    return usage.rate_violations(calls(spark, sf), limits)


@query(
    "m05_decide",
    f"""WITH r AS (SELECT *, event_id % 17 <> 0 AS valid, event_id % 13 - 1 >= 0 AS fresh FROM ({CALLS})),
       h AS (SELECT r.event_id, bool_or(list_contains(string_split(c.scopes, ','), r.api)) AS scoped FROM r JOIN ({CONSENTS}) c
         ON r.customer_id = c.customer_id AND r.partner_id = c.partner_id WHERE {_COVERED} GROUP BY r.event_id)
       SELECT r.event_id AS request_id, CASE WHEN NOT valid THEN '401 invalid_token' WHEN NOT fresh THEN '401 token_expired'
         WHEN scoped IS NULL THEN '403 consent_revoked' WHEN NOT scoped THEN '403 insufficient_scope' ELSE 'ALLOW' END AS decision
       FROM r LEFT JOIN h ON r.event_id = h.event_id""",
)
def _(spark, sf):
    return usage.decide(_as_requests(spark, sf), consents(spark, sf)).select("request_id", "decision")


@query(
    "m05_rate_limited",
    f"""WITH r AS (SELECT * REPLACE (date_trunc('day', ts) AS ts), event_id % 17 <> 0 AS valid FROM ({CALLS})),
       h AS (SELECT r.event_id, bool_or(list_contains(string_split(c.scopes, ','), r.api)) AS scoped FROM r JOIN ({CONSENTS}) c
         ON r.customer_id = c.customer_id AND r.partner_id = c.partner_id WHERE {_COVERED} GROUP BY r.event_id)
       SELECT r.event_id AS request_id, CASE WHEN NOT valid THEN '401 invalid_token' WHEN scoped IS NULL THEN '403 consent_revoked'
         WHEN NOT scoped THEN '403 insufficient_scope' WHEN row_number() OVER (PARTITION BY partner_id, ts ORDER BY r.event_id) > 20 THEN '429 rate_limited'
         ELSE 'ALLOW' END AS decision FROM r LEFT JOIN h ON r.event_id = h.event_id""",
)
def _(spark, sf):
    """All requests of a day at one moment, more than the rate lets through."""
    at = F.date_trunc("day", F.col("requested_at")).cast("timestamp_ntz")
    requests = _as_requests(spark, sf).withColumn("requested_at", at).withColumn("token_expires_at", at)
    return usage.decide(requests, consents(spark, sf), per_second=20).select("request_id", "decision")


@query(
    "m06_post_revocation",
    f"""SELECT * FROM (SELECT a.event_id, CASE WHEN a.ts > c.revoked_at THEN 'violation' WHEN a.ts + INTERVAL 6 HOUR > c.revoked_at THEN 'in_flight' END AS state
        FROM ({CALLS}) a JOIN ({CONSENTS}) c ON c.consent_id = 'c' || a.customer_id WHERE c.revoked_at IS NOT NULL) WHERE state IS NOT NULL""",
)
def _(spark, sf):
    access = calls(spark, sf).select(
        "event_id", F.concat(F.lit("c"), "customer_id").alias("consent_id"), F.col("ts").alias("started_at"),
        (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("finished_at"),
    )
    return usage.post_revocation(access, consents(spark, sf)).select("event_id", "state")


@query(
    "m07_volume_spikes",
    f"""WITH d AS (SELECT partner_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, count(*) AS calls FROM ({CALLS}) GROUP BY 1, 2),
       u AS (SELECT *, avg(calls) OVER (PARTITION BY partner_id ORDER BY day RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS usual FROM d)
       SELECT partner_id, day, calls, round(usual, 6) AS usual FROM u WHERE calls >= usual * 1.3""",
)
def _(spark, sf):
    out = usage.volume_spikes(calls(spark, sf), 7, 1.3)
    return out.select("partner_id", F.col("day").cast("long").alias("day"), "calls", F.round("usual", 6).alias("usual"))


@query(
    "m07_error_rates",
    f"""SELECT partner_id, count(*) AS calls, count(*) FILTER (response_code >= 400) AS errors, count(*) FILTER (response_code >= 400) / count(*) AS error_rate
        FROM ({CALLS}) GROUP BY partner_id HAVING count(*) >= 10 AND count(*) FILTER (response_code >= 400) / count(*) > 0.2""",
)
def _(spark, sf):
    return usage.error_rates(calls(spark, sf), 0.2)


@query(
    "m07_sequential_scans",
    f"""WITH s AS (SELECT event_id % 5 AS partner_id, event_id, customer_id % 4 AS cid FROM ({CALLS})),
       b AS (SELECT *, CASE WHEN cid = lag(cid) OVER w + 1 THEN 0 ELSE 1 END AS brk FROM s WINDOW w AS (PARTITION BY partner_id ORDER BY event_id)),
       r AS (SELECT *, sum(brk) OVER (PARTITION BY partner_id ORDER BY event_id) AS run FROM b)
       SELECT partner_id, first_id, length FROM (SELECT partner_id, run, min(cid) AS first_id, count(*) AS length FROM r GROUP BY 1, 2) WHERE length >= 3""",
)
def _(spark, sf):
    scanned = calls(spark, sf).select(
        (F.col("event_id") % 5).alias("partner_id"), "event_id", (F.col("customer_id") % 4).alias("customer_id")
    )
    return usage.sequential_scans(scanned, 3, ["event_id"])


@query(
    "m07_new_places",
    f"""WITH p AS (SELECT partner_id, CAST(json_extract_string(props, '$.k') AS INT) AS place, min(ts) AS first_seen FROM ({CALLS}) GROUP BY 1, 2),
       b AS (SELECT partner_id, min(ts) AS began FROM ({CALLS}) GROUP BY 1)
       SELECT partner_id, place, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen FROM p JOIN b USING (partner_id)
       WHERE date_sub('second', began, first_seen) > 10 * 86400""",
)
def _(spark, sf):
    placed = calls(spark, sf).withColumn("place", F.get_json_object("props", "$.k").try_cast("int"))
    out = usage.new_places(placed, "place", 10)
    return out.withColumn("first_seen", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss"))


@query(
    "m07_off_hours",
    f"""SELECT partner_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS calls FROM ({CALLS}) WHERE hour(ts) < 9 OR hour(ts) > 17
        GROUP BY 1, 2 HAVING count(*) >= 24""",
)
def _(spark, sf):
    return usage.off_hours_bulk(calls(spark, sf), 24).withColumn("day", F.col("day").cast("string"))


@query(
    "m07_whole_base",
    f"""WITH d AS (SELECT partner_id, CAST(ts AS DATE) AS day, count(DISTINCT customer_id) AS customers FROM ({CALLS}) GROUP BY 1, 2),
       b AS (SELECT partner_id, count(DISTINCT customer_id) AS base FROM ({CALLS}) GROUP BY 1)
       SELECT partner_id, CAST(day AS VARCHAR) AS day, customers, base FROM d JOIN b USING (partner_id) WHERE customers >= base * 0.95""",
)
def _(spark, sf):
    return usage.whole_base_downloads(calls(spark, sf), 0.95).withColumn("day", F.col("day").cast("string"))


@query(
    "m08_access_review",
    f"""SELECT partner_id, element, count(*) AS accesses, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_access, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_access
        FROM (SELECT partner_id, ts, unnest(string_split(CASE WHEN api = 'transactions' THEN 'amount,merchant,date' ELSE api END, ',')) AS element FROM ({CALLS})) GROUP BY 1, 2""",
)
def _(spark, sf):
    elements = F.when(F.col("api") == "transactions", F.lit("amount,merchant,date")).otherwise(F.col("api"))
    access = calls(spark, sf).select(
        "partner_id", F.col("ts").alias("accessed_at"), F.split(elements, ",").alias("data_elements_accessed")
    )
    out = usage.access_review(access, ["partner_id"])
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_access", "last_access")})


_FORGET = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"


@query("m09_erase", f"SELECT o_orderkey FROM orders WHERE o_custkey NOT IN ({_FORGET})")
def _(spark, sf):
    t = Tables(spark, sf)
    subjects = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return usage.erase(t.orders, subjects, "o_custkey").select("o_orderkey")


@query("m09_export", f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN ({_FORGET})")
def _(spark, sf):
    t = Tables(spark, sf)
    subjects = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return usage.export(t.orders, subjects, "o_custkey").select("o_orderkey", "o_totalprice")


_POLICIES = [
    Policy(
        "transfer-in-hours", "permit", action="transfer", resource="account", roles=("customer", "teller"),
        conditions=(
            When("res.balance", "ge", 1000), When("who.status", "eq", "active"),
            When("context.amount", "le", Field("res.balance")), When("context.hour", "between", (9, 17)),
        ),
    ),
    Policy("no-withdrawal-after-hours", "forbid", action="withdraw", conditions=(When("context.hour", "outside", (9, 17)),)),
    Policy("teller-withdrawal", "permit", action="withdraw", roles=("teller",)),
    Policy("admin-delete", "permit", action="delete", resource="account", roles=("admin",)),
    Policy("broken-check", "forbid", action="delete", conditions=(When("context.note", "gt", 1),)),
]

_REQUEST = """SELECT event_id, list_value('transfer', 'withdraw', 'delete', 'read')[1 + event_id % 4] AS action,
  CASE user_id % 3 WHEN 0 THEN 'customer' WHEN 1 THEN 'teller' ELSE 'admin' END AS role, value * 20 AS balance, value * 10 + 100 AS amount,
  hour(ts) AS h, user_id % 5 <> 0 AS active FROM events"""


@query(
    "m10_policies",
    f"""SELECT event_id, CASE WHEN action = 'withdraw' AND (h < 9 OR h > 17) THEN 'DENY' WHEN action = 'withdraw' AND role = 'teller' THEN 'ALLOW'
         WHEN action = 'delete' AND role = 'admin' THEN 'ALLOW' WHEN action = 'transfer' AND role IN ('customer', 'teller') AND balance >= 1000 AND active
         AND amount <= balance AND h BETWEEN 9 AND 17 THEN 'ALLOW' ELSE 'DENY' END AS decision FROM ({_REQUEST})""",
)
def _(spark, sf):
    user, value = F.col("user_id"), F.col("value")
    action = F.element_at(F.array(*[F.lit(a) for a in ("transfer", "withdraw", "delete", "read")]), (F.col("event_id") % 4 + 1).cast("int"))
    role = F.when(user % 3 == 0, "customer").when(user % 3 == 1, "teller").otherwise("admin")
    requests = Tables(spark, sf).events.select(
        "event_id", action.alias("action"), F.lit("account").alias("resource"), F.array(role).alias("roles"),
        F.struct((value * 20).alias("balance")).alias("res"),
        F.struct(F.when(user % 5 != 0, "active").otherwise("closed").alias("status")).alias("who"),
        F.create_map(
            F.lit("amount"), (value * 10 + 100).cast("string"), F.lit("hour"), F.hour("ts").cast("string"),
            F.lit("note"), F.lit("urgent"),
        ).alias("context"),
    )
    return evaluate_policies(requests, _POLICIES).select("event_id", "decision")
