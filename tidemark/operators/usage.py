"""API usage metering, invoices, quotas, consent decisions and abuse signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import epoch_seconds
from tidemark.operators.windows import moving
from tidemark.plans.intervals import MANY_RANGES, interval_join
from tidemark.plans.ordering import HOT_ROWS, check_hot, join_keys, keyed_neighbor, keyed_row_number, keyed_running

# Price per call, plans, service-level surcharges and rate limits.
PRICES = {
    "balance": "0.01",
    "transactions": "0.05",
    "identity": "0.25",
    "payment": "1.50",
}
PLANS = {"startup": (500, 10_000), "growth": (2_000, 100_000)}
SURCHARGE = {"standard": "0.0", "premium": "0.5", "mission_critical": "2.0"}
PARTNER_PER_SECOND = 1000
CUSTOMER_PER_SECOND = 10
PAYMENTS_PER_MINUTE = 1
QUOTA_WARNING = 0.9
SPIKE_FACTOR = 10


def usage(calls: DataFrame, grain: str, by: Sequence[str], at: str = "ts") -> DataFrame:
    """Calls per key and hour, day or month."""
    period = F.date_trunc(grain, F.col(at)).cast("timestamp_ntz")
    return calls.groupBy(*by, period.alias("period")).agg(F.count("*").alias("calls"))


def _lookup(values: Mapping[str, str], key: Column, kind: str) -> Column:
    """Literal table as a chain of conditions; unknown keys give null."""
    out = F.lit(None).cast(kind)
    for name, value in values.items():
        out = F.when(key == name, F.lit(value).cast(kind)).otherwise(out)
    return out


def call_charges(used: DataFrame, prices: Mapping[str, str] = PRICES, api: str = "api") -> DataFrame:
    """Price per call type times calls; a call type without a price is marked, not dropped."""
    price = _lookup(prices, F.col(api), "decimal(9,4)")
    return used.withColumns(
        {
            "unit_price": price,
            "amount": (price * F.col("calls").cast("decimal(18,0)")).cast("decimal(28,2)"),
            "unpriced": price.isNull(),
        }
    )


def invoice(used: DataFrame, contracts: DataFrame, plans: DataFrame, tiers: DataFrame) -> DataFrame:
    """Plan invoice per partner and period.

    ``used``: partner_id, period, calls. ``contracts``: partner_id, plan, sla.
    ``plans``: plan, base_fee, included_calls. ``tiers``: plan, from_call, to_call
    (null = open), price — volume steps of the calls beyond the included ones, counted
    from 0. The service-level surcharge applies to the sum.
    """
    monthly = used.groupBy("partner_id", "period").agg(F.sum("calls").alias("calls"))
    planned = monthly.join(contracts, "partner_id", "left").join(plans, "plan", "left")
    over = F.greatest(F.col("calls") - F.col("included_calls"), F.lit(0))
    planned = planned.withColumn("overage_calls", over)
    steps = planned.select("partner_id", "period", "plan", "overage_calls").join(tiers, "plan")
    top = F.least(F.col("overage_calls"), F.coalesce("to_call", F.col("overage_calls")))
    in_step = F.greatest(top - F.col("from_call"), F.lit(0)).cast("decimal(18,0)")
    charged = steps.groupBy("partner_id", "period").agg(F.sum(in_step * F.col("price")).alias("overage_fee"))
    surcharge = F.lit(1) + F.coalesce(_lookup(SURCHARGE, F.col("sla"), "decimal(4,2)"), F.lit(0))
    return (
        planned.join(charged, ["partner_id", "period"], "left")
        .withColumn("overage_fee", F.coalesce("overage_fee", F.lit(0)).cast("decimal(28,2)"))
        .withColumn("total", ((F.col("base_fee") + F.col("overage_fee")) * surcharge).cast("decimal(28,2)"))
    )


def quota_state(calls: DataFrame, quotas: DataFrame, at: str = "ts", limit=None) -> DataFrame:
    """Per partner and month: calls, state and when the warning and the quota were reached.

    ``quotas``: partner_id, quota. The running count goes over one row per time, so
    that many calls of one moment are one step. A partner without a quota keeps its
    calls and has the state ``no_quota``.
    """
    month = F.date_trunc("month", F.col(at)).cast("timestamp_ntz")
    steps = calls.groupBy("partner_id", month.alias("month"), at).agg(F.count("*").alias("_n"))
    steps = keyed_running(steps, ["partner_id", "month"], [at], "_n", "_used", "sum", limit)
    steps = steps.join(quotas, "partner_id", "left")
    share = F.col("_used") / F.col("quota")
    return (
        steps.groupBy("partner_id", "month")
        .agg(
            F.max("_used").alias("calls"),
            F.max("quota").alias("quota"),
            F.min(F.when(share >= QUOTA_WARNING, F.col(at))).alias("warned_at"),
            F.min(F.when(share >= 1, F.col(at))).alias("exceeded_at"),
        )
        .withColumn(
            "state",
            F.when(F.col("quota").isNull(), "no_quota")
            .when(F.col("exceeded_at").isNotNull(), "exceeded")
            .when(F.col("warned_at").isNotNull(), "warning")
            .otherwise("ok"),
        )
    )


DEFAULT_LIMITS = (
    ("partner", ("partner_id",), 1, PARTNER_PER_SECOND, None),
    ("customer", ("customer_id",), 1, CUSTOMER_PER_SECOND, None),
    ("payment", ("customer_id",), 60, PAYMENTS_PER_MINUTE, "payment"),
)


def rate_violations(calls: DataFrame, limits: Sequence[tuple] = DEFAULT_LIMITS, at="ts", api="api") -> DataFrame:
    """Seconds at whose end a key had more calls in the sliding window than allowed.

    ``limits``: (name, key columns, window seconds, most calls, api or None).
    """
    found = None
    for name, by, seconds, most, only in limits:
        picked = calls if only is None else calls.filter(F.col(api) == only)
        per_second = picked.groupBy(*by, epoch_seconds(at).alias("t")).agg(F.count("*").alias("_n"))
        summed = moving(per_second, by, "t", "_n", seconds - 1, "sum", "calls", 86_400)
        rows = summed.filter(F.col("calls") > most).select(
            F.lit(name).alias("limit_name"), F.concat_ws("|", *by).alias("key"), "t", "calls"
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def decide(
    requests: DataFrame, consents: DataFrame, per_second: int = PARTNER_PER_SECOND, limit=None,
    tile_rows: int = HOT_ROWS, many: int = MANY_RANGES,
) -> DataFrame:
    """First failing check of each request, in the fixed order token, expiry, consent, scope, rate.

    ``requests``: request_id, partner_id, customer_id, scope, requested_at, token_valid,
    token_expires_at. Overlapping consents are folded per request before they meet it; keys with
    more than ``many`` consents meet their requests tile by tile.
    """
    at = F.col("requested_at")
    live = (
        (F.col("granted_at") <= at) & (at <= F.col("expires_at"))
        & (F.col("revoked_at").isNull() | (at <= F.col("revoked_at")))
    )
    asked = requests.select("request_id", "partner_id", "customer_id", "scope", "requested_at")
    given = consents.withColumnsRenamed({"partner_id": "_partner", "customer_id": "_customer"})
    same = (F.col("partner_id") == F.col("_partner")) & (F.col("customer_id") == F.col("_customer")) & live
    keys = [("partner_id", "_partner"), ("customer_id", "_customer")]
    held = (
        interval_join(asked, given, keys, at, F.col("granted_at"), F.col("expires_at"), same, "inner", tile_rows, many)
        .groupBy("request_id")
        .agg(F.bool_or(F.array_contains("granted_scopes", F.col("scope"))).alias("_scoped"))
    )
    second = F.date_trunc("second", at)
    placed = keyed_row_number(
        requests.withColumn("_second", second), ["partner_id", "_second"], ["requested_at", "request_id"],
        "_place", limit,
    )
    checks = (
        (F.coalesce(F.col("token_valid"), F.lit(False)), "401 invalid_token"),
        (F.coalesce(F.col("token_expires_at") >= at, F.lit(False)), "401 token_expired"),
        (F.col("_scoped").isNotNull(), "403 consent_revoked"),
        (F.coalesce(F.col("_scoped"), F.lit(False)), "403 insufficient_scope"),
        (F.col("_place") <= per_second, "429 rate_limited"),
    )
    reason = F.coalesce(*[F.when(~ok, F.lit(text)) for ok, text in checks], F.lit("ALLOW"))
    return (
        placed.join(held, "request_id", "left")
        .withColumn("decision", reason)
        .drop("_scoped", "_place", "_second")
    )


def post_revocation(access: DataFrame, consents: DataFrame) -> DataFrame:
    """Accesses that began after the consent was revoked, and those still in flight then."""
    revoked = consents.filter(F.col("revoked_at").isNotNull()).select("consent_id", "revoked_at")
    state = F.when(F.col("started_at") > F.col("revoked_at"), "violation").when(
        F.col("finished_at") > F.col("revoked_at"), "in_flight"
    )
    return access.join(revoked, "consent_id").withColumn("state", state).filter("state IS NOT NULL")


def volume_spikes(calls: DataFrame, back: int = 7, factor: float = SPIKE_FACTOR, at="ts") -> DataFrame:
    """Partner days with at least ``factor`` times the mean daily volume of the days before."""
    day = F.unix_date(F.to_date(at)).alias("day")
    days = calls.groupBy("partner_id", day).agg(F.count("*").alias("calls"))
    summed = moving(days, ["partner_id"], "day", "calls", back, "sum", "_sum", upto=-1)
    counted = moving(summed, ["partner_id"], "day", "calls", back, "count", "_days", upto=-1)
    return (
        counted.withColumn("usual", F.col("_sum") / F.nullif(F.col("_days"), F.lit(0)))
        .filter(F.col("calls") >= F.col("usual") * factor)
        .drop("_sum", "_days")
    )


def error_rates(calls: DataFrame, most: float, at_least: int = 10, failed: Column | None = None) -> DataFrame:
    failed = F.col("response_code") >= 400 if failed is None else failed
    rates = calls.groupBy("partner_id").agg(
        F.count("*").alias("calls"), F.count_if(failed).alias("errors")
    )
    rates = rates.withColumn("error_rate", F.col("errors") / F.col("calls"))
    return rates.filter((F.col("calls") >= at_least) & (F.col("error_rate") > most))


def sequential_scans(calls: DataFrame, at_least: int, order: Sequence, limit=None) -> DataFrame:
    """Runs of calls in which a partner asks for customer ids one after the other."""
    limit = check_hot(calls, ["partner_id"], limit)
    stepped = keyed_neighbor(calls, ["partner_id"], order, "customer_id", "_prev", -1, limit)
    breaks = F.when(F.col("customer_id") == F.col("_prev") + 1, 0).otherwise(1)
    runs = keyed_running(stepped.withColumn("_break", breaks), ["partner_id"], order, "_break", "_run", "sum", limit)
    return (
        runs.groupBy("partner_id", "_run")
        .agg(F.min("customer_id").alias("first_id"), F.count("*").alias("length"))
        .filter(F.col("length") >= at_least)
        .drop("_run")
    )


def new_places(calls: DataFrame, place: str, settle_days: int, at: str = "ts") -> DataFrame:
    """Places a partner is first seen in more than ``settle_days`` after its first call."""
    seen = calls.groupBy("partner_id", place).agg(F.min(at).alias("first_seen"))
    began = calls.groupBy("partner_id").agg(F.min(at).alias("_began"))
    late = F.timestamp_diff("SECOND", F.col("_began"), F.col("first_seen")) > settle_days * 86_400
    return join_keys(seen, began, ["partner_id"]).filter(late).drop("_began")


def off_hours_bulk(calls: DataFrame, at_least: int, opens: int = 9, closes: int = 17, at: str = "ts"):
    """Partner days with many calls outside business hours."""
    outside = (F.hour(at) < opens) | (F.hour(at) > closes)
    return (
        calls.filter(outside).groupBy("partner_id", F.to_date(at).alias("day"))
        .agg(F.count("*").alias("calls")).filter(F.col("calls") >= at_least)
    )


def whole_base_downloads(calls: DataFrame, share: float, at: str = "ts") -> DataFrame:
    """Partner days that touch at least ``share`` of all customers the partner ever touched."""
    per_day = calls.groupBy("partner_id", F.to_date(at).alias("day")).agg(
        F.count_distinct("customer_id").alias("customers")
    )
    base = calls.groupBy("partner_id").agg(F.count_distinct("customer_id").alias("base"))
    return join_keys(per_day, base, ["partner_id"]).filter(F.col("customers") >= F.col("base") * share)


def access_review(access: DataFrame, by: Sequence[str], elements: str = "data_elements_accessed") -> DataFrame:
    """How often, when and for which data elements access happened."""
    return (
        access.select(*by, "accessed_at", F.explode_outer(elements).alias("element"))
        .groupBy(*by, "element")
        .agg(
            F.count("*").alias("accesses"),
            F.min("accessed_at").alias("first_access"),
            F.max("accessed_at").alias("last_access"),
        )
    )


def erase(df: DataFrame, subjects: DataFrame, key: str) -> DataFrame:
    """The table without the subjects' rows."""
    return df.join(subjects.select(key), key, "left_anti")


def export(df: DataFrame, subjects: DataFrame, key: str) -> DataFrame:
    """Only the subjects' rows."""
    return df.join(subjects.select(key), key, "left_semi")
