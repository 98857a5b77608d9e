"""Window-style queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import Tables, query
from tidemark.operators import aggregates as agg
from tidemark.operators import windows
from tidemark.operators.aggregates import money

_DATED = ["o_orderdate", "o_orderkey"]


def _orders(spark, sf):
    return Tables(spark, sf).orders.select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), money("o_totalprice").alias("price")
    )


@query(
    "w01_row_number",
    """SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
       FROM orders""",
)
def _(spark, sf):
    return windows.ranked(_orders(spark, sf), ["o_custkey"], _DATED, "row", "rn").select("o_orderkey", "o_custkey", "rn")


@query(
    "w02_rank",
    """SELECT event_id, event_type, rank() OVER (PARTITION BY event_type ORDER BY floor(value) DESC) AS rnk FROM events""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "event_type", F.floor("value").alias("v"))
    return windows.ranked(events, ["event_type"], [("v", "desc")], "rank").drop("v")


@query(
    "w03_dense_rank",
    """SELECT event_id, event_type, dense_rank() OVER (PARTITION BY event_type ORDER BY floor(value) DESC) AS rnk
       FROM events""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "event_type", F.floor("value").alias("v"))
    return windows.ranked(events, ["event_type"], [("v", "desc")], "dense").drop("v")


@query(
    "w03_top2_per_nation",
    """SELECT n_name, c_custkey, c_acctbal, rnk FROM (SELECT n_name, c_custkey, c_acctbal,
         dense_rank() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC) AS rnk
       FROM customer JOIN nation ON c_nationkey = n_nationkey) WHERE rnk <= 2""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    customer = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    best = windows.top_n(customer, ["c_nationkey"], [("c_acctbal", "desc")], 2)
    named = best.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("n_name", "c_custkey", "c_acctbal", "rnk")


@query(
    "w04_neighbors",
    """SELECT o_orderkey, lag(o_orderkey, 1, -1) OVER w AS prev_o_orderkey,
         lead(o_orderkey, 1, -1) OVER w AS next_o_orderkey
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(spark, sf):
    out = windows.neighbors(_orders(spark, sf), ["o_custkey"], _DATED, ["o_orderkey"], -1)
    return out.select("o_orderkey", "prev_o_orderkey", "next_o_orderkey")


_RUNNING = """SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey
  ORDER BY {order} {frame} BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running FROM orders"""


@query("w05_running_rows", _RUNNING.format(order="o_orderdate, o_orderkey", frame="ROWS"))
def _(spark, sf):
    out = windows.running(_orders(spark, sf), ["o_custkey"], _DATED, "price")
    return out.select("o_orderkey", F.col("running").cast("double").alias("running"))


@query("w06_running_range", _RUNNING.format(order="o_orderdate", frame="RANGE"))
def _(spark, sf):
    out = windows.running(_orders(spark, sf), ["o_custkey"], ["o_orderdate"], "price", "range")
    return out.select("o_orderkey", F.col("running").cast("double").alias("running"))


@query(
    "w07_moving_7_days",
    """SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate
       RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS DOUBLE) AS moving FROM orders""",
)
def _(spark, sf):
    orders = Tables(spark, sf).orders.select(
        "o_orderkey", "o_orderpriority", F.unix_date(F.to_date("o_orderdate")).alias("day"), money("o_totalprice").alias("price")
    )
    out = windows.moving(orders, ["o_orderpriority"], "day", "price", 7)
    return out.select("o_orderkey", F.col("moving").cast("double").alias("moving"))


@query(
    "w08_first_last",
    """SELECT o_orderkey, first_value(o_orderkey) OVER w AS first_o_orderkey, last_value(o_orderkey) OVER w AS last_o_orderkey
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def _(spark, sf):
    orders = _orders(spark, sf).withColumn("key", F.col("o_orderkey"))
    return windows.first_last(orders, ["o_custkey"], _DATED, ["o_orderkey"]).select(
        "o_orderkey", "first_o_orderkey", "last_o_orderkey"
    )


@query("w09_ntile_global", "SELECT c_custkey, ntile(7) OVER (ORDER BY c_acctbal, c_custkey) AS tile FROM customer")
def _(spark, sf):
    customer = Tables(spark, sf).customer.select("c_custkey", "c_acctbal")
    return windows.ntile(customer, 7, ["c_acctbal", "c_custkey"]).select("c_custkey", "tile")


@query(
    "w09_ntile_group",
    "SELECT c_custkey, ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS tile FROM customer",
)
def _(spark, sf):
    customer = Tables(spark, sf).customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return windows.ntile(customer, 4, ["c_acctbal", "c_custkey"], ["c_nationkey"]).select("c_custkey", "tile")


@query(
    "w10_group_total",
    """SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE) AS total
       FROM orders""",
)
def _(spark, sf):
    from tidemark.plans.ordering import join_keys

    orders = _orders(spark, sf)
    totals = orders.groupBy("o_custkey").agg(F.sum("price").cast("double").alias("total"))
    return join_keys(orders, totals, ["o_custkey"], "left").select("o_orderkey", "total")


@query(
    "w11_nth_highest",
    "SELECT DISTINCT c_acctbal FROM customer ORDER BY c_acctbal DESC LIMIT 1 OFFSET 4",
)
def _(spark, sf):
    return windows.nth_highest(Tables(spark, sf).customer, "c_acctbal", 5)


@query("w11_nth_with_repeats", "SELECT p_size FROM part ORDER BY p_size DESC LIMIT 1 OFFSET 2")
def _(spark, sf):
    return windows.nth_highest(Tables(spark, sf).part, "p_size", 3, distinct=False)


_GLOBAL = "SELECT o_orderkey, {fn}() OVER (ORDER BY {order}) AS rnk FROM orders"


@query("w12_global_row_number", _GLOBAL.format(fn="row_number", order="o_totalprice DESC, o_orderkey"))
def _(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return windows.global_rank(orders, [("o_totalprice", "desc"), "o_orderkey"]).drop("o_totalprice")


@query("w12_global_dense", _GLOBAL.format(fn="dense_rank", order="o_orderdate"))
def _(spark, sf):
    return windows.global_rank(Tables(spark, sf).orders.select("o_orderkey", "o_orderdate"), ["o_orderdate"], "dense").drop("o_orderdate")


@query("w12_global_rank", _GLOBAL.format(fn="rank", order="o_orderdate"))
def _(spark, sf):
    return windows.global_rank(Tables(spark, sf).orders.select("o_orderkey", "o_orderdate"), ["o_orderdate"], "rank").drop("o_orderdate")


def clicks(spark, sf):
    """Events with whole minutes as time, so that events share a time."""
    minute = F.floor(F.timestamp_diff("SECOND", F.lit("2024-01-01").cast("timestamp_ntz"), F.col("ts")) / 600)
    return Tables(spark, sf).events.select(
        "event_id", "user_id", "event_type", minute.cast("long").alias("t"), money("value").alias("clicks")
    )


_CLICKS = """SELECT event_id, user_id, event_type, CAST(floor(date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) / 600) AS BIGINT)
  AS t, CAST(value AS DECIMAL(18,2)) AS clicks FROM events"""


@query(
    "w13_trailing_sum",
    f"""WITH c AS ({_CLICKS}) SELECT a.event_id, CAST(sum(b.clicks) AS DOUBLE) AS trailing FROM c a JOIN c b
       ON a.event_type = b.event_type AND b.t >= a.t - 29 AND (b.t < a.t OR (b.t = a.t AND b.event_id <= a.event_id))
       GROUP BY a.event_id""",
)
def _(spark, sf):
    out = windows.trailing_agg(clicks(spark, sf), "t", "clicks", 30, "event_id", key=["event_type"])
    return out.select("event_id", F.col("trailing").cast("double").alias("trailing"))


@query(
    "w13_trailing_sum_unkeyed",
    f"""WITH c AS ({_CLICKS}) SELECT a.event_id, CAST(sum(b.clicks) AS DOUBLE) AS trailing FROM c a JOIN c b
       ON b.t >= a.t - 9 AND (b.t < a.t OR (b.t = a.t AND b.event_id <= a.event_id)) GROUP BY a.event_id""",
)
def _(spark, sf):
    out = windows.trailing_agg(clicks(spark, sf), "t", "clicks", 10, "event_id", width=144)
    return out.select("event_id", F.col("trailing").cast("double").alias("trailing"))


@query(
    "w14_trailing_max",
    f"""WITH c AS ({_CLICKS}) SELECT a.event_id, CAST(max(b.clicks) AS DOUBLE) AS trailing FROM c a JOIN c b
       ON a.user_id = b.user_id AND b.t >= a.t - 99 AND (b.t < a.t OR (b.t = a.t AND b.event_id <= a.event_id))
       GROUP BY a.event_id""",
)
def _(spark, sf):
    out = windows.trailing_agg(clicks(spark, sf), "t", "clicks", 100, "event_id", "max", ["user_id"])
    return out.select("event_id", F.col("trailing").cast("double").alias("trailing"))


@query(
    "w15_hits_at",
    f"""WITH c AS ({_CLICKS}) SELECT q.t, count(c.t) AS hits FROM (SELECT unnest(range(0, (SELECT max(t) FROM c) + 31, 7)) AS t) q
       LEFT JOIN c ON c.t BETWEEN q.t - 29 AND q.t GROUP BY q.t""",
)
def _(spark, sf):
    hits = clicks(spark, sf)
    # Until no window reaches the last hit any more.
    last = hits.agg(F.max("t")).first()[0]
    times = spark.range(0, last + 31, 7).select(F.col("id").alias("t"))
    return windows.hits_at(hits, times, "t", 30, width=144)


@query(
    "w16_group_max_row",
    """SELECT c_nationkey, c_custkey, c_acctbal FROM customer QUALIFY c_acctbal =
       max(c_acctbal) OVER (PARTITION BY c_nationkey)""",
)
def _(spark, sf):
    from tidemark.plans.ordering import join_keys

    customer = Tables(spark, sf).customer.select("c_nationkey", "c_custkey", "c_acctbal")
    best = customer.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("c_acctbal"))
    return join_keys(customer, best, ["c_nationkey", "c_acctbal"])
