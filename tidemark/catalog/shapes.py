"""Lending, call and consent tables derived from the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import Tables
from tidemark.operators.aggregates import money

POSITIONS = """
  SELECT l_orderkey || '-' || l_linenumber AS loan_id, CAST(o_orderdate AS DATE) AS trade_date,
    CAST(l_shipdate AS DATE) AS settle_date, CAST(l_partkey AS VARCHAR) AS security_id,
    CASE WHEN l_suppkey % 11 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS borrower_id,
    CAST(l_quantity AS DECIMAL(18,4)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS loan_value_usd,
    CASE l_returnflag WHEN 'A' THEN 'CASH' WHEN 'N' THEN 'NON_CASH' ELSE 'EQUITY' END AS collateral_type,
    CAST(l_extendedprice AS DECIMAL(18,2)) * l_linenumber AS collateral_value_usd,
    'B' || l_suppkey % 10 AS book_id, 'D' || l_suppkey % 3 AS desk_id,
    make_date(CAST(year(o_orderdate) AS INT), 1, 1) AS file_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def positions(spark, sf) -> DataFrame:
    t = Tables(spark, sf)
    flag = F.col("l_returnflag")
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("loan_id"),
        F.to_date("o_orderdate").alias("trade_date"),
        F.to_date("l_shipdate").alias("settle_date"),
        F.col("l_partkey").cast("string").alias("security_id"),
        F.when(F.col("l_suppkey") % 11 != 0, F.col("l_suppkey").cast("string")).alias("borrower_id"),
        F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
        money("l_extendedprice").alias("loan_value_usd"),
        F.when(flag == "A", "CASH").when(flag == "N", "NON_CASH").otherwise("EQUITY").alias("collateral_type"),
        (money("l_extendedprice") * F.col("l_linenumber")).alias("collateral_value_usd"),
        F.concat(F.lit("B"), F.col("l_suppkey") % 10).alias("book_id"),
        F.concat(F.lit("D"), F.col("l_suppkey") % 3).alias("desk_id"),
        F.trunc(F.to_date("o_orderdate"), "year").alias("file_date"),
    )


PNL = """
  SELECT make_date(CAST(year(l_shipdate) AS INT), 1, 1) AS file_date, 'B' || l_suppkey % 10 AS book_id,
    'D' || l_suppkey % 3 AS desk_id, l_orderkey || '-' || l_linenumber AS loan_id,
    CASE WHEN l_linenumber <> 2 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS mtm_value_prev_usd,
    CAST(l_extendedprice AS DECIMAL(18,2)) + 10 AS mtm_value_current_usd,
    CASE WHEN l_linenumber = 2 THEN CAST(l_extendedprice AS DECIMAL(18,2)) + 10 ELSE 10 END
      + CAST(l_quantity AS DECIMAL(18,2)) + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END AS pnl_usd,
    CASE WHEN l_linenumber <> 4 THEN CAST(l_quantity AS DECIMAL(18,2)) - 1 ELSE CAST(l_quantity AS DECIMAL(18,2)) END
      AS rebate_income_usd,
    CASE WHEN l_linenumber <> 4 THEN 1 END AS fee_income_usd
  FROM lineitem"""


def pnl(spark, sf) -> DataFrame:
    price, qty, line = money("l_extendedprice"), money("l_quantity"), F.col("l_linenumber")
    return Tables(spark, sf).lineitem.select(
        F.trunc(F.to_date("l_shipdate"), "year").alias("file_date"),
        F.concat(F.lit("B"), F.col("l_suppkey") % 10).alias("book_id"),
        F.concat(F.lit("D"), F.col("l_suppkey") % 3).alias("desk_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("loan_id"),
        F.when(line != 2, price).alias("mtm_value_prev_usd"),
        (price + 10).alias("mtm_value_current_usd"),
        (F.when(line == 2, price + 10).otherwise(10) + qty + F.when(line == 3, 1).otherwise(0)).alias("pnl_usd"),
        F.when(line != 4, qty - 1).otherwise(qty).alias("rebate_income_usd"),
        F.when(line != 4, 1).alias("fee_income_usd"),
    )


CALLS = """
  SELECT event_id, ts, user_id % 10 AS partner_id, user_id AS customer_id,
    CASE event_type WHEN 'click' THEN 'balance' WHEN 'view' THEN 'transactions' WHEN 'purchase' THEN 'payment'
      WHEN 'signup' THEN 'identity' ELSE event_type END AS api,
    CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS response_code, value, props
  FROM events"""


def calls(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    api = (
        F.when(kind == "click", "balance").when(kind == "view", "transactions")
        .when(kind == "purchase", "payment").when(kind == "signup", "identity").otherwise(kind)
    )
    return Tables(spark, sf).events.select(
        "event_id", "ts", (F.col("user_id") % 10).alias("partner_id"), F.col("user_id").alias("customer_id"),
        api.alias("api"), F.when(kind == "error", 500).otherwise(200).alias("response_code"), "value", "props",
    )


# One consent per customer and partner, from the customer's purchases: granted at the
# first, expiring 20 days later, revoked at the last one of every third customer.
CONSENTS = """
  SELECT 'c' || user_id AS consent_id, user_id AS customer_id, user_id % 10 AS partner_id,
    min(ts) AS granted_at, min(ts) + INTERVAL 20 DAY AS expires_at,
    CASE WHEN user_id % 3 = 0 THEN max(ts) END AS revoked_at,
    CASE WHEN user_id % 2 = 0 THEN 'balance,transactions' ELSE 'balance,payment,identity' END AS scopes
  FROM events WHERE event_type = 'purchase' GROUP BY user_id"""


def consents(spark, sf) -> DataFrame:
    user = F.col("user_id")
    bought = Tables(spark, sf).events.filter("event_type = 'purchase'")
    spans = bought.groupBy("user_id").agg(F.min("ts").alias("granted_at"), F.max("ts").alias("_last"))
    scopes = F.when(user % 2 == 0, F.lit("balance,transactions")).otherwise("balance,payment,identity")
    return spans.select(
        F.concat(F.lit("c"), user).alias("consent_id"),
        user.alias("customer_id"),
        (user % 10).alias("partner_id"),
        "granted_at",
        (F.col("granted_at") + F.expr("INTERVAL 20 DAYS")).alias("expires_at"),
        F.when(user % 3 == 0, F.col("_last")).alias("revoked_at"),
        F.split(scopes, ",").alias("granted_scopes"),
    )
