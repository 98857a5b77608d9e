"""Slowly changing dimensions, normal forms, hierarchies and lending reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import Tables, query
from tidemark.catalog.shapes import PNL, POSITIONS, pnl, positions
from tidemark.operators import dims, reports
from tidemark.operators.aggregates import money


def _priority_changes(spark, sf):
    """One (customer, day, priority) observation per day: several changes per key."""
    return (
        Tables(spark, sf).orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("day"))
        .agg(F.max("o_orderpriority").alias("pri"))
    )


_HISTORY = """WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, max(o_orderpriority) AS pri FROM orders GROUP BY 1, 2),
  c AS (SELECT *, lag(pri) OVER (PARTITION BY o_custkey ORDER BY day) AS prev FROM o),
  v AS (SELECT * FROM c WHERE prev IS NULL OR prev <> pri)
  SELECT o_custkey, pri, CAST(day AS VARCHAR) AS effective_from,
    CAST(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS VARCHAR) AS effective_to,
    lead(day) OVER (PARTITION BY o_custkey ORDER BY day) IS NULL AS is_current FROM v"""


def _dated(history):
    return history.withColumns({c: F.col(c).cast("string") for c in ("effective_from", "effective_to")})


@query("d01_replace_slice", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
  WHERE o_orderstatus <> 'O' OR o_totalprice > 100000""")
def _(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    return dims.scd1(orders, orders.filter("o_orderstatus = 'O' AND o_totalprice > 100000"), ["o_orderstatus"])


@query("d01_upsert", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer
  UNION ALL SELECT c_custkey + 10000000, c_acctbal FROM customer WHERE c_acctbal > 9000""")
def _(spark, sf):
    current = Tables(spark, sf).customer.select("c_custkey", "c_acctbal")
    debt = current.filter("c_acctbal < 0").select("c_custkey", F.lit(0.0).alias("c_acctbal"))
    added = current.filter("c_acctbal > 9000").withColumn("c_custkey", F.col("c_custkey") + 10000000)
    return dims.upsert(current, debt.unionByName(added), ["c_custkey"])


@query("d02_scd2", _HISTORY)
def _(spark, sf):
    return _dated(dims.open_versions(_priority_changes(spark, sf), "o_custkey", ["pri"], "day"))


@query("d02_scd2_late_and_replayed", _HISTORY)
def _(spark, sf):
    changes = _priority_changes(spark, sf)
    late = F.pmod(F.xxhash64("o_custkey", "day"), F.lit(3)) == 0
    history = dims.open_versions(changes.filter(~late), "o_custkey", ["pri"], "day")
    history = dims.scd2(history, changes, "o_custkey", ["pri"], "day")
    return _dated(history)


@query("d03_scd3", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'WATCH' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS previous_c_mktsegment FROM customer""")
def _(spark, sf):
    current = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment")
    delta = Tables(spark, sf).customer.filter("c_acctbal < 0").select("c_custkey", F.lit("WATCH").alias("c_mktsegment"))
    return dims.scd3(current, delta, "c_custkey", ["c_mktsegment"])


@query(
    "d04_surrogate",
    """SELECT c_custkey, CAST('0x' || md5(coalesce(length(a) || ':' || a, '~') || coalesce(length(b) || ':' || b, '~'))[1:15] AS BIGINT) AS sk, CAST(0 AS BIGINT) AS collisions
       FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS a, CASE WHEN c_custkey % 3 <> 1 THEN c_name END AS b FROM customer)""",
)
def _(spark, sf):
    # A name in either of two columns, or in both: the place counts.
    name = Tables(spark, sf).customer.select(
        "c_custkey", F.when(F.expr("c_custkey % 3 > 0"), F.col("c_name")).alias("a"),
        F.when(F.expr("c_custkey % 3 <> 1"), F.col("c_name")).alias("b"),
    )
    keyed = dims.surrogate(name, ["a", "b"])
    clashes = dims.surrogate_collisions(keyed, ["a", "b"])
    return keyed.select("c_custkey", "sk").withColumn("collisions", clashes.agg(F.count("*")).scalar())


@query("d05_normalize", """SELECT 'nation' AS tab, count(DISTINCT (n_name, r_name)) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'region', count(DISTINCT n_regionkey) FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'broken', count(*) FROM (SELECT c_nationkey FROM customer GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) > 1)""")
def _(spark, sf):
    t = Tables(spark, sf)
    wide = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    tables = dims.normalize(wide, {"nation": ["n_name", "r_name"], "region": ["n_regionkey", "r_name"]})
    tables["broken"] = dims.broken_dependencies(wide, "c_nationkey", ["c_mktsegment"])
    counts = [df.agg(F.lit(name).alias("tab"), F.count("*").alias("n")) for name, df in tables.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("r08_hierarchy", """WITH RECURSIVE e AS (SELECT c_custkey AS id, CASE WHEN c_custkey >= 10 THEN c_custkey // 10 END AS parent FROM customer),
  h AS (SELECT id, id AS root, 0 AS depth, CAST(id AS VARCHAR) AS path FROM e WHERE parent IS NULL
    UNION ALL SELECT e.id, h.root, h.depth + 1, h.path || '>' || e.id FROM e JOIN h ON e.parent = h.id)
  SELECT * FROM h""")
def _(spark, sf):
    k = F.col("c_custkey")
    staff = Tables(spark, sf).customer.select(k.alias("id"), F.when(k >= 10, F.floor(k / 10)).alias("parent"))
    walked = dims.hierarchy(staff, "id", "parent")
    return walked.withColumn("path", F.array_join(F.col("path").cast("array<string>"), ">"))


# ---------------------------------------------------------------- reports


@query("r01_daily_positions", f"""SELECT CAST(file_date AS VARCHAR) AS file_date, CAST(sum(loan_value_usd) AS DOUBLE) AS total_value_usd,
  count(DISTINCT loan_id) AS loan_count FROM ({POSITIONS}) GROUP BY 1""")
def _(spark, sf):
    out = reports.daily_positions(positions(spark, sf))
    return out.withColumns({"file_date": F.col("file_date").cast("string"), "total_value_usd": F.col("total_value_usd").cast("double")})


@query("r01_top_securities", f"""SELECT CAST(file_date AS VARCHAR) AS file_date, security_id, CAST(v AS DOUBLE) AS value_usd, rnk FROM
  (SELECT *, row_number() OVER (PARTITION BY file_date ORDER BY v DESC, security_id) AS rnk FROM
  (SELECT file_date, security_id, sum(loan_value_usd) AS v FROM ({POSITIONS}) GROUP BY 1, 2)) WHERE rnk <= 10""")
def _(spark, sf):
    out = reports.top_exposures(positions(spark, sf), "security_id", 10)
    return out.withColumns({"file_date": F.col("file_date").cast("string"), "value_usd": F.col("value_usd").cast("double")})


@query("r02_exposure", f"""SELECT borrower_id, CAST(v AS DOUBLE) AS exposure_usd, loans, round(CAST(v AS DOUBLE) * 100 / CAST(sum(v) OVER () AS DOUBLE), 2) AS share_pct FROM
  (SELECT borrower_id, sum(loan_value_usd) AS v, count(*) AS loans FROM ({POSITIONS}) GROUP BY borrower_id)""")
def _(spark, sf):
    sums = positions(spark, sf).withColumn("loan_value_usd", F.col("loan_value_usd").cast("decimal(18,2)"))
    out = reports.exposure(sums, ["borrower_id"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("exposure_usd", "share_pct")})


@query("r03_exposure_by_type", """SELECT r_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS exposure_usd, count(*) AS loans
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def _(spark, sf):
    from tidemark.operators.joins import star_join

    t = Tables(spark, sf)
    chain = [(t.supplier, "l_suppkey", "s_suppkey"), (t.nation, "s_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey")]
    # Pre-aggregated to the fact's key, so the dimension chain meets few rows.
    facts = t.lineitem.groupBy("l_suppkey").agg(F.sum(money("l_extendedprice")).alias("v"), F.count("*").alias("c"))
    return star_join(facts, chain).groupBy("r_name").agg(
        F.sum("v").cast("double").alias("exposure_usd"), F.sum("c").alias("loans")
    )


@query("r04_daily_pnl", f"""SELECT CAST(file_date AS VARCHAR) AS file_date, book_id, desk_id, CAST(grouping(book_id) * 2 + grouping(desk_id) AS BIGINT) AS level_id,
  CAST(sum(pnl_usd) AS DOUBLE) AS pnl_usd, CAST(coalesce(sum(rebate_income_usd), 0) AS DOUBLE) AS rebate_usd, CAST(coalesce(sum(fee_income_usd), 0) AS DOUBLE) AS fee_usd,
  CAST(sum(mtm_value_current_usd - coalesce(mtm_value_prev_usd, 0)) AS DOUBLE) AS mtm_change_usd FROM ({PNL})
  GROUP BY GROUPING SETS ((file_date, book_id, desk_id), (file_date, book_id), (file_date, desk_id), (file_date))""")
def _(spark, sf):
    out = reports.daily_pnl(pnl(spark, sf))
    cast = {c: F.col(c).cast("double") for c in ("pnl_usd", "rebate_usd", "fee_usd", "mtm_change_usd")}
    return out.withColumns({**cast, "file_date": F.col("file_date").cast("string")})


@query("r05_collateral", f"""SELECT collateral_type, CAST(sum(loan_value_usd) AS DOUBLE) AS loan_value_usd, CAST(sum(collateral_value_usd) AS DOUBLE) AS collateral_usd,
  round(CAST(sum(collateral_value_usd) AS DOUBLE) / CAST(sum(loan_value_usd) AS DOUBLE), 4) AS coverage FROM ({POSITIONS}) GROUP BY collateral_type""")
def _(spark, sf):
    out = reports.collateral(positions(spark, sf), ["collateral_type"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("loan_value_usd", "collateral_usd", "coverage")})


@query("r06_settlement", f"""SELECT CASE WHEN settle_date > DATE '1996-06-01' THEN 'pending' WHEN settle_date = DATE '1996-06-01' THEN 'settling' ELSE 'settled' END
  AS settlement_status, count(*) AS loans FROM ({POSITIONS}) GROUP BY 1""")
def _(spark, sf):
    return reports.settlement(positions(spark, sf), F.lit("1996-06-01").cast("date"))


@query("r07_trend", """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS period, r_name, n_name, CAST(grouping(r_name) * 2 + grouping(n_name) AS BIGINT) AS level_id,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, ROLLUP (r_name, n_name)""")
def _(spark, sf):
    from tidemark.operators.joins import star_join

    t = Tables(spark, sf)
    chain = [(t.customer, "o_custkey", "c_custkey"), (t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey")]
    wide = star_join(t.orders, chain).withColumn("price", money("o_totalprice"))
    out = reports.trend(wide, "o_orderdate", "month", ["r_name", "n_name"], "price")
    return out.withColumns({"value": F.col("value").cast("double"), "period": F.col("period").cast("string")})
