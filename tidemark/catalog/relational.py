"""Filters, joins, grouping and ordering over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import Tables, query
from tidemark.operators import aggregates as agg
from tidemark.operators import joins, rows, sorting
from tidemark.operators.aggregates import money

# ---------------------------------------------------------------- rows


@query("p01_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def _(spark, sf):
    return Tables(spark, sf).customer.filter("c_acctbal < 0").select("c_custkey", "c_acctbal")


@query(
    "p02_project",
    "SELECT c_custkey, upper(c_name) AS name, round(c_acctbal * 2, 2) AS doubled FROM customer",
)
def _(spark, sf):
    return Tables(spark, sf).customer.select(
        "c_custkey", F.upper("c_name").alias("name"), F.round(F.col("c_acctbal") * 2, 2).alias("doubled")
    )


@query(
    "p03_flat_map",
    """SELECT word, count(*) AS n FROM (
         SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
)
def _(spark, sf):
    words = Tables(spark, sf).spread("documents").select(F.split("text", " ").alias("word"))
    return agg.frequency(rows.explode_list(words, "word"), "word")


@query("p04_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    return Tables(spark, sf).events.select("user_id", "event_type").distinct()


@query(
    "p05_case_flag",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low'
       ELSE 'high' END AS band FROM customer""",
)
def _(spark, sf):
    bal = F.col("c_acctbal")
    band = F.when(bal < 0, "debt").when(bal < 5000, "low").otherwise("high")
    return Tables(spark, sf).customer.select("c_custkey", band.alias("band"))


@query(
    "p06_take_while",
    """SELECT e.event_id, e.user_id FROM events e LEFT JOIN (
         SELECT user_id, min(event_id) AS stop FROM events WHERE NOT (value < 120) GROUP BY user_id) s
       ON e.user_id = s.user_id WHERE s.stop IS NULL OR e.event_id < s.stop""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", "value")
    kept = rows.take_while(events, F.col("value") < 120, ["event_id"], ["user_id"])
    return kept.select("event_id", "user_id")


@query(
    "p06_drop_while",
    """SELECT event_id, user_id FROM events WHERE event_id >=
       (SELECT min(event_id) FROM events WHERE event_type = 'purchase')""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", "event_type")
    kept = rows.drop_while(events, F.col("event_type") != "purchase", ["event_id"])
    return kept.select("event_id", "user_id")


@query(
    "p07_present",
    """SELECT event_id, k FROM (SELECT event_id, CASE WHEN event_type <> 'error'
       THEN CAST(json_extract_string(props, '$.k') AS INT) END AS k FROM events) WHERE k IS NOT NULL""",
)
def _(spark, sf):
    k = F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k").try_cast("int"))
    return rows.present(Tables(spark, sf).events.select("event_id", k.alias("k")), "k")


@query(
    "p08_matches",
    """SELECT 'any' AS kind, coalesce(bool_or(c_acctbal < 0), false) AS matched FROM customer
       UNION ALL SELECT 'all', coalesce(bool_and(c_acctbal > -2000), true) FROM customer
       UNION ALL SELECT 'none', NOT coalesce(bool_or(c_mktsegment = 'NOPE'), false) FROM customer""",
)
def _(spark, sf):
    customer = Tables(spark, sf).customer
    found = {
        "any": rows.any_match(customer, F.col("c_acctbal") < 0),
        "all": rows.all_match(customer, F.col("c_acctbal") > -2000),
        "none": rows.none_match(customer, F.col("c_mktsegment") == "NOPE"),
    }
    named = [df.select(F.lit(kind).alias("kind"), "matched") for kind, df in found.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("p09_observe", "SELECT event_id, value FROM events WHERE event_type = 'view'")
def _(spark, sf):
    views = Tables(spark, sf).events.filter("event_type = 'view'").select("event_id", "value")
    return rows.observed(views, "views", seen=F.count("*"), largest=F.max("value"))


@query(
    "p10_mask",
    """SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace(c_name, '[A-Z]', 'X', 'g'),
         '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g') AS c_name, CAST(NULL AS DOUBLE) AS c_acctbal,
       c_mktsegment FROM customer""",
)
def _(spark, sf):
    rules = {
        "c_name": {"allowed": {"admin", "ops"}, "how": "mask"},
        "c_acctbal": {"allowed": {"admin"}, "how": "null"},
        "c_mktsegment": {"allowed": {"analyst"}, "how": "hash"},
    }
    customer = Tables(spark, sf).customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return rows.mask_columns(customer, {"analyst"}, rules)


# ---------------------------------------------------------------- joins


@query(
    "j01_inner",
    """SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "o_totalprice", "c_name")


@query(
    "j02_count_with_zeros",
    """SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem
       ON o_orderkey = l_orderkey GROUP BY o_orderkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.select("o_orderkey")
    return joins.count_with_zeros(orders, t.lineitem.select("l_orderkey"), "o_orderkey", "l_orderkey")


@query(
    "j03_right",
    """SELECT o_orderkey, n.n_name, c_custkey FROM
         (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 490000) x
       RIGHT JOIN nation n ON x.c_nationkey = n.n_nationkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    big = t.orders.filter("o_totalprice > 490000").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = big.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "right")
    return joined.select("o_orderkey", "n_name", "c_custkey")


@query(
    "j04_full",
    """SELECT o_orderkey, l_orderkey, n FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') o
       FULL JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l
       ON o_orderkey = l_orderkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    finished = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey")
    items = agg.frequency(t.lineitem, "l_orderkey")
    return finished.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "full")


@query(
    "j05_spine",
    """SELECT s.c_mktsegment, m.month, coalesce(n, 0) AS n FROM
         (SELECT DISTINCT c_mktsegment FROM customer) s,
         (SELECT unnest(range(1, 13)) AS month) m
       LEFT JOIN (SELECT c_mktsegment AS seg, month(o_orderdate) AS mon, count(*) AS n
                  FROM orders JOIN customer ON o_custkey = c_custkey
                  WHERE o_orderstatus = 'P' GROUP BY 1, 2) x
       ON x.seg = s.c_mktsegment AND x.mon = m.month""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    months = F.sequence(F.lit(1), F.lit(12)).cast("array<bigint>")
    all_cells = joins.spine(t.customer, ["c_mktsegment"], "month", months)
    pending = t.orders.filter("o_orderstatus = 'P'").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    counts = agg.frequency(
        pending.select("c_mktsegment", F.month("o_orderdate").cast("long").alias("month")), "c_mktsegment", "month"
    )
    return all_cells.join(counts, ["c_mktsegment", "month"], "left").na.fill(0, ["n"])


@query(
    "j06_semi",
    """SELECT c_custkey FROM customer WHERE EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    big = t.orders.filter("o_totalprice > 450000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query(
    "j07_anti",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def _(spark, sf):
    t = Tables(spark, sf)
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query(
    "j08_above_group_avg",
    """SELECT c_custkey, c_nationkey, c_acctbal > (SELECT sum(CAST(b.c_acctbal AS DECIMAL(18,2))) / count(*)
         FROM customer b WHERE b.c_nationkey = a.c_nationkey) AS above FROM customer a""",
)
def _(spark, sf):
    customer = Tables(spark, sf).customer.select("c_custkey", "c_nationkey", money("c_acctbal").alias("bal"))
    flagged = joins.above_group_avg(customer, "c_nationkey", "bal")
    return flagged.select("c_custkey", "c_nationkey", "above")


_RANKED_BALANCE = """
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max(o_orderpriority) AS pri FROM orders GROUP BY 1, 2"""


@query(
    "j09_asof_dim",
    f"""WITH v AS ({_RANKED_BALANCE}),
       dim AS (SELECT o_custkey AS k, pri, d AS f,
               lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS u FROM v)
       SELECT event_id, user_id, dim.pri FROM
         (SELECT event_id, user_id, DATE '1992-01-01' + CAST(event_id % 2500 AS INT) AS d FROM events) e
       LEFT JOIN dim ON dim.k = e.user_id AND dim.f <= e.d AND (dim.u IS NULL OR e.d < dim.u)""",
)
def _(spark, sf):
    from tidemark.operators.windows import neighbors

    t = Tables(spark, sf)
    versions = (
        t.orders.select(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("effective_from"), "o_orderpriority")
        .groupBy("user_id", "effective_from")
        .agg(F.max("o_orderpriority").alias("pri"))
    )
    dim = neighbors(versions, ["user_id"], ["effective_from"], ["effective_from"]).select(
        "user_id", "pri", "effective_from", F.col("next_effective_from").alias("effective_to")
    )
    day = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("event_id") % 2500).cast("int"))
    facts = t.events.select("event_id", "user_id", day.alias("d"))
    return joins.asof_dim_join(facts, dim, "user_id", "d").select("event_id", "user_id", "pri")


@query(
    "j09_asof_hot_key",
    """WITH v AS (SELECT l_returnflag AS k, CAST(l_shipdate AS DATE) AS f, max(l_discount) AS rate FROM lineitem GROUP BY ALL),
       dim AS (SELECT *, lead(f) OVER (PARTITION BY k ORDER BY f) AS u FROM v)
       SELECT l_orderkey, l_linenumber, rate FROM lineitem LEFT JOIN dim ON k = l_returnflag AND f <= CAST(l_shipdate AS DATE) + l_linenumber
       AND (u IS NULL OR CAST(l_shipdate AS DATE) + l_linenumber < u)""",
)
def _(spark, sf):
    """Three keys with thousands of versions each, one of them with half of the facts."""
    from tidemark.operators.windows import neighbors

    items = Tables(spark, sf).lineitem
    day = F.to_date("l_shipdate").alias("effective_from")
    versions = items.groupBy("l_returnflag", day).agg(F.max("l_discount").alias("rate"))
    dim = neighbors(versions, ["l_returnflag"], ["effective_from"], ["effective_from"]).select(
        "l_returnflag", "rate", "effective_from", F.col("next_effective_from").alias("effective_to")
    )
    facts = items.select("l_orderkey", "l_linenumber", "l_returnflag", F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber").cast("int")).alias("d"))
    found = joins.asof_dim_join(facts, dim, "l_returnflag", "d", tile_rows=100_000, many=200)
    return found.select("l_orderkey", "l_linenumber", "rate")


@query(
    "j10_star",
    """SELECT p_brand, s_nationkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       GROUP BY p_brand, s_nationkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    star = joins.star_join(
        t.lineitem.select("l_partkey", "l_suppkey", "l_extendedprice"),
        [(t.part, "l_partkey", "p_partkey"), (t.supplier, "l_suppkey", "s_suppkey")],
    )
    return star.groupBy("p_brand", "s_nationkey").agg(
        F.sum(money("l_extendedprice")).cast("double").alias("revenue")
    )


@query(
    "j11_snowflake",
    """SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    wide = joins.star_join(
        t.customer, [(t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey")]
    )
    return agg.frequency(wide, "r_name")


@query(
    "j12_wide_row",
    """SELECT l_orderkey, l_linenumber, l_quantity, p_name, s_name, n_name FROM lineitem
       LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    dims = [
        (t.part, "l_partkey", "p_partkey"),
        (t.supplier, "l_suppkey", "s_suppkey"),
        (t.nation, "s_nationkey", "n_nationkey"),
    ]
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "p_name", "s_name", "n_name"]
    return joins.to_wide(t.lineitem, dims, columns)


@query(
    "j13_batch_lookup",
    """SELECT o_orderkey, c_name AS customer_name, c_custkey IS NULL AS missing FROM
         (SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey END AS ck FROM orders)
       LEFT JOIN customer ON ck = c_custkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("ck"))
    looked = joins.batch_lookup(orders, "ck", t.customer.select("c_custkey", "c_name"), "c_custkey", "customer")
    return looked.select(
        "o_orderkey", F.col("customer.c_name").alias("customer_name"), F.col("customer").isNull().alias("missing")
    )


@query(
    "j14_nest",
    """SELECT c_custkey, CAST(0 AS BIGINT) AS page, coalesce(string_agg(
         o_orderkey || ':' || o_orderpriority, ',' ORDER BY o_orderkey), '') AS orders
       FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON c_custkey = o_custkey
       GROUP BY c_custkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    pending = t.orders.filter("o_orderstatus = 'P'").select("o_custkey", "o_orderkey", "o_orderpriority")
    nested = joins.nest(
        t.customer.select("c_custkey"), pending, "c_custkey", "o_custkey", ["o_orderkey"],
        ["o_orderkey", "o_orderpriority"], "orders",
    )
    text = F.transform("orders", lambda o: F.concat_ws(":", o["o_orderkey"], o["o_orderpriority"]))
    return nested.select("c_custkey", "page", F.array_join(text, ",").alias("orders"))


@query(
    "j15_enrich",
    """SELECT l_orderkey, l_partkey, p_brand,
         CASE WHEN p_partkey IS NULL THEN 'p_partkey:no_reference' END AS reject_reason
       FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) ON l_partkey = p_partkey""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    items = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_partkey").alias("p_partkey"))
    snapshot = t.part.filter("p_size <= 40").select("p_partkey", "p_brand")
    looked = joins.enrich(items, "p_partkey", lambda keys: snapshot.join(keys, "p_partkey", "left_semi"))
    return looked.select("l_orderkey", "l_partkey", "p_brand", "reject_reason")


@query(
    "j17_assemble",
    """WITH o AS (SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY rn) AS orders FROM (
           SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
           FROM orders) WHERE rn <= 5 GROUP BY o_custkey),
       e AS (SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY rn) AS events FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn
           FROM events) WHERE rn <= 3 GROUP BY user_id)
       SELECT c_custkey, coalesce(orders, '') AS orders, coalesce(events, '') AS events
       FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN e ON c_custkey = e.user_id""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    events = t.events.withColumnRenamed("user_id", "c_custkey")
    page = joins.assemble(
        t.customer.select("c_custkey"),
        "c_custkey",
        {
            "orders": (orders, [("o_orderdate", "desc"), "o_orderkey"], ["o_orderkey"], 5),
            "events": (events, [("ts", "desc"), "event_id"], ["event_id"], 3),
        },
    )
    return page.select(
        "c_custkey",
        F.array_join(F.col("orders.o_orderkey").cast("array<string>"), ",").alias("orders"),
        F.array_join(F.col("events.event_id").cast("array<string>"), ",").alias("events"),
    )


@query(
    "j18_applicable",
    """WITH dt AS (SELECT doc_id, CASE WHEN n_chars < 500 THEN 'All' ELSE lang END AS tag FROM documents
                  UNION ALL SELECT doc_id, source FROM documents),
       apps AS (SELECT DISTINCT source AS app FROM documents),
       ta AS (SELECT app, app AS tag FROM apps UNION ALL SELECT app, 'All' FROM apps
              UNION ALL SELECT app, 'fr' FROM apps WHERE length(app) % 2 = 0)
       SELECT app, count(DISTINCT doc_id) AS n FROM dt JOIN ta USING (tag) GROUP BY app""",
)
def _(spark, sf):
    t = Tables(spark, sf)
    own = F.when(F.col("n_chars") < 500, F.lit("All")).otherwise(F.col("lang"))
    docs = t.documents.select("doc_id", F.array(own, "source").alias("tags"))
    own = F.when(F.length("app") % 2 == 0, F.array("app", F.lit("fr"))).otherwise(F.array("app"))
    apps = t.documents.select(F.col("source").alias("app")).distinct().select("app", own.alias("tags"))
    return agg.frequency(joins.applicable(docs, apps, "doc_id", "app"), "app")


# ---------------------------------------------------------------- grouping


@query(
    "a01_summary",
    """SELECT l_returnflag, l_linestatus, count(l_quantity) AS n,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total,
         CAST(min(l_quantity) AS DOUBLE) AS lowest, CAST(max(l_quantity) AS DOUBLE) AS highest,
         round(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity), 6) AS mean
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def _(spark, sf):
    items = Tables(spark, sf).lineitem.withColumn("q", money("l_quantity"))
    stats = agg.summary_stats(items, "q", ["l_returnflag", "l_linestatus"])
    return stats.select(
        "l_returnflag", "l_linestatus", "n",
        *[F.col(c).cast("double").alias(c) for c in ("total", "lowest", "highest", "mean")],
    )


@query("a02_frequency", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    return agg.frequency(Tables(spark, sf).events, "event_type")


@query(
    "a03_group_avg",
    """SELECT c_mktsegment, round(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS mean
       FROM customer GROUP BY c_mktsegment""",
)
def _(spark, sf):
    sums = Tables(spark, sf).customer.groupBy("c_mktsegment").agg(
        F.sum(money("c_acctbal")).cast("double").alias("s"), F.count("*").alias("n")
    )
    return sums.select("c_mktsegment", F.round(F.col("s") / F.col("n"), 4).alias("mean"))


@query(
    "a04_top_row",
    """SELECT c_nationkey, c_custkey, c_name, c_acctbal FROM customer
       QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1""",
)
def _(spark, sf):
    customer = Tables(spark, sf).customer.select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    return agg.top_row(customer, ["c_nationkey"], "c_acctbal", "c_custkey")


@query(
    "a05_group_list",
    """SELECT o_custkey, (rn - 1) // 8 AS page, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY rn) AS items
       FROM (SELECT o_custkey, o_orderkey, row_number() OVER
             (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) GROUP BY 1, 2""",
)
def _(spark, sf):
    orders = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    lists = agg.group_collect(orders, ["o_custkey"], "o_orderkey", ["o_orderdate", "o_orderkey"], page_size=8)
    return lists.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@query(
    "a05_group_set",
    """SELECT o_custkey, CAST(0 AS BIGINT) AS page, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS items
       FROM orders GROUP BY o_custkey""",
)
def _(spark, sf):
    sets = agg.group_collect(Tables(spark, sf).orders, ["o_custkey"], "o_orderpriority", None, distinct=True)
    return sets.withColumn("items", F.array_join("items", ","))


@query(
    "a06_partition_by",
    """SELECT f.flag, coalesce(n, 0) AS n FROM (VALUES (true), (false)) f(flag) LEFT JOIN
       (SELECT c_acctbal > 20000 AS flag, count(*) AS n FROM customer GROUP BY 1) x ON x.flag = f.flag""",
)
def _(spark, sf):
    parts = agg.partition_by(Tables(spark, sf).customer, F.col("c_acctbal") > 20000, F.count("*").alias("n"))
    return parts.na.fill(0, ["n"])


@query(
    "a07_join_strings",
    """SELECT n_regionkey, CAST(0 AS BIGINT) AS page,
         '[' || string_agg(n_name, ', ' ORDER BY n_name) || ']' AS joined FROM nation GROUP BY n_regionkey""",
)
def _(spark, sf):
    nation = Tables(spark, sf).nation.select("n_regionkey", "n_name")
    return agg.join_strings(nation, ["n_regionkey"], "n_name", ", ", ["n_name"], "[", "]")


@query(
    "a08_to_map",
    """SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey""",
)
def _(spark, sf):
    return agg.to_map(Tables(spark, sf).orders, "o_custkey", "o_orderpriority", "first", ["o_orderkey"])


@query("a08_to_map_unique", "SELECT c_custkey, c_name FROM customer")
def _(spark, sf):
    return agg.to_map(Tables(spark, sf).customer, "c_custkey", "c_name")


@query(
    "a09_distinct_by_key",
    """SELECT user_id, event_type, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("user_id", "event_type", "event_id", "value")
    return agg.distinct_by_key(events, ["user_id", "event_type"], ["event_id"])


@query(
    "a10_first_non_repeating",
    """SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text HAVING count(*) = 1
       ORDER BY doc_id LIMIT 1""",
)
def _(spark, sf):
    return agg.first_non_repeating(Tables(spark, sf).documents.select("text", "doc_id"), "text", ["doc_id"])


@query(
    "a11_reduce",
    """SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(9,0))) AS DOUBLE) AS folded,
         max(l_extendedprice) AS largest FROM lineitem""",
)
def _(spark, sf):
    value = money("l_extendedprice") * F.col("l_quantity").cast("decimal(9,0)")
    return Tables(spark, sf).lineitem.agg(
        F.coalesce(F.sum(value), F.lit(0)).cast("double").alias("folded"),
        F.max("l_extendedprice").alias("largest"),
    )


@query(
    "a11_array_fold",
    """SELECT vec_id, list_reduce(list_prepend(0.0::DOUBLE, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 3))),
         lambda a, b: greatest(a, b)) AS peak FROM embeddings""",
)
def _(spark, sf):
    peak = F.reduce("embedding", F.lit(0.0), lambda a, x: F.greatest(a, F.round(x.cast("double"), 3)))
    return Tables(spark, sf).embeddings.select("vec_id", peak.alias("peak"))


@query(
    "a12_having",
    "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey HAVING count(*) > 60",
)
def _(spark, sf):
    return agg.frequency(Tables(spark, sf).customer, "c_nationkey").filter("n > 60")


_LEVELS = """SELECT {cols}, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT) AS level_id,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY {how}"""
_COLS = "o_orderstatus, o_orderpriority"


def _levels(spark, sf, how, sets=None):
    sums = {"total": money("o_totalprice")}
    out = agg.subtotals(Tables(spark, sf).orders, how, _COLS.split(", "), sums, sets)
    return out.withColumn("total", F.col("total").cast("double"))


@query("a13_rollup", _LEVELS.format(cols=_COLS, how=f"ROLLUP ({_COLS})"))
def _(spark, sf):
    return _levels(spark, sf, "rollup")


@query("a14_cube", _LEVELS.format(cols=_COLS, how=f"CUBE ({_COLS})"))
def _(spark, sf):
    return _levels(spark, sf, "cube")


@query(
    "a15_grouping_sets",
    _LEVELS.format(cols=_COLS, how="GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"),
)
def _(spark, sf):
    return _levels(spark, sf, "sets", [["o_orderstatus"], ["o_orderpriority"], []])


@query("a16_count_distinct", "SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY event_type")
def _(spark, sf):
    return agg.count_distinct(Tables(spark, sf).events, ["event_type"], "user_id")


@query(
    "a16_approx_distinct",
)
def _(spark, sf):
    return agg.count_distinct(Tables(spark, sf).events, ["event_type"], "user_id", approx=True)


@query(
    "a17_percentile",
    """SELECT event_type, round(quantile_cont(value, 0.95), 6) AS pct FROM events GROUP BY event_type""",
)
def _(spark, sf):
    pct = agg.percentile_sla(Tables(spark, sf).events, ["event_type"], "value", 0.95)
    return pct.withColumn("pct", F.round("pct", 6))


@query(
    "a18_pct_of_group",
    """SELECT c_custkey, round(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) * 100 / CAST(sum(CAST(c_acctbal AS DECIMAL(18,2)))
         OVER (PARTITION BY c_nationkey) AS DOUBLE), 2) AS pct FROM customer""",
)
def _(spark, sf):
    customer = Tables(spark, sf).customer.select("c_custkey", "c_nationkey", money("c_acctbal").alias("bal"))
    totals = customer.groupBy("c_nationkey").agg(F.sum("bal").cast("double").alias("t"))
    return agg.pct_of_group(customer, "c_nationkey", "bal").select("c_custkey", F.col("pct").cast("double").alias("pct"))


@query(
    "a19_pivot_env",
    """SELECT user_id, max(event_id) FILTER (event_type = 'click') AS click,
         max(event_id) FILTER (event_type = 'error') AS error,
         max(event_id) FILTER (event_type = 'purchase') AS purchase,
         max(event_id) FILTER (event_type = 'view') AS "view" FROM events GROUP BY user_id""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("user_id", "event_type", "event_id")
    return agg.pivot_env(events, ["user_id"], "event_type", F.max("event_id"), ["click", "error", "purchase", "view"])


# ---------------------------------------------------------------- order


@query("o01_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def _(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return sorting.sort_by(orders, [("o_totalprice", "desc"), "o_orderkey"])


@query(
    "o02_multi_key",
    """SELECT p_partkey, p_name, length(p_name) AS len FROM part ORDER BY len, p_name, p_partkey""",
)
def _(spark, sf):
    part = Tables(spark, sf).part.select("p_partkey", "p_name", F.length("p_name").cast("long").alias("len"))
    return sorting.sort_by(part, ["len", "p_name", "p_partkey"])


@query(
    "o03_nulls_last",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer
       ORDER BY bal ASC NULLS LAST, c_custkey LIMIT 2000000000""",
)
def _(spark, sf):
    bal = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("bal")
    return sorting.sort_by(Tables(spark, sf).customer.select("c_custkey", bal), [("bal", "asc", "last"), "c_custkey"])


@query(
    "o04_top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def _(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return sorting.take(orders, 25, [("o_totalprice", "desc"), "o_orderkey"])


@query("o05_skip", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 100")
def _(spark, sf):
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice")
    return sorting.skip(orders, 100, [("o_totalprice", "desc"), "o_orderkey"])


@query(
    "o05_keyset_page",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 1000",
)
def _(spark, sf):
    return sorting.page(Tables(spark, sf).orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 500, 1000)


@query("o06_find_first", "SELECT event_id, event_type FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 1")
def _(spark, sf):
    errors = Tables(spark, sf).events.filter("event_type = 'error'").select("event_id", "event_type")
    return sorting.first_row(errors, ["event_id"])
