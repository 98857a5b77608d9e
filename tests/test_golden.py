"""Small tables with known answers."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import tokens
from tidemark.operators import aggregates as agg
from tidemark.operators import joins, reports, rows, sorting, windows
from tidemark.streaming import keyed


@pytest.fixture(scope="module")
def employees(spark):
    data = [
        (1, "Alice", 10, 90000), (2, "Bob", 10, 85000), (3, "Carol", 10, 85000), (4, "Dave", 10, 70000),
        (5, "Eve", 20, 80000), (6, "Frank", 20, 75000), (7, "Grace", 20, 72000), (8, "Henry", 30, 65000),
    ]
    return spark.createDataFrame(data, "id int, name string, dept_id int, salary int").withColumn(
        "salary", F.col("salary").cast("decimal(10,2)")
    )


@pytest.fixture(scope="module")
def orders(spark):
    data = [
        (101, 1, "2024-01-05", 100), (102, 1, "2024-01-12", 150), (103, 1, "2024-01-20", 80),
        (104, 2, "2024-01-08", 200), (105, 2, "2024-01-15", 120), (106, 3, "2024-01-10", 90),
    ]
    return spark.createDataFrame(data, "order_id int, customer_id int, day string, amount int").withColumn(
        "day", F.to_date("day")
    )


@pytest.fixture(scope="module")
def staff(spark):
    data = [(1, "Alice", "IT", 80), (2, "Bob", "HR", 60), (3, "Carol", "IT", 90), (4, "Dave", "HR", 70)]
    return spark.createDataFrame(data, "seq int, name string, dept string, salary int")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_departments(spark, employees):
    names = spark.createDataFrame([(10, "Engineering"), (20, "Sales"), (30, "HR")], "id int, dept string")
    counted = joins.count_with_zeros(names, employees, "id", "dept_id")
    assert as_dict(counted, "dept", "n") == {"Engineering": 4, "Sales": 3, "HR": 1}
    assert {r.dept for r in counted.filter("n > 2").collect()} == {"Engineering", "Sales"}
    ordered = [r.dept for r in sorting.sort_by(names, ["dept"]).collect()]
    assert ordered == ["Engineering", "HR", "Sales"]


def test_orders_with_zeros(spark, orders):
    customers = spark.createDataFrame([(1, "Acme"), (2, "Beta"), (3, "Gamma"), (4, "Delta")], "id int, name string")
    counted = joins.count_with_zeros(customers, orders, "id", "customer_id")
    assert as_dict(counted, "name", "n") == {"Acme": 3, "Beta": 2, "Gamma": 1, "Delta": 0}
    nested = joins.nest(customers, orders, "id", "customer_id", ["day"], ["order_id"])
    lists = {r.name: [c.order_id for c in r.children] for r in nested.collect()}
    assert lists == {"Acme": [101, 102, 103], "Beta": [104, 105], "Gamma": [106], "Delta": []}
    paged = joins.nest(customers, orders, "id", "customer_id", ["day"], ["order_id"], page_size=2)
    pages = {(r.name, r.page): [c.order_id for c in r.children] for r in paged.collect()}
    assert pages[("Acme", 0)] == [101, 102] and pages[("Acme", 1)] == [103] and pages[("Delta", 0)] == []


def test_second_highest(spark, employees):
    assert [int(r.salary) for r in windows.nth_highest(employees, "salary", 2).collect()] == [85000]
    ranked = windows.global_rank(employees, [("salary", "desc")], "dense").filter("rnk = 2")
    assert {r.name for r in ranked.collect()} == {"Bob", "Carol"}
    people = spark.createDataFrame([(90000.0,), (80000.0,), (80000.0,), (60000.0,)], "salary double")
    assert windows.nth_highest(people, "salary", 3, distinct=False).first().salary == 80000
    assert windows.nth_highest(people, "salary", 9).count() == 0


def test_windows(employees, orders):
    near = windows.neighbors(employees.filter("dept_id = 10"), ["dept_id"], ["salary", "id"], ["salary"])
    got = {r.name: (r.prev_salary, r.next_salary) for r in near.collect()}
    d = Decimal
    assert got == {
        "Dave": (None, d(85000)), "Bob": (d(70000), d(85000)), "Carol": (d(85000), d(90000)), "Alice": (d(85000), None)
    }
    totals = windows.running(orders, ["customer_id"], ["day", "order_id"], "amount")
    assert as_dict(totals, "order_id", "running") == {101: 100, 102: 250, 103: 330, 104: 200, 105: 320, 106: 90}
    tiles = as_dict(windows.ntile(employees, 4, ["salary", "id"]), "name", "tile")
    assert tiles == {"Henry": 1, "Dave": 1, "Grace": 2, "Frank": 2, "Eve": 3, "Bob": 3, "Carol": 4, "Alice": 4}
    top = windows.top_n(employees, ["dept_id"], [("salary", "desc")], 2)
    assert as_dict(top, "name", "rnk") == {"Alice": 1, "Bob": 2, "Carol": 2, "Eve": 1, "Frank": 2, "Henry": 1}
    last = windows.first_last(employees, ["dept_id"], ["salary", "id"], ["name"])
    assert {r.last_name for r in last.filter("dept_id = 10").collect()} == {"Alice"}


def test_shares(employees):
    share = as_dict(agg.pct_of_group(employees, "dept_id", "salary"), "name", "pct")
    assert (float(share["Alice"]), float(share["Bob"])) == (27.27, 25.76)
    above = as_dict(joins.above_group_avg(employees, "dept_id", "salary"), "name", "above")
    assert {n for n, yes in above.items() if yes} == {"Alice", "Bob", "Carol", "Eve"}


def test_rollup_and_cube(spark):
    sales = spark.createDataFrame(
        [("North", "A", 1000), ("North", "B", 800), ("South", "A", 600), ("South", "B", 900)],
        "region string, product string, amount int",
    )
    sums = {"total": F.col("amount")}
    assert as_dict(agg.subtotals(sales, "rollup", ["region"], sums), "region", "total") == {
        "North": 1800, "South": 1500, None: 3300
    }
    cube = agg.subtotals(sales, "cube", ["region", "product"], sums).filter("region IS NULL AND product IS NOT NULL")
    assert as_dict(cube, "product", "total") == {"A": 1600, "B": 1700}


def test_trailing_sum(spark):
    clicks = spark.createDataFrame([(1, 5), (4, 10), (6, 2)], "t int, clicks int")
    got = windows.trailing_agg(clicks, "t", "clicks", 3, "t")
    assert as_dict(got, "t", "trailing") == {1: 5, 4: 10, 6: 12}


def test_recent_calls(spark):
    calls = spark.createDataFrame([(1,), (100,), (3001,), (3002,)], "t long")
    assert as_dict(windows.hits_at(calls, calls, "t", 3001), "t", "hits") == {1: 1, 100: 2, 3001: 3, 3002: 3}


def test_exposure(spark):
    data = [("L1", "B1", "S1", 5230000), ("L2", "B1", "S2", 3200000), ("L3", "B2", "S1", 12850000)]
    loans = spark.createDataFrame(data, "loan_id string, borrower_id string, security_id string, loan_value_usd long")
    out = {r.borrower_id: (r.exposure_usd, r.loans, r.share_pct) for r in reports.exposure(loans, ["borrower_id"]).collect()}
    assert out["B1"][:2] == (8430000, 2) and out["B2"][:2] == (12850000, 1)
    assert round(out["B1"][2] + out["B2"][2], 2) == 100


def test_shard_limits(spark):
    load = spark.createDataFrame(
        [(1, 800, 800 * 300), (2, 1200, 1200 * 200), (3, 400, 400 * 3000)], "shard int, records int, bytes long"
    )
    assert as_dict(keyed.with_throttle(load), "shard", "throttled_by") == {1: None, 2: "records", 3: "bytes"}


def test_tokens(spark):
    df = spark.createDataFrame(
        [("123-45-6789", "(555) 123-4567", "john.doe@example.com"), (None, None, None), ("12-3", "(555) 123-4567", "a@b.co")],
        "ssn string, phone string, email string",
    )
    spec = {"ssn": "ssn", "phone": "phone", "email": "email"}
    plain = tokens.tokenize_columns(df, spec)
    first, empty, bad = plain.collect()
    assert (first.ssn, first.email) == ("357-91-3579", "Z5Z6SY.1@UcS5960V0ba")
    assert empty.ssn is None and empty.reject_reasons == []
    assert bad.reject_reasons == ["ssn:not_ssn"] and bad.email is None
    back = tokens.detokenize_columns(plain, spec).first()
    assert (back.ssn, back.phone, back.email) == ("123-45-6789", "(555) 123-4567", "john.doe@example.com")
    hidden = tokens.tokenize_columns(df, spec, key="a", version=2)
    other = tokens.tokenize_columns(df, spec, key="b", version=2)
    assert hidden.first().ssn != other.first().ssn
    again = tokens.detokenize_columns(hidden, spec, key="a", version=2).first()
    assert (again.ssn, again.phone, again.email) == ("123-45-6789", "(555) 123-4567", "john.doe@example.com")


def test_long_email_obfuscation_round_trip(spark):
    name = "x_" * 320 + "y"
    df = spark.createDataFrame([(f"{name}@{'d' * 700}.com",)], "email string")
    there = tokens.tokenize_columns(df, {"email": "email"})
    assert tokens.detokenize_columns(there, {"email": "email"}).first().email == df.first().email


def test_keyed_tokens_are_a_permutation(spark):
    df = spark.range(2000).select(F.format_string("%03d-%02d-%04d", F.col("id") % 7, F.col("id") % 3, "id").alias("ssn"))
    out = tokens.tokenize_columns(df, {"ssn": "ssn"}, key="k")
    assert out.select("ssn").distinct().count() == df.distinct().count()


def test_collections(spark, staff):
    assert as_dict(staff.groupBy("dept").agg(F.avg("salary").alias("m")), "dept", "m") == {"IT": 85, "HR": 65}
    best = agg.top_row(staff, ["dept"], "salary", "seq")
    assert as_dict(best, "dept", "name") == {"IT": "Carol", "HR": "Dave"}
    joined = agg.join_strings(staff.withColumn("all", F.lit(1)), ["all"], "name", ", ", ["seq"], "[", "]")
    assert joined.first().joined == "[Alice, Bob, Carol, Dave]"
    pages = agg.join_strings(staff.withColumn("all", F.lit(1)), ["all"], "name", ", ", ["seq"], "[", "]", page_size=3)
    assert "".join(r.joined for r in pages.orderBy("page").collect()) == "[Alice, Bob, Carol, Dave]"
    parts = agg.partition_by(staff, F.col("salary") > 500, F.count("*").alias("n"))
    assert as_dict(parts, "flag", "n") == {True: None, False: 4}


def test_ties_keep_the_earliest(spark):
    df = spark.createDataFrame([(2, "b", 5), (1, "a", 5), (3, "c", 1)], "seq int, name string, v int").withColumn("g", F.lit(1))
    assert agg.top_row(df, ["g"], "v", "seq").first().name == "a"
    assert agg.top_row(df, ["g"], "v", "seq", lowest=True).first().name == "c"


def test_empty_input(spark):
    none = spark.createDataFrame([], "seq int, v int")
    stats = agg.summary_stats(none, "v").first()
    assert (stats.n, stats.total, stats.mean, stats.lowest) == (0, 0, 0, None)
    assert rows.all_match(none, F.col("v") > 1).first().matched is True
    assert rows.any_match(none, F.col("v") > 1).first().matched is False
    assert rows.none_match(none, F.col("v") > 1).first().matched is True
    assert rows.take_while(none, F.col("v") > 1, ["seq"]).count() == 0


def test_take_while_null_fails(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 1)], "seq int, v int")
    assert [r.seq for r in rows.take_while(df, F.col("v") < 3, ["seq"]).orderBy("seq").collect()] == [1, 2]
    assert [r.seq for r in rows.drop_while(df, F.col("v") < 3, ["seq"]).orderBy("seq").collect()] == [3, 4]
    assert rows.drop_while(df, F.lit(True), ["seq"]).count() == 0
    assert rows.all_match(df, F.col("v") < 3).first().matched is False


def test_words(spark):
    words = spark.createDataFrame(
        list(enumerate(["apple", "banana", "apricot", "berry", "avocado"])), "seq int, w string"
    ).withColumn("initial", F.substring("w", 1, 1))
    lists = agg.group_collect(words, ["initial"], "w", ["seq"])
    assert as_dict(lists, "initial", "items") == {"a": ["apple", "apricot", "avocado"], "b": ["banana", "berry"]}
    nums = spark.createDataFrame(list(enumerate([1, 2, 2, 3, 4, 4, 5, 6])), "seq int, n int")
    assert agg.first_non_repeating(nums, "n", ["seq"]).first().n == 1
    assert [r.n for r in sorting.skip(nums, 5, ["seq"]).orderBy("seq").collect()] == [4, 5, 6]
    assert sorted(r.n for r in agg.distinct_by_key(nums, ["n"], ["seq"]).collect()) == [1, 2, 3, 4, 5, 6]


def test_duplicate_keys_fail(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key 1"):
        agg.to_map(df, "k", "v").collect()


def test_nulls_last(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
    assert [r.v for r in sorting.sort_by(df, ["v"]).collect()] == [1, 2, None]
    assert [r.v for r in sorting.sort_by(df, [("v", "desc", "first")]).collect()] == [None, 2, 1]


def test_percentile_matches_builtin(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 101).cast("double").alias("v"))
    want = as_dict(df.groupBy("g").agg(F.percentile("v", 0.95).alias("p")), "g", "p")
    got = as_dict(agg.percentile_sla(df, ["g"], "v", 0.95), "g", "pct")
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_settlement(spark):
    day = dt.date(2024, 1, 15)
    df = spark.createDataFrame([(day,), (dt.date(2024, 1, 16),), (dt.date(2024, 1, 1),), (None,)], "settle_date date")
    out = as_dict(reports.settlement(df, F.lit(day)), "settlement_status", "loans")
    assert out == {"settling": 1, "pending": 1, "settled": 1, "unknown": 1}
