"""Range-partitioned plans must equal plain windows, with and without hot keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import windows
from tidemark.plans import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        key = None if i % 50 == 0 else ("hot" if rng.random() < 0.4 else f"k{rng.randrange(60)}")
        rows.append((i, key, rng.randrange(40), None if i % 11 == 0 else rng.randrange(100)))
    df = spark.createDataFrame(rows, "id long, k string, v int, x long").repartition(6)
    return df.cache()


def rows_of(df, *cols):
    return sorted(df.select(*cols).collect(), key=repr)


@pytest.mark.parametrize("limit", [None, 50, 0])
def test_row_number_and_running(skewed, limit):
    window = Window.partitionBy("k").orderBy("v", "id")
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    got = ordering.keyed_row_number(skewed, ["k"], ["v", "id"], "rn", limit)
    want = skewed.withColumn("rn", F.row_number().over(window))
    assert rows_of(got, "id", "rn") == rows_of(want, "id", "rn")
    for kind in ("sum", "count", "max", "min"):
        got = ordering.keyed_running(skewed, ["k"], ["v", "id"], "x", "r", kind, limit)
        want = skewed.withColumn("r", getattr(F, kind)("x").over(upto))
        assert rows_of(got, "id", "r") == rows_of(want, "id", "r"), kind


@pytest.mark.parametrize("limit", [None, 50, 0])
def test_neighbors(skewed, limit):
    window = Window.partitionBy("k").orderBy(F.col("v").desc(), "id")
    got = windows.neighbors(skewed, ["k"], [("v", "desc"), "id"], ["x"], limit=limit)
    want = skewed.withColumn("prev_x", F.lag("x").over(window)).withColumn("next_x", F.lead("x").over(window))
    assert rows_of(got, "id", "prev_x", "next_x") == rows_of(want, "id", "prev_x", "next_x")


@pytest.mark.parametrize("limit", [None, 50, 0])
@pytest.mark.parametrize("kind", ["rank", "dense"])
def test_rank(skewed, limit, kind):
    window = Window.partitionBy("k").orderBy("v")
    fn = F.rank() if kind == "rank" else F.dense_rank()
    got = windows.ranked(skewed, ["k"], ["v"], kind, "r", limit)
    assert rows_of(got, "id", "r") == rows_of(skewed.withColumn("r", fn.over(window)), "id", "r")


@pytest.mark.parametrize("limit", [None, 50])
def test_range_and_ntile(skewed, limit):
    peers = Window.partitionBy("k").orderBy("v").rangeBetween(Window.unboundedPreceding, 0)
    got = windows.running(skewed, ["k"], ["v"], "x", "range", "r", limit)
    assert rows_of(got, "id", "r") == rows_of(skewed.withColumn("r", F.sum("x").over(peers)), "id", "r")
    window = Window.partitionBy("k").orderBy("v", "id")
    got = windows.ntile(skewed, 7, ["v", "id"], ["k"], "t", limit)
    assert rows_of(got, "id", "t") == rows_of(skewed.withColumn("t", F.ntile(7).over(window)), "id", "t")


def test_global(skewed):
    window = Window.orderBy(F.col("v").desc(), "id")
    got = ordering.global_row_number(skewed, [("v", "desc"), "id"])
    assert rows_of(got, "id", "rn") == rows_of(skewed.withColumn("rn", F.row_number().over(window)), "id", "rn")
    got = ordering.global_running(skewed, ["v", "id"], "v", "s")
    upto = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows_of(got, "id", "s") == rows_of(skewed.withColumn("s", F.sum("v").over(upto)), "id", "s")
    fine = skewed.withColumn("d", F.when(F.col("v") > 5, F.col("x").cast("decimal(18,4)") / 8).cast("decimal(18,4)"))
    got = ordering.global_running(fine, ["v", "id"], "d", "s")
    assert rows_of(got, "id", "s") == rows_of(fine.withColumn("s", F.sum("d").over(upto)), "id", "s")


def test_empty_global(spark):
    none = spark.createDataFrame([], "id long, v int")
    assert ordering.global_row_number(none, ["id"]).count() == 0
    assert ordering.global_running(none, ["id"], "v").count() == 0
    assert windows.ntile(none, 4, ["id"]).count() == 0


def test_global_ranks(skewed):
    for kind, fn in (("rank", F.rank()), ("dense", F.dense_rank())):
        got = windows.global_rank(skewed, ["v"], kind, "r")
        want = skewed.withColumn("r", fn.over(Window.orderBy("v")))
        assert rows_of(got, "id", "r") == rows_of(want, "id", "r")


@pytest.mark.parametrize("buckets", [3, 7, 5000])
def test_global_ntile(skewed, buckets):
    got = windows.ntile(skewed, buckets, ["v", "id"], name="t")
    want = skewed.withColumn("t", F.ntile(buckets).over(Window.orderBy("v", "id")))
    assert rows_of(got, "id", "t") == rows_of(want, "id", "t")


@pytest.mark.parametrize("kind", ["sum", "count", "max", "min"])
@pytest.mark.parametrize("keyed", [True, False])
def test_trailing_against_loop(spark, kind, keyed):
    rng = random.Random(3)
    events = [(i, rng.choice("ab"), rng.randrange(120), rng.randrange(50)) for i in range(400)]
    df = spark.createDataFrame(events, "seq int, k string, t int, x int")
    for k in (1, 40):
        got = windows.trailing_agg(
            df, "t", "x", k, "seq", kind, ["k"] if keyed else [], width=16, limit=None if k == 1 else 5
        )
        fold = {"sum": sum, "count": len, "max": max, "min": min}[kind]
        want = []
        for seq, key, t, _ in events:
            frame = [
                x
                for s2, k2, t2, x in events
                if (not keyed or k2 == key) and t - k + 1 <= t2 <= t and (t2 < t or s2 <= seq)
            ]
            want.append((seq, fold(frame)))
        assert sorted((r.seq, r.trailing) for r in got.collect()) == want


def test_no_single_task_window(skewed):
    plan = ordering.global_row_number(skewed, ["v", "id"])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan
