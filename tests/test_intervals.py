"""Interval joins on hot keys: the same rows as the plain join, in bounded tiles."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.plans.intervals import interval_join, tiled


def sides(spark, facts=60_000, versions=10_000):
    """A third of the facts and 10,000 versions at key 0; half of its facts within a hundredth of the time."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(0)).otherwise(1 + n % 500)
    spread = F.pmod(F.xxhash64(n, F.lit(1)), F.lit(1_000_000))
    at = F.when((n % 3 == 0) & (n % 2 == 0), 400_000 + F.pmod(spread, F.lit(10_000))).otherwise(spread)
    points = spark.range(facts).select(
        n.alias("fact"), F.when(n % 1000 != 7, key).alias("key"), F.when(n % 1001 != 9, at).alias("at")
    )
    start = F.when(n < versions, n * (1_000_000 // versions)).otherwise(F.pmod(n, F.lit(7)) * 150_000)
    ranges = spark.range(versions + 3500).select(
        n.alias("version"), F.when(n < versions, 0).otherwise(1 + n % 500).alias("k"), start.alias("start"),
        F.when(n % 50 == 3, None).otherwise(start + F.pmod(n, F.lit(9)) * (1_000_000 // versions)).alias("end"),
    )
    return points, ranges


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_the_plain_join(spark, how):
    points, ranges = sides(spark, 6000, 2000)
    points = points.unionByName(spark.createDataFrame([(-1, 0, 5000)] * 700, points.schema))  # equal times
    cond = (points["key"] == ranges["k"]) & (ranges["start"] <= points["at"]) & (ranges["end"].isNull() | (points["at"] < ranges["end"]))
    got = interval_join(points, ranges, [("key", "k")], points["at"], ranges["start"], ranges["end"], cond, how, 200, 100)
    want = points.join(ranges, cond, how)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_task_holds_a_hot_key(spark):
    points, ranges = sides(spark)
    a, b, added = tiled(points, ranges, [("key", "k")], points["at"], ranges["start"], ranges["end"], 1000, 500)
    assert added == ["tile0", "copy"]
    place = [f"_p{x}" for x in added]
    hot = a.where("key = 0")
    tiles = [r["count"] for r in hot.groupBy(*place).count().collect()]
    assert len(tiles) >= 20 and max(tiles) <= 2 * 1000
    # Comparisons of a task: points and ranges of the tiles that fall to it.
    counts = a.where("key IS NOT NULL").groupBy(F.col("key").alias("k"), *place).count()
    other = b.groupBy("k", *[F.col(f"_r{x}").alias(f"_p{x}") for x in added]).agg(F.count(F.lit(1)).alias("ranges"))
    # The partition that an exchange by these columns gives them.
    met = counts.join(other, ["k", *place]).withColumn("part", F.pmod(F.hash("k", *place), F.lit(8)))
    work = [r["work"] for r in met.groupBy("part").agg(F.sum(F.col("count") * F.col("ranges")).alias("work")).collect()]
    whole = hot.count() * ranges.where("k = 0").count()
    assert max(work) < whole / 20
    rows = [r["rows"] for r in met.groupBy("part").agg(F.sum("count").alias("rows")).collect()]
    assert max(rows) <= 2 * statistics.median(rows)


def test_versions_in_a_short_time_are_cut_again(spark):
    points = spark.range(40_000).select(F.lit(0).alias("key"), (F.col("id") * 25).alias("at"))
    ranges = spark.range(5000).select(F.lit(0).alias("k"), (500_000 + F.col("id")).alias("start"), (500_001 + F.col("id")).alias("end"))
    a, b, added = tiled(points, ranges, [("key", "k")], points["at"], ranges["start"], ranges["end"], 2000, 200)
    assert added == ["tile0", "tile1"]
    met = a.groupBy(F.col("_ptile0").alias("_rtile0"), F.col("_ptile1").alias("_rtile1")).agg(F.count(F.lit(1)).alias("points"))
    met = met.join(b.groupBy("_rtile0", "_rtile1").agg(F.count(F.lit(1)).alias("ranges")), ["_rtile0", "_rtile1"])
    # The cluster meets 200 points; uncut it would meet all 40,000.
    assert max(r.points * r.ranges for r in met.collect()) < 40_000 * 5000 / 200
    cond = (points["key"] == ranges["k"]) & (ranges["start"] <= points["at"]) & (points["at"] < ranges["end"])
    assert interval_join(points, ranges, [("key", "k")], points["at"], ranges["start"], ranges["end"], cond, "inner", 2000, 200).count() == 200


def test_asof_join_of_a_hot_key(spark):
    day = dt.date(2020, 1, 1)
    dim = spark.createDataFrame(
        [("a", day + dt.timedelta(i), day + dt.timedelta(i + 1) if i < 1499 else None, i) for i in range(1500)],
        "k string, effective_from date, effective_to date, v int",
    )
    facts = spark.createDataFrame([("a", day + dt.timedelta(i % 1600 - 50), i) for i in range(5000)] + [("b", day, -1), (None, day, -2)], "k string, d date, id int")
    got = {r.id: r.v for r in joins.asof_dim_join(facts, dim, "k", "d", tile_rows=300, many=100).collect()}
    want = {i: None if i % 1600 < 50 else min(i % 1600 - 50, 1499) for i in range(5000)} | {-1: None, -2: None}
    assert got == want


def test_other_joins_are_refused(spark):
    points, ranges = sides(spark, 10, 5)
    with pytest.raises(ValueError):
        interval_join(points, ranges, [("key", "k")], points["at"], ranges["start"], ranges["end"], F.lit(True), "full")
