"""Securities-lending reports at their report grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import subtotals
from tidemark.operators.windows import top_n
from tidemark.plans.ordering import join_keys


def daily_positions(positions: DataFrame, date=None) -> DataFrame:
    """Value and number of loans per day."""
    if date is not None:
        positions = positions.filter(F.col("file_date") == F.lit(date))
    return positions.groupBy("file_date").agg(
        F.sum("loan_value_usd").alias("total_value_usd"), F.count_distinct("loan_id").alias("loan_count")
    )


def top_exposures(positions: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` largest borrowers (or securities) of each day, by value."""
    sums = positions.groupBy("file_date", by).agg(F.sum("loan_value_usd").alias("value_usd"))
    return top_n(sums, ["file_date"], [("value_usd", "desc"), by], k, ties=False)


def exposure(df: DataFrame, by: Sequence[str], value: str = "loan_value_usd", within: Sequence[str] = ()):
    """Sum, count and percentage of the total (of ``within``) per group."""
    groups = df.groupBy(*within, *by).agg(F.sum(value).alias("exposure_usd"), F.count("*").alias("loans"))
    if within:
        totals = groups.groupBy(*within).agg(F.sum("exposure_usd").alias("_total"))
        groups = join_keys(groups, totals, within)
        total = F.col("_total")
    else:
        total = groups.agg(F.sum("exposure_usd")).scalar()
    share = F.round(F.col("exposure_usd") * 100 / F.nullif(total, F.lit(0)), 2)
    return groups.withColumn("share_pct", share).drop("_total")


def daily_pnl(pnl: DataFrame) -> DataFrame:
    """P&L, rebate, fee and value change per day with book, desk and day totals.

    ``level_id``: 0 book and desk, 1 book total, 2 desk total, 3 day total.
    """

    def part(name):
        return F.coalesce(name, F.lit(0))

    sums = {
        "pnl_usd": part("pnl_usd"),
        "rebate_usd": part("rebate_income_usd"),
        "fee_usd": part("fee_income_usd"),
        "mtm_change_usd": part("mtm_value_current_usd") - part("mtm_value_prev_usd"),
    }
    day, book, desk = levels = ["file_date", "book_id", "desk_id"]
    return subtotals(pnl, "sets", levels, sums, [levels, [day, book], [day, desk], [day]])


def collateral(positions: DataFrame, by: Sequence[str] = ("file_date", "collateral_type")) -> DataFrame:
    """Collateral against loan value; coverage is their ratio."""
    return positions.groupBy(*by).agg(
        F.sum("loan_value_usd").alias("loan_value_usd"), F.sum("collateral_value_usd").alias("collateral_usd")
    ).withColumn(
        "coverage", F.round(F.col("collateral_usd") / F.nullif(F.col("loan_value_usd"), F.lit(0)), 4)
    )


def settlement(positions: DataFrame, date: Column) -> DataFrame:
    """Loans per settlement state on the report date."""
    state = (
        F.when(F.col("settle_date").isNull(), "unknown")
        .when(F.col("settle_date") > date, "pending")
        .when(F.col("settle_date") == date, "settling")
        .otherwise("settled")
    )
    return positions.groupBy(state.alias("settlement_status")).agg(F.count("*").alias("loans"))


def trend(df: DataFrame, date: str, grain: str, levels: Sequence[str], value: str) -> DataFrame:
    """Value per period with subtotals up the business hierarchy."""
    dated = df.withColumn("period", F.to_date(F.date_trunc(grain, F.col(date))))
    sets = [["period", *levels[:n]] for n in range(len(levels), -1, -1)]
    return subtotals(dated, "sets", ["period", *levels], {"value": F.col(value)}, sets)
