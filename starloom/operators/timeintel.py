"""Same period last year, and growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.marts import exact_sum


def sales_per_day(fact: DataFrame, dim_date: DataFrame, measure: str, day: str) -> DataFrame:
    """``(Day, Amount)``: at most one row per day of the calendar."""
    sums = fact.groupBy("DateKey").agg(exact_sum(measure).alias("Amount"))
    days = dim_date.select("DateKey", F.col(day).alias("Day"))
    return sums.join(days, "DateKey").select("Day", "Amount")


def same_period_last_year(
    fact: DataFrame,
    dim_date: DataFrame,
    context: Sequence[str],
    measure: str = "SalesAmount",
    day: str = "FullDate",
) -> DataFrame:
    """Sales of each ``context`` (calendar columns; none = all days) and of its days one year
    earlier.

    The earlier days are the context's own days shifted back twelve months, each counted once
    (28 and 29 February shift to one day), as far as the calendar has them. So a year with data
    up to August is compared with January to August of the year before."""
    both = F.array(
        F.struct(F.lit(True).alias("Current"), F.col(day).alias("Day")),
        F.struct(F.lit(False).alias("Current"), F.add_months(day, -12).alias("Day")),
    )
    periods = (
        dim_date.select(*context, F.explode(both).alias("_p"))
        .select(*context, "_p.Current", "_p.Day")
        .distinct()
    )
    amounts = sales_per_day(fact, dim_date, measure, day)

    def total(current: bool):
        chosen = F.when(F.col("Current") == F.lit(current), F.col("Amount"))
        return F.sum(chosen).cast("decimal(29,4)")

    return (
        periods.join(amounts, "Day", "left")
        .groupBy(*context)
        .agg(total(True).alias("TotalSales"), total(False).alias("SalesLastYear"))
    )


def growth(
    fact: DataFrame,
    dim_date: DataFrame,
    context: Sequence[str],
    measure: str = "SalesAmount",
    day: str = "FullDate",
) -> DataFrame:
    """Adds ``GrowthRate`` (null when last year is absent or zero) and ``GrowthPct``, the rate
    in percent with two decimals, to ``same_period_last_year``."""
    now, before = F.col("TotalSales"), F.col("SalesLastYear")
    rate = F.when(
        before.isNotNull() & (before != 0),
        F.try_divide((now - before).cast("double"), before.cast("double")),
    )
    return same_period_last_year(fact, dim_date, context, measure, day).select(
        *context,
        "TotalSales",
        "SalesLastYear",
        rate.alias("GrowthRate"),
        F.round(rate * 100, 2).alias("GrowthPct"),
    )
