"""Reports kept up load by load: sums of each load by key, merged when they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.marts import SUM_TYPE, largest_first
from starloom.plans.schemas import FACT
from starloom.sinks.atomic import AtomicStore, Load

LOAD, AMOUNT, LINES = "Load", "Amount", "Lines"


def partial_sums(lines: DataFrame, key: str, measure: str, load: str) -> DataFrame:
    """One row per key of a load's lines: Load, the key, Amount and Lines. Sums of sums are the sums
    of all lines, so they merge in any order; they are decimals, so order does not show either."""
    amount = F.sum(measure).cast(SUM_TYPE).alias(AMOUNT)
    sums = lines.groupBy(key).agg(amount, F.count(F.lit(1)).alias(LINES))
    return sums.select(F.lit(load).alias(LOAD), key, AMOUNT, LINES)


class KeptReports:
    """Tables ``sums_<key>`` beside a star in an ``AtomicStore``, one folder a load.

    A load adds the sums of its own lines only, in the same manifest as the lines: neither is ever
    there without the other, and a load that is repeated brings no lines and so no sums. Reports read
    the sums and the dimensions as they are now, never the fact.
    """

    def __init__(self, model: str, keys: Sequence[str] = ("ProductKey", "GeographyKey", "DateKey")):
        self.model, self.keys = model, list(keys)
        self.measure = "LineTotal" if model == "wide" else "SalesAmount"

    def add(self, load: Load, lines: DataFrame, mode: str = "append") -> None:
        """``lines`` are the rows that this load adds to the fact, or puts in its place; one pass for
        each key."""
        for key in self.keys:
            sums = partial_sums(lines, key, self.measure, load.name)
            load.write(f"sums_{key}", sums, mode)

    def withdraw(self, load: Load, name: str) -> None:
        """Takes a published load's lines, their record and their sums out again, in this load. Dimension
        rows stay, as later lines may use them. The lines can be loaded anew afterwards."""
        if not any(f"_loads/{name}/{FACT}" in folders for folders in load.tables.values()):
            raise ValueError(f"{name} is no load of this store, or it has been withdrawn")
        for table in (FACT, f"keys_{FACT}"):
            load.leave_out(table, name)
        for key in self.keys:
            if not load.leave_out(f"sums_{key}", name):  # its sums have been compacted
                rest = load.read(load.spark, f"sums_{key}").where(F.col(LOAD) != name)
                load.write(f"sums_{key}", rest, "overwrite")

    def compact(self, load: Load) -> None:
        """All sums of a key in one folder. They stay apart by load, so that each can be withdrawn."""
        for key in self.keys:
            held = load.read(load.spark, f"sums_{key}")
            load.write(f"sums_{key}", held.repartitionByRange(key).sortWithinPartitions(key), "overwrite")

    def reports(self, store: AtomicStore, spark: SparkSession) -> dict[str, DataFrame]:
        """Revenue by category, city and year as ``plans.star.reports`` gives it over the whole fact."""
        wide = self.model == "wide"
        category, year = ("ProductCategoryName", "CalendarYear") if wide else ("ProductCategory", "Year")

        def by(dim: str, key: str, attr: str) -> DataFrame:
            total = F.sum(AMOUNT).cast(SUM_TYPE).alias(AMOUNT)
            sums = store.read(spark, f"sums_{key}").groupBy(key).agg(total)
            rows = sums.join(store.read(spark, dim).select(key, attr), key)
            return rows.groupBy(attr).agg(F.sum(AMOUNT).cast(SUM_TYPE).alias("TotalRevenue"))

        return {
            "revenue_by_category": largest_first(by("DimProduct", "ProductKey", category), "TotalRevenue"),
            "revenue_by_city": largest_first(by("DimGeography", "GeographyKey", "City"), "TotalRevenue"),
            "revenue_by_year": by("DimDate", "DateKey", year).orderBy(year),
        }

    def lines(self, store: AtomicStore, spark: SparkSession) -> DataFrame:
        """Load and number of lines, as the sums of the first key have them."""
        sums = store.read(spark, f"sums_{self.keys[0]}")
        return sums.groupBy(LOAD).agg(F.sum(LINES).alias(LINES))
