"""Calendar expressions. All are built-in Spark functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: Column | str) -> Column:
    """Readable integer key of a day: 2013-05-09 -> 20130509."""
    c = _col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def quarter_name(quarter: Column) -> Column:
    """``Q 3``: the separator is part of the published value."""
    return F.concat_ws(" ", F.lit("Q"), quarter)


def semester(quarter: Column) -> Column:
    return F.when(quarter.isin(1, 2), F.lit("H1")).otherwise(F.lit("H2"))


def calendar_columns(c: Column | str) -> dict[str, Column]:
    """Every calendar attribute of a day, by its column name in the wide calendar."""
    c = _col(c)
    return {
        "DateKey": date_key(c),
        "DayNumberOfMonth": F.dayofmonth(c),
        "DayNameOfWeek": F.date_format(c, "EEEE"),
        "DayNumberOfWeek": F.dayofweek(c),
        "DayNumberOfYear": F.dayofyear(c),
        "WeekNumberOfYear": F.weekofyear(c),
        "MonthNumberOfYear": F.month(c),
        "MonthName": F.date_format(c, "MMMM"),
        "QuarterNumberOfYear": F.quarter(c),
        "QuarterName": quarter_name(F.quarter(c)),
        "CalendarYear": F.year(c),
        "CalendarSemester": semester(F.quarter(c)),
    }


def fiscal_columns(c: Column | str, start_month: int = 1) -> dict[str, Column]:
    """Fiscal attributes for a year that starts in ``start_month``; the fiscal year is named
    after the calendar year in which it ends. With 1 they equal the calendar ones."""
    if not 1 <= start_month <= 12:
        raise ValueError("start_month must be 1..12")
    shifted = F.add_months(_col(c), (13 - start_month) % 12)
    return {
        "FiscalQuarter": F.quarter(shifted),
        "FiscalYear": F.year(shifted),
        "FiscalSemester": semester(F.quarter(shifted)),
    }
