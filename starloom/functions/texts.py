"""Values that operational tables hold as text: times, offsets, fractions, bits and money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for true and false in a bit column.
BITS = {"1": True, "0": False, "true": True, "false": False}


def timestamp_of(text: Column) -> Column:
    """The moment in UTC, without a zone, of a date and time with or without an offset. Digits
    beyond microseconds are cut. What is no timestamp becomes null."""
    moment = F.try_to_timestamp(F.regexp_replace(text, r"\s+([+-]\d{2}:?\d{2})$", "$1"))
    return F.convert_timezone(None, F.lit("UTC"), moment.cast("timestamp_ntz"))


def seconds_of_day(text: Column) -> Column:
    """Seconds since midnight of a time of day such as 07:00:00.0000000, to microseconds."""
    parts = F.split(text, ":")
    whole = parts[0].try_cast("int") * 3600 + parts[1].try_cast("int") * 60
    return whole + F.substring(parts[2], 1, 9).try_cast("decimal(8,6)")


def bit_of(text: Column) -> Column:
    """Boolean of 0 and 1, false and true; else null."""
    known = F.create_map(*[F.lit(x) for pair in BITS.items() for x in pair])
    return F.try_element_at(known, F.lower(F.trim(text)))


def money_of(text: Column) -> Column:
    """decimal(19,4) of an amount with an optional sign, currency mark and thousands commas."""
    return F.regexp_replace(text, r"[^0-9.\-]", "").try_cast("decimal(19,4)")
