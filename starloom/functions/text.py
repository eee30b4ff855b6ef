"""String expressions of the customer dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(*parts: str, blank_middle: bool = False) -> Column:
    """Name parts joined by one space, nulls left out (all null gives ``''``, not null).

    ``blank_middle`` reads a null inner part as an empty one, which leaves two spaces."""
    if not blank_middle:
        return F.concat_ws(" ", *parts)
    inner = [F.coalesce(F.col(p), F.lit("")) for p in parts[1:-1]]
    return F.concat_ws(" ", F.col(parts[0]), *inner, F.col(parts[-1]))


def customer_type(store_id: str) -> Column:
    return F.when(F.col(store_id).isNotNull(), F.lit("Store")).otherwise(F.lit("Individual"))
