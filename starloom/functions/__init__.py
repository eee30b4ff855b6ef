from starloom.functions.calendar import (
    calendar_columns,
    date_key,
    fiscal_columns,
    quarter_name,
    semester,
)
from starloom.functions.text import customer_type, full_name

__all__ = [
    "calendar_columns",
    "customer_type",
    "date_key",
    "fiscal_columns",
    "full_name",
    "quarter_name",
    "semester",
]
