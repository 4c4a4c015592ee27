"""Column -> Column helpers, all built from native Spark expressions."""

from sentinela.functions.dates import (
    format_day,
    lenient_date,
    month_number,
    previous_month,
    year_month_date,
)
from sentinela.functions.numbers import lenient_double, strict_count, strict_long
from sentinela.functions.text import (
    comma_to_dot,
    na_to_null,
    repair_mojibake,
    strip_code,
    upper_equals,
)

__all__ = [
    "comma_to_dot",
    "format_day",
    "lenient_date",
    "lenient_double",
    "month_number",
    "na_to_null",
    "previous_month",
    "repair_mojibake",
    "strict_count",
    "strict_long",
    "strip_code",
    "upper_equals",
    "year_month_date",
]
