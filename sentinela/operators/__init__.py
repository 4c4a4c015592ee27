"""DataFrame -> DataFrame operators."""

from sentinela.operators.combine import replace_from_table, replace_values, stack_layouts, union_layouts
from sentinela.operators.filters import drop_header_lines, drop_incomplete, drop_missing, region_filter
from sentinela.operators.ordering import sort_in_ranges
from sentinela.operators.projection import (
    all_text,
    rename,
    rename_select,
    slice_rows,
    with_constant,
)
from sentinela.operators.reshape import months_to_rows
from sentinela.operators.timeseries import daily_rollup, dates_by_first_value, monthly_mean_filled

__all__ = [
    "all_text",
    "daily_rollup",
    "dates_by_first_value",
    "drop_header_lines",
    "drop_incomplete",
    "drop_missing",
    "monthly_mean_filled",
    "months_to_rows",
    "region_filter",
    "rename",
    "rename_select",
    "replace_from_table",
    "replace_values",
    "stack_layouts",
    "slice_rows",
    "sort_in_ranges",
    "union_layouts",
    "with_constant",
]
