"""Page layouts of the yearly case tables.

A layout says where, on the grid of a page's first table, the data rows
start (and end), which column holds the health region, which the
municipality, how many value cells follow it, and whether a leading
municipality code must be removed. One layout per (disease, year); pages are
joined to it, so one Spark job handles every disease and year at once.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from sentinela.fixed import LAYOUT_TABLE


class Layout(NamedTuple):
    disease: str
    year: int
    first_row: int
    end_row: int | None
    region_col: int
    municipality_col: int
    n_values: int
    strip_code: bool


LAYOUT_SCHEMA = (
    "disease string, year int, first_row int, end_row int, region_col int, "
    "municipality_col int, n_values int, strip_code boolean"
)

# The published pages' layouts (values in ``sentinela.fixed``).
PUBLISHED_LAYOUTS = [Layout(*row) for row in LAYOUT_TABLE]


def layout_frame(spark: SparkSession, layouts: Iterable[Layout] = PUBLISHED_LAYOUTS) -> DataFrame:
    """The layout table as a (small, literal) DataFrame."""
    return spark.createDataFrame([tuple(x) for x in layouts], LAYOUT_SCHEMA)


def attach_layouts(pages: DataFrame, layouts: DataFrame) -> DataFrame:
    """Pages joined to their layout on (disease, year); pages without one
    are dropped. Spark broadcasts the layouts while they are below its size
    threshold, so the pages are not shuffled."""
    return pages.join(layouts, ["disease", "year"], "inner")


def pages_without_layout(pages: DataFrame, layouts: DataFrame) -> DataFrame:
    """Pages whose (disease, year) has no layout (they are not read)."""
    return pages.join(layouts.select("disease", "year"), ["disease", "year"], "left_anti")
