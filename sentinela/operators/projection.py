"""Row/column selection by position and by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _val(v: int | Column | None) -> Column | None:
    if v is None or isinstance(v, Column):
        return v
    return F.lit(v)


def row_range(start: int | Column = 0, end: int | Column | None = None, col: str = "row_index") -> Column:
    """``start <= col < end`` (``end`` NULL or None: open)."""
    pos = F.col(col)
    cond = pos >= _val(start)
    if end is not None:
        e = _val(end)
        cond = cond & (e.isNull() | (pos < e))
    return cond


def slice_rows(
    df: DataFrame,
    start: int | Column = 0,
    end: int | Column | None = None,
    col: str = "row_index",
) -> DataFrame:
    """Keep rows with ``start <= col < end`` (``end`` NULL or None: open).

    ``start``/``end`` may be columns, so one pass serves sources with
    different bounds (e.g. one layout per page).
    """
    return df.filter(row_range(start, end, col))


def rename_select(df: DataFrame, mapping: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Rename (absent names ignored) and keep ``keep`` in that order."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present).select(*keep)


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename one column; an absent name is ignored."""
    return df.withColumnRenamed(old, new)


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def all_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast columns (all by default) to STRING."""
    cols = df.columns if cols is None else cols
    return df.select(*[F.col(c).cast("string").alias(c) if c in cols else F.col(c) for c in df.columns])
