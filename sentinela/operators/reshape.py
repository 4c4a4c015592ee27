"""Wide month columns -> one row per month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def months_to_rows(
    df: DataFrame,
    ids: Sequence[str],
    value_cols: Sequence[str],
    var_name: str = "mes",
    value_name: str = "casos",
    dtype: str = "string",
) -> DataFrame:
    """Unpivot ``value_cols`` into (``var_name``, ``value_name``) rows.

    NULL values are kept; values are cast to one type first. Row-local, no
    shuffle: each row becomes an array of (name, value) structs, inlined by
    a generator. (``DataFrame.unpivot`` plans an ``Expand`` whose string
    outputs, in Spark 4.1, break whole-stage code generation of a following
    projection with common subexpressions; the stage then runs interpreted.)
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias(var_name), F.col(c).cast(dtype).alias(value_name)) for c in value_cols
    ])
    return df.select(*ids, F.inline(pairs))
