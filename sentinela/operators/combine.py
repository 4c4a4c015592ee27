"""Union of differing layouts and whole-cell value replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sentinela.functions.text import literal_map, replaced
from sentinela.operators.projection import all_text


def union_layouts(*dfs: DataFrame, fill: str | None = "0", na_text: str | None = "nan") -> DataFrame:
    """Union all by column name; columns missing from a frame become NULL.

    Every column is cast to STRING first: a text ``'2021'`` and an integer
    ``2020`` column must not widen to a number. The result keeps the first
    frame's column order, later new columns appended. With ``fill`` every
    NULL becomes ``fill`` and every whole cell equal to ``na_text`` too.
    """
    texts = [all_text(df) for df in dfs]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)
    if fill is not None:
        out = out.na.fill(fill)
        if na_text is not None:
            out = replace_values(out, {na_text: fill})
    return out


def replace_values(df: DataFrame, mapping: Mapping[str, str], cols: Sequence[str] | None = None) -> DataFrame:
    """Whole-cell replacement in the string columns (all by default).

    One map literal, searched pair by pair: for dictionaries of up to some
    hundred pairs. For larger ones see :func:`replace_from_table`.
    """
    if not mapping:
        return df
    lookup = literal_map(mapping)
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)
    }
    return df.select(*[
        replaced(c, lookup).alias(c) if c in targets else F.col(c) for c in df.columns
    ])


def replace_from_table(
    df: DataFrame, dictionary: DataFrame, cols: Sequence[str], old: str = "old", new: str = "new"
) -> DataFrame:
    """Whole-cell replacement by a dictionary table of any size.

    Cells equal to an ``old`` value become its ``new`` one (NULL included); NULL cells and
    those without an entry stay. Each column is one left join, hashed in memory or sorted as
    the dictionary's size has it. An ``old`` value given several times must have one ``new``
    value, or the job fails.
    """
    several = F.raise_error(F.concat(F.lit("two replacements for "), F.col("_old"))).cast("string")
    pairs = dictionary.select(F.col(old).cast("string").alias("_old"), F.struct(F.col(new).cast("string").alias("v")).alias("_new"))
    pairs = pairs.filter("_old IS NOT NULL").groupBy("_old").agg(F.min("_new").alias("_new"), F.max("_new").alias("_most"))
    pairs = pairs.select("_old", F.when(F.col("_new") == F.col("_most"), F.col("_new")).otherwise(F.struct(several.alias("v"))).alias("_new"))
    out = df
    for c in cols:
        out = out.join(pairs, F.col(c) == F.col("_old"), "left")
        value = F.when(F.col("_new").isNotNull(), F.col("_new")["v"]).otherwise(F.col(c))
        out = out.withColumn(c, value).select(*df.columns)
    return out


def stack_layouts(
    rows: DataFrame, names: str = "names", cells: str = "cells", keep: Sequence[str] = (), fill: str | None = "0", na_text: str | None = "nan"
) -> DataFrame:
    """Rows of any number of layouts -> one table, columns by name.

    A row carries its layout's column names and its cells as arrays of text (cells beyond the
    names are dropped, missing ones NULL). The table has a column per name found, in order of
    first appearance (by position in a layout, then by name), after ``keep``. One pass for the
    names, one for the rows: the plan does not grow with the layouts. As in
    :func:`union_layouts`, NULLs and cells equal to ``na_text`` become ``fill`` unless that is
    None. A name found twice in a layout, or equal to one of ``keep``, is an error.
    """
    places = rows.select(F.posexplode(names).alias("at", "name")).filter("name IS NOT NULL")
    found = places.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()  # one row per column
    columns = [r["name"] for r in found]
    clash = set(columns) & set(keep)
    if clash:
        raise ValueError(f"columns of the layouts and kept columns share names: {sorted(clash)}")
    pairs = F.arrays_zip(F.col(names).alias("k"), F.slice(cells, 1, F.greatest(F.size(names), F.lit(0))).alias("v"))
    named = F.filter(pairs, lambda x: x["k"].isNotNull())
    mapped = rows.select(*keep, F.map_from_entries(F.transform(named, lambda x: F.struct(x["k"], x["v"]))).alias("_cells"))

    def cell(name: str):
        value = F.try_element_at("_cells", F.lit(name))
        if fill is None:
            return value
        value = F.coalesce(value, F.lit(fill))
        return value if na_text is None else F.when(value == na_text, F.lit(fill)).otherwise(value)

    return mapped.select(*keep, *[cell(c).alias(c) for c in columns])
