"""Sorted output without a sampling pass over its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.session import scratch_path

#: Rows that one task of the sort aims at.
ROWS_PER_TASK = 2_000_000


def sort_in_ranges(df: DataFrame, by: str, ties: Sequence[str] = (), rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` sorted by ``by`` and ``ties`` (ascending, NULLs first), over all partitions.

    ``orderBy`` evaluates its input twice, once for a sample. Here the rows are written once as
    they come; the cuts are of equal depth, from a histogram of ``by`` (a few columns of what was
    written). A value with more than ``rows_per_task`` rows is cut by the first of ``ties``, and so
    on; the histograms hold a row per value, and at the next column only for the heavy ones. Rows
    that agree in all these columns go to one task.
    """
    spark, keys = df.sparkSession, [by, *ties]
    path = scratch_path(spark, "sorted")
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)

    cells, heavy = None, None  # cells that are not cut further, of all depths
    for depth in range(1, len(keys) + 1):
        named = {k: f"_k{i}" for i, k in enumerate(keys[:depth])}
        part = rows.select(*[F.col(f"`{k}`").alias(n) for k, n in named.items()])
        if heavy is not None:
            above = list(named.values())[:-1]
            part = part.alias("p").join(heavy.alias("h"), [F.col(f"p.{n}").eqNullSafe(F.col(f"h.{n}")) for n in above], "left_semi")
        counted = part.groupBy(*named.values()).agg(F.count(F.lit(1)).alias("_n"))
        counted = _kept(counted, f"cells_{depth}").withColumn("_depth", F.lit(depth))
        last = depth == len(keys)
        done = counted if last else counted.filter(F.col("_n") <= rows_per_task)
        cells = done if cells is None else cells.unionByName(done, allowMissingColumns=True)
        heavy = counted.filter(F.col("_n") > rows_per_task).select(*named.values())
        if last or heavy.isEmpty():
            break

    order = [F.asc_nulls_first(c) for c in cells.columns if c.startswith("_k")]
    before = F.sum("_n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    task = F.floor(F.coalesce(before, F.lit(0)) / rows_per_task).cast("int")
    cells = _kept(cells.withColumn("_task", task), "cuts")
    tasks = (cells.agg(F.max("_task")).first()[0] or 0) + 1
    placed, found = rows, []
    for depth in range(1, len(keys) + 1):
        cut = cells.filter(F.col("_depth") == depth)
        if depth > 1 and cut.isEmpty():
            break
        names = [f"_k{i}" for i in range(depth)]
        cut = cut.select(*[F.col(n).alias(f"{n}_{depth}") for n in names], F.col("_task").alias(f"_task_{depth}"))
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"{n}_{depth}")) for k, n in zip(keys, names)]
        placed = placed.join(cut, same, "left")
        found.append(f"_task_{depth}")
    placed = placed.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(*found).alias("_task"))
    return placed.repartitionById(tasks, "_task").drop("_task").sortWithinPartitions(*[F.asc_nulls_first(f"`{k}`") for k in keys])


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "sorted", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
