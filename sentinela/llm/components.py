"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.llm.common import written


def connected_components(spark: SparkSession, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the smallest
    node of the component.

    Large-star links each node's larger neighbours to its smallest neighbour,
    small-star does the same with the smaller ones; every round is group-by-min
    (combined before the shuffle) and an equi-join, written to the shared folder.
    The number of rounds grows with the logarithm of the component size. Loops
    and repeated edges are allowed; no edges give no rows.
    """
    e = written(spark, _down(edges.select("u", "v")), "edges")
    before = None
    for _ in range(max_rounds):
        e = written(spark, _small_star(_large_star(e)), "edges")
        # unchanged when every edge already is a star edge and the set is the same
        now = e.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _down(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    return (
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return _down(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(low, "u")
    return _down(
        linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    )
