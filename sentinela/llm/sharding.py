"""Rendezvous (highest random weight) hashing of stable keys over weighted shards.

Every shard scores every key with ``-weight / ln(u)``, ``u`` being a hash of key
and shard number in (0, 1); the highest score gets the row. A shard's score
depends on nothing else, so a new shard takes rows only into itself and a
removed one gives away only its own. Native expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _scores(key: Column, weights: Sequence[float], seed: int) -> list[Column]:
    """One (score, -shard) pair per shard; equal scores go to the lower shard."""
    text = F.coalesce(key.cast("string"), F.lit("\u0000null"))
    out = []
    for i, weight in enumerate(weights):
        bits = F.shiftrightunsigned(F.xxhash64(text, F.lit(i), F.lit(seed)), 11)
        u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        out.append(F.struct((F.lit(-float(weight)) / F.log(u)).alias("score"), F.lit(-i).alias("shard")))
    return out


def rendezvous_shard(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """Shard (0 … len(weights)-1) of ``key``. Weights are positive; a null key
    is one ordinary key of its own."""
    if not weights or min(weights) <= 0:
        raise ValueError("shard weights must be positive")
    scores = _scores(key, weights, seed)
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return -best["shard"]


def shard_rows(
    df: DataFrame,
    key: str,
    weights: Sequence[float],
    grown_weight: float | None = None,
    buckets: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """``df`` with ``shard``, ``slot`` (0, 1, … inside the shard, gapless) and
    ``grown_shard`` (the shard once one more shard of ``grown_weight`` is added).

    Slots are counted in two steps, so that no shard passes through one task:
    rows are numbered inside (shard, key bucket), and bucket totals (shards x
    buckets rows, a fixed bound) are summed up and broadcast. ``buckets``
    defaults to the session's number of shuffle partitions.

    Null keys share one shard; repeated keys share a shard, each row with its
    own slot; an empty table gives an empty result; input columns named like an
    output column are replaced.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = df.drop("shard", "slot", "grown_shard", "_bucket", "_within", "_before", "_n")
    k = F.col(f"`{key}`")
    text = F.coalesce(k.cast("string"), F.lit("\u0000null"))
    bucket = F.pmod(F.xxhash64(text, F.lit("bucket"), F.lit(seed)), F.lit(n)).cast("int")
    grown = rendezvous_shard(k, [*weights, grown_weight or 1.0], seed)
    placed = base.withColumns({"shard": rendezvous_shard(k, weights, seed), "grown_shard": grown, "_bucket": bucket})
    counted = (
        base.select(k)
        .select(rendezvous_shard(k, weights, seed).alias("shard"), bucket.alias("_bucket"))
        .groupBy("shard", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_bucket").orderBy(k)
    return (
        placed.withColumn("_within", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), ["shard", "_bucket"])
        .withColumn("slot", (F.col("_before") + F.col("_within")).cast("long"))
        .select(*base.columns, "shard", "slot", "grown_shard")
    )
