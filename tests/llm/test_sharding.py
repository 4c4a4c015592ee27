"""Rendezvous sharding against a brute-force placement."""

import math
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from sentinela.llm.sharding import rendezvous_shard, shard_rows


def _place(spark, keys, weights):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    return {r.k: r.s for r in df.select("k", rendezvous_shard(F.col("k"), weights).alias("s")).collect()}


def test_moves_only_into_the_new_shard(spark):
    eight, nine = (_place(spark, range(3000), [1.0] * n) for n in (8, 9))
    moved = [k for k in eight if eight[k] != nine[k]]
    assert {nine[k] for k in moved} == {8}
    assert 0.07 < len(moved) / 3000 < 0.16
    assert all(300 < n < 450 for n in Counter(eight.values()).values())


def test_weights_set_the_shares(spark):
    got = Counter(_place(spark, range(6000), [1.0, 2.0, 3.0]).values())
    for shard, share in enumerate((1 / 6, 2 / 6, 3 / 6)):
        assert abs(got[shard] / 6000 - share) < 0.03


def test_highest_score_wins(spark):
    """The native expression against the scores worked out one by one."""
    weights = [1.0, 2.5, 0.5]
    rows = spark.range(40).select("id", *[
        F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), F.lit(i), F.lit(0)), 11).alias(f"h{i}") for i in range(3)
    ]).collect()
    got = _place(spark, range(40), weights)
    for r in rows:
        scores = [-w / math.log((r[f"h{i}"] + 0.5) / 2**53) for i, w in enumerate(weights)]
        assert got[r.id] == scores.index(max(scores))
    assert xxhash.xxh64_intdigest(b"7", seed=42) % (1 << 64) == spark.sql("select xxhash64('7') h").first().h % (1 << 64)


def test_slots_nulls_ties_clashes_and_empty(spark):
    rows = [(None, "a"), (None, "b"), (5, "x"), (5, "x"), (5, None)] + [(i, "t") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, shard string").withColumn("slot", F.lit("old")).withColumn("extra", F.lit(1))
    out = shard_rows(df, "doc_id", [1.0] * 8)
    assert out.columns == ["doc_id", "extra", "shard", "slot", "grown_shard"]
    got = out.collect()
    assert len(got) == len(rows)
    slots, shards = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        shards[r.doc_id].add((r.shard, r.grown_shard))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in shards.values())
    assert shard_rows(df.limit(0), "doc_id", [1.0] * 8).count() == 0
