"""SimHash near-duplicates by covering locality-sensitive hashing.

Radius r needs 2^(r+1) - 1 tables. Each bit position gets a non-zero vector of
r+1 bits, each table a non-zero vector v, and table v keeps the positions whose
vector has an odd product with v. Up to r differing positions span at most r
dimensions, so some v is orthogonal to all of them: that table masks every
difference out, and the pair is sure to collide there.

Rows with one fingerprint are one class before any table is built. A bucket with
more than ``bucket_limit`` fingerprints is cut by a second, independent set of
masks (again covering), and so on: no bucket is compared whole when it is large,
none is dropped. Buckets give star edges (one per member), never all pairs.
"""

from __future__ import annotations

import random
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from sentinela.llm.common import add_columns, written
from sentinela.llm.components import connected_components

_CHUNK = 1 << 16


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of the word shingles; 0 without words."""
    import xxhash

    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(size)))))
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), shingles), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _CHUNK):
        part = h[i : i + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])


def covering_masks(radius: int, level: int = 0, bits: int = 64) -> list[int]:
    """The kept-position masks of one covering family, as signed 64-bit numbers."""
    rng, top = random.Random(level), (1 << (radius + 1)) - 1
    vectors = [1 + i % top for i in range(bits)]
    rng.shuffle(vectors)
    masks = []
    for v in range(1, top + 1):
        m = sum(1 << i for i in range(bits) if (vectors[i] & v).bit_count() & 1)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _tables(rows: DataFrame, radius: int, level: int) -> DataFrame:
    """(t, kept, key, fp): one row per table of this level; ``kept`` is the union
    of the masks so far."""
    masks = covering_masks(radius, level)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).cast("long").alias("m")) for i, m in enumerate(masks)]))
    old: Column = F.col("t") if level else F.lit(0).cast("long")
    kept: Column = F.col("kept") if level else F.lit(0).cast("long")
    out = rows.select("fp", old.alias("t0"), kept.alias("k0"), each.alias("x")).select(
        (F.col("t0") * len(masks) + F.col("x.i")).cast("long").alias("t"), F.col("k0").bitwiseOR(F.col("x.m")).alias("kept"), "fp"
    )
    return out.withColumn("key", F.col("fp").bitwiseAND(F.col("kept")))


def bucket_roots(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Star edges (member, root) of the components, at ``radius`` bits, of one
    bucket of distinct fingerprints; the root is a component's first member."""
    left, edges = np.sort(fps), []
    while len(left):
        root, left = left[0], left[1:]
        frontier = [root]
        while frontier and len(left):
            near = np.bitwise_count((left ^ frontier.pop()).view(np.uint64)) <= radius
            if near.any():
                frontier.extend(left[near])
                edges.extend((int(x), int(root)) for x in left[near])
                left = left[~near]
    return edges


def _scan_buckets(radius: int, limit: int, last: bool):
    """Reads rows sorted by bucket; yields star edges, and unchanged the rows of
    buckets over ``limit``. Holds at most ``limit`` rows of a bucket."""

    def run(batches):
        held: list[np.ndarray] = []
        state = {"bucket": None, "n": 0, "over": False}
        edges: list[tuple[int, int]] = []

        def close():
            if state["n"] > 1 and not state["over"]:
                edges.extend(bucket_roots(np.concatenate(held), radius))
            held.clear()

        for b in batches:
            t, kept, key, fp = (b.column(i).to_numpy() for i in range(4))
            if not len(t):
                continue
            over_rows: list[slice] = []
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(t)]
            first = (int(t[0]), int(key[0]))
            more = (ends - starts) > 1
            more[0] = more[-1] = True  # these may go on in another batch
            for s, e in zip(starts[more], ends[more]):
                bucket = (int(t[s]), int(key[s]))
                if not (s == 0 and bucket == first == state["bucket"]):
                    close()
                    state.update(bucket=bucket, n=0, over=False)
                state["n"] += int(e - s)
                if state["over"]:
                    over_rows.append(slice(s, e))
                elif state["n"] > limit and not last:
                    state["over"] = True
                    if held:
                        old = np.concatenate(held)
                        yield _deferred(np.full(len(old), bucket[0]), np.full(len(old), kept[s]), old)
                        held.clear()
                    over_rows.append(slice(s, e))
                else:
                    held.append(fp[s:e])
            for x in over_rows:
                yield _deferred(t[x], kept[x], fp[x])
            if edges:
                yield _edges(edges)
                edges.clear()
        close()
        if edges:
            yield _edges(edges)

    return run


_OUT = "u long, v long, t long, kept long, fp long"


def _batch(u, v, t, kept, fp) -> pa.RecordBatch:
    cols = [pa.array(x, pa.int64()) for x in (u, v, t, kept, fp)]
    return pa.RecordBatch.from_arrays(cols, ["u", "v", "t", "kept", "fp"])


def _edges(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    none = [None] * len(edges)
    return _batch([a for a, _ in edges], [b for _, b in edges], none, none, none)


def _deferred(t, kept, fp) -> pa.RecordBatch:
    none = [None] * len(fp)
    return _batch(none, none, t, kept, fp)


def links(spark: SparkSession, fingerprints: DataFrame, radius: int = 3, bucket_limit: int = 1024, levels: int = 6) -> DataFrame:
    """Star edges (u, v) between distinct fingerprints (column ``fp``) whose
    components are exactly those of "at most ``radius`` bits apart"."""
    rows, found = fingerprints, None
    for level in range(levels):
        tables = _tables(rows, radius, level)
        sorted_ = tables.repartition("t", "key").sortWithinPartitions("t", "key").select("t", "kept", "key", "fp")
        out = written(spark, sorted_.mapInArrow(_scan_buckets(radius, bucket_limit, level == levels - 1), _OUT), "buckets")
        edges = out.where("u IS NOT NULL").select("u", "v")
        found = edges if found is None else found.unionByName(edges)
        rows = out.where("u IS NULL").select("t", "kept", "fp")
        if rows.isEmpty():
            break
    return found


def near_duplicate_components(
    spark: SparkSession,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 3,
    radius: int = 3,
    bucket_limit: int = 1024,
) -> DataFrame:
    """(doc_id, fp, root, component_id): ``fp`` the signed fingerprint, ``root`` the
    component's smallest one, ``component_id`` the smallest id reachable over links
    of at most ``radius`` bits.

    Null and empty texts have fingerprint 0 and link like any other; repeated
    texts share a class; a null id keeps its row and is never a component's id
    unless the component has no other; an empty table gives no rows; other
    columns are ignored.
    """
    base = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = add_columns(
        base, "text", [StructField("fp", LongType())], lambda texts: [[fingerprint(x, size) for x in texts]], keep=["doc_id"]
    )
    prints = written(spark, prints, "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    edges = links(spark, classes.select("fp"), radius, bucket_limit)
    roots = connected_components(spark, edges).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = rooted.join(lowest, "root").select("fp", "root", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "root", "component_id")


def one_of_each(
    spark: SparkSession, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, radius: int = 3
) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id.

    Ids that go are joined back by id alone. Rows with a null or a repeated id are
    told apart by their fingerprints as well; of those that remain alike, any one
    stays.
    """
    found = written(spark, near_duplicate_components(spark, docs, doc_id, text, size, radius), "components")
    odd = written(spark, found.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"), "odd_ids")
    key = F.col(f"`{doc_id}`")
    gone = written(spark, found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")), "gone")
    if odd.isEmpty():
        return docs.join(gone, key == F.col("_gone"), "left_anti")
    ids = odd.select(F.col("doc_id").alias("_odd"))
    plain = docs.join(gone, key == F.col("_gone"), "left_anti").join(ids, key.eqNullSafe(F.col("_odd")), "left_anti")
    prints = add_columns(
        docs.join(ids, key.eqNullSafe(F.col("_odd")), "left_semi"),
        text,
        [StructField("_fp", LongType())],
        lambda texts: [[fingerprint(x, size) for x in texts]],
    )
    mine = found.join(ids, F.col("doc_id").eqNullSafe(F.col("_odd")), "left_semi").select(
        F.col("doc_id").alias("_id"), F.col("fp").alias("_f"), F.col("root").alias("_root"), F.col("component_id").alias("_c")
    )
    first = mine.where("_id <=> _c").distinct()
    kept = prints.join(first, (F.col("_fp") == F.col("_f")) & key.eqNullSafe(F.col("_id"))).dropDuplicates(["_root"])
    return plain.unionByName(kept.select(*docs.columns))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
