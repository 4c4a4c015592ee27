"""Nearest neighbours by vantage-point trees, one per shard.

Rows go to shards of bounded size by a hash of their id. Each shard's tree keeps,
for both halves below a node, the range of distances to its vantage point; a
half is skipped if the triangle inequality puts all of it beyond the k-th best
distance so far. ``factor`` scales that lower bound: 1 is exact search, larger
values skip more.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentinela.llm.common import written

LEAF = 96


def build_tree(ids: np.ndarray, vectors: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of one tree. Rows are reordered so that a node is a range of rows;
    nodes: begin, end, left, right (0: leaf), and the halves' distance ranges to
    the vantage point, which is the node's first row."""
    order = np.lexsort((ids,))
    nodes: list[list[float]] = []
    todo = [(0, len(ids), None, 0)]
    while todo:
        begin, end, parent, side = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][2 + side] = me
        nodes.append([begin, end, 0, 0, 0.0, 0.0, 0.0, 0.0])
        if end - begin <= LEAF:
            continue
        rows = order[begin:end]
        # of a few spread candidates, the one whose distances vary most
        tries = rows[np.linspace(0, len(rows) - 1, 5).astype(int)]
        probe = vectors[rows[:: max(1, len(rows) // 64)]]
        spread = [np.sqrt(((probe - vectors[t]) ** 2).sum(1)).std() for t in tries]
        vantage = tries[int(np.argmax(spread))]
        rest = rows[rows != vantage]
        d = np.sqrt(((vectors[rest] - vectors[vantage]) ** 2).sum(1))
        by = np.argsort(d, kind="stable")
        rest, d = rest[by], d[by]
        half = len(rest) // 2
        order[begin], order[begin + 1 : end] = vantage, rest
        nodes[me][4:] = [d[0], d[half - 1], d[half], d[-1]]
        todo += [(begin + 1 + half, end, me, 1), (begin + 1, begin + 1 + half, me, 0)]
    return {"ids": ids[order], "vectors": vectors[order], "nodes": np.array(nodes, np.float64).reshape(-1, 8)}


class _Best:
    """The k best (distance, id) of every query, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.dist = np.full((n, k), np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, who: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> None:
        """Candidates ``ids`` with distances ``dist`` (queries x candidates)."""
        d = np.concatenate([self.dist[who], dist], axis=1)
        i = np.concatenate([self.ids[who], np.broadcast_to(ids, dist.shape)], axis=1)
        best = np.lexsort((i, d), axis=1)[:, : self.k]
        self.dist[who], self.ids[who] = np.take_along_axis(d, best, 1), np.take_along_axis(i, best, 1)


def search_tree(tree: dict[str, np.ndarray], q_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> _Best:
    """All queries walk the tree together; each goes to its nearer half first."""
    best, ids, vectors, nodes = _Best(len(q_ids), k), tree["ids"], tree["vectors"], tree["nodes"]

    def compare(who: np.ndarray, begin: int, end: int) -> np.ndarray:
        out = np.empty((len(who), end - begin))
        for s in range(0, len(who), 256):
            w = who[s : s + 256]
            out[s : s + 256] = np.sqrt(((queries[w][:, None, :] - vectors[None, begin:end]) ** 2).sum(2))
        own = q_ids[who][:, None] == ids[None, begin:end]
        best.add(who, np.where(own, np.inf, out), ids[begin:end])
        return out

    def visit(node: int, who: np.ndarray) -> None:
        if not len(who):
            return
        begin, end, left, right = nodes[node, :4].astype(int)
        if not right:
            compare(who, begin, end)
            return
        d = compare(who, begin, begin + 1)[:, 0]
        lo1, hi1, lo2, hi2 = nodes[node, 4:]
        far_left = np.maximum(0, np.maximum(lo1 - d, d - hi1)) * factor
        far_right = np.maximum(0, np.maximum(lo2 - d, d - hi2)) * factor
        first_left = far_left <= far_right
        for half, bound, first in ((left, far_left, first_left), (right, far_right, ~first_left)):
            visit(half, who[first & (bound <= best.dist[who, -1])])
        for half, bound, first in ((left, far_left, first_left), (right, far_right, ~first_left)):
            visit(half, who[~first & (bound <= best.dist[who, -1])])

    if len(ids):
        visit(0, np.arange(len(q_ids)))
    return best


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as z:
        return {n: z[n] for n in z.files}


def usable(vector: str):
    """Not null, not zero, and every component a finite number."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def nearest_neighbours(
    spark: SparkSession,
    vectors: DataFrame,
    is_query,
    k: int = 10,
    factor: float = 1.15,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = 8192,
    block_rows: int = 4096,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest rows found for
    each query row (condition ``is_query`` on the id column), by Euclidean
    distance in double precision on the original vectors, ties to the smaller id.

    Every row is indexed. Trees and query blocks are rows of bounded size in
    written tables; each block meets each tree of its dimension once, and only k
    rows per query and tree are shuffled. Rows with a null id, or a vector that
    is null, zero or not finite, take no part; vectors of other dimensions are
    no candidates; rows with the query's id are its own; among rows that repeat
    a query's id the least vector is the query; empty tables give no rows.
    """
    base = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"))
    base = base.where(F.col("id").isNotNull() & usable("v")).withColumn("dim", F.size("v"))
    n = base.count()
    shards, queries = max(1, -(-n // shard_rows)), base.where(is_query(F.col("id")))
    queries = queries.groupBy("id", "dim").agg(F.min("v").alias("v"))
    blocks = max(1, -(-queries.count() // block_rows))

    def arrays(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()).astype(np.float64)

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        blob = _pack(**build_tree(*arrays(pdf)))
        return pd.DataFrame({"dim": [key[0]], "part": [key[1]], "blob": [blob]})

    def block(key, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, v = arrays(pdf)
        return pd.DataFrame({"dim": [key[0]], "part": [key[1]], "blob": [_pack(ids=ids, vectors=v)]})

    def grouped(df: DataFrame, parts: int, name: str, make) -> DataFrame:
        part = F.pmod(F.xxhash64("id", "v", F.lit(name)), F.lit(parts)).cast("int")
        rows = df.withColumn("part", part).repartition(parts, "dim", "part") if parts > 1 else df.withColumn("part", F.lit(0))
        return written(spark, rows.groupBy("dim", "part").applyInPandas(make, "dim int, part int, blob binary"), name)

    trees = grouped(base, shards, "trees", build)
    asked = grouped(queries, blocks, "query_blocks", block)

    def search(batches):
        for b in batches:
            for tree, q in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                q = _unpack(q)
                best = search_tree(_unpack(tree), q["ids"], q["vectors"], k, factor)
                who, place = np.nonzero(np.isfinite(best.dist))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q["ids"][who]), pa.array(best.ids[who, place]), pa.array(best.dist[who, place])],
                    ["query_id", "vec_id", "score"],
                )

    pairs = trees.withColumnRenamed("blob", "tree").join(asked.select("dim", F.col("part").alias("b"), "blob"), "dim")
    # one tree and one block at a time in a task's memory
    pairs = pairs.repartition(max(1, min(shards * blocks, 100_000)), F.xxhash64("dim", "part", "b")).select("tree", "blob")
    found = pairs.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
