"""Document fingerprints by winnowing.

A text's k-grams (k code points) get rolling polynomial hashes; of every window of
``w`` neighbouring hashes the smallest is kept, the rightmost of equal ones, with its
position. Any passage of ``k + w - 1`` code points that two texts share then puts at
least one common hash into both fingerprints, and no match shorter than ``k`` does
(but for 32-bit collisions).

Defined results: a null text is an empty one and has no fingerprint; a text shorter
than ``k`` has one hash, that of the whole text, at position 0; one with fewer than
``w`` k-grams is one window. Two empty fingerprints are alike by 1.0. Repeated rows
are rows like others.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from sentinela.llm.common import add_columns, written

K = 24
WINDOW = 64
#: Bytes of text that one task of the neighbour pass aims at.
TASK_BYTES = 32 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_CHUNK = 1 << 16


class Winnower:
    """Hashes and positions of texts; the tables of powers are built once."""

    def __init__(self, k: int = K, window: int = WINDOW):
        if k < 1 or window < 1:
            raise ValueError("k and window must be positive")
        self.k, self.window = k, window
        size = _CHUNK + k + window
        self.powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, _BASE, np.uint64)])
        self.inverse = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)])

    def hashes(self, codes: np.ndarray) -> np.ndarray:
        """32-bit hash of every k-gram of at most ``_CHUNK + window + k`` codes: with prefix sums
        S of c[i] / B^i, the polynomial of c[i:i+k] is (S[i+k] - S[i]) * B^(i+k-1)."""
        k, n = min(self.k, len(codes)), len(codes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.inverse[:n], out=sums[1:])
        x = (sums[k:] - sums[: n - k + 1]) * self.powers[k - 1 : n]
        # the low bits of such a polynomial depend on the low bits of the codes only: mix
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return (x >> np.uint64(32)).astype(np.uint64)

    def select(self, hashes: np.ndarray, start: int) -> np.ndarray:
        """``hash << 32 | (2^32 - 1 - position)`` of each window's choice, in order, without
        repeats: the smallest such number is the smallest hash, the rightmost of equal ones."""
        keys = hashes << np.uint64(32) | (np.uint64(0xFFFFFFFF) - np.arange(start, start + len(hashes), dtype=np.uint64))
        w, span = min(self.window, len(keys)), 1
        while 2 * span <= w:
            keys = np.minimum(keys[:-span], keys[span:])
            span *= 2
        if span < w:
            keys = np.minimum(keys[: span - w], keys[w - span :])
        return keys[np.r_[True, keys[1:] != keys[:-1]]]

    def fingerprint(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, positions) as unsigned 32-bit numbers, by position."""
        codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        grams = max(len(codes) - self.k + 1, 1)
        windows = max(grams - self.window + 1, 1)
        parts = []
        for s in range(0, windows, _CHUNK):  # windows s .. s + _CHUNK - 1 in pieces of bounded size
            last = min(s + _CHUNK, windows) - 1 + self.window  # one past the last hash they see
            parts.append(self.select(self.hashes(codes[s : last + self.k - 1]), s))
        keys = np.concatenate(parts)
        keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
        return (keys >> np.uint64(32)).astype(np.uint32), (np.uint64(0xFFFFFFFF) - (keys & np.uint64(0xFFFFFFFF))).astype(np.uint32)


_ready: dict[tuple[int, int], Winnower] = {}


def winnower(k: int = K, window: int = WINDOW) -> Winnower:
    """One per worker and parameters."""
    if (k, window) not in _ready:
        _ready[k, window] = Winnower(k, window)
    return _ready[k, window]


def to_hex(hashes: np.ndarray, positions: np.ndarray) -> str:
    """Per kept hash 8 hex digits, then 8 of the distance from the one before (from -1)."""
    gaps = np.diff(positions.astype(np.int64), prepend=-1)
    return np.stack([hashes, gaps], axis=1).astype(">u4").tobytes().hex()


def from_hex(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(bytes.fromhex(fingerprint), ">u4").reshape(-1, 2)
    return both[:, 0].astype(np.uint32), (np.cumsum(both[:, 1].astype(np.int64)) - 1).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the sets of kept hashes."""
    x, y = set(a.tolist()), set(b.tolist())
    return len(x & y) / len(x | y) if x or y else 1.0


def shared_passages(text_a: str, text_b: str, k: int = K, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """``(start in a, start in b, length)`` of the passages that kept hashes point to: each common
    hash is checked and stretched to both sides. Holds every common passage of ``k + window - 1``."""
    (ha, pa_), (hb, pb) = winnower(k, window).fingerprint(text_a), winnower(k, window).fingerprint(text_b)
    where: dict[int, list[int]] = {}
    for h, p in zip(hb.tolist(), pb.tolist()):
        where.setdefault(h, []).append(p)
    found = set()
    for h, i in zip(ha.tolist(), pa_.tolist()):
        for j in where.get(h, ()):
            size = min(k, len(text_a), len(text_b))
            if text_a[i : i + size] != text_b[j : j + size]:
                continue
            lo = 0
            while lo < min(i, j) and text_a[i - lo - 1] == text_b[j - lo - 1]:
                lo += 1
            hi = size
            while i + hi < len(text_a) and j + hi < len(text_b) and text_a[i + hi] == text_b[j + hi]:
                hi += 1
            found.add((i - lo, j - lo, lo + hi))
    return sorted(found)


def fingerprints(
    docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW, keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with ``hashes array<long>`` and ``positions array<int>`` of every whole text. No shuffle;
    an input column of one of these names is replaced."""

    def compute(texts):
        both = [winnower(k, window).fingerprint(t) for t in texts]
        return [h.tolist() for h, _ in both], [p.tolist() for _, p in both]

    fields = [StructField("hashes", ArrayType(LongType())), StructField("positions", ArrayType(IntegerType()))]
    return add_columns(docs, text, fields, compute, keep)


NEIGHBOUR_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, other: str) -> str:
    """The last half of ``text`` replaced by as many code points from the head of ``other``."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _compared(rows: Iterator[tuple], k: int, window: int) -> Iterator[tuple]:
    """Rows ``(doc_id, text, guest)`` in order -> the results of all but the guests, each
    compared with the row after it."""
    make = winnower(k, window).fingerprint
    before = None
    for doc_id, text, guest in rows:
        text = text or ""
        now = (doc_id, text, make(text))
        if before is not None:
            yield _pair(before, now, make)
        before = now
        if guest:
            return


def _pair(one: tuple, after: tuple, make) -> tuple:
    doc_id, text, (hashes, positions) = one
    changed = edited(text, after[1])
    other = make(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id, len(text), digest, to_hex(hashes, positions), to_hex(*other),
        likeness(hashes, other[0]), likeness(hashes, after[2][0]),
    )


def neighbour_fingerprints(
    spark: SparkSession, docs: DataFrame, k: int = K, window: int = WINDOW, task_bytes: int = TASK_BYTES
) -> DataFrame:
    """Every document beside its edited text and the next document by descending ``doc_id``
    (null ids last; rows of one id by the XXH64 of their texts; after the last row the first).

    Returns ``NEIGHBOUR_SCHEMA``, one row per row of ``docs``. The order is cut into ranges of
    about ``task_bytes``; texts are shuffled once, to the task of their range. The first row of a
    range goes to the range before it as well, as a guest, so that the last row there meets its
    successor. The driver gets one key per range.
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # ascending order of these three is the wanted one: ~x reverses whole numbers without overflow
    key = [
        F.col("doc_id").isNull().cast("int").alias("k0"),
        F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).cast("long").alias("k1"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("k2"),
    ]
    keys = written(spark, src.select(*key, F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")), "winnow_keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    ranges = int(total // task_bytes) + 1
    dealt = keys.repartitionByRange(ranges, "k0", "k1", "k2")
    heads = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("k0", "k1", "k2")).alias("head"))
    starts = sorted(tuple(r.head) for r in heads.collect())  # one per range
    n = max(len(starts), 1)

    @F.pandas_udf("array<int>")
    def target(k0: pd.Series, k1: pd.Series, k2: pd.Series) -> pd.Series:
        out = []
        for one in zip(k0.tolist(), k1.tolist(), k2.tolist()):
            p = bisect_right(starts, one) - 1
            out.append([p, (p - 1) % n] if starts[p] == one else [p])
        return pd.Series(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*[batch.column(i).to_pylist() for i in range(3)])

        schema = pa.schema([(f.name, t) for f, t in zip(out_schema.fields, types)])
        made, size = [], 0
        for row in _compared(rows(), k, window):
            made.append(row)
            size += len(row[3]) + len(row[4])
            if size > 1 << 22 or len(made) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], schema=schema)
                made, size = [], 0
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], schema=schema)

    out_schema = StructType.fromDDL(NEIGHBOUR_SCHEMA)
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    placed = src.select("*", *key).withColumn("targets", target("k0", "k1", "k2"))
    placed = placed.select("doc_id", "text", "k0", "k1", "k2", F.posexplode("targets").alias("guest", "task"))
    sorted_rows = placed.repartitionById(n, "task").sortWithinPartitions("guest", "k0", "k1", "k2")
    return sorted_rows.select("doc_id", "text", (F.col("guest") == 1).alias("guest")).mapInArrow(run, out_schema)
