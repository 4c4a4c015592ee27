"""Filter interaction audit on a sparse document-term matrix.

The matrix is built in CSR shards: a block of documents is split into words once, each
shard with a dictionary of its own; the shards' dictionaries are then dealt to hash
buckets, where every distinct word of the corpus gets one id. Only a shard's distinct words
are dealt, so a word of every document comes once per shard. Row sums are word counts,
nonzero counts are distinct words; with the other flags of a document they make a mask of
failed filters, and only counts per (part, mask, labels) go on to the orders.

Filters (words: maximal runs of anything but blank and \\x09-\\x0D, case-sensitive):

    A  under 100 words                      D  holds any of # $ % & * |
    B  100 * distinct words < 80 * words    E  same text as a row of smaller doc_id
    C  100 * [A-Z] > 10 * code points

Defined results: a null text is empty, a null ``lang`` is part ''. A row without doc_id has
no smaller one and is none; rows of one id and text do not duplicate each other. A document
with several label rows is good (toxic) if one of them says so. Empty tables give no part.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentinela.llm.common import written

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
SYMBOLS = "#$%&*|"

#: Text bytes of one shard, and its rows at most (a longer text is a shard by itself).
SHARD_BYTES = 8 << 20
SHARD_ROWS = 20_000
#: Bytes of shard dictionaries that one bucket of the global dictionary aims at.
BUCKET_BYTES = 4 << 20

_UPPER = bytes(range(65, 91))
_TAIL = bytes(range(0x80, 0xC0))  # UTF-8 continuation bytes: the others begin a code point

SHARD_SCHEMA = (
    "shard long, doc_ids array<long>, parts array<string>, flags binary, text_of binary, "
    "texts array<binary>, lows array<long>, indptr binary, indices binary, data binary, words binary"
)


def pack(numbers: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers as compressed int32, after their count; runs of ``ascending`` ones as differences."""
    raw = np.asarray(numbers, np.int32)
    if ascending:
        raw = np.diff(raw, prepend=np.int32(0))
    return len(raw).to_bytes(8, "little") + pa.compress(raw.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes, ascending: bool = False) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    out = np.frombuffer(pa.decompress(blob[8:], 4 * size, codec="zstd", asbytes=True), np.int32)
    return np.cumsum(out, dtype=np.int32) if ascending else out


def _pack_words(words) -> bytes:
    raw = b" ".join(words)  # a word holds no blank
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_words(blob: bytes) -> list[bytes]:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True).split()


class _Shard:
    """One block's documents as CSR rows over the block's own dictionary."""

    def __init__(self):
        self.doc_ids, self.parts, self.flags = [], [], bytearray()
        self.texts: dict[bytes, int] = {}
        self.lows, self.text_of = [], []
        self.words: dict[bytes, int] = {}
        self.indptr, self.indices, self.data = [0], [], []
        self.size = 0

    def add(self, doc_id: int | None, part: str | None, text: bytes) -> None:
        counts = Counter(text.split())  # bytes split at blank and \x09-\x0D
        words = self.words
        codes = np.fromiter((words.setdefault(w, len(words)) for w in counts), np.int32, len(counts))
        order = np.argsort(codes)
        self.indices.append(codes[order])
        self.data.append(np.fromiter(counts.values(), np.int32, len(counts))[order])
        self.indptr.append(self.indptr[-1] + len(counts))
        upper = len(text) - len(text.translate(None, _UPPER))
        points = len(text.translate(None, _TAIL))
        self.flags.append((100 * upper > MAX_UPPER_PERCENT * points) << 2 | (len(text) != len(text.translate(None, SYMBOLS.encode()))) << 3)
        code = self.texts.setdefault(hashlib.sha256(text).digest(), len(self.texts))
        self.text_of.append(code)
        if code == len(self.lows):
            self.lows.append(doc_id)
        elif doc_id is not None and (self.lows[code] is None or doc_id < self.lows[code]):
            self.lows[code] = doc_id
        self.doc_ids.append(doc_id)
        self.parts.append(part or "")
        self.size += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        flat = lambda parts, **how: pack(np.concatenate([np.zeros(0, np.int32), *parts]), **how)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([self.doc_ids], pa.list_(pa.int64())),
                pa.array([self.parts], pa.list_(pa.string())),
                pa.array([bytes(self.flags)], pa.binary()),
                pa.array([pack(self.text_of)], pa.binary()),
                pa.array([list(self.texts)], pa.list_(pa.binary())),
                pa.array([self.lows], pa.list_(pa.int64())),
                pa.array([pack(self.indptr, ascending=True)], pa.binary()),
                pa.array([flat(self.indices, ascending=True)], pa.binary()),
                pa.array([flat(self.data)], pa.binary()),
                pa.array([_pack_words(self.words)], pa.binary()),
            ],
            names=[c.split()[0] for c in SHARD_SCHEMA.split(", ")],
        )


def _shards(docs: DataFrame, shard_bytes: int) -> DataFrame:
    """Documents -> one row per shard (``SHARD_SCHEMA``), word indices local. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        shard = _Shard()
        for batch in batches:
            for doc_id, part, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                shard.add(doc_id, part, text)
                if shard.size >= shard_bytes or len(shard.doc_ids) >= SHARD_ROWS:
                    yield shard.row(number)
                    number, shard = number + 1, _Shard()
        if shard.doc_ids:
            yield shard.row(number)

    src = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    )
    return src.mapInArrow(run, SHARD_SCHEMA)


def _bucketed(shards: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, shard, places, words)``: each shard's dictionary dealt by the words' CRC-32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = unpack_words(blob)
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
                order = np.argsort(bucket, kind="stable")
                ends = np.flatnonzero(np.r_[np.diff(bucket[order]) != 0, bool(len(words))]) + 1
                rows = [order[a:b] for a, b in zip(np.r_[0, ends[:-1]].astype(np.int64), ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(bucket[r[0]]) for r in rows], pa.int32()),
                        pa.array([shard] * len(rows), pa.int64()),
                        pa.array([pack(r, ascending=True) for r in rows], pa.binary()),
                        pa.array([_pack_words([words[i] for i in r.tolist()]) for r in rows], pa.binary()),
                    ],
                    names=["bucket", "shard", "places", "words"],
                )

    return shards.select("shard", "words").mapInArrow(run, "bucket int, shard long, places binary, words binary")


def _numbered(bucketed: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, shard, places, numbers, words, n)``: the words of a bucket numbered from 0 as they
    come. The row without a shard holds the bucket's words in that order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, known = None, {}

        def whole():
            return row(bucket, None, None, None, _pack_words(known), len(known))

        def row(*values):
            types = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types)], names=["bucket", "shard", "places", "numbers", "words", "n"]
            )

        for batch in batches:
            for b, shard, places, blob in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if bucket is not None and b != bucket:
                    yield whole()
                    known = {}
                bucket = b
                words = unpack_words(blob)
                numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))
                yield row(b, shard, places, pack(numbers), None, len(words))
        if bucket is not None:
            yield whole()

    dealt = bucketed.repartitionById(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket int, shard long, places binary, numbers binary, words binary, n long")


def _words_with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = unpack_words(blob)
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode("utf-8", "replace") for w in words], pa.string()), pa.array(range(start, start + len(words)), pa.int64())],
                names=["word", "id"],
            )


def document_term_shards(spark: SparkSession, docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(shards, dictionary)``: CSR shards of the document-term matrix and ``(word, id)``.

    A shard's row ``i`` is document ``doc_ids[i]``; its entries stand at ``indptr[i]`` to
    ``indptr[i+1]`` of ``indices`` (places of the shard's dictionary) and ``data`` (counts), all three
    packed (see :func:`unpack`, the first two as ascending). ``columns`` lists parts ``(start, places, numbers)`` of that dictionary: the word at
    place ``places[j]`` has the global id ``start + numbers[j]`` (see :func:`column_ids`); ids run from 0 without gaps. ``first_seen[text_of[i]]``
    is the smallest doc_id of that text in the whole table.
    """
    shards = written(spark, _shards(docs, shard_bytes), "dt_shards")
    size = shards.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    buckets = int(size // BUCKET_BYTES) + 8
    # written: numbers follow the order of arrival, so a lost task must not number them anew
    numbered = written(spark, _numbered(_bucketed(shards, buckets), buckets), "dt_dictionary")

    heads = numbered.where("shard IS NULL").select("bucket", "n", "words")  # one row per bucket
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = heads.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("start"))
    dictionary = heads.join(starts, "bucket").select("start", "words").mapInArrow(_words_with_ids, "word string, id long")

    parts = numbered.where("shard IS NOT NULL").join(starts, "bucket")
    columns = parts.groupBy("shard").agg(F.collect_list(F.struct("start", "places", "numbers")).alias("columns"))

    seen = shards.select("shard", F.posexplode(F.arrays_zip("texts", "lows")).alias("i", "z")).select("shard", "i", "z.texts", "z.lows")
    low = seen.groupBy("texts").agg(F.min("lows").alias("low"))
    first = seen.join(low, "texts").groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("i", "low"))).alias("z"))
    first = first.select("shard", F.transform("z", lambda x: x["low"]).alias("first_seen"))
    whole = shards.drop("words", "texts", "lows").join(columns, "shard", "left").join(first, "shard")
    return whole, dictionary


def column_ids(columns: list | None) -> np.ndarray:
    """Global word id of every place of a shard's dictionary."""
    parts = [(unpack(c["places"], ascending=True), unpack(c["numbers"]) + np.int64(c["start"])) for c in columns or []]
    out = np.zeros(sum(len(p) for p, _ in parts), np.int64)
    for places, ids in parts:
        out[places] = ids
    return out


def failed_filters(shards: DataFrame) -> DataFrame:
    """``(doc_id, part, mask)``: bit ``i`` of the mask is set if the document fails filter ``i``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a shard at a time
                (r,) = batch.slice(i, 1).to_pylist()
                indptr = unpack(r["indptr"], ascending=True)
                ids = column_ids(r["columns"])[unpack(r["indices"], ascending=True)]
                sums = np.r_[0, np.cumsum(unpack(r["data"]), dtype=np.int64)]
                total = sums[indptr[1:]] - sums[indptr[:-1]]
                # nonzeros of a row: its columns are distinct, as a word has one id
                distinct = np.diff(indptr)
                if len(ids) != indptr[-1]:
                    raise ValueError(f"shard {r['shard']}: {len(ids)} entries, not {indptr[-1]}")
                mask = np.frombuffer(r["flags"], np.uint8).astype(np.int32)
                mask = mask | (total < MIN_WORDS) | (100 * distinct < MIN_DISTINCT_PERCENT * total) << 1
                text_of = unpack(r["text_of"]).tolist()
                low = [r["first_seen"][t] for t in text_of]
                later = [d is not None and m is not None and d > m for d, m in zip(r["doc_ids"], low)]
                mask = mask | np.array(later, bool) << 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(r["parts"], pa.string()), pa.array(mask, pa.int32())],
                    names=["doc_id", "part", "mask"],
                )

    return shards.select("shard", "doc_ids", "parts", "flags", "text_of", "first_seen", "indptr", "indices", "data", "columns").mapInArrow(
        run, "doc_id long, part string, mask int"
    )


def _ordered(cells: DataFrame) -> DataFrame:
    """Every row once per (order, step), with the bit of the step's filter and those of the filters before."""
    orders = F.lit(["".join(o) for o in permutations(FILTERS)])
    each = cells.withColumn("filter_order", F.explode(orders))
    each = each.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = f"transform(split(filter_order, '', {len(FILTERS)}), x -> shiftleft(1, instr('{FILTERS}', x) - 1))"
    each = each.withColumn("bits", F.expr(bits))
    before = F.aggregate(F.slice("bits", 1, F.col("step") - 1), F.lit(0), lambda a, x: a + x)
    return each.withColumn("bit", F.get("bits", F.col("step") - 1)).withColumn("before", before)


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every order of the five filters, step by step and per part: what is kept and removed."""
    shards, _ = document_term_shards(spark, docs, shard_bytes)
    masks = failed_filters(shards)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("g"), (F.col("toxic") == 1).alias("t"))
    marked = marked.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("g").alias("g"), F.max("t").alias("t"))
    # rows without an id find no label: kept out of the join, where they would be one key
    known = masks.where("doc_id IS NOT NULL").join(marked, "doc_id", "left")
    none = masks.where("doc_id IS NULL").select("*", F.lit(None).cast("boolean").alias("g"), F.lit(None).cast("boolean").alias("t"))
    false = F.lit(False)
    cells = known.unionByName(none).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("g", false)).alias("good"), F.count_if(F.coalesce("t", false)).alias("toxic")
    )
    # at most 32 rows a part
    cells = written(spark, cells, "audit_cells")
    each = _ordered(cells)
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    removed = fails & ~earlier

    def total(condition: Column, what: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(what))), F.lit(0)).cast("long")

    # a document that fails m filters is removed first by each of them in 120 / m of the orders
    share = (F.col("n") * F.expr("120 div greatest(bit_count(mask), 1)")).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(removed).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, share)), F.lit(0)).cast("long").alias("shapley"),
    )


#: The same in DuckDB.
AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS low FROM d),
f AS (SELECT doc_id, part, (len(words) < 100)::INT AS a, (100 * len(list_distinct(words)) < 80 * len(words))::INT AS b,
        (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT AS c,
        regexp_matches(text, '[#$%&*|]')::INT AS d, coalesce(doc_id > low, false)::INT AS e FROM w),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS g, max((toxic = 1)::INT) AS t FROM labels GROUP BY doc_id),
cell AS (SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, sum(coalesce(g, 0)) AS good, sum(coalesce(t, 0)) AS toxic
         FROM f LEFT JOIN lab USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
ord AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM l p, l q, l r, l s, l u
        WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
st AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM ord),
bits AS (SELECT filter_order, step::INT AS step, (1 << (ascii(filter_order[step]) - 65))::INT AS bit,
        coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(filter_order[i]) - 65))), 0)::INT AS before FROM st),
x AS (SELECT part, filter_order, step, bit, n, good, toxic, mask, (mask & bit) <> 0 AS fails, (mask & before) <> 0 AS earlier FROM cell, bits)
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (WHERE NOT fails AND NOT earlier), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (WHERE fails AND NOT earlier), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (WHERE fails AND earlier), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (WHERE fails AND NOT earlier), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (WHERE fails AND NOT earlier), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (WHERE fails), 0)::BIGINT AS shapley
FROM x GROUP BY ALL
"""
