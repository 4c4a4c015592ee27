"""Quality by an interpolated modified Kneser-Ney n-gram model.

Units are bytes of the normalised text (ASCII lower case, white-space runs as one
space), so the model knows every language and no word is out of vocabulary.
Texts are dealt to blocks of bounded size, each with the counts of its own n-grams.
The blocks' counts are summed by n-gram, and joins of the counts, the continuation
counts and their contexts give the probability of every n-gram that any block
holds. Each block's distinct n-grams then meet those by buckets of n-grams, and its
texts are scored with the answers: no table passes the driver or is broadcast, and
a text is shuffled once.

Trusted texts are cross-fitted: each is dealt to a fold by its hash (equal texts
share one) and scored by the model of the other folds, so that the quantiles held
against unseen texts are themselves of texts the model has not seen.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from sentinela.llm.common import without, written

#: Bytes of text in one block (a longer text is a block of its own).
BLOCK_BYTES = 8 << 20
#: Parts of the trusted texts that are scored by a model of the others.
FOLDS = 5
#: N-grams of the probability table, and asked ones, that one bucket holds on average.
BUCKET_GRAMS, BUCKET_ASKED = 250_000, 8_000_000
#: Bytes that the trusted ids may have to be broadcast; beyond, texts are shuffled to them.
BROADCAST_BYTES = 64 << 20
#: Bytes of text whose n-grams are handled at once.
CHUNK = 4 << 20


def normal(text: str | bytes | None) -> bytes:
    """No byte 0 is left: it marks the beginning and the end. Bytes are normal."""
    if isinstance(text, bytes):
        return text
    data = b"" if text is None else text.encode("utf-8", "surrogatepass").lower()
    return b" ".join(data.replace(b"\0", b" ").split())


def gram_runs(texts: list, n: int, chunk: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Packed n-grams of the texts one after another (each byte, and the end, with
    the n-1 bytes before it) in runs of at most ``chunk``: the n-grams, the numbers
    of the texts they are of, and how many are of each. A long text has many runs."""
    parts = [normal(t) for t in texts]
    pad = b"\0" * (n - 1)
    data = np.frombuffer(b"".join(pad + p + b"\0" for p in parts), np.uint8)
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    ends = np.cumsum(sizes + n - 1)
    first = ends - sizes - (n - 1)
    for a in range(0, len(data) - n + 1, chunk):
        b = min(a + chunk, len(data) - n + 1)
        grams = np.zeros(b - a, np.int64)
        for i in range(n):
            grams <<= 8
            grams |= data[a + i : b + i]
        keep = np.ones(b - a, bool)
        for i in range(1, n):  # windows that end inside a padding belong to no text
            cut = ends - i
            keep[cut[(cut >= a) & (cut < b)] - a] = False
        at = np.arange(np.searchsorted(first + sizes, a, "right"), np.searchsorted(first, b, "left"))
        yield grams[keep], at, np.minimum(first[at] + sizes[at], b) - np.maximum(first[at], a)


def text_grams(texts: list, n: int, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """All packed n-grams of the texts, and how many each text has."""
    found, sizes = [np.zeros(0, np.int64)], np.zeros(len(texts), np.int64)
    for grams, at, count in gram_runs(texts, n, chunk):
        found.append(grams)
        sizes[at] += count
    return np.concatenate(found), sizes


def gram_counts(texts: list, n: int, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the texts, sorted, with their counts."""
    grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for found, _, _ in gram_runs(texts, n, chunk):
        new, times = np.unique(found, return_counts=True)
        both, back = np.unique(np.concatenate([grams, new]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([counts, times]), len(both)).astype(np.int64)
        grams = both
    return grams, counts


def text_scores(
    grams: np.ndarray, logp: np.ndarray, texts: list, n: int, chunk: int = CHUNK
) -> tuple[np.ndarray, np.ndarray]:
    """Per text: sum of the log-probabilities of its n-grams, all of them in the
    sorted ``grams``, and its number of n-grams."""
    sums, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for found, at, count in gram_runs(texts, n, chunk):
        if len(at):
            value = logp[np.searchsorted(grams, found)]
            sums[at] += np.add.reduceat(value, np.r_[0, np.cumsum(count)[:-1]])
            sizes[at] += count
    return sums, sizes


def _blocks(batches, n_folds: int, block_bytes: int) -> Iterator[tuple[str, int, pa.Table]]:
    """(block, fold, rows): rows of one fold with at most about ``block_bytes`` of
    text, the text normalised. A block is named by its task, its number and a digest
    of its texts, so that two passes over the same input agree or do not meet."""
    from pyspark import TaskContext

    task, number = TaskContext.get().partitionId(), 0
    held: list[list] = [[] for _ in range(n_folds)]
    size = [0] * n_folds

    def block(fold):
        nonlocal number
        rows, number = pa.Table.from_batches(held[fold]).combine_chunks(), number + 1
        held[fold], size[fold] = [], 0
        return f"{task}-{number}-{zlib.crc32(b' '.join(rows['_text'].to_pylist()))}", fold, rows

    for b in batches:
        at = b.schema.get_field_index("_text")
        texts = [normal(t) for t in b.column(at).to_pylist()]
        b = b.set_column(at, "_text", pa.array(texts, pa.binary()))
        folded = b.column(b.schema.get_field_index("_fold")).to_numpy()
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        for fold in np.unique(folded):
            at = np.flatnonzero(folded == fold)
            part, low = b.take(pa.array(at)), 0
            filled = size[fold] + np.cumsum(lengths[at])
            for cut in np.flatnonzero(np.diff(filled // block_bytes, prepend=0)) + 1:
                held[fold].append(part.slice(low, cut - low))
                low = int(cut)
                yield block(fold)
            if low < len(at):
                held[fold].append(part.slice(low))
                size[fold] = int(filled[-1]) % block_bytes
    for fold in range(n_folds):
        if held[fold]:
            yield block(fold)


def block_grams(told: DataFrame, n: int, folds: int, block_bytes: int) -> DataFrame:
    """(block, fold, grams, counts): the distinct n-grams of each block."""

    def run(batches):
        for name, fold, rows in _blocks(batches, folds + 1, block_bytes):
            grams, counts = gram_counts(rows["_text"].to_pylist(), n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name]),
                    pa.array([fold], pa.int32()),
                    pa.array([grams], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int32())),
                ],
                names=["block", "fold", "grams", "counts"],
            )

    return told.mapInArrow(run, "block string, fold int, grams array<long>, counts array<int>")


def block_rows(told: DataFrame, folds: int, block_bytes: int) -> DataFrame:
    """(block, rows): the same blocks' rows, each block a compressed Arrow stream."""

    def run(batches):
        for name, _, rows in _blocks(batches, folds + 1, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(rows)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()])], ["block", "rows"])

    return told.mapInArrow(run, "block string, rows binary")


def _bucket(grams, buckets: int):
    """Of an n-gram, as a number: the same rule for arrays and columns."""
    return grams % 1_000_003 % buckets


def answers(grams: DataFrame, table: DataFrame, models: int, buckets: int, salts: int, parts: int) -> DataFrame:
    """(asking, bucket, n, logp): for each block of ``grams`` and each bucket the
    log-probabilities, under the model of the block's fold, of its n-grams there, in
    their order. Blocks are dealt to ``salts`` groups a bucket, each of which meets
    the bucket's part of ``table``: a group is of bounded size."""

    def ask(batches):
        for b in batches:
            for name, fold, held in zip(*(b.column(i) for i in range(3))):
                held = held.values.to_numpy()
                bucket = _bucket(held, buckets)
                for k in np.unique(bucket):
                    part = held[bucket == k]
                    steps = pa.compress(np.diff(part, prepend=0).tobytes(), codec="zstd", asbytes=True)
                    row = [name.as_py(), fold.as_py(), int(k), zlib.crc32(name.as_py().encode()) % salts, len(part), steps]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t) for v, t in zip(row, (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                        names=["asking", "fold", "bucket", "salt", "n", "steps"],
                    )

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            known = right["gram"].to_numpy()
            order = np.argsort(known)
            known = known[order]
            logp = right["logp"].combine_chunks().flatten().to_numpy().reshape(-1, models)[order]
            for fold, n, steps in zip(*(left[c].to_pylist() for c in ("fold", "n", "steps"))):
                held = np.cumsum(np.frombuffer(pa.decompress(steps, 8 * n, codec="zstd"), np.int64))
                found = np.ascontiguousarray(logp[np.searchsorted(known, held), fold])
                out.append(pa.compress(found.tobytes(), codec="zstd", asbytes=True))
        return pa.table([left["asking"], left["bucket"], left["n"], pa.array(out, pa.binary())], names=["asking", "bucket", "n", "logp"])

    asked = grams.select("block", "fold", "grams").mapInArrow(
        ask, "asking string, fold int, bucket long, salt int, n long, steps binary"
    )
    parted = table.select(
        _bucket(F.col("gram"), buckets).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("copy"),
        "gram",
        F.col("logp").cast("array<float>").alias("logp"),
    )
    return (
        asked.repartition(parts, "bucket", "salt").groupBy("bucket", "salt")
        .cogroup(parted.repartition(parts, "part", "copy").groupBy("part", "copy"))
        .applyInArrow(answer, "asking string, bucket long, n long, logp binary")
    )


def _mask(k: int) -> Column:
    return F.lit((1 << 8 * k) - 1).cast("long")


def _array(one, models: int) -> Column:
    return F.array(*[one(m) for m in range(models)])


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; within 0 and
    the count where the count-of-counts are too few."""
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    raw = (
        1 - 2 * y * n2 / n1 if n1 else 0.5,
        2 - 3 * y * n3 / n2 if n2 else 1.0,
        3 - 4 * y * n4 / n3 if n3 else 1.5,
    )
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw))


def gram_probabilities(spark: SparkSession, counted: DataFrame, n: int, models: int) -> DataFrame:
    """(gram, logp) for every n-gram of ``counted`` (gram, c), where ``c`` holds one
    count per model and ``logp`` one value, by joins of the count tables of each
    order: discounted count over the context's total, plus the context's discounted
    mass times the probability of the next lower order. A context or a suffix has
    at most 256 n-grams, so no key is frequent."""
    types = {n: counted.where(F.exists("c", lambda x: x > 0))}
    for k in range(n - 1, 0, -1):  # continuation counts: distinct bytes to the left
        low = types[k + 1].select(F.col("gram").bitwiseAND(_mask(k)).alias("gram"), "c")
        c = _array(lambda m: F.count_if(F.col("c")[m] > 0), models).alias("c")
        types[k] = written(spark, low.groupBy("gram").agg(c), f"types_{k}")
    below = None
    for k in range(1, n + 1):
        r = types[k].agg(
            *[F.count_if(F.col("c")[m] == i).alias(f"m{m}_{i}") for m in range(models) for i in range(1, 5)]
        ).first()
        off = [discounts(*(r[f"m{m}_{i}"] for i in range(1, 5))) for m in range(models)]

        def lost(m: int, off=off) -> Column:
            c = F.col("c")[m]
            return F.when(c == 0, 0.0).when(c == 1, off[m][0]).when(c == 2, off[m][1]).otherwise(off[m][2])

        seen = types[k].select("gram", _array(lambda m: F.col("c")[m] - lost(m), models).alias("kept"))
        context = types[k].groupBy(F.shiftright("gram", 8).alias("context")).agg(
            _array(lambda m: F.sum(F.col("c")[m]), models).alias("total"),
            _array(lambda m: F.sum(lost(m)), models).alias("spare"),
        )
        need = counted.select(F.col("gram").bitwiseAND(_mask(k)).alias("gram"))
        need = need.distinct() if k < n else need
        joined = (
            need.withColumns({"context": F.shiftright("gram", 8), "low": F.col("gram").bitwiseAND(_mask(k - 1))})
            .join(seen, "gram", "left")
            .join(context, "context", "left")
        )
        if below is not None:
            joined = joined.join(below, "low", "left")

        def prob(m: int, below=below) -> Column:
            low = F.lit(1.0 / 256) if below is None else F.col("p_low")[m]
            total = F.col("total")[m]
            here = (F.coalesce(F.col("kept")[m], F.lit(0.0)) + F.col("spare")[m] * low) / total
            return F.when(total > 0, here).otherwise(low)

        probs = joined.select("gram", _array(prob, models).alias("p"))
        if k < n:
            below = written(spark, probs, f"p_{k}").select(F.col("gram").alias("low"), F.col("p").alias("p_low"))
    return probs.select("gram", F.transform("p", lambda p: F.log(p)).alias("logp"))


def perplexities(
    spark: SparkSession,
    docs: DataFrame,
    trusted_ids: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n: int = 5,
    keep: list[str] | None = None,
    folds: int = FOLDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with ``n_grams`` and ``perplexity``
    under the model of the trusted texts (rows whose id is in ``trusted_ids``,
    column doc_id); a trusted text's own fold is left out of its model.

    Null and empty texts consist of the end mark; repeated rows count each time;
    without trusted texts (outside a text's own fold) every n-gram is equally
    likely; input columns named like an output column are replaced. A text of any
    length is scored whole. ``docs`` is read twice and must give the same rows in the
    same partitions, as tables do; if not, the job fails.
    """
    base = without(docs if keep is None else docs.select(*dict.fromkeys([*keep, text, doc_id])), ["n_grams", "perplexity"])
    names = [c for c in (docs.columns if keep is None else keep) if c in base.columns]
    # the operator's columns beside numbered ones, so that no name of the input can clash
    told = base.select(
        F.col(f"`{doc_id}`").alias("_id"),
        F.col(f"`{text}`").alias("_text"),
        *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)],
    )
    ids = trusted_ids.select(F.col("doc_id").alias("_trusted")).where("doc_id IS NOT NULL").distinct()
    ids = written(spark, ids, "trusted_ids")
    size = ids.agg(F.sum(F.octet_length(F.col("_trusted").cast("string")) + 32)).first()[0] or 0
    few = size <= BROADCAST_BYTES
    fold = F.when(F.col("_trusted").isNull(), folds).otherwise(F.pmod(F.xxhash64("_text"), F.lit(folds)))
    told = told.join(F.broadcast(ids) if few else ids, F.col("_id") == F.col("_trusted"), "left").select(
        "_text", *[f"_{i}" for i in range(len(names))], fold.cast("int").alias("_fold")
    )
    # the blocks are made twice, from the same rows: beyond a broadcast these are written
    told = told if few else written(spark, told, "told", "zstd")
    blocks = written(spark, block_grams(told, n, folds, block_bytes), "block_grams", "zstd")

    # model m leaves out fold m; the last one leaves out nothing
    models = folds + 1
    grams = blocks.select("fold", F.inline(F.arrays_zip("grams", "counts")).alias("gram", "c"))
    every = F.sum(F.when(F.col("fold") < folds, F.col("c")).otherwise(0))
    own = [F.sum(F.when(F.col("fold") == m, F.col("c")).otherwise(0)) for m in range(folds)]
    counted = grams.groupBy("gram").agg(_array(lambda m: every - own[m] if m < folds else every, models).alias("c"))
    counted = written(spark, counted, "grams")
    table = written(spark, gram_probabilities(spark, counted, n, models), "gram_logp")

    r = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.size("grams")).alias("asked")).first()
    buckets = -(-table.count() // BUCKET_GRAMS) or 1
    salts = -(-(r.asked or 0) // (buckets * BUCKET_ASKED)) or 1
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = answers(blocks, table, models, buckets, salts, min(buckets * salts, most))
    fields = [StructField(f"_{i}", base.schema[c].dataType) for i, c in enumerate(names)]
    fields += [StructField("n_grams", LongType()), StructField("perplexity", DoubleType())]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = pa.ipc.open_stream(left["rows"][0].as_py()).read_all() if left.num_rows else None
        texts = rows["_text"].to_pylist() if left.num_rows else []
        held, _ = gram_counts(texts, n)
        if len(held) != sum(right["n"].to_pylist()):
            raise RuntimeError("the input's rows came in another order when read again: write them first")
        parts = sorted(zip(*(right[c].to_pylist() for c in ("bucket", "n", "logp"))))
        logp = np.empty(len(held))
        found = [np.frombuffer(pa.decompress(v, 4 * k, codec="zstd"), np.float32) for _, k, v in parts]
        logp[np.argsort(_bucket(held, buckets), kind="stable")] = np.concatenate(found)
        sums, sizes = text_scores(held, logp, texts, n)
        cols = [rows[f.name] for f in fields[:-2]] + [pa.array(sizes, pa.int64()), pa.array(np.exp(-sums / sizes))]
        return pa.table(cols, names=[f.name for f in fields])

    parts = max(1, min(r.blocks, most))
    scored = (
        block_rows(told, folds, block_bytes).repartition(parts, "block").groupBy("block")
        .cogroup(known.repartition(parts, "asking").groupBy("asking"))
        .applyInArrow(score, StructType(fields))
    )
    return scored.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(names)], "n_grams", "perplexity")


def judge(
    scored: DataFrame, trusted_ids: DataFrame, doc_id: str = "doc_id", lang: str = "lang", low: float = 0.002, high: float = 0.995
) -> DataFrame:
    """``scored`` with ``low``, ``high`` and ``kept``: perplexity within these
    quantiles of the trusted texts of the same language (of all trusted texts for
    a language, or null, without any; kept if there are none at all). Below the
    lower one lies text that repeats itself.

    Quantiles are over all trusted rows (percentile_approx, error 1 in 10,000).
    """
    base = without(scored, ["low", "high", "kept"])
    ids = trusted_ids.select(F.col("doc_id").alias(doc_id)).where(F.col(doc_id).isNotNull()).distinct()
    trusted = base.select(doc_id, F.col(lang).alias("_lang"), "perplexity").join(ids, doc_id, "left_semi")
    q = F.percentile_approx("perplexity", [low, high], 10_000).alias("_q")
    per = trusted.groupBy("_lang").agg(q)
    every = trusted.agg(q).first()["_q"]  # two numbers
    rest = F.array(*[F.lit(x) for x in every]) if every else F.lit(None).cast("array<double>")
    both = base.join(per, base[lang].eqNullSafe(F.col("_lang")), "left")
    quant = F.coalesce("_q", rest)
    inside = F.col("perplexity").between(quant[0], quant[1])
    return both.select(*base.columns, quant[0].alias("low"), quant[1].alias("high"), F.coalesce(inside, F.lit(True)).alias("kept"))
