"""Phrase collocation mining with weighted acyclic automata.

A sample of word windows cuts the sorted n-grams into ranges of about equal size (it decides
where they lie, and nothing else). Blocks of documents are counted into sorted n-grams, cut at
the ranges, and built into count transducers; every range sums those of all blocks in a running
union, whatever their number. Candidates are read off the ranges. Their parts' counts are looked up where the parts
lie: an acceptor of the parts asked for is composed with the range's transducer. A part is
asked for once per range that needs it, so the parts of very many candidates are no hot keys.

Defined results: a null text is empty, a null language is ``und``. Repeated rows count like
others; other columns of the documents are not read. Empty tables give no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentinela.llm.common import written
from sentinela.llm.count_automata import Automaton, Union, acceptor, build, compose, count_ngrams, cut, only_used

MAX_WORDS = 3
MIN_COUNT = 10
#: A candidate goes if a longer one around it has at least this share of its count.
DROP_PERCENT = 50
SCALE = 1_000_000
TOP = 2000

#: Bytes of text counted into one block of transducers.
BLOCK_BYTES = 8 << 20
#: Bytes of text whose n-grams one range aims at, and windows sampled per range.
RANGE_BYTES = 6 << 20
SAMPLES = 64
SALTS = 64

_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"\xff"  # no byte of UTF-8
_TABLE = bytes.maketrans(_ENDS + b"\t", _BREAK * len(_ENDS) + b" ")

AUTOMATON = "lang string, words binary, final binary, widths binary, arcs binary"


class _Words(dict):
    def __missing__(self, word):
        label = self[word] = len(self)
        return label


def labels_of(text: bytes, words: _Words) -> np.ndarray:
    """Labels of a text's words; label 0, of the break, stands between pieces and at the end."""
    tokens = text.lower().translate(_TABLE).replace(_BREAK, b" \xff ").split()
    tokens.append(_BREAK)
    return np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens))


class _Block:
    """Texts of one block, per language, as streams of labels."""

    def __init__(self):
        self.words: dict[str, _Words] = {}
        self.streams: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.words:
            self.words[lang], self.streams[lang] = _Words({_BREAK: 0}), []
        self.streams[lang].append(labels_of(text, self.words[lang]))
        self.size += len(text)

    def tables(self, size: int) -> Iterator[tuple[str, list[bytes], list[np.ndarray], np.ndarray]]:
        """Per language the words and the sorted n-grams with their counts."""
        for lang, known in self.words.items():
            ids = np.concatenate(self.streams[lang])
            words = sorted(w for w in known if w != _BREAK)
            if words:
                rank = np.zeros(len(known), np.int32)
                rank[[known[w] for w in words]] = np.arange(1, len(words) + 1)
                yield lang, words, *count_ngrams(rank[ids], size, len(words) + 1)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def range_bounds(docs: DataFrame, range_bytes: int) -> list[tuple[bytes, tuple[bytes, ...]]]:
    """First ``(lang, words)`` of every range but the first, sorted: one entry per range comes to the driver.

    About ``SAMPLES`` windows of three words per ``range_bytes`` of text, at places that the hash of a
    text chooses. A text is taken with a probability by its length, a long one several times.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    src = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    every = max(range_bytes // SAMPLES, 64)
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chance = F.pmod(F.xxhash64("text"), F.lit(every))
    times = F.expr(f"length(text) div {every}").cast("int") + F.when(chance < F.expr(f"length(text) % {every}"), 1).otherwise(0)
    taken = src.withColumn("times", times).where("times > 0").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("times"))))
    at = F.pmod(F.xxhash64("text", "i"), F.length("text")).cast("int") + 1
    around = F.lower(F.substring("text", at, F.lit(120)))
    # the first word may be cut
    words = F.slice(F.filter(F.split(around, "[ .,;:!?\\x09-\\x0D]+"), lambda w: w != ""), 2, 3)
    sample = taken.select(F.col("lang").cast("binary").alias("lang"), F.transform(words, lambda w: w.cast("binary")).alias("key"))
    dealt = sample.where(F.size("key") > 0).repartitionByRange(int(total // range_bytes) + 1, "lang", "key")
    heads = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("lang", "key")).alias("h")).collect()
    return sorted((bytes(r.h.lang), tuple(bytes(w) for w in r.h.key)) for r in heads)[1:]


def block_transducers(docs: DataFrame, bounds: list, size: int, block_bytes: int) -> DataFrame:
    """Documents -> ``(range, transducer)``: per block and language one for every range. No shuffle."""
    names = ["range"] + [c.split()[0] for c in AUTOMATON.split(", ")]
    types = [pa.int32(), pa.string(), *[pa.binary()] * 4]

    def finished(block: _Block) -> Iterator[pa.RecordBatch]:
        for lang, words, columns, counts in block.tables(size):
            code = lang.encode()
            low = high = bisect_left(bounds, (code, ()))
            while high < len(bounds) and bounds[high][0] == code:
                high += 1
            ends = [cut(words, columns, key) for _, key in bounds[low:high]]
            for k, (a, b) in enumerate(zip([0, *ends], [*ends, len(counts)])):
                if b > a:
                    used, part = only_used(words, [c[a:b] for c in columns])
                    yield _batch([(low + k, lang, *build(used, part, counts[a:b]).pack())], types, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block.add(lang, text)
                if block.size >= block_bytes:
                    yield from finished(block)
                    block = _Block()
        yield from finished(block)

    src = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return src.mapInArrow(run, "range int, " + AUTOMATON)


def _united(slices: DataFrame, ranges: int, size: int) -> DataFrame:
    """``(range, transducer, n_words)``: the slices of a range summed, one row per language in it."""
    names = ["range"] + [c.split()[0] for c in AUTOMATON.split(", ")] + ["n_words"]
    types = [pa.int32(), pa.string(), *[pa.binary()] * 4, pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unions: dict[tuple[int, str], Union] = {}

        def finished():
            for (number, lang), union in unions.items():
                automaton = union.result()
                columns, counts = automaton.rows(1)
                yield _batch([(number, lang, *automaton.pack(), int(counts.sum()))], types, names)

        for batch in batches:
            for number, lang, *packed in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if unions and (number, lang) not in unions:  # sorted: the one before is complete
                    yield from finished()
                    unions = {}
                unions.setdefault((number, lang), Union(size)).add(Automaton.unpack(*packed))
        yield from finished()

    dealt = slices.repartitionById(ranges, "range").sortWithinPartitions("range", "lang")
    return dealt.mapInArrow(run, "range int, " + AUTOMATON + ", n_words long")


def ngram_transducers(
    spark: SparkSession,
    docs: DataFrame,
    size: int = MAX_WORDS,
    block_bytes: int = BLOCK_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> tuple[DataFrame, list]:
    """``(transducers, bounds)``: counts of all n-grams of up to ``size`` words as one transducer per
    (range, language); range ``i`` holds the n-grams from ``bounds[i - 1]`` on."""
    bounds = range_bounds(docs, range_bytes)
    united = _united(block_transducers(docs, bounds, size, block_bytes), len(bounds) + 1, size)
    return written(spark, united, "ngram_ranges"), bounds


def candidates(transducers: DataFrame, size: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(range, lang, phrase, size, a)`` of the phrases of 2 to ``size`` words found often enough."""
    names, types = ["range", "lang", "phrase", "size", "a"], [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, lang, *packed in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                automaton = Automaton.unpack(*packed)
                columns, counts = automaton.rows(size)
                often = np.flatnonzero((counts >= min_count) & (columns[1] != 0))
                for s in range(0, len(often), 1 << 14):
                    at = often[s : s + (1 << 14)]
                    phrases = [[automaton.words[k - 1] for k in r if k] for r in zip(*[c[at].tolist() for c in columns])]
                    yield _batch(
                        [(number, lang, b" ".join(p).decode(), len(p), n) for p, n in zip(phrases, counts[at].tolist())], types, names
                    )

    return transducers.select("range", "lang", "words", "final", "widths", "arcs").mapInArrow(
        run, "range int, lang string, phrase string, size int, a long"
    )


def part_counts(asked: DataFrame, transducers: DataFrame, bounds: list, size: int = MAX_WORDS) -> DataFrame:
    """``asked(range, lang, part)`` with ``f``, the part's count, from the transducer of the part's own range."""
    n = len(bounds) + 1

    @F.pandas_udf("int")
    def home(lang: pd.Series, part: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, (k.encode(), tuple(p.encode().split(b" ")))) for k, p in zip(lang, part)], dtype="int32")

    empty = F.lit(None)
    machines = transducers.select(
        F.col("range").alias("task"), F.lit(0).alias("kind"), empty.cast("int").alias("range"), "lang", empty.cast("string").alias("part"),
        "words", "final", "widths", "arcs",
    )
    questions = asked.select(
        home("lang", "part").alias("task"), F.lit(1).alias("kind"), "range", "lang", "part",
        *[empty.cast("binary").alias(c) for c in ("words", "final", "widths", "arcs")],
    )
    names, types = ["range", "lang", "part", "f"], [pa.int32(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine: dict[tuple[int, str], Automaton] = {}
        for batch in batches:
            wanted: dict[tuple[int, str], list[tuple[int, str]]] = {}
            for task, kind, number, lang, part, *packed in zip(*[batch.column(i).to_pylist() for i in range(9)]):
                if kind == 0:
                    machine = {k: v for k, v in machine.items() if k[0] == task}
                    machine[task, lang] = Automaton.unpack(*packed)
                else:
                    wanted.setdefault((task, lang), []).append((number, part))
            for (task, lang), rows in wanted.items():
                split = {part: tuple(part.encode().split(b" ")) for _, part in rows}
                found = compose(acceptor(list(split.values()), size), machine[task, lang], size)
                yield _batch([(number, lang, part, found[split[part]]) for number, part in rows], types, names)

    dealt = machines.unionByName(questions).repartitionById(n, "task").sortWithinPartitions("task", "kind", "lang", "part")
    return dealt.mapInArrow(run, "range int, lang string, part string, f long")


def collocations(
    spark: SparkSession,
    docs: DataFrame,
    size: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases.

    ``score`` is ``floor(10^6 a^2 / (l r))`` of the phrase's weakest cut into a first part (count
    ``l``) and a rest (``r``); a phrase of which a longer candidate around it has at least half the
    count is left out. Counts may have up to 15 digits.
    """
    transducers, bounds = ngram_transducers(spark, docs, size, block_bytes, range_bytes)
    found = written(spark, candidates(transducers, size, min_count), "collocation_candidates")

    words = F.split("phrase", " ")
    cuts = found.withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "range", "lang", "phrase", "size", "a", "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("rest"),
    )
    asked = cuts.select("range", "lang", F.explode(F.array("head", "rest")).alias("part")).distinct()
    parts = written(spark, part_counts(asked, transducers, bounds, size), "collocation_parts")

    # the range stands in both keys: a part that very many candidates share is one row per range
    heads = parts.select("range", "lang", F.col("part").alias("head"), F.col("f").alias("l"))
    rests = parts.select("range", "lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["range", "lang", "head"]).join(rests, ["range", "lang", "rest"])
    exact = {c: F.col(c).cast("decimal(15,0)") for c in "alr"}
    square, product = F.lit(SCALE).cast("decimal(7,0)") * exact["a"] * exact["a"], exact["l"] * exact["r"]
    scored = scored.withColumn("square", square).withColumn("product", product).withColumn("score", F.expr("square div product"))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = scored.groupBy("range", "lang", "phrase", "size", "a").agg(least)

    inner = found.where("size > 2").withColumn("w", words)
    inner = inner.withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("s"), F.col("m")), " ").alias("phrase"), "a")
    around = inner.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(around, ["lang", "phrase"], "left")
    kept = kept.where(f"around IS NULL OR 100 * around < {DROP_PERCENT} * a")
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within salts of a language, which may hold nearly all phrases, then among what is left
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = transducers.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return kept.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB.
COLLOCATIONS_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, s, unnest(list_transform(range(1, len(w) - s + 2), lambda i: array_to_string(w[i : i + s - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3]) AS s) WHERE len(w) >= s),
f AS (SELECT lang, s, phrase, count(*) AS c FROM g GROUP BY ALL),
n AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE s = 1 GROUP BY lang),
cand AS (SELECT lang, s, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE s > 1 AND c >= 10),
cuts AS (SELECT lang, s, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS rest
         FROM (SELECT *, unnest(range(1, s)) AS k FROM cand)),
sc AS (SELECT c.lang, c.s, c.phrase, c.a, k, l.c AS l, r.c AS r, (1000000::HUGEINT * c.a * c.a) // (l.c::HUGEINT * r.c) AS score
       FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.rest),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (SELECT lang, phrase, max(a) AS b FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE s = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE s = 3) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN around o ON o.lang = low.lang AND o.phrase = low.phrase WHERE b IS NULL OR 100 * b < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""
