"""Benchmark decontamination: one Aho-Corasick automaton over normalised items.

Texts are normalised to words (ASCII lower case, runs of digits, letters and
non-ASCII characters) joined by one space. Each run of ``window`` item words is a
pattern (an item with fewer words is one pattern); one pass of the automaton
over a document's normalised text finds all occurrences, and word numbers lead
back to character offsets of the original text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from sentinela.llm.common import add_columns

#: Bytes of patterns in one automaton (a trie node takes some 50 bytes in memory).
MAX_PATTERN_BYTES = 4 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_HITS = [
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("items", ArrayType(StringType())),
    StructField("hits", ArrayType(_SPAN)),
    StructField("spans", ArrayType(_SPAN)),
]


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; null has none."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows(text: str | None, size: int) -> set[bytes]:
    words = normal_words(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def word_offsets(text: str, first: int, last: int) -> tuple[int, int]:
    """Code points [start, end) of words ``first`` … ``last`` in the original."""
    start = end = 0
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    for i, m in enumerate(_WORD.finditer(folded)):
        if i == first:
            start = m.start()
        if i == last:
            end = m.end()
            break
    return start, end


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of closed word ranges as disjoint ranges in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_built: dict[str, object] = {}


def _automaton(key: str, patterns: list[tuple[bytes, list[str]]]):
    """The automaton of a pattern group, kept while the worker goes on with it."""
    if key not in _built:
        import ahocorasick

        found = ahocorasick.Automaton()
        for words, items in patterns:
            found.add_word(f" {words.decode('latin-1')} ", (words.count(b" ") + 1, items))
        found.make_automaton()
        _built.clear()
        _built[key] = found
    return _built[key]


def scan(text: str | None, automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit word ranges (closed) and items of one text."""
    words = normal_words(text)
    if not words:
        return 0, [], set()
    hay = f" {b' '.join(words).decode('latin-1')} "
    ranges, items, ends = [], set(), None
    for at, (size, ids) in automaton.iter(hay):
        if ends is None:
            ends = np.cumsum([len(w) + 1 for w in words])  # place of the space after each word
        last = int(np.searchsorted(ends, at))
        ranges.append((last - size + 1, last))
        items.update(ids)
    return len(words), merged(ranges), items


def find_contamination(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    max_pattern_bytes: int = MAX_PATTERN_BYTES,
    unnamed: bool = False,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurrence), ``items``
    (ids as strings, sorted, of items with an occurring window) and ``spans``
    (code-point ranges of the hits in the original text).

    Patterns are cut by hash into groups of at most about ``max_pattern_bytes``;
    each group is one automaton, broadcast after its size is known, and adds to
    the hits of the groups before it: a benchmark of any size needs no shuffle
    of documents. Null and empty texts have no words and no hits, null and empty
    items no windows; items with a null id are left out, or with ``unnamed`` their
    windows hit words but name no item;
    repeated items and windows count once per item id; with an empty benchmark
    nothing is hit. Input columns named like an output
    column are replaced.
    """
    import json

    def cut(batches):
        import pyarrow as pa

        for b in batches:
            ids, texts = (b.column(i).to_pylist() for i in (0, 1))
            rows = [(w, i) for i, t in zip(ids, texts) for w in windows(t, window) if unnamed or i is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], pa.binary()), pa.array([i for _, i in rows], pa.string())], ["w", "item"]
            )

    pairs = items.select(
        F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").alias("t")
    ).mapInArrow(cut, "w binary, item string")
    grouped = pairs.groupBy("w").agg(F.sort_array(F.collect_set("item")).alias("items"))
    size = grouped.agg(F.sum(F.length("w") + 16 * F.greatest(F.size("items"), F.lit(1)))).first()[0] or 0
    groups = max(1, -(-int(size) // max_pattern_bytes))
    folded = docs if keep is None else docs.select(*dict.fromkeys([*keep, text]))
    returned = list(folded.columns if keep is None else keep)
    for g in range(groups):
        part = grouped.where(F.pmod(F.xxhash64("w"), F.lit(groups)) == g) if groups > 1 else grouped
        found = [(bytes(r.w), list(r["items"])) for r in part.collect()]
        key = hashlib.sha1(json.dumps([[w.hex(), i] for w, i in sorted(found)]).encode()).hexdigest()
        shared = spark.sparkContext.broadcast((key, found))
        folded = _one_group(folded, text, shared, g, returned if groups == 1 else folded.columns)
    return folded.drop("hits", *([] if text in returned else [text]))


def _one_group(df: DataFrame, text: str, shared, g: int, keep: list[str]) -> DataFrame:
    if g == 0:

        def first(texts: list) -> list:
            key, patterns = shared.value
            automaton = _automaton(key, patterns) if patterns else None
            rows = [_row(t, *(scan(t, automaton) if patterns else (len(normal_words(t)), [], set()))) for t in texts]
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in _HITS]

        return add_columns(df, text, _HITS, first, keep=keep)

    names = df.columns

    def further(batches):
        import pyarrow as pa

        key, patterns = shared.value
        automaton = _automaton(key, patterns) if patterns else None
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(names)}
            if patterns:
                rows = []
                for t, old, ids in zip(*(cols[n].to_pylist() for n in (text, "hits", "items"))):
                    n, ranges, more = scan(t, automaton)
                    rows.append(_row(t, n, merged(ranges + [(h["start"], h["end"]) for h in old]), more | set(ids)))
                for i, f in enumerate(_HITS):
                    cols[f.name] = pa.array([r[i] for r in rows], cols[f.name].type)
            yield pa.RecordBatch.from_arrays([cols[n] for n in names], names=names)

    return df.mapInArrow(further, df.schema)


def _row(text: str | None, n: int, ranges: list[tuple[int, int]], items: set[str]) -> tuple:
    as_struct = [{"start": a, "end": b} for a, b in ranges]
    spans = [dict(zip(("start", "end"), word_offsets(text, a, b))) for a, b in ranges]
    return n, sum(b - a + 1 for a, b in ranges), sorted(items), as_struct, spans


def is_contaminated(share: int = 20):
    """At least one word hit and at least one in ``share`` words."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * F.lit(share) >= F.col("n_words"))
