"""Collocations against a loop over pieces; ranges and blocks of any size give the same."""

import random
import re
from collections import Counter, defaultdict

import pytest

from sentinela.llm.collocations import collocations, ngram_transducers
from sentinela.llm.count_automata import Automaton

SCHEMA = "doc_id long, text string, lang string, phrase string, range int"


def _ngrams(rows):
    f = defaultdict(Counter)
    for text, lang in rows:
        t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", t):
            w = re.findall("[^\x20\x09]+", piece)
            for s in (1, 2, 3):
                for i in range(len(w) - s + 1):
                    f["und" if lang is None else lang][tuple(w[i : i + s])] += 1
    return f


def _brute(rows, min_count=10, top=2000):
    out = set()
    for lang, f in _ngrams(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


def _corpus(n=160, seed=4):
    rng = random.Random(seed)
    vocab = ["The", "cat", "sat", "é", "Éa", "on", "mat\x1c", "a-b", "x y", "😀", "b"]
    rows = []
    for i in range(n):
        words = rng.choices(vocab, weights=[9, 7, 6, 5, 4, 3, 3, 2, 2, 1, 1], k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "\x0b", "  ", "; "]) for w in words)
        rows.append((text, [None, "en", "en", "und", "de"][i % 5]))
    return rows + [(None, "en"), ("", None), ("one " * 40_000, "en"), ("one " * 40_000, "en"), (" .,;:!?\n", "xx")]


@pytest.mark.parametrize("block,ranges", [(300, 2000), (1 << 20, 1 << 20)])
def test_equals_brute_force(spark, block, ranges):
    rows = _corpus()
    df = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    for top in (2000, 7):
        got = {tuple(r) for r in collocations(spark, df, top=top, block_bytes=block, range_bytes=ranges).collect()}
        assert got == _brute(rows, top=top) and got


def test_transducers_count_every_ngram_once(spark):
    rows = _corpus(60)
    df = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    machines, bounds = ngram_transducers(spark, df, block_bytes=500, range_bytes=4000)
    got, ranges = defaultdict(Counter), set()
    for r in machines.collect():
        a = Automaton.unpack(bytes(r.words), bytes(r.final), bytes(r.widths), bytes(r.arcs))
        columns, counts = a.rows(3)
        for *key, n in zip(*[c.tolist() for c in columns], counts.tolist()):
            phrase = tuple(a.words[k - 1] for k in key if k)
            at = (r.lang.encode(), phrase)
            assert (not r.range or bounds[r.range - 1] <= at) and (r.range == len(bounds) or at < bounds[r.range])
            got[r.lang][tuple(w.decode() for w in phrase)] += n
            ranges.add(r.range)
    want = _ngrams(rows)
    assert got == {k: v for k, v in want.items() if v} and len(ranges) > 3


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations(spark, empty).count() == 0
    few = spark.createDataFrame([(1, None, None, "x", 1), (2, "a b", "en", "x", 1)], SCHEMA)
    assert collocations(spark, few).count() == 0
    # counts whose products pass 64 bits are exact: see the decimal types
    same = spark.createDataFrame([(i, "p q", "en", None, None) for i in range(10)], SCHEMA)
    assert [tuple(r) for r in collocations(spark, same).collect()] == [("en", 1, "p q", 10, 10, 10, 20, 1_000_000)]
