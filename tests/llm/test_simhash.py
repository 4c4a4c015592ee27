"""Covering SimHash: the guarantee, fingerprints, components against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from sentinela.llm import simhash
from sentinela.llm.components import connected_components
from sentinela.llm.simhash import covering_masks, fingerprint, links, near_duplicate_components, one_of_each


@pytest.mark.parametrize("level", [0, 1, 5])
def test_masks_cover_every_difference(level):
    masks = [m & (2**64 - 1) for m in covering_masks(3, level)]
    assert len(masks) == 15
    for diff in itertools.combinations(range(64), 3):
        bits = sum(1 << i for i in diff)
        assert any(not m & bits for m in masks)


def _fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        ra, rb = find(a), find(b)
        root[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_components_of_documents(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(300)) for _ in range(4)]
    docs = [(i, t) for i, t in enumerate(base)]
    for i in range(10, 60):
        w = base[i % 4].split()
        w[rng.randrange(300)] = "changed"
        docs.append((i, " ".join(w)))
    docs += [(70, None), (71, ""), (72, "  "), (73, "One"), (74, "one"), (75, "one two"), (None, "lonely text here"), (76, base[0]), (76, base[0]), (77, "w " * 70000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 AS fp", "'c' AS component_id")
    got = near_duplicate_components(spark, df)
    assert got.columns == ["doc_id", "fp", "root", "component_id"]
    rows = got.collect()
    assert len(rows) == len(docs)
    fps = {d: _fp(t) for d, t in docs}
    known = [d for d in fps if d is not None]
    linked = [(a, b) for a in known for b in known if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    want = _roots(known, linked)
    assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in rows if r.doc_id is not None} == {d: (fps[d], want[d]) for d in known}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert near_duplicate_components(spark, df.limit(0)).count() == 0


def test_one_of_each(spark):
    rows = [(5, "a b c"), (3, "A b  c"), (9, "other words here"), (4, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS root")
    assert sorted(r.doc_id for r in one_of_each(spark, df).collect()) == [3, 4, 9]
    more = rows + [(9, "other words here"), (9, "third text now"), (3, "other words here"), (None, "a b c"), (None, "null only"), (None, "Null only")]
    df = spark.createDataFrame(more, "doc_id long, text string").selectExpr("*", "'k' AS root")
    got = one_of_each(spark, df)
    assert got.columns == df.columns
    kept = sorted((str(r.doc_id), (r.text or "").lower().split()) for r in got.collect())
    assert kept == [("3", ["a", "b", "c"]), ("3", ["other", "words", "here"]), ("4", []), ("9", ["third", "text", "now"]), ("None", ["null", "only"])]


@pytest.mark.parametrize("limit", [1024, 4])
def test_no_link_is_lost_in_large_buckets(spark, limit):
    rng = random.Random(9)
    fps = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(150):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x - 2**64 if x >> 63 else x)
    fps |= {rng.getrandbits(63) for _ in range(200)}
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    edges = links(spark, df, 3, bucket_limit=limit)
    got = {r.node: r.root for r in connected_components(spark, edges).collect()}
    want = _roots(fps, [(a, b) for a, b in itertools.combinations(fps, 2) if ((a ^ b) % 2**64).bit_count() <= 3])
    assert {x: got.get(x, x) for x in fps} == want


def test_components_of_a_path_and_a_star(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 2)]
    df = spark.createDataFrame(e, "u long, v long")
    got = {r.node: r.root for r in connected_components(spark, df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert connected_components(spark, df.limit(0)).count() == 0


def test_bucket_roots_and_fingerprint():
    assert simhash.bucket_roots(np.array([0, 1, 3, 255 << 8], np.int64), 1) == [(1, 0), (3, 0)]
    for t in ("", None, "a", "A b", "a b c d e", "é ü a b\x0bc"):
        assert fingerprint(t) % 2**64 == _fp(t)
