"""Aho-Corasick decontamination against a window-by-window search."""

import random
import re

from pyspark.sql import functions as F

from sentinela.llm.decontamination import find_contamination, windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(t):
    return [] if t is None else WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))


def _brute(docs, items, size):
    out = {}
    for d, t in docs:
        w, hit, ids = _words(t), set(), set()
        for i, x in items:
            q = _words(x)
            n = min(size, len(q))
            for a in range(len(q) - n + 1) if q else []:
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == q[a : a + n]:
                        hit.update(range(at, at + n))
                        ids.add(str(i))
        out[d] = (len(w), len(hit), sorted(ids))
    return out


def test_against_brute_force(spark):
    rng = random.Random(4)
    vocab = ["a", "B", "éa", "ab", "x1", "É", "c"]
    text = lambda n: rng.choice([" ", "-", " ,"]).join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.randint(1, 9))) for i in range(12)] + [(90, None), (91, " .,"), (92, "zz"), (93, "ZZ"), (None, "a")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)] + [(100, None), (101, ""), (102, "q zz! q"), (103, "qzz " * 2000)]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS n_hit", "1 AS extra")
    q = spark.createDataFrame(items, "item_id long, text string")
    want = _brute(docs, [x for x in items if x[0] is not None], 4)
    for limit in (1 << 20, 150):  # one automaton; several in a row
        out = find_contamination(spark, d, q, window=4, max_pattern_bytes=limit)
        assert out.columns == ["doc_id", "text", "extra", "n_words", "n_hit", "items", "spans"]
        assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in out.collect()} == want


def test_spans_lead_to_the_original(spark):
    d = spark.createDataFrame([(1, "é… The  CAT,\nsat — on"), (2, "the cat satin")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "the cat sat")], "item_id long, text string")
    rows = {r.doc_id: r for r in find_contamination(spark, d, q).collect()}
    assert [rows[1].text[s.start : s.end] for s in rows[1].spans] == ["The  CAT,\nsat"]
    assert rows[2].spans == [] and rows[2].n_hit == 0


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert find_contamination(spark, d, q.limit(0)).first().n_hit == 0
    assert find_contamination(spark, d.limit(0), q).count() == 0
    assert windows("a b c", 2) == {b"a b", b"b c"} and windows(None, 2) == set()


def test_items_without_id_hit_in_query_and_stage(spark, scratch):
    import corpus_pipeline
    from sentinela.llm.queries import op7_benchmark_decontamination

    docs = spark.createDataFrame([(1, "one two three"), (2, "a b c")], "doc_id long, text string").withColumn("hits", F.lit("x"))
    docs.write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(None, "two three"), (5, "z")], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in op7_benchmark_decontamination(spark, scratch).collect()}
    assert got == {1: (2, 0, True), 2: (0, 0, False)}
    kept = corpus_pipeline.drop_contaminated(spark, docs, scratch)
    assert kept.columns == docs.columns and [(r.doc_id, r.hits) for r in kept.collect()] == [(2, "x")]
