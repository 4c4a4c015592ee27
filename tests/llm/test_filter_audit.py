"""Filter audit: the matrix itself, and every order against a loop over documents."""

import re
from collections import defaultdict
from itertools import permutations

from sentinela.llm.filter_audit import audit, column_ids, document_term_shards, failed_filters, unpack

SCHEMA = "doc_id long, text string, lang string, words string, mask int"
LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i}" for i in range(30_000))
TEXTS = [
    None, "", " \t\n", "one two", "one two", "ONE TWO THREE", "cost: 5$", LONG, LONG, " ".join(["same"] * 150),
    " ".join(f"w{i}" for i in range(120)), "a\x1cb\x85c d", "é" * 40 + " A", "x\x0by\x0cz",
]
ROWS = [(i * 7 % 31, t, [None, "en", "de"][i % 3]) for i, t in enumerate(TEXTS)] + [(None, "one two", "en"), (3, "one two", "en"), (3, "one two", "en")]
MARKS = [(0, 1, 0), (7, 1, 1), (7, 0, 0), (3, None, 1), (None, 1, 1), (99, 1, 1), (21, 1, None)]


def _brute(rows, marks):
    good, toxic = {d for d, q, _ in marks if q == 1}, {d for d, _, t in marks if t == 1}
    low = {}
    for d, t, _ in rows:
        if d is not None:
            low[t or ""] = min(low.get(t or "", d), d)
    out = defaultdict(lambda: [0] * 7)
    parts = {lang or "" for _, _, lang in rows}
    docs = []
    for d, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        fails |= {"A"} if len(w) < 100 else set()
        fails |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if d is not None and t in low and d > low[t] else set()
        docs.append((d, lang or "", fails))
    shap = defaultdict(int)
    for o in permutations("ABCDE"):
        for part in parts:
            for s, x in enumerate(o, 1):
                out[part, "".join(o), s]
        for d, part, fails in docs:
            gone = False
            for s, x in enumerate(o, 1):
                r = out[part, "".join(o), s]
                hit = x in fails
                r[0] += not gone and not hit
                r[1] += hit and not gone
                r[2] += hit and gone
                r[3] += fails == {x}
                r[4] += hit and not gone and d in good
                r[5] += hit and not gone and d in toxic
                shap[part, x] += hit and not gone
                gone |= hit
    return {(*k, *v[:6], shap[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_all_orders_equal_brute_force(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA)
    labels = spark.createDataFrame(MARKS, LABELS)
    want = _brute(ROWS, [m for m in MARKS if m[0] is not None])
    for size in (64, 1 << 20):
        got = audit(spark, docs, labels, shard_bytes=size).collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want) == 3 * 600


def test_matrix_holds_every_word_once(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA)
    shards, dictionary = document_term_shards(spark, docs, shard_bytes=64)
    words = {r.id: bytes(r.word, "utf-8") for r in dictionary.collect()}
    assert sorted(words) == list(range(len(words))) and len(set(words.values())) == len(words)
    seen = []
    for r in shards.collect():
        ptr, cols = unpack(r.indptr, ascending=True), column_ids([c.asDict() for c in r.columns or []])
        ids, data = cols[unpack(r.indices, ascending=True)], unpack(r.data)
        for i, d in enumerate(r.doc_ids):
            row = {words[k]: n for k, n in zip(ids[ptr[i] : ptr[i + 1]].tolist(), data[ptr[i] : ptr[i + 1]].tolist())}
            seen.append((d, sorted(row.items())))
    want = []
    for d, t, _ in ROWS:
        counts = defaultdict(int)
        for w in (t or "").encode().split():
            counts[w] += 1
        want.append((d, sorted(counts.items())))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(seen, key=key) == sorted(want, key=key)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame(MARKS, LABELS)
    assert audit(spark, docs, labels).count() == 0
    one = spark.createDataFrame([(None, None, None, "x", 1)], SCHEMA)
    got = audit(spark, one, labels.limit(0)).collect()
    assert len(got) == 600 and sum(r.removed for r in got) == 120 and failed_filters(document_term_shards(spark, one)[0]).first().mask == 1
