"""Personal data: base spans against the plain patterns, bootstrapping, redaction."""

import random
import re
from itertools import groupby

from pyspark.sql import functions as F

from sentinela.llm.pii import KINDS, find_personal_data, redacted, spans_text

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _ok(kind, v):
    d = [int(c) for c in v if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        worth = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1]))
        return 12 <= len(d) <= 19 and worth % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def _base(text):
    out = []
    for n, kind in enumerate(KINDS):
        out += [(m.start(), n, m.end()) for m in re.finditer(PLAIN[kind], text or "") if _ok(kind, m[0])]
    return ",".join(f"{KINDS[n]}:{a}:{b}" for a, n, b in sorted(out))


def _docs():
    rng = random.Random(11)
    parts = ["a@b.c", "@", ".", "x_y%z", "é", "😀", " ", "\n", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "+1 (555) 123-4567", "+", "-", "9",
             "007.08.09.1", "5500-0000-0000-0004", "b@c-d.e.f", "1", "12", "(", ")", "_", "user.name@site.example.org", "0000000000000000000000"]
    docs = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(250)]
    docs += ["a@b.c@d.e a@b.c_x@d.e", "a.b@c..d@e.f", "1.2.3.4.5.6.7.8", "x@y", "+12 345 678 90 (", "@" * 50, "é 😀 a@b.cd", "a" * 60_000, "1 " * 30_000,
             "a@" * 20_000, "+1(" * 20_000, "4111111111111111", "00001.2.3.4", "", None]
    return docs


def test_base_spans(spark):
    docs = list(enumerate(_docs()))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).selectExpr("*", "'x' AS spans", "1 AS found", "2 AS value")
    got = find_personal_data(spark, df)
    assert sorted(got.columns) == ["doc_id", "spans", "text", "value"]
    rows = got.select("doc_id", spans_text(F.expr("filter(spans, s -> s.base)")).alias("s"), spans_text(F.col("spans")).alias("all")).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.s == _base(docs[r.doc_id][1]), docs[r.doc_id]
        assert set(filter(None, r.s.split(","))) <= set(r["all"].split(","))
    assert find_personal_data(spark, df.limit(0)).count() == 0


def test_patterns_discover_unseen_identifiers(spark):
    rng = random.Random(1)
    filler = "lorem ipsum dolor sit amet consetetur".split()
    text = lambda mid: f"{rng.choice(filler)} {rng.choice(filler)} {mid} {rng.choice(filler)} x{rng.choice('12')}"
    docs = [text(f"please call +1 555 123 {i:04d} today") for i in range(20)]
    docs += [text(f"write to me{i}@site.org") for i in range(20)]
    docs += [text("please call 555-987-6543 today"), text("write to someone@intranet soon"), text("serial number 555-987-6544 ok"), text("please call x1 now")]
    rows = list(enumerate(docs)) + [(3, docs[3]), (None, docs[20])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = find_personal_data(spark, df).select("doc_id", "text", "spans", redacted(F.col("text"), F.col("spans")).alias("out")).collect()
    assert len(got) == len(rows)
    added = {(r.doc_id, s.kind, r.text[s.start : s.end]) for r in got for s in r.spans if not s.base}
    assert added == {(40, "phone", "555-987-6543"), (41, "email", "someone@intranet")}
    for r in got:
        kinds = re.findall(r"\[(\w+)\]", r.out)
        assert kinds == [s.kind.upper() for s in r.spans]
        kept = re.sub(r"\[\w+\]", "", r.out)
        assert all(r.text[s.start : s.end] not in kept for s in r.spans)


def test_redaction_of_overlaps(spark):
    rows = [("é +4111111111111111 b", 0), ("a@b.cd,e@f.gh", 1), (None, 2), ("none", 3)]
    df = spark.createDataFrame(rows, "text string, doc_id long")
    out = find_personal_data(spark, df).select("doc_id", redacted(F.col("text"), F.col("spans")).alias("t")).collect()
    got = {r.doc_id: r.t for r in out}
    assert got[1] == "[EMAIL],[EMAIL]" and got[2] is None and got[3] == "none"
    assert got[0] in ("é +[CARD] b", "é [PHONE] b") and all(len(list(g)) for _, g in groupby(got))


def _added(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    rows = find_personal_data(spark, df).select("doc_id", "text", "spans").collect()
    return {(r.doc_id, s.kind, r.text[s.start : s.end]) for r in rows for s in r.spans if not s.base}


def test_contexts_are_those_of_the_text(spark):
    """Neighbouring tokens, and punctuation after or before an instance."""
    docs = [f"n{i} order {i} please call +1 555 123 {i:04d}, ok" for i in range(9)]
    docs += [f"w{i} he wrote ({i}) to \"me{i}@site.org\". Bye" for i in range(9)]
    docs += ["id 42 call 555-987-6543, ok", "k9 please call 555-987-6544", "c3po wrote (x1) to \"someone@intranet\". Bye", "he wrote 2 555-987-6545. Bye"]
    assert _added(spark, docs) == {(18, "phone", "555-987-6543"), (19, "phone", "555-987-6544"), (20, "email", "someone@intranet")}


def test_contexts_equal_substrings(spark):
    from sentinela.llm.common import written
    from sentinela.llm.pii import CONTEXT, _instances, scan

    docs = [(i, t) for i, t in enumerate(_docs()) if t and len(t) < 5000]
    docs += [(1000, "7 " * 300), (1001, "a@b.c_" * 60), (1002, "x " * 50 + "(u@v), ::1 (555)123 @ 9. +1(2+1(2+1(2 é" + " y" * 50)]
    text = dict(docs)
    scanned = scan(spark.createDataFrame(docs, "rid long, text string"), "text").select("rid", "found")
    for r in _instances(written(spark, scanned, "scanned")).collect():
        t = text[r.rid]
        assert r.value == t[r.start : r.end]
        assert r.left == t[max(0, r.start - CONTEXT) : r.start] and r.right == t[r.end : r.end + CONTEXT]


def test_taken_instances_bring_patterns(spark):
    seeds = [f"aa call +1 555 123 {i:04d} now" for i in range(60)]
    bridge = [f"aa call 555-987-{i:04d} now" for i in range(5)] + [f"zz dial 555-987-{i:04d} soon" for i in range(5)]
    far = ["zz dial 555-111-2222 soon"]
    got = _added(spark, seeds + bridge + far)
    assert {v for _, _, v in got} == {f"555-987-{i:04d}" for i in range(5)} | {"555-111-2222"}
