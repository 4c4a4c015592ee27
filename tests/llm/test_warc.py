"""WARC: round trip, damage, gaps."""

import gzip
import random
from collections import defaultdict

from pyspark.sql import functions as F

from sentinela.llm.warc import gzip_member, page_number, payload_digest, read_archives, record_bytes, salvage, write_archives


def test_round_trip_with_revisits(spark, scratch):
    pages = [(i, f"http://a/{i}", f"<p>é {i % 7}</p>" * (i % 5)) for i in range(60)]
    pages += [(100, None, None), (101, "", ""), (102, "http://x y\r\nEvil: 1", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "only"), (None, "u", "<p>é 1</p>")]
    pages += [(103, "u", "big " * 300_000), (104, "u", "big " * 300_000), (105, "u", "same"), (105, "u", "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'c' AS content", "1 AS sha", "2 AS first")
    path = write_archives(spark, df.repartition(3), scratch, segment_bytes=2000)
    got = read_archives(spark, path).withColumn("id", page_number("record_id").cast("long")).withColumn("to", page_number("refers_to").cast("long"))
    rows = got.collect()
    assert len(rows) == len(pages) and not any(r.reason for r in rows)
    first = {}
    for i, _, h in pages:
        h = h or ""
        first[h] = min((x for x in (first.get(h), i) if x is not None), default=None)
    left = defaultdict(list)
    for i, _, h in pages:
        left[i].append(h or "")
    for r in rows:
        text = next(t for t in left[r.id] if payload_digest(t.encode()) == r.payload_digest)
        assert r.payload_bytes == len(text.encode())
        if r.id == first[text]:
            assert (r.record_type, r.to, bytes(r.payload)) == ("response", None, text.encode())
        else:
            assert (r.record_type, r.to, r.payload) == ("revisit", first[text], None)
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    raw = b"".join(gzip.open(f.removeprefix("file:"), "rb").read() for f in files)  # readable by others
    assert raw.count(b"WARC-Record-ID") == len(pages)


def test_minimum_size_and_empty_table(spark, scratch):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    path = write_archives(spark, df, scratch, min_revisit_bytes=3)
    got = {r.id: r.record_type for r in read_archives(spark, path).select(page_number("record_id").alias("id"), "record_type").collect()}
    assert got == {"1": "response", "2": "response", "3": "response", "4": "revisit"}
    assert read_archives(spark, write_archives(spark, df.limit(0))).count() == 0


def _texts(data):
    out = list(salvage(data))
    return [r["payload"].decode() for r in out if r["reason"] is None], [(r["offset"], r["length"]) for r in out if r["reason"]]


def test_salvage_of_damaged_members():
    rng = random.Random(8)
    texts = [f"page {i} " * rng.randint(1, 400) for i in range(30)]
    members = [gzip_member(record_bytes(i, "u", t.encode())) for i, t in enumerate(texts)]
    data = b"".join(members)
    assert _texts(data) == (texts, [])
    starts = [sum(map(len, members[:i])) for i in range(31)]
    for broken in (0, 7, 29):
        for kind in range(3):
            bad = bytearray(data)
            if kind == 0:  # a flipped byte inside
                bad[(starts[broken] + starts[broken + 1]) // 2] ^= 0x55
            elif kind == 1:  # the magic is gone
                bad[starts[broken]] = 0x41
            else:  # the checksum is wrong
                bad[starts[broken + 1] - 6] ^= 1
            got, gaps = _texts(bytes(bad))
            assert got == texts[:broken] + texts[broken + 1 :]
            assert gaps == [(starts[broken], len(members[broken]))]
    got, gaps = _texts(b"junk" + data[:-5])
    assert got == texts[:-1] and gaps == [(0, 4), (4 + starts[29], len(members[29]) - 5)]
    got, gaps = _texts(data[: starts[3]] + b"\x1f\x8b\x08 false start" + data[starts[3] :] + b"\0\0")
    assert got == texts and gaps == [(starts[3], 15)]


def test_salvage_of_plain_records_and_mixtures():
    texts = ["one", "two", "WARC/1.1\r\nnot a record", ""]
    plain = [record_bytes(i, "u", t.encode()) for i, t in enumerate(texts)]
    assert _texts(b"".join(plain)) == (texts, [])
    mixed = plain[0] + gzip_member(plain[1] + plain[2]) + b"\0" + plain[3]
    assert _texts(mixed) == (texts, [])
    short = plain[1].replace(b"two", b"tw")  # the length runs over
    got, gaps = _texts(plain[0] + short + plain[3])
    assert got == ["one", ""] and gaps == [(len(plain[0]), len(short))]
    wrong = plain[1].replace(b"two", b"owt")  # the digest fails
    got, gaps = _texts(plain[0] + wrong + plain[3])
    assert got == ["one", ""] and gaps == [(len(plain[0]), len(wrong))]
    assert list(salvage(b"")) == [] and _texts(b"nothing here") == ([], [(0, 12)])


def test_gaps_are_logged_by_the_reader(spark, scratch):
    df = spark.createDataFrame([(i, "u", f"t{i}") for i in range(5)], "page_id long, url string, html string").coalesce(1)
    path = write_archives(spark, df, scratch)
    content = bytearray(spark.read.format("binaryFile").load(path).first().content)
    content[30] ^= 0xFF
    bad = spark.createDataFrame([(bytes(content),)], "c binary").select(F.col("c").cast("string"))
    bad.write.mode("overwrite").option("lineSep", "\0").text(path)
    rows = read_archives(spark, path, with_payload=False).collect()
    assert [r.reason is None for r in sorted(rows, key=lambda r: r.offset)] == [False, True, True, True, True]


def test_salvage_inside_members_of_many_records():
    rng = random.Random(3)
    texts = [f"page {i} " + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9000))) for i in range(40)]
    plain = [record_bytes(i, "u", t.encode()) for i, t in enumerate(texts)]
    assert _texts(gzip_member(b"".join(plain))) == (texts, [])
    for fault in (plain[7].replace(b"page 7", b"PAGE 7"), plain[7][:-30], plain[7].replace(b"WARC/1.1", b"WORC/1.1")):
        whole = gzip_member(b"".join([*plain[:7], fault, *plain[8:]]))
        got, gaps = _texts(whole)
        assert got == texts[:7] + texts[8:] and gaps == [(0, len(whole))]
    for level in (0, 4):  # stored blocks show their records to the outer search: none comes twice
        whole = gzip_member(b"".join(plain), level)
        after = gzip_member(record_bytes(99, "u", b"after"))
        got, gaps = _texts(whole[:-5])  # the checksum is cut off
        assert got == texts and len(gaps) >= 1
        got, gaps = _texts(whole[: len(whole) // 2] + after)
        assert got[-1] == "after" and got[:-1] == texts[: len(got) - 1] and len(got) > 15 and gaps
        bad = bytearray(whole)
        bad[len(bad) * 3 // 4] ^= 0x55
        got, gaps = _texts(bytes(bad) + after)
        assert got[-1] == "after" and got[:25] == texts[:25] and len(set(got)) == len(got) and gaps
        assert set(got) <= {*texts, "after"}
