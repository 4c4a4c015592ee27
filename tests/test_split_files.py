"""Files read in blocks give the rows of the reader that holds a whole file."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from sentinela.sources.delimited import read_delimited
from sentinela.sources.files import parse_file_name  # noqa: F401  (the module imports)
from sentinela.sources.split_files import file_lines, read_delimited_files


@pytest.fixture()
def small_blocks(spark):
    """Blocks of some 200 bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _save(folder, files):
    os.makedirs(folder)
    for name, data in files.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data)


def _random_file(rng, eol=b"\r\n"):
    lines = [f"titulo {i};x".encode() for i in range(rng.randint(0, 12))]
    for _ in range(rng.randint(0, 120)):
        cells = [rng.choice(["1,5", "", "abc", "é", 'a"b', '"q;z"', " "]) for _ in range(rng.choice([3, 4, 4, 4, 5]))]
        lines.append(rng.choice([b"", b"", ";".join(cells).encode("latin-1"), ";".join(cells).encode("latin-1"), ";".join(cells).encode("latin-1")]))
    return eol.join(lines) + rng.choice([b"", eol])


@pytest.mark.parametrize("skip", [0, 8])
def test_same_rows_as_the_one_row_reader(spark, small_blocks, tmp_path, skip):
    rng = random.Random(skip)
    files = {f"f{i}.csv": _random_file(rng, rng.choice([b"\n", b"\r\n"])) for i in range(12)}
    files.update({"empty.csv": b"", "blank.csv": b"\n" * 30, "one.csv": b"a;b", "late.csv": b"t\n" * 8 + b"\n" * 500 + b"a;b\n1;2\n1;2;3\n"})
    _save(tmp_path / "in", files)
    got = read_delimited_files(spark, str(tmp_path / "in"), skip_rows=skip)
    whole = spark.createDataFrame([(n, bytearray(d)) for n, d in files.items()], "name string, content binary")
    want = read_delimited(whole, skip_rows=skip)
    key = lambda df: sorted((r.name, r.line_no, tuple(r.fields)) for r in df.collect())
    assert key(got) == key(want) and got.count() > 100
    _, blocks = file_lines(spark, str(tmp_path / "in"))
    assert blocks.groupBy("file").count().agg(F.max("count")).first()[0] > 3  # really in several blocks


def test_quoted_breaks_across_blocks(spark, small_blocks, tmp_path):
    rng = random.Random(5)
    files, want = {}, []
    for i in range(6):
        out = io.StringIO()
        writer = csv.writer(out, delimiter=";", lineterminator="\n")
        rows = [["k", "texto", "fim"]] + [
            [str(j), rng.choice(["x", "a;b", 'dito "assim"', "linha\noutra", "\n\n", "y" * 150 + "\n" + "z" * 300 + "\n;fim", ""]), "é"]
            for j in range(rng.randint(1, 40))
        ]
        writer.writerows(rows)
        text = "titulo sem aspas\n" + out.getvalue()
        files[f"f{i}.csv"] = text.encode("utf-8")
        at = 1
        for r in rows:
            want.append((f"f{i}.csv", at, tuple(r)))
            at += 1 + r[1].count("\n")
    _save(tmp_path / "in", files)
    got = read_delimited_files(spark, str(tmp_path / "in"), skip_rows=1, encoding="UTF-8", multiline=True)
    assert sorted((r.name, r.line_no, tuple(r.fields)) for r in got.collect()) == sorted(want)


def test_an_open_quote_swallows_nothing(spark, small_blocks, tmp_path):
    _save(tmp_path / "in", {"a.csv": b'a;b\n1;"x\ny"\n2;"open\n3;z\n', "b.csv": b'a;b\n"1";2\n'})
    got = read_delimited_files(spark, str(tmp_path / "in"), skip_rows=0, multiline=True)
    rows = sorted((r.name, r.line_no, tuple(r.fields)) for r in got.collect())
    assert rows == [
        ("a.csv", 0, ("a", "b")), ("a.csv", 1, ("1", "x\ny")), ("a.csv", 3, ('2;"open',)), ("a.csv", 4, ("3", "z")),
        ("b.csv", 0, ("a", "b")), ("b.csv", 1, ("1", "2")),
    ]


def test_fixed_width_and_globs(spark, tmp_path):
    _save(tmp_path / "in", {"a.CSV": b"1;2;3\n1;2\n", "b.txt": b"no;no\n"})
    got = read_delimited_files(spark, str(tmp_path / "in"), skip_rows=0, n_fields=2, glob="*.CSV")
    assert [(r.name, r.line_no, r.fields) for r in got.collect()] == [("a.CSV", 1, ["1", "2"])]
