"""The work of the archive and block readers does not grow with the number of small archives or scans."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from sentinela.plans import table_inputs
from sentinela.plans.table_inputs import (
    lineitem_station_files,
    saved_files,
    saved_station_files,
    supplier_station_archives,
    supplier_station_bounds,
    zip_archives,
)
from sentinela.sources.archives import ZipMembers, unzip_members, zip_members

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lineitem(spark, n=400):
    i = F.col("id")
    return spark.range(n).select(
        (i * 7919 % 900_000).alias("l_orderkey"), (i * 13).alias("l_partkey"), F.when(i % 50 != 0, i % 83).alias("l_suppkey"),
        (i % 7 + 1).cast("int").alias("l_linenumber"), (i % 9).cast("double").alias("l_quantity"), (i * 1.5).cast("double").alias("l_extendedprice"),
        F.lit(0.25).cast("double").alias("l_discount"), F.lit(0.5).cast("double").alias("l_tax"),
        F.expr("timestamp_ntz'1995-03-01 00:00:00' + make_dt_interval(cast(id % 900 as int))").alias("l_shipdate"),
    )


def test_archives_are_made_without_a_join_or_a_call_each(spark):
    made = supplier_station_archives(_lineitem(spark))
    plan = _plan(made)
    assert "Join" not in plan and "FlatMapGroups" not in plan


def test_periods_are_those_of_the_bounds(spark):
    lines = _lineitem(spark)
    made = supplier_station_archives(lines).collect()
    assert len({r.archive for r in made}) == len(made)
    names = {n.split("/")[-1] for r in made for n, _, _, _ in zip_members(r.content)}
    stations = {r.cidade: r.end.strftime("%d-%m-%Y") for r in supplier_station_bounds(lines).collect() if r.cidade}
    files = [n for n in names if n.startswith("INMET_")]
    assert {n[6:].split("_01-01-")[0] for n in files} == set(stations)
    last = {s: any(n == f"INMET_{s}_01-01-{e[-4:]}_A_{e}.CSV" for n in files) for s, e in stations.items()}
    assert all(last.values())
    assert {"notas.csv", "LEIA-ME.txt"} <= names


@pytest.mark.parametrize("deflate", [True, False])
def test_zip_and_unzip_in_batches(spark, monkeypatch, deflate):
    monkeypatch.setattr(table_inputs, "BATCH_BYTES", 10)  # the smallest batches
    rows = [(f"z{i % 37}.zip", f"d/m{i:04d}.csv", bytearray(b"%d;" % i * (i % 11))) for i in range(500)]
    members = spark.createDataFrame(rows, "archive string, member string, data binary").repartition(5)
    zipped = zip_archives(members, deflate)
    assert zipped.count() == 37
    for r in zipped.collect():
        inside = [n for n, _, _, _ in zip_members(r.content)]
        assert inside == sorted(m for a, m, _ in rows if a == r.archive)
    # and a damaged, an empty and a null archive
    more = [("cut", bytearray(b"PK\x03\x04x")), ("empty", bytearray()), ("null", None)]
    src = zipped.select("archive", "content").unionByName(spark.createDataFrame(more, "archive string, content binary"))
    got = unzip_members(src.withColumnRenamed("archive", "name"))
    assert got.columns == ["archive_name", "member", "name", "content", "error"]
    key = lambda r: (r[0], r[1] or "", bytes(r[3] or b""), r[4] or "")
    by_udtf = src.lateralJoin(ZipMembers(F.col("content").outer(), F.lit(None).cast("string")))
    want = by_udtf.toDF("archive_name", "archive", "member", "name", "content", "error").drop("archive")
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and got.count() == 503


def test_members_are_named_by_pattern(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a/x.CSV", b"1")
        z.writestr("a/y.txt", b"2")
    src = spark.createDataFrame([("a", bytearray(buf.getvalue()))], "archive string, content binary")
    assert [r.member for r in unzip_members(src, name_pattern=r"\.CSV$").collect()] == ["a/x.CSV"]
    assert unzip_members(src, name_pattern="nothing").count() == 0


def test_station_files_are_written_by_line(spark, tmp_path):
    lines = _lineitem(spark)
    lines = lines.unionByName(lines.filter("l_orderkey % 3 = 0"))  # repeated rows too
    saved_station_files(lines, str(tmp_path / "by_line"), 100_000)
    saved_files(lineitem_station_files(lines, 100_000), str(tmp_path / "whole"))
    got, want = {}, {}
    for folder, found in (("by_line", got), ("whole", want)):
        for d in sorted((tmp_path / folder).glob("arquivo=*")):
            (file,) = d.glob("part-*")
            found[d.name] = file.read_bytes()
    assert len(got) > 20 and {n: d + b"\n" for n, d in got.items()} == want  # a whole value gets a line end of its own
