"""Station archives of any keys are made by one shuffle."""

import io
import random
import re
import zipfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sentinela.plans import table_inputs
from sentinela.plans.table_inputs import (
    LINE_ORDER,
    station_lines,
    supplier_station_archives,
    supplier_station_bounds,
)

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark, rows):
    """``(order, supplier, line, day)`` rows with measures made up from their place."""
    made = [(o, i, s, n, i % 7 + 0.5, i * 10.0, 0.25, None if i % 3 else 0.5, d) for i, (o, s, n, d) in enumerate(rows)]
    df = spark.createDataFrame(made, LINES.replace("timestamp_ntz", "string"))
    return df.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))


def _members(archives):
    out = {}
    for r in archives.collect():
        assert r.archive not in out
        with zipfile.ZipFile(io.BytesIO(r.content)) as z:
            out[r.archive] = {n: z.read(n).decode("ISO-8859-1") for n in z.namelist()}
            assert sorted(out[r.archive]) == z.namelist()
    return out


def test_archives_are_made_by_one_shuffle(spark):
    plan = _plan(supplier_station_archives(_rows(spark, [(1, 1, 1, "1995-01-01")])))
    assert len(re.findall(r"Exchange", plan)) == 1 and "Window" not in plan


@pytest.mark.parametrize("batch_rows", ["3", "10000"])
def test_archives_of_any_keys(spark, batch_rows):
    """Names and lines as a plain loop makes them: stations whose number is cut to six places, that lie
    in several archives, that end in any year; keys below 0, missing and repeated."""
    rng = random.Random(5)
    suppliers = [None, 0, 1, 24, 25, 26, -1, -30, 123456, 123457, 1234560, 1234575, 1234576, 12345600, 12345699]
    orders = [None, -300_000, -1, 0, 1, 199_999, 200_000, 450_000]
    rows = [
        (rng.choice(orders), rng.choice(suppliers), rng.choice([1, 4, 5, 6, 7, None]), f"{rng.randrange(1995, 1999)}-{rng.randrange(1, 13):02d}-11")
        for _ in range(600)
    ]
    lines = _rows(spark, rows + rows[:40])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        got = _members(supplier_station_archives(lines))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ends = {r.cidade: r.end.strftime("%d-%m-%Y") for r in supplier_station_bounds(lines).collect() if r.cidade}
    want, files = defaultdict(set), defaultdict(list)
    for r in station_lines(lines).collect():
        div = lambda n, by: "null" if n is None else int(n / by)
        archive = f"{r.l_shipdate.year}_{div(r.l_suppkey, 25)}_{div(r.l_orderkey, 200000)}.zip"
        want[archive] |= {"LEIA-ME.txt", f"{r.l_shipdate.year}/notas.csv"}
        if r.l_suppkey is None or r.l_orderkey is None:
            continue
        station = f"SE_XX_A{str(r.l_suppkey).rjust(6, '0')[:6]}B{r.l_orderkey // 200000}"
        year = str(r.l_shipdate.year)
        end = ends[station] if ends[station].endswith(year) else f"31-12-{year}"
        name = f"{year}/INMET_{station}_01-01-{year}_A_{end}.CSV"
        want[archive].add(name)
        key = [(r[c] is not None, r[c]) if r[c] is not None else (False, 0) for c in LINE_ORDER]
        files[archive, name].append((key, r.text))
    assert {a: set(m) for a, m in got.items()} == dict(want)
    for (archive, name), found in files.items():
        body = got[archive][name].split("\r\n")
        assert body[:8] == table_inputs.PREAMBLE and body[8] == body[-2] == table_inputs.STATION_HEADER and body[-1] == ""
        assert body[9:-2] == [text for _, text in sorted(found)]
    assert any(len(found) > 1 for found in files.values())


def test_a_line_without_a_date_has_no_archive(spark):
    with pytest.raises(Exception, match="without a date"):
        supplier_station_archives(_rows(spark, [(1, 1, 1, None)])).collect()


def test_station_lines_leave_out_missing_fields(spark):
    def line(**changed):
        row = dict(l_orderkey=1, l_partkey=123, l_suppkey=1, l_linenumber=1, l_quantity=5.0, l_extendedprice=10.5, l_discount=0.25, l_tax=0.5, l_shipdate="1995-01-02")
        df = spark.createDataFrame([tuple({**row, **changed}.values())], LINES.replace("timestamp_ntz", "string"))
        return station_lines(df.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz"))).first().text

    assert line() == "1995/01/02;0300 UTC;0,25;;10,5;5,0;;;;0,5;-5,0;;;;;23;;;;"
    assert line(l_linenumber=4) == "1995/01/02;1200 UTC;;;;;;;;;;;;;;;;;;"
    assert line(l_linenumber=5) == "1995/01/02;1500 UTC;0,25;;10,5;5,0;;;;0,5"
    assert line(l_linenumber=6, l_partkey=20).endswith(";5f;;;;;20;;;;;x;y")
    assert line(l_linenumber=7).startswith("lixo;2100 UTC;")
    assert line(l_quantity=None, l_linenumber=None, l_shipdate=None) == "0,25;;10,5;;;;0,5;;;;;23;;;;"
