"""Scalar functions (FIXTURES §3.3) and the HTML grid, without layers."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from sentinela.functions import (
    comma_to_dot,
    lenient_date,
    lenient_double,
    month_number,
    na_to_null,
    repair_mojibake,
    strict_long,
    strip_code,
    upper_equals,
    year_month_date,
)
from sentinela.sources.files import parse_file_name, file_name, reporting_end, yearly_windows
from sentinela.sources.html import table_rows


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(col.alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, expected",
    [("355220 Sorocaba", "Sorocaba"), ("Sorocaba", "Sorocaba"), ("12  X", " X"), ("a 12 b", "a 12 b")],
)
def test_strip_code(spark, text, expected):
    assert one(spark, strip_code("x"), text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("", None), (" 5 ", 5.0), (".8", 0.8), ("-9999", -9999.0), ("1e3", 1000.0), ("nan", None),
     ("5f", None), ("1d", None), ("-", None), ("1.2.3", None), ("Infinity", None), ("+2.", 2.0), (None, None)],
)
def test_lenient_double(spark, text, expected):
    assert one(spark, lenient_double("x"), text) == expected


def test_comma_then_number(spark):
    assert one(spark, lenient_double(comma_to_dot("x")), ",8") == 0.8


@pytest.mark.parametrize("text, expected", [("12.9", 12), ("-1.9", -1), ("7", 7), (None, None)])
def test_strict_long(spark, text, expected):
    assert one(spark, strict_long("x"), text) == expected


def test_strict_long_fails_on_text(spark):
    with pytest.raises(PySparkException):
        one(spark, strict_long("x"), "abc")


def test_upper_equals_does_not_trim(spark):
    df = spark.createDataFrame([("sorocaba",), ("SOROCABA ",), ("Sorocaba",)], "x string")
    assert df.filter(upper_equals("x", "SOROCABA")).count() == 2


def test_month_number_and_date(spark):
    assert one(spark, month_number("x"), "fev") == "02"
    assert one(spark, month_number("x"), "xyz") is None
    df = spark.createDataFrame([("2021", "mar")], "ano string, mes string")
    assert df.select(year_month_date("ano", month_number("mes"))).first()[0] == dt.date(2021, 3, 1)


@pytest.mark.parametrize("ano, mes", [("2021", None), ("0", "01"), ("2021", "13"), ("20x1", "01")])
def test_year_month_date_is_strict(spark, ano, mes):
    df = spark.createDataFrame([(ano, mes)], "ano string, mes string")
    with pytest.raises(PySparkException):
        df.select(year_month_date("ano", "mes")).collect()


def test_lenient_date(spark):
    assert one(spark, lenient_date("x"), "2024/01/05") == dt.date(2024, 1, 5)
    assert one(spark, lenient_date("x"), "lixo") is None
    assert one(spark, lenient_date("x", ("yyyy/MM/dd", "yyyy-MM-dd")), "2019-12-31") == dt.date(2019, 12, 31)


def test_na_spellings(spark):
    for text in ["", "nan", "NaN", "N/A", "NULL", "null"]:
        assert one(spark, na_to_null("x"), text) is None
    assert one(spark, na_to_null("x"), "0") == "0"


@pytest.mark.parametrize(
    "text, expected",
    [("AraÃ§ariguama", "Araçariguama"), ("AlumÃ­nio", "Alumínio"), ("Iperó", "Iperó"),
     ("SÃO PAULO", "SÃO PAULO"), ("plain", "plain"), ("Ã© and é", "Ã© and é")],
)
def test_repair_mojibake(spark, text, expected):
    assert one(spark, repair_mojibake("x"), text) == expected


def test_yearly_windows(spark):
    bounds = spark.createDataFrame([("S", dt.date(2020, 1, 1), dt.date(2022, 2, 28))], "cidade string, start date, end date")
    rows = yearly_windows(bounds, keys=["cidade"]).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end) for r in rows] == [
        (dt.date(2020, 1, 1), dt.date(2020, 12, 31)),
        (dt.date(2021, 1, 1), dt.date(2021, 12, 31)),
        (dt.date(2022, 1, 1), dt.date(2022, 2, 28)),
    ]


def test_file_name_round_trip(spark):
    df = spark.createDataFrame([("SE_SP_A713_SOROCABA", dt.date(2024, 1, 1), dt.date(2024, 6, 30))], "s string, a date, b date")
    name = df.select(file_name("s", "a", "b").alias("n")).first()["n"]
    assert name == "INMET_SE_SP_A713_SOROCABA_01-01-2024_A_30-06-2024.CSV"
    parsed = spark.createDataFrame([(name,)], "n string").select(parse_file_name("n").alias("p")).first()["p"]
    assert (parsed.station, parsed.window_start, parsed.window_end) == ("SE_SP_A713_SOROCABA", dt.date(2024, 1, 1), dt.date(2024, 6, 30))


def test_reporting_end(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 15),)], "d date")
    assert df.select(reporting_end("d")).first()[0] == dt.date(2024, 2, 29)


def test_html_spans():
    rows = table_rows("<table><tr><th colspan=2>A</th><th>B</th></tr></table>")
    assert rows == [(-1, ["A", "A", "B"])]
    rows = table_rows(
        "<table><tr><td rowspan=2>SOROCABA</td><td>x</td></tr><tr><td>y</td></tr></table>"
        "<table><tr><td>other</td></tr></table>"
    )
    assert rows == [(0, ["SOROCABA", "x"]), (1, ["SOROCABA", "y"])]


def test_html_first_table_text_rules():
    html = (
        "<script>var t='<table><tr><td>no</td></tr></table>'</script>"
        "<table><thead><tr><td>h</td></tr></thead><tr><td> a \n b &amp; c </td><td></td></tr></table>"
    )
    assert table_rows(html) == [(-1, ["h"]), (0, ["a b & c", ""])]
    assert table_rows("<p>no table</p>") == []
    assert table_rows(None) == []


def test_html_sections_and_blank_rows():
    html = (
        "<table><thead><tr><th rowspan=2>H</th><th>x</th></tr></thead>"
        "<tbody><tr><td>b1</td></tr><tr></tr><tr><td> </td></tr><tr><td></td><td></td></tr><tr><td>b2</td></tr></tbody>"
        "<tfoot><tr><td>f</td></tr></tfoot></table>"
    )
    # the header rowspan is laid out within the header only; the single-blank
    # and empty rows are skipped, a row of two empty cells is kept
    assert table_rows(html) == [(-2, ["H", "x"]), (-1, ["H"]), (0, ["b1"]), (1, ["", ""]), (2, ["b2"]), (3, ["f"])]
