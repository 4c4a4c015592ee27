"""Case tables, FIXTURES §3.1: pages in three layouts -> bronze/silver/gold."""

import datetime as dt

from sentinela.plans.cases import bronze_cases, gold_cases, silver_cases
from sentinela.plans.layouts import PUBLISHED_LAYOUTS, Layout, layout_frame
from sentinela.plans.runner import run_cases

TITLES = "".join(f"<tr><td colspan=43>title {i}</td></tr>" for i in range(5))


def td(v):
    return f"<td>{v}</td>"


def wide_row(region, town, values, rowspan=None):
    lead = "".join(td(x) for x in ["a", "b", "c", "d", "e"])
    reg = "" if region is None else (f'<td rowspan="{rowspan}">{region}</td>' if rowspan else td(region))
    return "<tr>" + lead + reg + td(town) + "".join(td(v) for v in values) + "</tr>"


def shifted_row(region, town, values):
    return "<tr>" + td("a") + td("b") + td(region) + td(town) + "".join(td(v) for v in values) + "".join(td("t") for _ in range(3)) + "</tr>"


def page(rows):
    return f"<html><body><p>x</p><table>{TITLES}{rows}</table><table><tr><td>SOROCABA</td></tr></table></body></html>"


def wide_values():
    return ["" if v % 5 == 0 else str(v) for v in range(1, 37)]


def pages_df(spark):
    p2020 = page(
        wide_row("Sorocaba", "355220 Sorocaba", wide_values(), rowspan=2)
        + wide_row(None, "352110 Iperó", ["1"] * 36)  # region cell merged from above
        + wide_row("CAMPINAS", "350950 Campinas", ["9"] * 36)
        + wide_row("SOROCABA ", "999 Trailing", ["7"] * 36)  # trailing blank is trimmed by the parser
    )
    p2021 = page(shifted_row("SOROCABA", "352110 Iperó", [str(v) for v in range(101, 137)]))
    p2024 = page(wide_row("sorocaba", "355220 Sorocaba", [str(v) for v in range(201, 216)] + ["999", "888"]))
    return spark.createDataFrame(
        [("dengue", 2020, p2020), ("dengue", 2021, p2021), ("dengue", 2024, p2024), ("dengue", 2019, p2020)],
        "disease string, year int, html string",
    )


def test_bronze_shape(spark):
    bronze = bronze_cases(pages_df(spark), layout_frame(spark, PUBLISHED_LAYOUTS))
    rows = {(r.coluna_0, r.coluna_37): r for r in bronze.collect()}
    assert set(rows) == {("Sorocaba", "2020"), ("Iperó", "2020"), ("Trailing", "2020"), ("352110 Iperó", "2021"), ("Sorocaba", "2024")}
    r = rows[("Sorocaba", "2024")]
    assert r.coluna_15 == "215" and r.coluna_16 == "0" and r.coluna_36 == "0"  # partial year: rest is 0
    assert rows[("Sorocaba", "2020")].coluna_10 == "0"  # empty cell -> 0
    assert len(bronze.columns) == 39


def test_silver_golden(spark):
    bronze = bronze_cases(pages_df(spark), layout_frame(spark, PUBLISHED_LAYOUTS))
    silver = silver_cases(bronze)
    got = {}
    for r in silver.collect():
        got.setdefault((r.municipio_resid, r.ano_mes.year), {})[r.ano_mes.month] = r.casos
    assert [got[("Sorocaba", 2020)][m] for m in range(1, 13)] == [1, 4, 7, 0, 13, 16, 19, 22, 0, 28, 31, 34]
    assert [got[("352110 Iperó", 2021)][m] for m in range(1, 13)] == list(range(101, 137, 3))
    assert [got[("Sorocaba", 2024)][m] for m in range(1, 13)] == [201, 204, 207, 210, 213] + [0] * 7
    assert silver.count() == 12 * 5
    months = [r.ano_mes for r in silver.select("ano_mes").collect()]
    assert months == sorted(months)


def test_gold_and_rerun(spark, scratch):
    layouts = layout_frame(spark, PUBLISHED_LAYOUTS)
    first = run_cases(spark, pages_df(spark), layouts, scratch, incomplete="report")
    assert first.columns == ["municipio_resid", "ano_mes", "qtd_casos", "caso"]
    before = sorted(map(tuple, first.collect()))
    again = run_cases(spark, pages_df(spark), layouts, scratch, incomplete="report")  # full refresh, same result
    a = sorted(map(tuple, again.collect()))
    assert len(a) == 60
    assert ("Sorocaba", dt.date(2024, 2, 1), 204, "dengue") in a
    assert before == a
    unread = spark.read.parquet(f"{scratch}/_reports/casos_pages_without_layout").collect()
    assert [(r.disease, r.year) for r in unread] == [("dengue", 2019)]


def test_row_range_and_repairs(spark):
    html = page(
        wide_row("SOROCABA", "1 IperÃ³", ["1"] * 36)
        + wide_row("SOROCABA", "2 Tarde", ["2"] * 36)
    )
    # first_row 4 keeps the last title row out only through the region test;
    # end_row 6 keeps row 5 (IperÃ³) and drops row 6.
    layouts = layout_frame(spark, [Layout("zika", 2020, 4, 6, 5, 6, 36, True)])
    pages = spark.createDataFrame([("zika", 2020, html)], "disease string, year int, html string")
    bronze = bronze_cases(pages, layouts)
    assert [r.coluna_0 for r in bronze.collect()] == ["Iperó"]


def test_gold_label(spark):
    silver = spark.createDataFrame([("d", "X", dt.date(2020, 1, 1), 3)], "disease string, municipio_resid string, ano_mes date, casos bigint")
    assert gold_cases(silver, "dengue").first().asDict() == {
        "municipio_resid": "X", "ano_mes": dt.date(2020, 1, 1), "qtd_casos": 3, "caso": "dengue"
    }
