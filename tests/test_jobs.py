"""Job entry points: folders of pages / archives -> gold; SQL table functions."""

import datetime as dt
import os

import pytest

from sentinela.plans.jobs import run_pipeline
from sentinela.plans.layouts import PUBLISHED_LAYOUTS, layout_frame
from sentinela.plans.runner import run_cases
from sentinela.session import checkpoint_root, register_sql_functions, scratch_path
from sentinela.sources.html import read_pages
from sentinela.sources.layers import live_folders
from tests.test_climate import GOLDEN, station_file, zipped


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def _page(rows):
    return "<html><body><table>" + "<tr><td>t</td></tr>" * 5 + rows + "</table></body></html>"


def test_run_pipeline_disease_from_folder(spark):
    root = scratch_path(spark, "jobs")
    wide = "<tr>" + "<td>x</td>" * 5 + "<td>SOROCABA</td><td>355220 Sorocaba</td>" + "".join(f"<td>{i}</td>" for i in range(1, 37)) + "</tr>"
    shifted = "<tr><td>x</td><td>x</td><td>Sorocaba</td><td>352110 Iperó</td>" + "".join(f"<td>{i}</td>" for i in range(1, 37)) + "</tr>"
    _write(f"{root}/pages/dengue/2020/dengue20_import_autoc_mes.htm", _page(wide))
    _write(f"{root}/pages/dengue/2021/dengue21_import_autoc_mes.htm", _page(shifted), encoding="latin-1")
    _write(f"{root}/pages/zika/2021/zika21_mes.htm", _page(shifted))  # other disease: not read
    gold = run_pipeline(spark, "dengue", "2024-07-01", f"{root}/out", f"{root}/pages", layer_format="csv", incomplete="report")
    rows = gold.collect()
    assert len(rows) == 24 and {r.caso for r in rows} == {"dengue"}
    assert {(r.municipio_resid, r.ano_mes.year) for r in rows} == {("Sorocaba", 2020), ("352110 Iperó", 2021)}
    jan = [r.qtd_casos for r in rows if r.ano_mes == dt.date(2020, 1, 1)]
    assert jan == [1]


def test_run_pipeline_climate_from_folder(spark):
    root = scratch_path(spark, "jobs")
    name = "INMET_SE_SP_A713_SOROCABA_01-01-2024_A_31-03-2024.CSV"
    os.makedirs(f"{root}/zips", exist_ok=True)
    with open(f"{root}/zips/2024.zip", "wb") as f:
        f.write(zipped({f"2024/{name}": station_file(GOLDEN)}))
    # as_of in April 2024: the expected 2024 window ends on 31-03-2024
    gold = run_pipeline(spark, "climaticas", "2024-04-10", f"{root}/out", f"{root}/zips")
    assert [r.data for r in gold.orderBy("data").collect()] == [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    csv = run_pipeline(spark, "climaticas", "2024-04-10", f"{root}/out_csv", f"{root}/zips", per_station=True, layer_format="csv")
    assert [(r.cidade, r.data, r.umidade_relativa_ar) for r in csv.orderBy("cidade", "data").collect()][0] == ("SE_SP_A713_SOROCABA", dt.date(2024, 1, 1), 75.0)
    assert os.listdir(f"{root}/out_csv/1. bronze/climaticas")
    (silver,) = live_folders(spark, f"{root}/out_csv", "2. silver", "climaticas")
    assert any(f.endswith(".csv") for f in os.listdir(silver))


def test_sql_table_functions(spark):
    register_sql_functions(spark)
    spark.createDataFrame(
        [(1, "<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>")], "id int, html string"
    ).createOrReplaceTempView("pg")
    rows = spark.sql("SELECT id, t.row_index, t.cells FROM pg, LATERAL html_table(html, 0) t ORDER BY t.row_index").collect()
    assert [(r.row_index, r.cells) for r in rows] == [(0, ["a", "b"]), (1, ["a", "c"])]
    spark.createDataFrame([(bytearray(zipped({"d/x.CSV": b"1", "d/y.txt": b"2"})),)], "content binary").createOrReplaceTempView("zz")
    got = spark.sql("SELECT z.name, z.member FROM zz, LATERAL zip_members(content, '\\\\.CSV$') z").collect()
    assert [(r.name, r.member) for r in got] == [("x.CSV", "d/x.CSV")]


def test_run_pipeline_publishes_and_replaces_table(spark):
    root = scratch_path(spark, "jobs")
    wide = "<tr>" + "<td>x</td>" * 5 + "<td>SOROCABA</td><td>355220 Sorocaba</td>" + "".join(f"<td>{i}</td>" for i in range(1, 37)) + "</tr>"
    _write(f"{root}/pages/chikung/2022/chik22_mes.htm", _page(wide))
    table = "chik_gold_" + root.rsplit("/", 1)[-1]
    first = run_pipeline(spark, "chikungunya", "2024-07-01", f"{root}/out", f"{root}/pages", table=table, incomplete="report")
    assert first.count() == 12
    # a second run replaces the table (full refresh), it does not append
    run_pipeline(spark, "chikungunya", "2024-07-01", f"{root}/out", f"{root}/pages", table=table, incomplete="report")
    rows = spark.table(table).collect()
    assert len(rows) == 12 and {r.caso for r in rows} == {"chikungunya"}
    assert sorted(r.qtd_casos for r in rows) == sorted(range(1, 37, 3))


def test_pages_are_labelled_below_their_folder(spark):
    root = scratch_path(spark, "zika", "dengue-2019-backup")
    for name in ("dengue/2020/dengue20_mes.htm", "chikung/2021/chikung21_mes_arquivos/sheet001.htm", "zika_2022.htm", "other/2020/x.htm"):
        _write(f"{root}/{name}", _page(""))
    got = {(r.disease, r.year) for r in read_pages(spark, root).collect()}
    assert got == {("dengue", 2020), ("chikungunya", 2021), ("zika", 2022), ("", None)}


def test_each_layout_needs_exactly_one_page(spark):
    wide = "<tr>" + "<td>x</td>" * 5 + "<td>SOROCABA</td><td>355220 Sorocaba</td>" + "".join(f"<td>{i}</td>" for i in range(1, 37)) + "</tr>"
    layouts = layout_frame(spark, [x for x in PUBLISHED_LAYOUTS if (x.disease, x.year) in {("dengue", 2020), ("chikungunya", 2022)}])
    good = [("dengue", 2020, "a", _page(wide)), ("chikungunya", 2022, "b", _page(wide))]

    def run(rows, base, **kw):
        pages = spark.createDataFrame(rows, "disease string, year int, path string, html string")
        return run_cases(spark, pages, layouts, base, **kw)

    base = scratch_path(spark, "jobs")
    assert run(good, base).count() == 24
    for bad in (good[:1], [good[0], ("chikungunya", 2022, "b", "<p>error</p>")], [*good, ("dengue", 2020, "c", _page(wide))]):
        with pytest.raises(ValueError, match="exactly one page"):
            run(bad, base)
    # reported instead: a true full refresh, nothing of the run before is left
    rows = run([good[0], ("chikungunya", 2022, "b", "<p>error</p>")], base, incomplete="report").collect()
    assert {r.caso for r in rows} == {"dengue"}
    faults = spark.read.parquet(f"{base}/_reports/casos_incomplete").collect()
    assert [(r.disease, r.year, r.pages) for r in faults] == [("chikungunya", 2022, 0)]


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://head:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
