"""Edge cases of single operators and sources."""

import pytest
from pyspark.sql import functions as F

from sentinela.operators import drop_header_lines, region_filter, rename, rename_select, replace_values, slice_rows
from sentinela.sources.delimited import read_delimited
from sentinela.sources.files import expected_vs_found


def files(spark, *texts, encoding="latin-1"):
    return spark.createDataFrame([(f"f{i}", bytearray(t.encode(encoding))) for i, t in enumerate(texts)], "name string, content binary")


def lines(df):
    return [(r.name, r.line_no, r.fields) for r in df.orderBy("name", "line_no").collect()]


def test_delimited_rules(spark):
    pre = "\n".join(f"p{i}" for i in range(8))
    text = pre + "\r\n\r\nh;a;b;\r\n1;2;3;\r\n1;2\r\n1;2;3;4;5\r\n\r\n\"x;y\";2;3;\r\n"
    got = lines(read_delimited(files(spark, text)))
    # width from the first non-blank kept line (4 fields); blank lines skipped;
    # the 5-field line skipped; the short line kept (padded later); quotes honoured
    assert got == [
        ("f0", 9, ["h", "a", "b", ""]),
        ("f0", 10, ["1", "2", "3", ""]),
        ("f0", 11, ["1", "2"]),
        ("f0", 14, ["x;y", "2", "3", ""]),
    ]


def test_delimited_fixed_width(spark):
    text = "\n".join(["p"] * 8) + "\na;b\na;b;c\na;b;c;d"
    got = lines(read_delimited(files(spark, text), n_fields=3))
    assert got == [("f0", 8, ["a", "b"]), ("f0", 9, ["a", "b", "c"])]


def test_delimited_short_and_empty_files(spark):
    got = lines(read_delimited(files(spark, "only\nthree\nlines", "", "\n".join(["p"] * 8) + "\nD;1")))
    assert got == [("f2", 8, ["D", "1"])]


def test_delimited_latin1(spark):
    got = lines(read_delimited(files(spark, "\n" * 8 + "São;Iperó"), skip_rows=8))
    assert got == [("f0", 8, ["São", "Iperó"])]


def test_expected_vs_found_duplicates(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "name string")
    found = spark.createDataFrame([("a",), ("a",), ("c",)], "name string")
    assert sorted(tuple(r) for r in expected_vs_found(expected, found).collect()) == [("a", True), ("b", False)]


def test_replace_values_subset_and_nulls(spark):
    df = spark.createDataFrame([("IperÃ³", "IperÃ³"), (None, "x")], "a string, b string")
    out = replace_values(df, {"IperÃ³": "Iperó"}, cols=["a"]).collect()
    assert [tuple(r) for r in out] == [("Iperó", "IperÃ³"), (None, "x")]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(8)], "row_index int, v string")
    assert [r.v for r in slice_rows(df, 4, 6).collect()] == ["v4", "v5"]
    assert slice_rows(df, 5).count() == 3
    assert rename_select(df, {"v": "w", "absent": "z"}, ["w"]).columns == ["w"]
    assert rename(df, "absent", "z").columns == df.columns


def test_header_and_region_filters(spark):
    df = spark.createDataFrame([("Data",), (None,), ("2024/01/01",)], "data string")
    assert drop_header_lines(df).count() == 2  # NULL kept
    r = spark.createDataFrame([("Sorocaba",), ("SOROCABA ",), ("campinas",)], "x string")
    assert [x.x for x in region_filter(r, "x", "sorocaba").collect()] == ["Sorocaba"]
    assert r.filter(F.lit(True)).count() == 3


def test_daily_rollup_from_hourly_timestamps(spark):
    import datetime as dt

    from sentinela.operators import daily_rollup

    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 3), 1.0), (dt.datetime(2024, 1, 1, 22), 2.0), (dt.datetime(2024, 1, 2, 0), None), (None, 9.0)],
        "ts timestamp_ntz, v double",
    )
    got = sorted(tuple(r) for r in daily_rollup(df, "ts", {"v": "sum"}).collect())
    assert got == [(dt.date(2024, 1, 1), 3.0), (dt.date(2024, 1, 2), 0.0)]


def test_order_check_sees_disorder(spark):
    from sentinela.plans.queries import _out_of_order

    df = spark.range(0, 100, 1, 4).selectExpr("(id * 37) % 100 AS k")
    assert _out_of_order(df.orderBy("k"), "k", "x").first().asDict() == {"saida": "x", "linhas": 100, "fora_de_ordem": 0}
    assert _out_of_order(df, "k", "x").first().fora_de_ordem > 0


def test_dates_by_first_value(spark):
    from sentinela.operators import dates_by_first_value

    rows = [
        ("a", 1, ""), ("a", 2, "03/04/2020"), ("a", 3, "2020/04/05"), ("a", 4, "31/12/2020"), ("a", 5, None),
        ("b", 1, "2021/01/02"), ("b", 2, "03/04/2020"), ("c", 1, "lixo"), ("c", 2, "03/04/2020"), ("c", 3, "2021/01/02"),
        (None, 7, "05/06/2020"), ("d", 1, None),
    ]
    df = spark.createDataFrame(rows, "s string, n int, data string")
    got = {(r.s, r.n): r.data and r.data.isoformat() for r in dates_by_first_value(df, "data", "n", ["yyyy/MM/dd", "dd/MM/yyyy"], ["s"]).collect()}
    assert got == {
        ("a", 1): None, ("a", 2): "2020-04-03", ("a", 3): None, ("a", 4): "2020-12-31", ("a", 5): None,
        ("b", 1): "2021-01-02", ("b", 2): None, ("c", 1): None, ("c", 2): "2020-04-03", ("c", 3): "2021-01-02",
        (None, 7): "2020-06-05", ("d", 1): None,
    }
    alone = dates_by_first_value(df.filter("s = 'b'"), "data", "n", ["dd/MM/yyyy", "yyyy/MM/dd"])
    assert [r.data is not None for r in alone.orderBy("n").collect()] == [True, False]
    assert dates_by_first_value(df.limit(0), "data", "n", ["yyyy/MM/dd"]).count() == 0


def test_replace_from_table(spark):
    from sentinela.operators import replace_from_table

    df = spark.createDataFrame([(1, "x", "y"), (2, None, "x"), (3, "zz", "w"), (4, "x", "x")], "id int, a string, b string")
    pairs = spark.createDataFrame([("x", "X"), ("x", "X"), ("w", None), (None, "never")], "old string, new string")
    got = sorted(map(tuple, replace_from_table(df, pairs, ["a", "b"]).collect()))
    assert got == [(1, "X", "y"), (2, None, "X"), (3, "zz", None), (4, "X", "X")]
    two = spark.createDataFrame([("x", "X"), ("x", "Y")], "old string, new string")
    with pytest.raises(Exception, match="two replacements for x"):
        replace_from_table(df, two, ["a"]).collect()


def test_stack_layouts_plan_does_not_grow(spark):
    from sentinela.operators import stack_layouts

    def rows(layouts):
        data = [(i, [f"c{(i + j) % 7}" for j in range(3)], [str(i), None, "nan", "extra"]) for i in range(layouts)]
        return spark.createDataFrame(data, "id int, names array<string>, cells array<string>")

    out = stack_layouts(rows(2), keep=["id"])
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(0, "0", "0", "0", "0"), (1, "0", "1", "0", "0")] and out.columns == ["id", "c0", "c1", "c2", "c3"]
    size = lambda n: len(stack_layouts(rows(n), keep=["id"])._jdf.queryExecution().analyzed().toString().splitlines())
    assert size(200) == size(7)
    kept = stack_layouts(rows(1), keep=["id"], fill=None).collect()
    assert [tuple(r) for r in kept] == [(0, "0", None, "nan")]
    with pytest.raises(ValueError, match="share names"):
        stack_layouts(rows(1).withColumnRenamed("id", "c0"), keep=["c0"])


def test_infer_types(spark):
    from sentinela.sources import infer_types
    from sentinela.sources.layers import typed

    data = [("1", "1", "True", "x", "", "1", "9" * 30), ("2", "2.5", "FALSE", "1", "NA", "true", "1"), ("", "nan", None, "", None, "", "1")]
    df = spark.createDataFrame(data, "a string, b string, c string, d string, e string, f string, g string").withColumn("h", F.lit(1))
    got = {f.name: f.dataType.simpleString() for f in infer_types(df)}
    assert got == {"a": "bigint", "b": "double", "c": "boolean", "d": "string", "e": "double", "f": "string", "g": "double", "h": "int"}
    rows = [tuple(r) for r in typed(df, infer_types(df)).collect()]
    assert rows[0][:4] == (1, 1.0, True, "x") and rows[2][:6] == (None, None, None, None, None, None)


def test_strict_long_is_bounded_without_ansi(spark):
    from sentinela.functions.numbers import strict_long

    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            ok = spark.createDataFrame([("9.2e18",), ("-9223372036854775808",), ("1e3",), ("-1.9",)], "v string")
            assert [r[0] for r in ok.select(strict_long("v")).collect()] == [9200000000000000000, -(2**63), 1000, -1]
            for bad in ("1e30", "-1e19", "9223372036854775808", "9.3e18", "1e999"):
                with pytest.raises(Exception, match="out of range"):
                    spark.createDataFrame([(bad,)], "v string").select(strict_long("v")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
