"""Property tests: operator invariants on generated inputs."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, assume, given, settings
from hypothesis import strategies as st

from sentinela.fixed import MONTHS
from sentinela.operators import months_to_rows, monthly_mean_filled, union_layouts
from sentinela.sources.html import table_rows

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

counts = st.one_of(st.none(), st.integers(min_value=0, max_value=10_000))
wide_rows = st.lists(st.tuples(st.text("abc", min_size=1, max_size=3), st.integers(2000, 2030), st.lists(counts, min_size=12, max_size=12)), min_size=1, max_size=12)


@SETTINGS
@given(rows=wide_rows)
def test_unpivot_keeps_rows_and_sums(spark, rows):
    data = [(town, year, *vals) for town, year, vals in rows]
    df = spark.createDataFrame(data, "town string, year int, " + ", ".join(f"{m} bigint" for m in MONTHS))
    long = months_to_rows(df, ["town", "year"], list(MONTHS), "mes", "casos", dtype="bigint")
    got = long.collect()
    assert len(got) == 12 * len(rows)  # NULLs are kept
    assert sum(r.casos or 0 for r in got) == sum(v or 0 for _, _, vals in rows for v in vals)


months = st.lists(st.tuples(st.sampled_from("xyz"), st.dates(dt.date(2019, 1, 1), dt.date(2023, 12, 31)), st.one_of(st.none(), st.floats(-50, 50))), min_size=1, max_size=40)


@SETTINGS
@given(rows=months)
def test_spine_has_no_holes(spark, rows):
    daily = spark.createDataFrame(rows, "k string, data date, v double")
    out = monthly_mean_filled(daily, "data", ["v"], keys=["k"]).collect()
    by_key = {}
    for r in out:
        by_key.setdefault(r.k, []).append(r.data)
    for k, got in by_key.items():
        ds = [d for kk, d, _ in rows if kk == k]
        first, last = min(ds).replace(day=1), max(ds).replace(day=1)
        span = (last.year - first.year) * 12 + last.month - first.month + 1
        assert got == sorted(got) and len(got) == span == len(set(got))
        assert got[0] == first and got[-1] == last
    assert all(r.v is not None for r in out)
    # brute force mean per key and month over the non-NULL values
    for r in out:
        vals = [v for kk, d, v in rows if kk == r.k and d.replace(day=1) == r.data and v is not None]
        expected = sum(vals) / len(vals) if vals else 0.0
        assert abs(r.v - expected) < 1e-9


@SETTINGS
@given(a=st.lists(st.integers(0, 99), min_size=1, max_size=5), b=st.lists(st.integers(0, 99), min_size=1, max_size=5))
def test_union_layouts_fills_by_name(spark, a, b):
    full = spark.createDataFrame([(str(i), i, 2020) for i in a], "town string, jan bigint, ano int")
    half = spark.createDataFrame([(str(i), "nan", "2024", str(i)) for i in b], "town string, jan string, ano string, extra string")
    out = union_layouts(full, half)
    assert out.columns == ["town", "jan", "ano", "extra"]
    rows = out.collect()
    assert len(rows) == len(a) + len(b)
    assert all(isinstance(v, str) for r in rows for v in r)
    assert sorted(r.jan for r in rows if r.ano == "2024") == ["0"] * len(b)
    assert sorted(r.extra for r in rows if r.ano == "2020") == ["0"] * len(a)


def _brute_grid(spec):
    """Independent model (the HTML table model): a dict of (row, col)
    slots. Returns None for malformed tables (overlapping cells or holes),
    where parsers legitimately differ."""
    slots = {}
    for r, cells in enumerate(spec):
        c = 0
        for text, rs, cs in cells:
            while (r, c) in slots:
                c += 1
            for dr in range(rs):
                for dc in range(cs):
                    if (r + dr, c + dc) in slots:
                        return None
                    slots[(r + dr, c + dc)] = text
            c += cs
    n_rows = max(r for r, _ in slots) + 1
    out = []
    for r in range(n_rows):
        cols = [c for rr, c in slots if rr == r]
        width = max(cols) + 1
        if len(cols) != width:
            return None
        out.append([slots[(r, c)] for c in range(width)])
    return out


cell = st.tuples(st.text("ab", min_size=1, max_size=2), st.integers(1, 3), st.integers(1, 3))


@settings(max_examples=200, deadline=None)
@given(spec=st.lists(st.lists(cell, min_size=1, max_size=4), min_size=1, max_size=5))
def test_html_grid_matches_slot_model(spec):
    html = "<table>" + "".join(
        "<tr>" + "".join(f'<td rowspan="{rs}" colspan="{cs}">{t}</td>' for t, rs, cs in row) + "</tr>" for row in spec
    ) + "</table>"
    got = [cells for _, cells in table_rows(html)]
    want = _brute_grid(spec)
    assume(want is not None)
    assert got == want


def test_html_overlap_keeps_every_cell():
    # row 2's colspan runs into the cell carried down from row 1: the
    # carried text is placed after it, nothing is lost
    html = '<table><tr><td colspan="2">a</td><td rowspan="2">b</td></tr><tr><td>c</td><td colspan="2">d</td></tr></table>'
    assert [cells for _, cells in table_rows(html)] == [["a", "a", "b"], ["c", "d", "d", "b"]]


def test_html_hidden_elements_are_left_out():
    html = (
        '<table><tr><td>a<td style="color:red; DISPLAY : none">x<td>b</td></tr><tr style="display:none"><td>y<td>z</tr>'
        '<tr><td>c<span style="display:none">q<br></span>d</td><td>e</td></tr><tbody style="display: none;"><tr><td>n</table>'
    )
    assert table_rows(html) == [(0, ["a", "b"]), (1, ["cd", "e"])]
    assert table_rows('<table style="display:none"><tr><td>h</table><table><tr><td>v</table>') == [(0, ["v"])]


@pytest.mark.parametrize(
    "hidden", ["<p {}>x", "<li {}>x", "<option {}>x", "<span {}>x", "<div {}>x", "<div {}><b>x", "<p {}>x</b>", "<ul {}><li>x", "<table {}><tr><td>x</table>"]
)
@pytest.mark.parametrize("ends", ["</td>", "", "</td></tr>", "</tr>"])
def test_html_unclosed_hidden_elements_end_with_their_cell(hidden, ends):
    part = hidden.format('style="display:none"')
    row = "" if "tr" in ends else "<td>b"
    want = ["a"] if "tr" in ends else ["a", "b"]
    html = f"<table><tr><td>a{part}{ends}{row}<tr><td>c</td></tr><tbody><tr><td>d{part}</table><table><tr><td>e</table>"
    assert table_rows(html) == [(0, want), (1, ["c"]), (2, ["d"])]
    assert table_rows(html, 1) == [(0, ["e"])]
    # in a table inside a cell, and before the end tag of a visible element around it
    inner = f"<table><tr><td>a<table><tr><td>n{part}</td><td>m</table>b<div>c{part}</div>d</td><td>e</table>"
    assert table_rows(inner) == [(0, ["anmbcd", "e"])]


def test_html_hidden_elements_end_at_their_siblings():
    h = 'style="display:none"'
    html = f"<p {h}>x<table><caption {h}>t<colgroup {h}><col><tr><td>a<p {h}>x<p>b<ul><li {h}>x<li>c</ul><select><option {h}>x<option>d</select><td>e</table>"
    assert table_rows(html) == [(0, ["abcd", "e"])]
    # what is inside a hidden element stays hidden, tables included
    html = f"<table><tr><td>a<div {h}><table><tr><td>x</td></tr></table>y<p>z</div>b</td></tr><tbody {h}><tr><td>n</td></tr></tbody><tr><td>c</table>"
    assert table_rows(html) == [(0, ["ab"]), (1, ["c"])]


def test_html_spans_are_never_cut():
    assert [len(c) for _, c in table_rows('<table><tr><td colspan="3000">a</table>')] == [3000]
    with pytest.raises(ValueError, match="page begins with"):
        table_rows('<table><tr><td colspan="99999999">a</table>')


def _model_delimited(text, skip=8, sep=";"):
    """Independent model of the reader's rules on one file's text."""
    lines = text.replace("\r\n", "\n").split("\n")
    body = [(i, l) for i, l in enumerate(lines) if i >= skip]
    first = next((l for _, l in body if l != ""), None)
    if first is None:
        return []
    width = len(first.split(sep))
    return [(i, l.split(sep)) for i, l in body if l != "" and len(l.split(sep)) <= width]


line_st = st.lists(st.sampled_from(["a", "b", "", "1,5"]), min_size=1, max_size=5).map(";".join)
file_st = st.lists(st.one_of(line_st, st.just("")), min_size=0, max_size=14).map("\n".join)


@SETTINGS
@given(texts=st.lists(file_st, min_size=1, max_size=3))
def test_read_delimited_matches_model(spark, texts):
    from sentinela.sources.delimited import read_delimited

    files = spark.createDataFrame([(f"f{i}", bytearray(t.encode("latin-1"))) for i, t in enumerate(texts)], "name string, content binary")
    got = sorted((r.name, r.line_no, list(r.fields)) for r in read_delimited(files, quote=None).collect())
    want = sorted((f"f{i}", n, f) for i, t in enumerate(texts) for n, f in _model_delimited(t))
    assert got == want


NUMBER_GRAMMAR = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
num_text = st.one_of(
    st.from_regex(r"\A[+-]?[0-9]{1,4}(\.[0-9]{0,3})?([eE][+-]?[0-9]{1,2})?\Z"),
    st.text(alphabet="0123456789٠١", min_size=1, max_size=3),  # non-ASCII digits are not numbers
    st.text(alphabet="0123456789.eE+- nafdxI", max_size=8),
)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(num_text, min_size=1, max_size=25))
def test_lenient_double_matches_model(spark, values):
    import re

    from sentinela.functions import lenient_double

    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r.y for r in df.select(lenient_double("x").alias("y")).collect()]
    # ASCII digits and whitespace only, as Java's regex and a CSV reader
    want = [float(v.strip()) if re.match(NUMBER_GRAMMAR, v, flags=re.ASCII) else None for v in values]
    assert got == want


words = st.text(alphabet="abcSãçéíóúêôÁÉÍÓÚÇ ", min_size=1, max_size=12)


@SETTINGS
@given(texts=st.lists(words, min_size=1, max_size=20))
def test_repair_mojibake_inverts_the_damage(spark, texts):
    from sentinela.functions import repair_mojibake

    damaged = [t.encode("utf-8").decode("latin-1") for t in texts]
    df = spark.createDataFrame(list(zip(texts, damaged)), "good string, bad string")
    rows = df.select(repair_mojibake("bad").alias("fixed"), repair_mojibake("good").alias("kept")).collect()
    assert [r.fixed for r in rows] == texts  # damage undone
    assert [r.kept for r in rows] == texts  # correct text untouched


@SETTINGS
@given(bounds=st.lists(st.tuples(st.dates(dt.date(2015, 1, 1), dt.date(2030, 12, 31)), st.integers(0, 2000)), min_size=1, max_size=6))
def test_yearly_windows_tile_the_period(spark, bounds):
    from sentinela.sources.files import yearly_windows

    rows = [(f"s{i}", s, s + dt.timedelta(days=n)) for i, (s, n) in enumerate(bounds)]
    df = spark.createDataFrame(rows, "cidade string, start date, end date")
    got = {}
    for r in yearly_windows(df, keys=["cidade"]).collect():
        got.setdefault(r.cidade, []).append((r.window_start, r.window_end))
    for key, s, e in rows:
        w = sorted(got[key])
        assert w[0][0] == s and w[-1][1] == e
        assert all(a.year == b.year and a <= b for a, b in w)
        assert all(w[i + 1][0] == w[i][1] + dt.timedelta(days=1) for i in range(len(w) - 1))
        assert len(w) == e.year - s.year + 1
