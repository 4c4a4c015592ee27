"""Surveillance-shaped inputs derived, in Spark, from the driver's tables.

The test tables hold no HTML tables, archives or station files, so the
registered queries build them from ``customer``, ``orders`` and
``lineitem`` and then run the real operators over them. Every builder groups
by a bounded key (a block of keys, a page of a dimension, a station-year),
so no page, file or archive grows with the table size, and all rows of the
source table are used.
"""

from __future__ import annotations

import io
import zipfile
from calendar import monthrange
from collections.abc import Iterator
from datetime import date, timedelta
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentinela.fixed import STATION_FILE

# Rows per generated page / file / archive group.
CUSTOMERS_PER_PAGE = 50
ORDERS_PER_MEMBER_BLOCK = 5000
ORDERS_PER_FILE_BLOCK = 2000
SUPPLIERS_PER_ARCHIVE = 25
CUSTOMERS_PER_CASE_PAGE = 2000
ORDERS_PER_STATION_BLOCK = 200000
# Bits of a sort key's number that tell stations apart.
STATION_BITS = 24
# Archives of about this size leave a Python task together.
BATCH_BYTES = 16 * 1024 * 1024

PREAMBLE = [
    "REGIAO:;SE",
    "UF:;SP",
    "ESTACAO:;TESTE",
    "CODIGO (WMO):;A000",
    "LATITUDE:;-23,48",
    "LONGITUDE:;-47,58",
    "ALTITUDE:;609",
    "DATA DE FUNDAÇÃO:;21/05/06",
]
STATION_HEADER = ";".join(["Data", "Hora UTC", "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)"] + [f"MEDIDA {i}" for i in range(3, 19)]) + ";"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _td(c: Column) -> Column:
    return F.concat(F.lit("<td>"), c, F.lit("</td>"))


def _sorted_join(rows: Column, sep: str = "") -> Column:
    """``collect_list(struct(sort keys…, text))`` -> texts in key order."""
    return F.array_join(F.transform(F.sort_array(rows), lambda x: x["text"]), sep)


# --- HTML pages --------------------------------------------------------------

_PAGE_HEAD = (
    '<!DOCTYPE html><html><head><meta charset="utf-8"><title>Clientes</title>'
    '<script>var s = "<table><tr><td>not a table</td></tr></table>";</script></head>'
    "<body><p>Relat&oacute;rio &amp; notas</p><table border=1><thead>"
    '<tr><th colspan="2">Cliente</th><th>Saldo</th><th>Segmento</th></tr></thead><tbody>'
)
_PAGE_TAIL = "</tbody></table><table><tr><td>second table</td></tr></table></body></html>"


def customer_pages(customer: DataFrame) -> DataFrame:
    """One page per (nation, block of 50 customer keys): a header row with a
    colspan, a nation cell spanning every body row (rowspan), entities and
    padded text; a hidden cell in every row and a hidden row before every row
    but the first; a table inside a script and a second table after it."""
    rows = customer.select(
        F.col("c_nationkey").alias("page_nation"),
        F.expr(f"c_custkey div {CUSTOMERS_PER_PAGE}").alias("page_block"),
        "c_custkey",
        F.concat(
            _td(F.concat(F.lit("\n   "), F.col("c_name"), F.lit("  "))),
            F.lit('<td style="color:red; display : none">oculta</td>'),
            _td(F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")),
            _td(F.concat(F.col("c_mktsegment"), F.lit(" &amp; "), F.col("c_nationkey").cast("string"))),
            F.lit("</tr>"),
        ).alias("text"),
    )
    grouped = rows.groupBy("page_nation", "page_block").agg(
        F.sort_array(F.collect_list(F.struct("c_custkey", "text"))).alias("rs")
    )
    first = F.concat(
        F.lit('<tr><td rowspan="'), F.size("rs").cast("string"), F.lit('">'),
        F.col("page_nation").cast("string"), F.lit("</td>"),
    )
    hidden = F.lit('<tr style="display:none"><td>oculta</td><td>0</td></tr>')
    body = F.transform("rs", lambda x, i: F.concat(F.when(i == 0, first).otherwise(F.concat(hidden, F.lit("<tr>"))), x["text"]))
    html = F.concat(F.lit(_PAGE_HEAD), F.array_join(body, ""), F.lit(_PAGE_TAIL))
    return grouped.select("page_nation", "page_block", html.alias("html"))


def order_month_counts(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders per (priority and block of customer keys, year, customer nation) as
    36 values in one array: for each month the number of orders, of status F and
    of status O."""
    o = orders.select(
        "o_custkey", "o_orderpriority", "o_orderstatus",
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m"),
    )
    j = o.join(customer.select("c_custkey", "c_nationkey"), o.o_custkey == F.col("c_custkey"))
    label = F.concat_ws("/", "o_orderpriority", F.expr(f"c_custkey div {CUSTOMERS_PER_CASE_PAGE}").cast("string"))
    per_month = j.groupBy(label.alias("disease"), "year", "c_nationkey", "m").agg(
        F.array(F.count(F.lit(1)), F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") == "O")).alias("n")
    )
    months = per_month.groupBy("disease", "year", "c_nationkey").agg(  # at most twelve entries each
        F.map_from_entries(F.collect_list(F.struct("m", "n"))).alias("by_month")
    )
    none = F.array_repeat(F.lit(0).cast("bigint"), 3)
    values = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: F.coalesce(F.try_element_at("by_month", m), none))
    return months.select("disease", "year", "c_nationkey", F.flatten(values).alias("values"))


TITLE_ROWS = 5

# Test layouts: even years wide, odd years shifted, the latest year partial.
_KINDS = {
    #          first_row, region_col, municipality_col, n_values, strip, width
    "wide": (5, 5, 6, 36, True, 43),
    "shifted": (5, 2, 3, 36, False, 43),
    "partial": (5, 5, 6, 15, True, 24),
}


def _kind(year: Column, last: Column) -> Column:
    return F.when(year == last, "partial").when(year % 2 == 0, "wide").otherwise("shifted")


def _by_kind(kind: Column, pos: int) -> Column:
    expr = None
    for name, spec in _KINDS.items():
        expr = (F.when(kind == name, F.lit(spec[pos])) if expr is None else expr.when(kind == name, F.lit(spec[pos])))
    return expr


def order_case_layouts(pages: DataFrame) -> DataFrame:
    """Layout rows for the generated pages, one per (disease, year)."""
    kind = F.col("kind")
    return pages.select(
        "disease", F.col("year").cast("int").alias("year"),
        _by_kind(kind, 0).alias("first_row"), "end_row",
        _by_kind(kind, 1).alias("region_col"), _by_kind(kind, 2).alias("municipality_col"),
        _by_kind(kind, 3).alias("n_values"), _by_kind(kind, 4).alias("strip_code"),
    )


def order_case_pages(counts: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One HTML page per (disease, year) in that year's layout (even years
    wide, odd years shifted, the disease's latest year partial): five title
    rows (colspan/rowspan), then one row per nation with orders, the region
    cell merged over the nations of a region (rowspan) in mixed case, the
    municipality cell ``'<key> <name>'``, zero counts as empty cells, and
    extra columns right of the shifted and partial layouts, and a total line below
    the shifted ones (their layout has an end row)."""
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "n_regionkey",
        F.when(F.col("n_regionkey") % 2 == 1, F.initcap("r_name")).otherwise(F.col("r_name")).alias("region_text"),
    )
    # each disease's latest year is the partial one (a window per disease
    # over its (year, nation) aggregates)
    rows = counts.withColumn("_last", F.max("year").over(Window.partitionBy("disease")))
    rows = rows.withColumn("kind", _kind(F.col("year"), F.col("_last"))).withColumn("width", _by_kind(F.col("kind"), 5))
    rows = rows.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    run = Window.partitionBy("disease", "year", "n_regionkey")
    rows = rows.withColumn("rn", F.row_number().over(run.orderBy("n_nationkey"))).withColumn(
        "run_len", F.count(F.lit(1)).over(run)
    )
    kind = F.col("kind")
    values = F.transform("values", lambda v: _td(F.when(v == 0, F.lit("")).otherwise(v.cast("string"))))
    n_values = F.when(kind == "partial", 15).otherwise(36)
    total = F.aggregate(F.filter("values", lambda v, i: i % 3 == 0), F.lit(0).cast("bigint"), lambda a, v: a + v)
    lead_cells = F.when(
        kind == "shifted",
        F.array(_td(F.lit("DRS")), _td(F.col("n_regionkey").cast("string"))),
    ).otherwise(F.array(
        _td(F.lit("DRS")), _td(F.col("n_regionkey").cast("string")), _td(F.lit("X")),
        _td(F.col("n_nationkey").cast("string")), F.lit("<td></td>"),
    ))
    region_cell = F.when(
        F.col("rn") == 1,
        F.concat(F.lit('<td rowspan="'), F.col("run_len").cast("string"), F.lit('">'), F.col("region_text"), F.lit("</td>")),
    ).otherwise(F.lit(""))
    town = _td(F.concat(F.col("n_nationkey").cast("string"), F.lit(" "), F.col("n_name")))
    extra = F.when(kind == "shifted", F.array(_td(total.cast("string")), _td(F.lit("x")), _td(F.lit("y")))).otherwise(
        F.when(kind == "partial", F.array(_td(total.cast("string")), _td(F.lit("z")))).otherwise(F.array().cast("array<string>"))
    )
    cells = F.concat(lead_cells, F.array(region_cell, town), F.slice(values, 1, n_values), extra)
    row_html = F.concat(F.lit("<tr>"), F.array_join(cells, ""), F.lit("</tr>"))
    pages = rows.groupBy("disease", "year", "kind", "width").agg(
        _sorted_join(F.collect_list(F.struct("n_regionkey", "n_nationkey", row_html.alias("text")))).alias("body"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    # the shifted pages end in a total that only the layout's row range keeps out
    bounded = F.col("kind") == "shifted"
    foot = F.when(bounded, F.concat(
        F.lit("<tr><td>DRS</td><td>0</td><td>"), F.lit("AMERICA"), F.lit("</td><td>0 TOTAL</td>"),
        F.lit("<td>1</td>" * 36), F.lit("</tr>"),
    )).otherwise(F.lit(""))
    w = F.col("width").cast("string")
    w1 = (F.col("width") - 1).cast("string")
    filler = F.array_join(F.array_repeat(F.lit("<td>-</td>"), F.col("width") - 1), "")
    titles = F.concat(
        F.lit('<tr><td colspan="'), w, F.lit('">'), F.col("disease"), F.lit(" "), F.col("year").cast("string"), F.lit("</td></tr>"),
        F.lit('<tr><td colspan="'), w, F.lit('">Casos autóctones por mês</td></tr>'),
        F.lit('<tr><td rowspan="3">DRS</td><td colspan="'), w1, F.lit('">Mês de início</td></tr>'),
        F.lit("<tr>"), filler, F.lit("</tr><tr>"), filler, F.lit("</tr>"),
    )
    html = F.concat(
        F.lit("<html><body><h1>Casos</h1><table>"), titles, F.col("body"), foot,
        F.lit("</table><table><tr><td>notas</td></tr></table></body></html>"),
    )
    end_row = F.when(bounded, F.lit(TITLE_ROWS) + F.col("n_rows")).cast("int")
    return pages.select("disease", F.col("year").cast("int").alias("year"), "kind", end_row.alias("end_row"), html.alias("html"))


# --- zip archives ------------------------------------------------------------

def _make_zip(members: list, method: int) -> bytes:
    buf = io.BytesIO()
    level = 1 if method == zipfile.ZIP_DEFLATED else None
    with zipfile.ZipFile(buf, "w") as z:
        for member, data in sorted(members):
            z.writestr(zipfile.ZipInfo(member), data, method, level)  # no time of writing: the same bytes each time
    return buf.getvalue()


def _zipped(batches: Iterator[pa.RecordBatch], method: int) -> Iterator[pa.RecordBatch]:
    """Members in order of their archive -> archives. One archive is held at a time, and those
    made since the last batch that went out."""
    rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("archive", "member", "data"))))
    made, size = [], 0
    for archive, members in groupby(rows, itemgetter(0)):
        made.append((archive, _make_zip([m[1:] for m in members], method)))
        size += len(made[-1][1])
        if size > BATCH_BYTES:
            yield _archive_batch(made)
            made, size = [], 0
    if made:
        yield _archive_batch(made)


def _archive_batch(made: list) -> pa.RecordBatch:
    names, contents = zip(*made)
    return pa.record_batch([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["archive", "content"])


def zip_archives(members: DataFrame, deflate: bool = True) -> DataFrame:
    """``(archive, member, data BINARY)`` -> one zip per archive (deflated or
    stored). Callers choose archive keys that bound the members per archive.

    Archives may be many and small: a task makes them from one sorted run of members, without
    a call into Python for each."""
    method = zipfile.ZIP_DEFLATED if deflate else zipfile.ZIP_STORED
    runs = members.select("archive", "member", "data").repartition("archive").sortWithinPartitions("archive")
    return runs.mapInArrow(lambda batches: _zipped(batches, method), "archive string, content binary")


def order_archives(orders: DataFrame) -> DataFrame:
    """Zip per (year, block of order keys); one member per month, in a
    folder, with one ``;``-line per order sorted by key."""
    o = orders.select(
        F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"),
        F.expr(f"o_orderkey div {ORDERS_PER_MEMBER_BLOCK}").alias("part"), "o_orderkey",
        F.concat_ws(";", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                    "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("text"),
    )
    members = o.groupBy("y", "m", "part").agg(_sorted_join(F.collect_list(F.struct("o_orderkey", "text")), "\n").alias("body"))
    members = members.select(
        F.format_string("orders_%d_%d.zip", "y", "part").alias("archive"),
        F.format_string("%d/orders_%d_%02d_%d.csv", "y", "y", "m", "part").alias("member"),
        F.encode("body", "UTF-8").alias("data"),
    )
    return zip_archives(members)


# --- station files -------------------------------------------------------------

def _comma(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit("."), F.lit(","))


def _day(when: Column) -> Column:
    """``yyyy/MM/dd``, for the usual years without a formatter's work per value."""
    day = when.cast("date")
    plain = F.replace(day.cast("string"), F.lit("-"), F.lit("/"))
    usual = (day >= F.lit("0001-01-01").cast("date")) & (day <= F.lit("9999-12-31").cast("date"))
    return F.when(usual, plain).otherwise(F.date_format(when, "yyyy/MM/dd"))


# Line order inside a file: order key and line number repeat in the test
# data, so every field that feeds the line text breaks ties.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def station_lines(lineitem: DataFrame) -> DataFrame:
    """One hourly station line per lineitem row, with dirt by line number:
    4 -> all measures empty, 5 -> line cut short, 6 -> extra fields,
    7 -> unparsable date; part key ending in 0 -> ``5f`` as temp_min."""
    ln = F.col("l_linenumber")
    blank = ln == 4

    def measure(c: Column) -> Column:
        return F.when(blank, F.lit("")).otherwise(_comma(c))

    day = F.when(ln == 7, F.lit("lixo")).otherwise(_day(F.col("l_shipdate")))
    # fields that are NULL are left out, empty ones are not: a run of those is one text
    first = F.concat_ws(
        ";", day, F.concat(F.lpad((ln * 3).cast("string"), 2, "0"), F.lit("00 UTC")),
        measure(F.col("l_discount")), F.lit(""), measure(F.col("l_extendedprice")), measure(F.col("l_quantity")),
        F.lit(";;"), measure(F.col("l_tax")),
    )
    rest = F.concat_ws(
        ";", F.when(F.col("l_partkey") % 10 == 0, F.when(blank, F.lit("")).otherwise(F.lit("5f"))).otherwise(measure(F.col("l_quantity") - 10)),
        F.lit(";;;"), measure(F.col("l_partkey") % 100), F.lit(";;;"),
    )
    short = F.coalesce(ln == 5, F.lit(False))
    text = F.concat_ws(";", first, F.when(~short, rest), F.when(ln == 6, F.lit("x;y")))
    return lineitem.withColumn("text", text)


def _station_file(body: Column) -> Column:
    crlf = "\r\n"
    head = crlf.join(PREAMBLE) + crlf + STATION_HEADER + crlf
    return F.encode(F.concat(F.lit(head), body, F.lit(crlf + STATION_HEADER + crlf)), "ISO-8859-1")


def lineitem_station_files(lineitem: DataFrame, orders_per_file: int = ORDERS_PER_FILE_BLOCK) -> DataFrame:
    """Station files ``(name, content)``: one per (ship month, block of
    ``orders_per_file`` order keys), latin-1, CRLF, 8 preamble lines, header, a repeated header
    at the end; lines sorted by (order key, line number).

    Rows are shuffled to their file first and the lines are built there: the
    grouping reuses that partitioning (one shuffle), and the per-line text
    work runs on the reduce side, spread over the shuffle partitions rather
    than over however few splits the input has."""
    keyed = lineitem.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("ym"),
        F.expr(f"l_orderkey div {orders_per_file}").alias("part"),
        *lineitem.columns,
    ).repartition("ym", "part")
    lines = station_lines(keyed).select("ym", "part", *LINE_ORDER, "text")
    files = lines.groupBy("ym", "part").agg(
        _sorted_join(F.collect_list(F.struct(*LINE_ORDER, "text")), "\r\n").alias("body")
    )
    return files.select(
        F.format_string("lineitem_%s_%d.CSV", "ym", "part").alias("name"),
        _station_file(F.col("body")).alias("content"),
    )


ORDERS_PER_SPLIT_FILE = 100_000


def saved_files(files: DataFrame, path: str, name: str = "name", content: str = "content") -> str:
    """``(name, content BINARY)`` rows saved one per file, in a folder ``arquivo={name}`` each."""
    out = files.select(F.col(name).alias("arquivo"), F.col(content).cast("string").alias("value"))
    out.write.option("maxRecordsPerFile", 1).partitionBy("arquivo").text(path)
    return path


def saved_station_files(lineitem: DataFrame, path: str, orders_per_file: int = ORDERS_PER_SPLIT_FILE) -> str:
    """The files of :func:`lineitem_station_files` saved as :func:`saved_files` saves them, written line
    by line from sorted rows: a file is never one value, however long it is."""
    keyed = lineitem.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("ym"),
        F.expr(f"l_orderkey div {orders_per_file}").alias("part"),
        F.lit(1).alias("place"), *lineitem.columns,
    )
    ends = keyed.select("ym", "part").distinct().withColumn("place", F.explode(F.array(F.lit(0), F.lit(2))))
    rows = station_lines(keyed.unionByName(ends, allowMissingColumns=True).repartition("ym", "part"))
    head = "\r\n".join([*PREAMBLE, STATION_HEADER])
    text = F.when(F.col("place") == 0, head).when(F.col("place") == 2, STATION_HEADER).otherwise(F.col("text"))
    lines = rows.select(
        F.format_string("lineitem_%s_%d.CSV", "ym", "part").alias("arquivo"), "place", *LINE_ORDER,
        F.encode(text, "ISO-8859-1").cast("string").alias("value"),
    )
    # the writer goes from file to file in this order
    lines = lines.sortWithinPartitions("arquivo", "place", *LINE_ORDER, "value").select("arquivo", "value")
    lines.write.option("lineSep", "\r\n").partitionBy("arquivo").text(path)
    return path


def saved_name(file: Column | str) -> Column:
    """The name under which :func:`saved_files` saved a file."""
    return F.regexp_extract(file, "/arquivo=([^/]+)/[^/]+$", 1)


def order_note_files(orders: DataFrame) -> DataFrame:
    """``(name, content)`` per (order year, block of order keys): two title lines, a header, and a
    record ``key;"note";status`` per order. The note of every fifth order holds a line break, of
    every seventh a quoted word, of every eleventh a separator, of every thirteenth two breaks in
    a row; a blank line stands between orders now and then, and an open quote before the end."""
    key = F.col("o_orderkey")
    note = F.concat(
        F.lit("nota "), F.col("o_orderpriority"),
        F.when(key % 5 == 0, F.lit("\r\nsegue")).otherwise(""),
        F.when(key % 7 == 0, F.lit(' ""dito""')).otherwise(""),
        F.when(key % 11 == 0, F.lit("; outro")).otherwise(""),
        F.when(key % 13 == 0, F.lit("\r\n\r\nfim")).otherwise(""),
    )
    order = ["o_orderkey", "o_custkey", "o_totalprice"]
    rows = orders.select(
        F.year("o_orderdate").alias("y"), F.expr(f"o_orderkey div {ORDERS_PER_SPLIT_FILE}").alias("part"), *order,
        F.concat(
            key.cast("string"), F.lit(';"'), note, F.lit('";'), F.col("o_orderstatus"),
            F.when(key % 17 == 0, F.lit("\r\n")).otherwise(""),
        ).alias("text"),
    )
    files = rows.groupBy("y", "part").agg(_sorted_join(F.collect_list(F.struct(*order, "text")), "\r\n").alias("body"))
    head, tail = "titulo\r\nsegundo titulo\r\nchave;nota;estado\r\n", '\r\naberta;"sem fim;X\r\nultima;linha;Z'
    content = F.encode(F.concat(F.lit(head), F.col("body"), F.lit(tail)), "UTF-8")
    return files.select(F.format_string("notas_%d_%d.csv", "y", "part").alias("name"), content.alias("content"))


def _station_name(supplier: Column, block: Column) -> Column:
    return F.concat(F.lit("SE_XX_A"), F.lpad(supplier.cast("string"), 6, "0"), F.lit("B"), block.cast("string"))


def supplier_station(supplier: Column, order: Column) -> Column:
    """Station of a supplier and a block of order keys: a busy supplier has many
    stations, so none of its files grows with the table."""
    return _station_name(supplier, F.floor(order / ORDERS_PER_STATION_BLOCK))


def supplier_station_bounds(lineitem: DataFrame) -> DataFrame:
    """Per station (supplier): reporting from January of its first year to
    the end of the month of its last reading."""
    day = F.col("l_shipdate").cast("date")
    # by numbers first: a station's name is made once per task, not once per row
    numbers = lineitem.groupBy("l_suppkey", F.floor(F.col("l_orderkey") / ORDERS_PER_STATION_BLOCK).alias("part")).agg(
        F.min(day).alias("first"), F.max(day).alias("last")
    )
    return numbers.groupBy(_station_name(F.col("l_suppkey"), F.col("part")).alias("cidade")).agg(
        F.trunc(F.min("first"), "year").alias("start"), F.last_day(F.max("last")).alias("end")
    )


def _archive_group(supplier: Column, order: Column) -> list[Column]:
    """Keys that neither an archive's nor a station's rows are parted by. They are the block of
    suppliers and the block of orders; but a station's name has six places for its supplier, so
    those of larger numbers go by their first six digits, and all numbers below 0 together."""
    digits = F.substring(supplier.cast("string"), 1, 6).cast("bigint")
    lead = F.when(supplier < 0, 0).when(supplier < 1_000_000, supplier).otherwise(digits)
    return [F.floor(lead / SUPPLIERS_PER_ARCHIVE), F.greatest(F.floor(order / ORDERS_PER_STATION_BLOCK), F.lit(0))]


def _file_date(day: date) -> str:
    return f"{day:%d-%m}-{day.year:04d}"


def _runs(batch: pa.RecordBatch, keys: int) -> Iterator[tuple]:
    """``(key, last day, text)`` of rows in a row with the same first ``keys`` columns; the
    others are the day, as a number, and the line. Lines are cut out of the batch's buffer."""
    ends = [pc.run_end_encode(c).run_ends.to_numpy() for c in batch.columns[:keys]]
    ends = np.unique(np.concatenate(ends))
    starts = np.concatenate([[0], ends[:-1]])
    of_run = zip(*(c.take(pa.array(starts)).to_pylist() for c in batch.columns[:keys]))
    days = np.maximum.reduceat(batch.column(keys).to_numpy(), starts).tolist()
    lines = batch.column(keys + 1).cast(pa.large_binary())
    _, offsets, text = lines.buffers()
    offsets = np.frombuffer(offsets, np.int64)[lines.offset : lines.offset + len(lines) + 1]
    for key, day, i, j in zip(of_run, days, offsets[starts].tolist(), offsets[ends].tolist()):
        yield key, day, text.slice(i, j - i) if j > i else b""


def _station_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines by year, group and station, late years first -> archives. A group's archives of
    a year (as a rule one archive) are held at a time, those made since the last batch that went
    out, and the names of the stations."""
    runs = (r for b in batches if b.num_rows for r in _runs(b, 5))
    known: set[str] = set()  # stations that have a later year: they report to the end of this one
    made, size = [], 0
    for _, rows in groupby(runs, lambda r: (r[0][0] or 0) >> STATION_BITS):
        for name, members in _archives_of_year(rows, known):
            made.append((name, _make_zip(members, zipfile.ZIP_STORED)))
            size += len(made[-1][1])
        if size > BATCH_BYTES:
            yield _archive_batch(made)
            made, size = [], 0
    if made:
        yield _archive_batch(made)


_FILE_HEAD = "".join(x + "\r\n" for x in [*PREAMBLE, STATION_HEADER]).encode("ISO-8859-1")
_FILE_TAIL = ("\r\n" + STATION_HEADER + "\r\n").encode("ISO-8859-1")


def _archives_of_year(rows: Iterator[tuple], known: set[str]) -> Iterator[tuple[str, list]]:
    """``(archive, members)`` of one year's runs; its stations are ``known`` afterwards."""
    files: dict[tuple, list] = {}
    ends: dict[str | None, int] = {}
    for (_, *file), day, text in rows:
        if file[0] is None:
            raise ValueError("a line without a date belongs to no yearly file")
        files.setdefault(tuple(file), []).append(text)
        ends[file[3]] = max(ends.get(file[3], day), day)
    for station, day in ends.items():
        last = date(1970, 1, 1) + timedelta(day)
        ends[station] = date(last.year, 12, 31) if station in known else last.replace(day=monthrange(last.year, last.month)[1])
    known.update(x for x in ends if x is not None)
    archives: dict[tuple, list] = {}
    for (*archive, station), texts in files.items():
        archives.setdefault(tuple(archive), []).append((station, b"".join(texts).removesuffix(b"\r\n")))
    for (year, block, part), own in archives.items():
        members = [(f"{year}/notas.csv", b"nota;1\n"), ("LEIA-ME.txt", b"nota;1\n")]
        for station, body in own:
            if station is not None:
                name = STATION_FILE.format(station=station, start=_file_date(date(year, 1, 1)), end=_file_date(ends[station]))
                members.append((f"{year}/{name}", b"".join((_FILE_HEAD, body, _FILE_TAIL))))
        block, part = ("null" if n is None else n for n in (block, part))
        yield f"{year}_{block}_{part}.zip", members


def supplier_station_archives(lineitem: DataFrame) -> DataFrame:
    """Yearly archives of station files, as published: one zip per (year,
    block of suppliers, block of order keys), members
    ``{year}/INMET_{station}_{start}_A_{end}.CSV``, one member per station and year,
    and two members that are not station files.

    Rows are shuffled once, to where their archive and their station are whole, and sorted there;
    a task's archives are made from one run of sorted lines. Late years come first: a station that
    has been seen reports to the end of the year, another one to the month of its last line (the
    period of :func:`supplier_station_bounds`), so no file is joined to anything or shuffled."""
    supplier, order, year = F.col("l_suppkey"), F.col("l_orderkey"), F.year("l_shipdate")
    group = _archive_group(supplier, order)
    dealt = lineitem.select("l_suppkey", *LINE_ORDER).repartition(*group)
    keyed = dealt.select(
        year.alias("y"),
        F.expr(f"l_suppkey div {SUPPLIERS_PER_ARCHIVE}").alias("block"),
        F.expr(f"l_orderkey div {ORDERS_PER_STATION_BLOCK}").alias("part"),
        supplier_station(supplier, order).alias("cidade"),
        F.struct(*group).alias("_group"),
        *LINE_ORDER,
    )
    # year, group and station as one number, which settles most of the sort's comparisons. Groups
    # that share its upper bits are held together, and lines of stations that share it lie mixed,
    # each station's in order
    run = F.shiftleft((-F.col("y")).cast("bigint"), 48)
    run = run + F.shiftleft(F.shiftrightunsigned(F.xxhash64("_group"), 40), STATION_BITS)
    run = run + F.shiftrightunsigned(F.xxhash64("cidade"), 64 - STATION_BITS)
    rows = keyed.withColumn("run", run).drop("_group").sortWithinPartitions("run", *LINE_ORDER)
    line = F.when(F.col("cidade").isNull(), F.lit("")).otherwise(F.concat("text", F.lit("\r\n")))
    day = F.coalesce(F.unix_date(F.col("l_shipdate").cast("date")), F.lit(0))
    lines = station_lines(rows).select("run", "y", "block", "part", "cidade", day.alias("day"), line.alias("line"))
    return lines.mapInArrow(_station_archives, "archive string, content binary")
