"""Contract queries: one per operator group, each over whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns carry the same names and types as the matching SQL in
:mod:`sentinela.plans.oracle`. Doubles are rounded to 6 decimals at the very
end so that sums taken in a different order compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sentinela.fixed import MONTHS, TEXT_REPAIRS
from sentinela.functions.dates import lenient_date, month_number, year_month_date
from sentinela.functions.numbers import lenient_double, strict_count
from sentinela.functions.text import repair_mojibake, strip_code
from sentinela.operators.combine import replace_from_table, replace_values, stack_layouts, union_layouts
from sentinela.operators.filters import drop_missing, region_filter
from sentinela.operators.ordering import sort_in_ranges
from sentinela.operators.projection import rename, rename_select, with_constant
from sentinela.operators.reshape import months_to_rows
from sentinela.operators.timeseries import daily_rollup, dates_by_first_value, monthly_mean_filled
from sentinela.plans import runner
from sentinela.plans.cases import bronze_cases, silver_cases
from sentinela.plans.climate import bronze_climate, bronze_lines, expected_station_files_for, land_members
from sentinela.plans.table_inputs import (
    customer_pages,
    lineitem_station_files,
    order_archives,
    order_case_layouts,
    order_case_pages,
    order_month_counts,
    order_note_files,
    saved_files,
    saved_name,
    saved_station_files,
    supplier_station_archives,
    supplier_station_bounds,
    table,
)
from sentinela.session import checkpoint_root, scratch_path
from sentinela.sources.archives import unzip_members
from sentinela.sources.files import expected_vs_found, file_name, yearly_windows, reporting_end
from sentinela.sources.html import html_table, read_pages
from sentinela.sources.layers import publish, read_layer, read_layer_inferred, write_layer
from sentinela.sources.split_files import read_delimited_files
from sentinela.streaming.land import land_archives

CASE_REGION = "AMERICA"
BEYOND_DOUBLE = 9007199254740992  # 2^53: above it a double skips whole numbers


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (presentation only)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


# --- sources -----------------------------------------------------------------

def html_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1: the first table of generated customer pages (colspan header,
    rowspan cell, entities, a table in a script, a second table) as
    positional rows."""
    pages = customer_pages(table(spark, sf_dir, "customer"))
    rows = html_table(pages)
    return rows.select(
        "page_nation", "page_block", "row_index",
        *[F.get("cells", i).alias(f"c{i}") for i in range(4)],
    )


def _case_inputs(spark: SparkSession, sf_dir: str):
    """Pages (one per priority and year) and their layouts. The pages are
    built once and checkpointed to the shared folder, since both the pages
    and the layout table derive from them."""
    counts = order_month_counts(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))
    pages = order_case_pages(counts, table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
    checkpoint_root(spark)
    pages = pages.checkpoint(eager=True)
    return pages.select("disease", "year", "html"), order_case_layouts(pages)


def _page_folders(pages: DataFrame) -> DataFrame:
    """Case pages dealt to the folders of the three diseases, years after 2000."""
    k = F.ascii(F.col("disease")) % 3
    folder = F.when(k == 0, "dengue").when(k == 1, "chikung").otherwise("zika")
    return pages.select(folder.alias("_doenca"), (F.col("year") + 30).alias("_ano"), F.col("html").alias("value"))


def pages_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1, S-2: case pages saved one per file below a folder that bears another
    disease's name, read back with the labels of their own folders: pages and
    table rows per (disease, year)."""
    pages, _ = _case_inputs(spark, sf_dir)
    path = scratch_path(spark, "zika_2019_paginas")
    _page_folders(pages).write.option("maxRecordsPerFile", 1).partitionBy("_doenca", "_ano").text(path)
    read = read_pages(spark, path, glob="part-*")
    rows = html_table(read.select("disease", "year", "path", "html"))
    each = rows.groupBy("disease", "year", "path").agg(F.count(F.lit(1)).alias("linhas"))
    return each.groupBy("disease", "year").agg(F.count(F.lit(1)).alias("paginas"), F.sum("linhas").alias("linhas"))


def land_all_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3, K-4, X-15: every member of the station archives lands, whatever its ending."""
    land = land_members(supplier_station_archives(table(spark, sf_dir, "lineitem")))
    return land.select("archive", "member", "name", "cidade", F.col("error").isNull().alias("lido"))


def layout_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2, P-1..P-8, F-1, X-2, N-1, N-2: yearly order pages in three layouts -> bronze columns."""
    pages, layouts = _case_inputs(spark, sf_dir)
    return bronze_cases(pages, layouts, region=CASE_REGION)


def unzip_members_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3, X-15: zip archives of order lines (members in folders) -> member base names and their lines."""
    members = unzip_members(order_archives(table(spark, sf_dir, "orders")))
    lines = members.select(
        "archive", "name",
        F.posexplode(F.split(F.decode("content", "UTF-8"), "\n", -1)).alias("line_no", "line"),
    )
    return lines


def delimited_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-4, F-2, F-4, F-6, X-3, X-4: dirty latin-1 station files from lineitem -> bronze rows."""
    files = lineitem_station_files(table(spark, sf_dir, "lineitem"))
    return bronze_climate(files, keep=("name", "line_no"))


def delimited_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-4, F-2, F-4, F-6, X-3, X-4: station files in a folder, read in blocks by many tasks -> bronze rows."""
    path = saved_station_files(table(spark, sf_dir, "lineitem"), scratch_path(spark, "delimited_split"))
    lines = read_delimited_files(spark, path).withColumn("name", saved_name("file"))
    return bronze_lines(lines, keep=("name", "line_no"))


def quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-4: order notes with line breaks, separators and quotes inside quoted fields, read in blocks."""
    path = saved_files(order_note_files(table(spark, sf_dir, "orders")), scratch_path(spark, "quoted_breaks"))
    rows = read_delimited_files(spark, path, skip_rows=2, encoding="UTF-8", multiline=True)
    return rows.select(saved_name("file").alias("name"), "line_no", *[F.get("fields", i).alias(f"c{i}") for i in range(3)])


def inferred_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-7: a CSV layer without a declared schema: types from all values, a late text value included."""
    base = scratch_path(spark, "inferred_layer")
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0]
    key = F.col("o_orderkey")
    src = orders.select(
        "o_orderkey",
        F.when(key % 3 != 0, F.col("o_custkey")).alias("inteiro_com_falta"),
        "o_totalprice",
        F.when(key == last, F.lit("n/d?")).otherwise((key % 100).cast("string")).alias("texto_tardio"),
        F.when(key % 2 == 0, F.lit("True")).otherwise("False").alias("par"),
        F.when(key == last, F.lit("7.5")).otherwise((key % 10).cast("string")).alias("decimal_tardio"),
        F.col("o_orderdate").cast("date").cast("string").alias("data"),
    )
    write_layer(src, base, "1. bronze", "orders", fmt="csv")
    read = read_layer_inferred(spark, base, "1. bronze", "orders")
    return read.withColumn("inteiro_com_falta", F.coalesce("inteiro_com_falta", F.lit(-1)))


def yearly_windows_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected yearly files per nation over its order period, flagged by
    whether the nation's customers placed a pending order in that year.

    One aggregate per (nation, year) carries both the period bounds and the
    pending flag, so ``orders`` is scanned and joined once."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    per_year = (
        orders.join(customer.select("c_custkey", "c_nationkey"), orders.o_custkey == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("y"))
        .agg(
            F.min("o_orderdate").alias("_min"),
            F.max("o_orderdate").alias("_max"),
            F.max(F.col("o_orderstatus") == "P").alias("pending"),
        )
    )
    # small (nations x years) and read by three branches: cut it once in the
    # shared checkpoint folder instead of scanning orders per branch
    checkpoint_root(spark)
    per_year = per_year.checkpoint(eager=True)
    # each nation reports from its customers' first order to the end of
    # the month of their last one
    bounds = (
        per_year.groupBy("c_nationkey")
        .agg(F.min("_min").cast("date").alias("start"), reporting_end(F.add_months(F.max("_max").cast("date"), 1)).alias("end"))
        .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("cidade")), "c_nationkey")
    )
    expected = yearly_windows(bounds, keys=["cidade", "c_nationkey"]).withColumn(
        "name", file_name("cidade", "window_start", "window_end")
    )
    pending = per_year.filter("pending").select("c_nationkey", "y")  # one row per (nation, year)
    found = expected.withColumn("y", F.year("window_start")).join(pending, ["c_nationkey", "y"]).select("name")
    out = expected_vs_found(expected, found)
    return out.select("cidade", "window_start", "window_end", "name", "found")


def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-1, K-2, S-7: a CSV layer written and read back with a declared schema."""
    base = scratch_path(spark, "layer_roundtrip")
    src = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )
    write_layer(src, base, "1. bronze", "lineitem", fmt="csv")
    schema = "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate date"
    return read_layer(spark, base, "1. bronze", "lineitem", schema=schema, fmt="csv")


def publish_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-3: a table replaced twice, with a publish between that fails in a task; only the last content remains."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "publish_replace")
    name = "publish_check_" + path.rsplit("/", 1)[-1]
    first = orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("qtd"))
    publish(first.select(F.lit(None).cast("date").alias("ano_mes"), "o_orderstatus", "qtd"), name, path)
    second = orders.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "month").alias("ano_mes"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("qtd")
    )
    failing = F.when(F.col("qtd") > 0, F.raise_error(F.lit("publish interrupted")).cast("bigint"))
    try:
        publish(second.withColumn("qtd", failing), name, path)
    except PySparkException:  # the table still holds the first content
        if spark.table(name).where("ano_mes IS NULL").count() == 0:
            raise
    publish(second, name, path)
    return spark.table(name)


# --- projections / filters / functions -------------------------------------------

def rename_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P-4, P-5, P-7: dictionary rename with a keep list, constant column, single rename (absent names ignored)."""
    customer = table(spark, sf_dir, "customer")
    out = rename_select(
        customer,
        {"c_custkey": "id_cliente", "c_name": "nome", "c_nationkey": "nacao", "c_acctbal": "saldo", "c_absent": "x"},
        keep=["id_cliente", "nome", "nacao", "saldo", "c_mktsegment"],
    )
    out = with_constant(out, "caso", "cliente")
    out = rename(rename(out, "saldo", "saldo_conta"), "not_there", "ignored")
    return out


def region_filter_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-1, X-1, X-2: case-insensitive region filter without trim; leading code stripped."""
    customer = table(spark, sf_dir, "customer")
    geo = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    c = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    k = F.col("c_custkey") % 4
    nk = F.col("c_nationkey").cast("string")
    town = (
        F.when(k == 0, F.concat(nk, F.lit(" "), "c_name"))
        .when(k == 1, F.col("c_name"))
        .when(k == 2, F.concat(nk, F.lit("  "), "c_name"))
        .otherwise(F.concat(F.lit("a "), nk, F.lit(" "), "c_name"))
    )
    r = F.col("c_custkey") % 3
    region_cell = F.when(r == 0, F.col("r_name")).when(r == 1, F.lower("r_name")).otherwise(F.concat("r_name", F.lit(" ")))
    cells = c.select("c_custkey", region_cell.alias("regiao"), town.alias("municipio"))
    kept = region_filter(cells, "regiao", "asia")
    return kept.select("c_custkey", "regiao", strip_code("municipio").alias("municipio"))


def months_to_rows_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R-1, X-5..X-7, X-14, F-3, O-1: wide monthly order counts (zero months missing) -> one dated row per month."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    j = orders.join(customer.select("c_custkey", "c_nationkey"), orders.o_custkey == F.col("c_custkey"))
    m = F.month("o_orderdate")
    wide = j.groupBy("c_nationkey", F.year("o_orderdate").alias("ano")).agg(*[
        F.count_if(m == i).alias(name) for i, name in enumerate(MONTHS, start=1)
    ])

    def spelled(n: str):  # beyond what a double holds, or with a comma after the first digit
        k, text = F.col("c_nationkey") % 5, F.col(n).cast("string")
        return (
            F.when(k == 0, (F.col(n) + F.lit(BEYOND_DOUBLE)).cast("string"))
            .when(k == 1, F.regexp_replace(text, r"^(\d)(\d)", "$1,$2"))
            .otherwise(text)
        )

    wide = wide.select(
        "c_nationkey", F.col("ano").cast("string").alias("ano"),
        *[F.when(F.col(n) > 0, spelled(n)).alias(n) for n in MONTHS],
    ).join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("municipio_resid")), "c_nationkey")
    long = months_to_rows(wide, ["municipio_resid", "ano"], list(MONTHS), "mes", "casos")
    long = long.withColumn("ano_mes", year_month_date("ano", month_number("mes")))
    long = drop_missing(long, "casos").withColumn("casos", strict_count("casos"))
    return long.select("municipio_resid", "ano_mes", "casos").orderBy("ano_mes", "municipio_resid")


def _lineitem_hourly(lineitem: DataFrame) -> DataFrame:
    """Lineitem as text-dated hourly readings: line 7 has a bad date; days
    numbered 13 have every measure missing; line 3 lacks humidity."""
    ln = F.col("l_linenumber")
    void = F.dayofmonth("l_shipdate") == 13
    def m(c):
        return F.when(void, F.lit(None).cast("double")).otherwise(F.col(c).cast("double"))
    return lineitem.select(
        F.when(ln == 7, F.lit("lixo")).otherwise(F.date_format("l_shipdate", "yyyy/MM/dd")).alias("data"),
        m("l_quantity").alias("precipitacao_total"),
        m("l_extendedprice").alias("pressao_atmosferica_max"),
        m("l_discount").alias("pressao_atmosferica_min"),
        m("l_tax").alias("temp_max"),
        m("l_quantity").alias("temp_min"),
        F.when(ln == 3, F.lit(None).cast("double")).otherwise(m("l_quantity")).alias("umidade_relativa_ar"),
    )


def daily_rollup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1, A-2, X-8, F-5: text-dated readings -> one row per day, a function per column."""
    hourly = _lineitem_hourly(table(spark, sf_dir, "lineitem"))
    dated = hourly.withColumn("data", lenient_date("data"))
    return rounded(daily_rollup(dated, "data"))


def union_layouts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U-1, U-2, N-1, N-2: a full-year frame (int year) and a half-year frame (text year, 'nan') stacked by name."""
    orders = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    j = orders.join(customer.select("c_custkey", "c_nationkey"), orders.o_custkey == F.col("c_custkey"))
    m = F.month("o_orderdate")
    counts = j.groupBy("c_nationkey", F.year("o_orderdate").alias("ano")).agg(*[
        F.count_if(m == i).alias(n) for i, n in enumerate(MONTHS, start=1)
    ]).join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nacao")), "c_nationkey")
    # a nation's latest year comes as a half-year frame
    counts = counts.withColumn("_last", F.max("ano").over(Window.partitionBy("c_nationkey")))
    # both layouts derive from these few rows: cut them once (shared folder)
    checkpoint_root(spark)
    counts = counts.checkpoint(eager=True)
    names = list(MONTHS)
    full = counts.filter(F.col("ano") < F.col("_last")).select(
        "nacao", *[F.when(F.col(n) > 0, F.col(n)).alias(n) for n in names], F.col("ano").cast("int").alias("ano")
    )
    half = counts.filter(F.col("ano") == F.col("_last")).select(
        "nacao", *[F.when(F.col(n) > 0, F.col(n).cast("string")).otherwise(F.lit("nan")).alias(n) for n in names[:5]],
        F.col("ano").cast("string").alias("ano"),
    )
    return union_layouts(full, half)


def replace_values_towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-3: wrongly decoded town names repaired by the fixed map and by the general repair."""
    part = table(spark, sf_dir, "part")
    towns = F.array(*[F.lit(v) for v in TEXT_REPAIRS.values()])
    town = F.get(towns, (F.col("p_partkey") % len(TEXT_REPAIRS)).cast("int"))
    damaged = F.decode(F.encode(town, "UTF-8"), "ISO-8859-1")
    spoiled = part.select("p_partkey", F.when(F.col("p_size") % 2 == 0, damaged).otherwise(town).alias("cidade_original"))
    fixed = replace_values(spoiled.withColumn("cidade_mapa", F.col("cidade_original")), TEXT_REPAIRS, cols=["cidade_mapa"])
    return fixed.withColumn("cidade_auto", repair_mojibake("cidade_original"))


def replace_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N-3: two columns repaired by a dictionary table of 100,000 pairs."""
    orders = table(spark, sf_dir, "orders")
    pairs = spark.range(100_000).select(
        F.concat(F.lit("k"), F.col("id") * 2).alias("old"),
        F.when(F.col("id") % 10 != 0, F.concat(F.lit("v"), F.col("id"))).alias("new"),
    )
    cells = orders.select(
        "o_orderkey", "o_totalprice",
        F.concat(F.lit("k"), F.col("o_orderkey") % 300_000).alias("primeira"),
        F.when(F.col("o_custkey") % 5 != 0, F.concat(F.lit("k"), F.col("o_custkey") % 7)).alias("segunda"),
    )
    return replace_from_table(cells, pairs, ["primeira", "segunda"])


def layouts_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U-1, U-2, N-1, N-2: rows of 200 layouts, each with its own columns and column order, stacked by name."""
    part = table(spark, sf_dir, "part")
    layout = F.col("p_partkey") % 200
    # a layout has the columns whose number does not divide it, in an order of its own
    numbers = F.filter(F.sequence(F.lit(2), F.lit(9)), lambda i: layout % i != 0)
    names = F.when(layout % 2 == 1, numbers).otherwise(F.reverse(numbers))
    cells = F.transform(names, lambda i: F.when((F.col("p_partkey") + i) % 11 == 0, F.lit("nan")).otherwise(F.concat(F.col("p_size"), F.lit("/"), i)))
    rows = part.select("p_partkey", F.transform(names, lambda i: F.concat(F.lit("col_"), i)).alias("names"), cells.alias("cells"))
    out = stack_layouts(rows, keep=["p_partkey"])
    return out.select("p_partkey", *sorted(c for c in out.columns if c != "p_partkey"))


def date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-8, F-5: sources in two date formats; a source's first value decides, values of the other one are NULL."""
    orders = table(spark, sf_dir, "orders")
    source, key = F.col("o_custkey") % 50, F.col("o_orderkey")
    slashed = (source % 2 == 0) != (key % 10 == 3)
    text = F.when(slashed, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    rows = orders.select(source.alias("fonte"), "o_orderkey", "o_totalprice", F.when(key % 17 == 0, F.lit("lixo")).otherwise(text).alias("data"))
    dated = dates_by_first_value(rows, "data", "o_orderkey", ["yyyy/MM/dd", "dd/MM/yyyy"], ["fonte"])
    return dated.withColumn("data", F.date_format("data", "yyyy-MM-dd"))


def monthly_mean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-3, A-4, X-10, N-4: daily order values per customer -> monthly means with every month between first and last."""
    orders = table(spark, sf_dir, "orders")
    v = F.col("o_totalprice")
    readings = orders.select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("data"),
        v.alias("total"), v.alias("maior"), v.alias("menor"), v.alias("media"),
    )
    daily = daily_rollup(readings, "data", {"total": "sum", "maior": "max", "menor": "min", "media": "mean"}, keys=["o_custkey"])
    return rounded(monthly_mean_filled(daily, "data", ["total", "maior", "menor", "media"], keys=["o_custkey"], sort=False))


def _daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("o_totalprice")
    readings = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("data"), v.alias("total"), v.alias("maior"))
    return daily_rollup(readings, "data", {"total": "sum", "maior": "max"})


def monthly_mean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-1..A-4, X-10, N-4 without keys: one series of all orders, like the weather job's."""
    return rounded(monthly_mean_filled(_daily_orders(spark, sf_dir), "data", ["total", "maior"]))


def lenient_number_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-4: event values written as text with junk spellings -> numbers or NULL."""
    events = table(spark, sf_dir, "events")
    k = F.col("event_id") % 10
    v = F.col("value").cast("string")
    text = (
        F.when(k == 0, F.lit("")).when(k == 1, F.lit("nan")).when(k == 2, F.concat(v, F.lit("f")))
        .when(k == 3, F.lit("x")).when(k == 4, F.concat(F.lit(" "), v, F.lit(" ")))
        .when(k == 5, F.lit("1e3")).when(k == 6, F.lit("-")).when(k == 7, F.lit(".5"))
        .when(k == 8, F.lit("1.2.3")).otherwise(v)
    )
    return events.select("event_id", lenient_double(text).alias("numero"))


def land_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3, K-4 as a stream: order archives arrive in two appends to a
    staged folder; after each, the landing stream (availableNow) lands what
    is new. The land's member lines must equal a single unpacking."""
    root = scratch_path(spark, "land_stream")
    inbox, base = f"{root}/inbox", f"{root}/base"
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    first_year = orders.agg(F.min(year)).first()[0]
    # two deliveries; archives are per year, so each is built once, whole
    for arrived in (year <= first_year + 2, year > first_year + 2):
        delivery = order_archives(orders.filter(arrived)).withColumn("length", F.octet_length("content").cast("bigint"))
        delivery.write.mode("append").parquet(inbox)
        q = land_archives(spark, inbox, base, name="pedidos", checkpoint=f"{root}/checkpoint", name_pattern=None, staged=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    land = spark.read.parquet(f"{base}/0. land/pedidos")
    return land.select(
        "archive", "name",
        F.posexplode(F.split(F.decode("content", "UTF-8"), "\n", -1)).alias("line_no", "line"),
    )


# --- layer jobs -------------------------------------------------------------------

def cases_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-1..G-3, G-7: order pages through bronze, silver and gold layers."""
    pages, layouts = _case_inputs(spark, sf_dir)
    base = scratch_path(spark, "cases")
    return runner.run_cases(spark, pages, layouts, base, region=CASE_REGION, partition_by=())


def cases_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-7: a second run without one priority leaves nothing of the first run."""
    pages, layouts = _case_inputs(spark, sf_dir)
    base = scratch_path(spark, "cases_rerun")
    runner.run_cases(spark, pages, layouts, base, region=CASE_REGION, partition_by=())
    kept = ~F.col("disease").startswith("1-URGENT")
    return runner.run_cases(spark, pages.filter(kept), layouts.filter(kept), base, region=CASE_REGION, partition_by=())


def cases_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-7: a first run over a third of the pages in an older state, then one over all of them:
    the years that are the same are not parsed again, and the tables are those of a full refresh."""
    pages, layouts = _case_inputs(spark, sf_dir)
    base = scratch_path(spark, "cases_incremental")
    # years that the second run finds unchanged, changed, and new
    third = F.col("year") % 3
    older = F.when(third == 1, F.regexp_replace("html", "<td>\\d+</td></tr>", "<td>7</td></tr>")).otherwise(F.col("html"))
    before = third != 2
    runner.run_cases(
        spark, pages.filter(before).withColumn("html", older), layouts.filter(before), base, region=CASE_REGION, incremental=True
    )
    return runner.run_cases(spark, pages, layouts, base, region=CASE_REGION, incremental=True)


def _out_of_order(df: DataFrame, key: str, what: str) -> DataFrame:
    """One row: the rows of a sorted frame, and how many of them come after a
    greater ``key`` in the same partition or begin a partition below the end of
    an earlier one."""
    placed = df.select(key, F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"))
    before = F.lag(key).over(Window.partitionBy("p").orderBy("i"))
    parts = placed.withColumn("_before", before).groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_before") > F.col(key)).alias("inside"),
        F.min(key).alias("lo"), F.max(key).alias("hi"),
    )
    # one row per partition of the sorted frame
    earlier = F.max("hi").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    return parts.withColumn("_earlier", earlier).agg(
        F.lit(what).alias("saida"), F.sum("n").alias("linhas"),
        F.sum(F.col("inside") + F.when(F.col("_earlier") > F.col("lo"), 1).otherwise(0)).alias("fora_de_ordem"),
    )


def sorted_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-1, O-2: the silver cases and the monthly means come out by ascending month."""
    pages, layouts = _case_inputs(spark, sf_dir)
    unsorted = silver_cases(bronze_cases(pages, layouts, region=CASE_REGION), sort=False)
    silver = sort_in_ranges(unsorted, "ano_mes", ("disease", "municipio_resid"), rows_per_task=10_000)
    months = monthly_mean_filled(_daily_orders(spark, sf_dir), "data", ["total", "maior"])
    return _out_of_order(silver, "ano_mes", "casos").unionByName(_out_of_order(months, "data", "medias"))


def climate_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G-4..G-7: yearly station archives from lineitem through land, bronze, silver and gold (per station)."""
    return _climate_run(spark, sf_dir, "climate")


def climate_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3, G-4..G-7 with an archive cut off in the middle: it is reported, and the run goes on without it."""
    second = table(spark, sf_dir, "lineitem").agg(F.year(F.min("l_shipdate")) + 1).first()[0]

    def cut(archives: DataFrame) -> DataFrame:
        half = F.substring("content", F.lit(1), F.expr("int(length div 2)"))
        return archives.withColumn("content", F.when(F.col("archive") == f"{second}_0_0.zip", half).otherwise(F.col("content")))

    return _climate_run(spark, sf_dir, "climate_damaged", cut, unreadable="report")


def _climate_run(spark: SparkSession, sf_dir: str, folder: str, change=None, **options) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    checkpoint_root(spark)
    # one row per station, and many files to expect of each: in as many parts as there are cores
    bounds = supplier_station_bounds(lineitem).repartition(spark.sparkContext.defaultParallelism).checkpoint(eager=True)
    base = scratch_path(spark, folder)
    # delivered once to a folder, as archives are; the job reads them from there
    delivered = supplier_station_archives(lineitem).withColumn("length", F.octet_length("content").cast("bigint"))
    if change is not None:
        delivered = change(delivered)
    delivered.write.parquet(f"{base}/inbox")
    archives = spark.read.schema(delivered.schema).parquet(f"{base}/inbox")
    expected = expected_station_files_for(bounds)
    gold = runner.run_climate(spark, archives, expected, base, keys=("cidade",), **options)
    return rounded(gold)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "html_table_extract": html_table_extract,
    "layout_extract": layout_extract,
    "unzip_members": unzip_members_lines,
    "land_stream": land_stream,
    "delimited_clean": delimited_clean,
    "yearly_windows": yearly_windows_found,
    "layer_roundtrip": layer_roundtrip,
    "publish_replace": publish_replace,
    "rename_label": rename_label,
    "region_filter_strip": region_filter_strip,
    "months_to_rows": months_to_rows_counts,
    "daily_rollup": daily_rollup_lineitem,
    "union_layouts": union_layouts_orders,
    "replace_values": replace_values_towns,
    "monthly_mean_filled": monthly_mean_orders,
    "lenient_number": lenient_number_events,
    "cases_layers": cases_layers,
    "cases_rerun": cases_rerun,
    "cases_incremental": cases_incremental,
    "pages_from_files": pages_from_files,
    "land_all_members": land_all_members,
    "monthly_mean_all": monthly_mean_all,
    "sorted_months": sorted_months,
    "climate_layers": climate_layers,
    "climate_damaged": climate_damaged,
    "delimited_split": delimited_split,
    "quoted_breaks": quoted_breaks,
    "inferred_layer": inferred_layer,
    "replace_dictionary": replace_dictionary,
    "layouts_by_name": layouts_by_name,
    "date_formats": date_formats,
}
