"""Case tables: yearly HTML pages -> bronze -> silver -> gold.

bronze  ``disease, coluna_0 … coluna_37`` all STRING (municipality, twelve
        monthly triples, year); missing cells are ``'0'``.
silver  ``disease, municipio_resid, ano_mes DATE, casos BIGINT``, one row per
        municipality and month, sorted by month.
gold    ``municipio_resid, ano_mes, qtd_casos, caso`` (``caso`` = disease).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.fixed import BRONZE_PREFIX, MONTHS, N_BRONZE_VALUES, REGION, TEXT_REPAIRS, YEAR_COLUMN
from sentinela.functions.dates import month_number, year_month_date
from sentinela.functions.numbers import drop_thousands, strict_count
from sentinela.functions.text import na_to_null, replaced, strip_code, upper_equals
from sentinela.operators.filters import drop_missing
from sentinela.operators.projection import rename, rename_select, row_range, with_constant
from sentinela.operators.reshape import months_to_rows
from sentinela.plans.layouts import attach_layouts
from sentinela.sources.html import html_table

BRONZE_COLUMNS = [f"{BRONZE_PREFIX}{i}" for i in range(N_BRONZE_VALUES + 1)] + [YEAR_COLUMN]


def _in_layout(region: str) -> Column:
    """Rows of the layout's row range and of ``region``."""
    return row_range(F.col("first_row"), F.col("end_row")) & upper_equals(F.get("cells", F.col("region_col")), region)


def _layout_values(rows: DataFrame, *more: str) -> DataFrame:
    """``disease, municipio, valores, ano``: ``valores`` holds the at most ``n_values`` cells
    after the municipality, in one array; the year travels from the page row."""
    town_col = F.col("municipality_col")
    town = F.get("cells", town_col)
    return rows.select(
        "disease",
        F.when(F.col("strip_code"), strip_code(town)).otherwise(town).alias("municipio"),
        F.slice("cells", town_col + F.lit(2), F.least(F.col("n_values"), F.lit(N_BRONZE_VALUES))).alias("valores"),
        F.col("year").cast("string").alias("ano"),
        *more,
    )


def extract_layout(rows: DataFrame, region: str = REGION) -> DataFrame:
    """Table rows (with their layout columns) -> ``disease, municipio, valores, ano`` of the rows of ``region``."""
    return _layout_values(rows.filter(_in_layout(region)))


def _bronze_columns(raw: DataFrame, repairs: Mapping[str, str] | None, fill: str | None, *more: str) -> DataFrame:
    """The cells are cleaned as one array and read by position afterwards, so the
    plan holds each cleaning expression once and not once per column."""
    repairs = dict(repairs or {})

    def finished(c):
        return replaced(F.coalesce(c, F.lit(fill)) if fill is not None else c, repairs)

    clean = raw.select(
        "disease",
        finished(na_to_null("municipio")).alias("municipio"),
        F.transform("valores", lambda c: finished(drop_thousands(na_to_null(c)))).alias("valores"),
        finished(na_to_null("ano")).alias("ano"),
        *more,
    )
    absent = F.lit(None if fill is None else repairs.get(fill, fill)).cast("string")  # a month the page has no cell for
    # padded to full width, so that a column is read by its position alone
    pad = F.array_repeat(absent, F.lit(N_BRONZE_VALUES) - F.size("valores"))
    clean = clean.withColumn("valores", F.concat("valores", pad))
    values = F.col("valores")
    return clean.select(
        "disease",
        F.col("municipio").alias(BRONZE_COLUMNS[0]),
        *[values[i].alias(BRONZE_COLUMNS[i + 1]) for i in range(N_BRONZE_VALUES)],
        F.col("ano").alias(YEAR_COLUMN),
        *more,
    )


def bronze_cases(
    pages: DataFrame,
    layouts: DataFrame,
    region: str = REGION,
    repairs: Mapping[str, str] | None = TEXT_REPAIRS,
    fill: str | None = "0",
) -> DataFrame:
    """``pages(disease, year, html)`` -> bronze.

    Months a layout does not carry (e.g. a year still in progress) are
    missing and, like every missing or NA-spelled cell, become ``fill``
    (``None`` keeps NULL). ``repairs`` fixes wrongly decoded names.
    """
    rows = html_table(attach_layouts(pages.select("disease", "year", "html"), layouts))
    return _bronze_columns(extract_layout(rows, region), repairs, fill)


# what a staged bronze row is: a row of the layer, or a page that has table rows
STAGED, STAGED_ROWS, STAGED_PAGES = "staged", "rows", "pages"


def staged_bronze(
    pages: DataFrame,
    layouts: DataFrame,
    region: str = REGION,
    repairs: Mapping[str, str] | None = TEXT_REPAIRS,
    fill: str | None = "0",
) -> DataFrame:
    """Bronze rows, and one row per page with table rows, from one parse of the pages.

    Column ``staged`` tells them apart. A page's row carries its path in the first
    bronze column, a number of its own in the second and the year in the last.
    """
    path = F.col("path") if "path" in pages.columns else F.lit(None).cast("string")
    named = pages.select("disease", "year", path.alias("path"), F.monotonically_increasing_id().alias("page"), "html")
    rows = html_table(attach_layouts(named, layouts))
    # data rows are numbered from 0, so a page with any has that one
    kinds = F.array_compact(F.array(F.when(_in_layout(region), STAGED_ROWS), F.when(F.col("row_index") == 0, STAGED_PAGES)))
    each = _layout_values(rows.withColumn(STAGED, F.explode(kinds)), "path", "page", STAGED)
    bronze = _bronze_columns(each, repairs, fill, "path", "page", STAGED)
    page = F.col(STAGED) == STAGED_PAGES
    first, second = BRONZE_COLUMNS[:2]
    return bronze.select(
        "disease",
        F.when(page, F.col("path")).otherwise(F.col(first)).alias(first),
        F.when(page, F.col("page").cast("string")).otherwise(F.col(second)).alias(second),
        *BRONZE_COLUMNS[2:],
        STAGED,
    )


def incomplete_pages(found: DataFrame, layouts: DataFrame) -> DataFrame:
    """``(disease, year, pages, paths)`` of the layouts that have not exactly one page with
    table rows. ``found``: the page rows of :func:`staged_bronze`."""
    each = found.select("disease", F.col(YEAR_COLUMN).cast("int").alias("year"), F.col(BRONZE_COLUMNS[0]).alias("path"))
    counted = each.groupBy("disease", "year").agg(F.count(F.lit(1)).alias("pages"), F.sort_array(F.collect_set("path")).alias("paths"))
    wanted = layouts.select("disease", "year").distinct()
    out = wanted.join(counted, ["disease", "year"], "left").withColumn("pages", F.coalesce("pages", F.lit(0)))
    return out.filter("pages <> 1")


def page_digests(pages: DataFrame, layouts: DataFrame, settings: str = "") -> DataFrame:
    """``(disease, year, digest)``: what the bronze rows of a year are made from, its pages with
    their layout and ``settings``, as one digest. Pages are hashed, not parsed."""
    fields = [c for c in layouts.columns if c not in ("disease", "year")]
    made = F.concat_ws("\x1f", F.lit(settings), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in fields], F.coalesce("html", F.lit("")))
    each = attach_layouts(pages.select("disease", "year", "html"), layouts).select("disease", "year", F.sha2(made, 256).alias("d"))
    digest = F.sha2(F.array_join(F.sort_array(F.collect_list("d")), ","), 256)  # a year has a page, or a few by mistake
    return each.groupBy("disease", "year").agg(digest.alias("digest"))


def silver_cases(bronze: DataFrame, sort: bool = True) -> DataFrame:
    """Bronze -> one row per municipality and month with an integer count."""
    month_cols = {f"{BRONZE_PREFIX}{3 * m - 2}": name for m, name in enumerate(MONTHS, start=1)}
    ids = ["disease", "municipio_resid", "ano"]
    wide = rename_select(
        bronze,
        {f"{BRONZE_PREFIX}0": "municipio_resid", **month_cols, YEAR_COLUMN: "ano"},
        keep=["disease", "municipio_resid", *MONTHS, "ano"],
    )
    long = months_to_rows(wide, ids, list(MONTHS), "mes", "casos")
    long = long.withColumn("ano_mes", year_month_date("ano", month_number("mes")))
    long = drop_missing(long, "casos").withColumn("casos", strict_count("casos"))
    out = long.select("disease", "municipio_resid", "ano_mes", "casos")
    # Sorted by month; ties (left open by the original job) are broken by
    # disease and town so a range partitioner can split a heavy month.
    return out.orderBy("ano_mes", "disease", "municipio_resid") if sort else out


def gold_cases(silver: DataFrame, caso: str | None = None) -> DataFrame:
    """Silver -> published shape; ``caso`` defaults to the disease column."""
    labelled = with_constant(silver, "caso", caso) if caso is not None else silver.withColumn("caso", F.col("disease"))
    out = rename(labelled, "casos", "qtd_casos")
    return out.select("municipio_resid", F.to_date("ano_mes").alias("ano_mes"), "qtd_casos", "caso")
