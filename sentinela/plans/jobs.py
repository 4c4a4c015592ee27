"""Entry points of the monthly jobs (one call = one full-refresh run).

``run_pipeline(spark, name, as_of, base, ...)`` runs the three disease
jobs and the weather job by name. Scheduling and retries belong to the
cluster's scheduler; the run date is an argument, never the clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.fixed import STATION, WINDOWS_START
from sentinela.plans.climate import expected_station_files
from sentinela.plans.layouts import PUBLISHED_LAYOUTS, layout_frame
from sentinela.plans.runner import run_cases, run_climate
from sentinela.sources.archives import read_binary_files
from sentinela.sources.files import reporting_end
from sentinela.sources.html import read_pages

DISEASES = ("dengue", "chikungunya", "zika")


def run_pipeline(
    spark: SparkSession,
    name: str,
    as_of: str,
    base: str,
    source: str,
    table: str | None = None,
    stations: Sequence[str] = (STATION,),
    page_encoding: str = "auto",
    per_station: bool = False,
    layer_format: str = "parquet",
    incomplete: str = "raise",
    unreadable: str = "raise",
) -> DataFrame:
    """Run one job by name and return its gold table.

    ``name``: a disease (``source`` = folder of saved yearly pages; the job
    uses the layouts of that disease) or ``"climaticas"`` (``source`` =
    folder of yearly zip archives; stations and ``as_of`` pick the files;
    ``per_station`` keeps one monthly series per station instead of merging
    all stations by date).
    """
    if name in DISEASES:
        # unlabelled pages stay in: the run's report lists them
        pages = read_pages(spark, source, encoding=page_encoding).filter(F.col("disease").isin(name, ""))
        layouts = layout_frame(spark, [x for x in PUBLISHED_LAYOUTS if x.disease == name])
        return run_cases(spark, pages, layouts, base, table=table, name=name, layer_format=layer_format, incomplete=incomplete)
    if name == "climaticas":
        archives = read_binary_files(spark, source, glob="*.zip", recursive=True)
        # archives are one per year: those outside the run's years are not read
        year = F.regexp_extract("path", r"((?:19|20)\d\d)\D*$", 1).try_cast("int")
        last = F.year(reporting_end(F.lit(as_of)))
        archives = archives.filter(F.coalesce(year.between(F.year(F.lit(WINDOWS_START).cast("date")), last), F.lit(True)))
        expected = expected_station_files(spark, as_of, stations)
        keys = ("cidade",) if per_station else ()
        return run_climate(spark, archives, expected, base, keys=keys, table=table, name=name, layer_format=layer_format, unreadable=unreadable)
    raise ValueError(f"unknown job {name!r}")


def main(argv: Sequence[str] | None = None) -> None:
    """``python -m sentinela.plans.jobs NAME --as-of YYYY-MM-DD --base PATH
    --source PATH [--table T] [--station S ...]`` — one monthly run, e.g.
    from a scheduler task. The session comes from the cluster's defaults."""
    import argparse

    from sentinela.session import get_session

    p = argparse.ArgumentParser(prog="sentinela.plans.jobs", description=main.__doc__)
    p.add_argument("name", choices=[*DISEASES, "climaticas"])
    p.add_argument("--as-of", required=True, help="run date; the month before it is reported")
    p.add_argument("--base", required=True, help="folder holding the land/bronze/silver layers")
    p.add_argument("--source", required=True, help="folder of yearly pages or of zip archives")
    p.add_argument("--table", default=None, help="catalog table to replace with the gold rows")
    p.add_argument("--station", action="append", default=None, help="weather station (repeatable)")
    p.add_argument("--page-encoding", default="auto")
    p.add_argument("--per-station", action="store_true", help="one weather series per station")
    p.add_argument("--layer-format", choices=["parquet", "csv"], default="parquet")
    a = p.parse_args(argv)
    spark = get_session(app=f"sentinela-{a.name}")
    gold = run_pipeline(
        spark, a.name, a.as_of, a.base, a.source, table=a.table,
        stations=tuple(a.station) if a.station else (STATION,), page_encoding=a.page_encoding,
        per_station=a.per_station, layer_format=a.layer_format,
    )
    print(f"{a.name}: gold table with {len(gold.columns)} columns written under {a.base}")


if __name__ == "__main__":
    main()
