"""Print the physical plans of the core jobs (the library code, on the
sf0.01 tables), expression ids removed, lines cut at 160 characters.

usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sentinela.plans import queries as Q  # noqa: E402
from sentinela.plans import table_inputs as T  # noqa: E402
from sentinela.plans.cases import bronze_cases, silver_cases  # noqa: E402
from sentinela.plans.climate import (  # noqa: E402
    bronze_climate,
    expected_station_files,
    expected_station_files_for,
    land_members,
    select_station_files,
    silver_climate,
    write_land,
)
from sentinela.session import get_session, scratch_path  # noqa: E402
from sentinela.sources.layers import BRONZE, LAND, read_layer, write_layer  # noqa: E402

def show(title: str, df) -> None:
    text = df._jdf.queryExecution().executedPlan().toString()
    print(f"\n### {title}\n```")
    for line in text.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        print(line[:160])
    print("```")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "16"})
    spark.sparkContext.setLogLevel("ERROR")
    pages, layouts = Q._case_inputs(spark, sf_dir)
    bronze = bronze_cases(pages, layouts, region="AMERICA")
    show("cases bronze: pages x broadcast(layouts) -> HTML UDTF -> filter -> columns", bronze)
    show("cases silver: months to rows (inline) -> typed -> range sort", silver_cases(bronze))

    li = T.table(spark, sf_dir, "lineitem")
    base = scratch_path(spark, "plans")
    write_land(land_members(T.supplier_station_archives(li)), base, "c")
    land = read_layer(spark, base, LAND, "c")
    expected = expected_station_files(spark, as_of="2000-03-01", stations=["SE_XX_A000007"], start="1996-01-01", extra=())
    files = select_station_files(land, expected)
    show("weather file selection: broadcast expected list, dynamic pruning of land buckets", files)
    show("weather bronze: decode/split once per file, explode, native parsing", bronze_climate(files))
    every_station = expected_station_files_for(T.supplier_station_bounds(li))
    write_layer(bronze_climate(select_station_files(land, every_station)), base, BRONZE, "c")
    b = read_layer(spark, base, BRONZE, "c")
    show("weather silver: partial+final daily agg, partial+final monthly agg, per-key window + explode", silver_climate(b, keys=("cidade",)))
    show("lineitem scan pruning (daily roll-up query)", Q.daily_rollup_lineitem(spark, sf_dir))
    show("customer x nation x region (filter + strip query)", Q.region_filter_strip(spark, sf_dir).filter(F.lit(True)))
    spark.stop()


if __name__ == "__main__":
    main()
