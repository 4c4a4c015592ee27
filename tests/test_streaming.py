"""Incremental landing: each archive once, replays and re-downloads safe."""

import os

from sentinela.plans.climate import expected_station_files
from sentinela.plans.runner import run_climate
from sentinela.session import scratch_path
from sentinela.streaming import land_archives
from tests.test_climate import GOLDEN, MONTHLY, station_file, zipped

NAME = "INMET_SE_SP_A713_SOROCABA_01-01-2024_A_31-03-2024.CSV"


def drop(folder, fname, members):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, fname), "wb") as f:
        f.write(zipped(members))


def test_land_stream_then_batch(spark):
    root = scratch_path(spark, "stream")
    inbox, base = f"{root}/inbox", f"{root}/base"
    drop(f"{inbox}/2024-04", "2024.zip", {f"2024/{NAME}": station_file(GOLDEN)})
    q = land_archives(spark, inbox, base)
    q.awaitTermination(120)
    assert q.exception() is None
    # same archive downloaded again next month: landed again, read once
    drop(f"{inbox}/2024-05", "2024.zip", {f"2024/{NAME}": station_file(GOLDEN)})
    q = land_archives(spark, inbox, base)
    q.awaitTermination(120)
    land = spark.read.parquet(f"{base}/0. land/climaticas")
    assert land.count() == 2 and land.select("batch_id").distinct().count() == 2
    # nothing new: the checkpoint remembers both archives
    q = land_archives(spark, inbox, base)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{base}/0. land/climaticas").count() == 2
    expected = expected_station_files(spark, as_of="2024-04-02", start="2024-01-01", extra=())
    gold = run_climate(spark, None, expected, base)
    assert [tuple(r) for r in gold.orderBy("data").collect()] == MONTHLY
