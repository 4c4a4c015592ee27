"""Workers that have no copy of the package: the session starts in another folder, and
only the driver's path names the repository."""

import os
import subprocess
import sys
import textwrap

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

RUN = """
import os, sys
repo, sf, scratch = sys.argv[1:]
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", scratch + "/ckpt").config("spark.sql.warehouse.dir", scratch + "/wh").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def importable(batches):
    import pyarrow as pa
    for b in batches:
        try:
            import sentinela
            found = True
        except ModuleNotFoundError:
            found = False
        yield pa.RecordBatch.from_arrays([pa.array([found] * b.num_rows)], ["found"])

assert not spark.range(1).mapInArrow(importable, "found boolean").first().found
sys.path.insert(0, repo)
import __spark_entry__ as E
bad = []
for name, query in E.queries().items():
    if name.startswith("op") or name in ("pipeline", "html_table_extract", "unzip_members"):
        try:
            print(name, query(spark, sf).count(), flush=True)
        except Exception as e:
            bad.append(name)
            print(name, "FAILED", str(e)[:600], flush=True)
sys.exit(len(bad))
"""


def test_every_operator_runs(tmp_path):
    # workers start with this driver's environment; it gets the repository only in its own sys.path
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYTHONPATH"] = ":".join(p for p in os.environ.get("PYTHONPATH", "").split(":") if p and "repo" not in p and p != os.getcwd())
    ran = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(RUN), REPO, SF, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200
    )
    assert ran.returncode == 0, ran.stdout + ran.stderr[-1500:]
