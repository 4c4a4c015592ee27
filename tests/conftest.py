import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sentinela.session import get_session

    scratch = tempfile.mkdtemp(prefix="sentinela-tests-")
    s = get_session(
        "local[4]",
        app="sentinela-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from sentinela.session import scratch_path

    return scratch_path(spark, "tests")
