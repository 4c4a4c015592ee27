"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package assumes. Dates are calendar dates, so
# the session time zone must not shift them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffle partitions to the advisory size instead of
    # keeping many tiny tasks (Spark's advice for shared clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "sentinela", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured on a local master (tests) a folder of our own
    is created and registered as the checkpoint directory; any other master needs
    the setting, since its executors cannot see a folder of the driver's.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="sentinela-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    return "/".join([checkpoint_root(spark), "sentinela", *parts, uuid.uuid4().hex])


def register_sql_functions(spark: SparkSession) -> None:
    """Make the two table functions callable from SQL:
    ``SELECT … FROM pages, LATERAL html_table(html, 0)`` and
    ``SELECT … FROM archives, LATERAL zip_members(content, '\\.CSV$')``."""
    from sentinela.sources import archives, html

    html.register(spark)
    archives.register(spark)
