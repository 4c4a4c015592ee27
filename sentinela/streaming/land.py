"""Incremental landing of station archives with Structured Streaming.

The monthly job re-reads every archive. As a stream, each archive that
appears in the drop folder is unpacked exactly once into the land layer:
the file source remembers what it has processed in the checkpoint (in the
shared folder), ``availableNow`` processes what is there and stops (a
scheduled run), and every micro-batch is written into its own
``(bucket, batch_id)`` partition with dynamic overwrite, so a batch replayed after a
failure rewrites the same files instead of adding copies. A new download of
an archive should arrive under a new path; copies of a member are resolved
later by ``select_station_files`` (latest ``landed_at`` wins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentinela.plans.climate import land_files_per_bucket, land_members, spread_land
from sentinela.session import checkpoint_root
from sentinela.sources.layers import LAND, commits, layer_path

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


STAGED_SCHEMA = "archive string, length bigint, content binary"


def archive_stream(
    spark: SparkSession,
    archive_dir: str,
    glob: str = "*.zip",
    max_files: int | None = None,
    staged: bool = False,
) -> DataFrame:
    """New archives as a stream: zip files in a folder (``binaryFile``), or
    with ``staged`` a parquet folder of ``(archive, length, content)`` rows that a
    downloader appends to."""
    reader = spark.readStream
    if staged:
        reader = reader.format("parquet").schema(STAGED_SCHEMA)
    else:
        reader = (
            reader.format("binaryFile")
            .schema(BINARY_FILE_SCHEMA)
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
        )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(archive_dir)


def land_archives(
    spark: SparkSession,
    archive_dir: str,
    base: str,
    name: str = "climaticas",
    checkpoint: str | None = None,
    name_pattern: str | None = None,
    max_files: int | None = None,
    available_now: bool = True,
    staged: bool = False,
) -> StreamingQuery:
    """Start the landing stream; returns the running query."""
    target = layer_path(base, LAND, name)
    if commits(spark, base, LAND, name) is not None:
        raise ValueError(f"{target} is written by batch runs: a stream's rows beside its log would not be read")
    ckpt = checkpoint or f"{checkpoint_root(spark)}/sentinela/streams/land_{name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # sized like the batch land: from the archives' bytes; only the small
        # length column is read for that
        per_bucket = land_files_per_bucket(batch.agg(F.sum("length")).first()[0])
        members = land_members(batch, name_pattern).withColumn("batch_id", F.lit(batch_id))
        (
            spread_land(members, per_bucket)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket", "batch_id")
            .parquet(target)
        )

    writer = archive_stream(spark, archive_dir, max_files=max_files, staged=staged).writeStream.foreachBatch(write_batch)
    writer = writer.option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
