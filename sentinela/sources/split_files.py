"""Delimited files of any size, read by many tasks: the rows of :func:`read_delimited`
without a file ever being one value.

Files are scanned as text, which Spark splits into blocks. What needs a file's order is
carried by small tables: the lines of a block are counted once, prefix sums over a file's
blocks (one row each) give every line its number, and the width of a file's rows comes from
the block that holds its first kept line. Lines themselves are not shuffled for that.

Line breaks inside quotes: a line with an odd number of quotes opens or closes a quoted
field. Those lines are numbered by the same two steps, within their block and over blocks,
and paired; the lines of a pair are one record, whatever blocks they lie in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentinela.fixed import STATION_ENCODING, STATION_PREAMBLE_LINES, STATION_SEPARATOR
from sentinela.session import scratch_path
from sentinela.sources.delimited import split_fields

_MOST_FIELDS = 1 << 20


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A small table that several steps read, written once."""
    path = scratch_path(spark, "split_files", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _before(col: str):
    """Sum over a file's blocks before this one."""
    window = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(col).over(window), F.lit(0))


def file_lines(
    spark: SparkSession, path: str | Sequence[str], encoding: str = STATION_ENCODING, glob: str | None = None, recursive: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(lines, blocks)`` of text files: ``file, block, line_no, line`` and one row per block
    with the number of its first line and of its last line that is not blank.

    Lines end in LF or CR LF; numbers count from 0 in each file. A line belongs to the block in
    which it begins.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # ids are consecutive in a task and a block lies in one task, so they give the place in the
    # block; both uses below plan the same scan of the same listing, so they are the same twice
    scan = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.regexp_replace(F.decode(F.col("value").cast("binary"), encoding), "\r$", "").alias("line"),
    )
    text = F.when(F.col("line") != "", F.col("id"))
    blocks = scan.groupBy("file", "block").agg(F.min("id").alias("id0"), F.count(F.lit(1)).alias("n"), F.max(text).alias("last"))
    blocks = _kept(spark, blocks, "blocks").select("file", "block", "id0", _before("n").alias("start"), "last")
    blocks = blocks.withColumn("last_text", F.col("start") + F.col("last") - F.col("id0")).drop("last")
    blocks = _kept(spark, blocks, "starts")
    lines = scan.join(blocks.select("file", "block", "id0", "start"), ["file", "block"])
    lines = lines.select("file", "block", (F.col("start") + F.col("id") - F.col("id0")).alias("line_no"), "line")
    return lines, blocks


def quoted_records(spark: SparkSession, lines: DataFrame, quote: str = '"') -> DataFrame:
    """Lines -> records ``file, block, line_no, line``: lines that a quoted field runs over are
    one record (joined by LF), at the number and block of its first line.

    A quote still open at the end of its file opens nothing: that line and those after it stay.
    """
    odd = F.length("line") - F.length(F.replace(F.col("line"), F.lit(quote), F.lit("")))
    marks = _kept(spark, lines.filter(odd / len(quote) % 2 == 1).select("file", "block", "line_no"), "marks")
    counts = marks.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("file", "block", _before("n").alias("before"))
    place = F.row_number().over(Window.partitionBy("file", "block").orderBy("line_no"))
    numbered = marks.withColumn("k", place).join(counts, ["file", "block"])
    pairs = numbered.groupBy("file", F.expr("(before + k - 1) div 2").alias("pair")).agg(
        F.min(F.struct("line_no", "block")).alias("first"), F.max("line_no").alias("end"), F.count(F.lit(1)).alias("n")
    )
    inside = pairs.filter("n = 2").select(
        "file", F.col("first.block").alias("block0"), F.col("first.line_no").alias("start"),
        F.explode(F.sequence(F.col("first.line_no"), F.col("end"))).alias("line_no"),
    )
    inside = _kept(spark, inside, "quoted")  # one row per line of such a record
    alone = lines.join(inside.select("file", "line_no"), ["file", "line_no"], "left_anti").select("file", "block", "line_no", "line")
    parts = lines.drop("block").join(inside, ["file", "line_no"]).groupBy("file", "block0", "start")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    whole = parts.agg(joined.alias("line")).select("file", F.col("block0").alias("block"), F.col("start").alias("line_no"), "line")
    return alone.unionByName(whole)


def read_delimited_files(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = STATION_SEPARATOR,
    skip_rows: int = STATION_PREAMBLE_LINES,
    encoding: str = STATION_ENCODING,
    quote: str | None = '"',
    n_fields: int | None = None,
    multiline: bool = False,
    glob: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """``file, name, line_no, fields`` of every kept row of the files under ``path``.

    As :func:`read_delimited`: the first ``skip_rows`` lines of a file are left out, blank lines
    skipped, the width taken from the first kept line (or ``n_fields``), wider lines skipped.
    With ``multiline`` a quoted field may hold line breaks.
    """
    lines, blocks = file_lines(spark, path, encoding, glob, recursive)
    kept = lines.filter(F.col("line_no") >= skip_rows)
    records = quoted_records(spark, kept, quote) if multiline and quote else kept
    records = records.filter(F.col("line") != "")
    fields = split_fields(F.col("line"), sep, quote)
    if n_fields is None:
        first = blocks.filter(F.col("last_text") >= skip_rows).groupBy("file").agg(F.min("block").alias("block"))
        size = F.size(fields)
        size = F.when(size < _MOST_FIELDS, size).otherwise(F.raise_error(F.lit("over a million fields in a line")).cast("int"))
        heads = records.join(first, ["file", "block"], "left_semi")
        # line number and width in one number: a hash aggregate
        heads = heads.groupBy("file").agg(F.min(F.col("line_no") * _MOST_FIELDS + size).alias("head"))
        widths = _kept(spark, heads, "widths").select("file", (F.col("head") % _MOST_FIELDS).alias("width"))
        records = records.join(widths, "file")
    else:
        records = records.withColumn("width", F.lit(n_fields))
    rows = records.select("file", "line_no", fields.alias("fields"), "width").filter(F.size("fields") <= F.col("width"))
    return rows.select("file", F.element_at(F.split("file", "/"), -1).alias("name"), "line_no", "fields")

