"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sentinela.session import scratch_path


def written(spark: SparkSession, df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts the
    lineage, and a lost executor costs no recomputation of what is written."""
    path = scratch_path(spark, "llm", name)
    schema = df.schema
    df.write.parquet(path, compression=codec)
    return spark.read.schema(schema).parquet(path)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns whose names (in any case) are in ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def add_columns(
    df: DataFrame,
    text: str,
    fields: Sequence[StructField],
    compute: Callable[[list], list[Sequence]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Append columns that are computed from one text column, batch by batch.

    ``compute`` gets the batch's texts (None for null) and returns one sequence
    per field. ``keep`` names the input columns to return (default: all); an
    input column with the name of a new one is replaced. No shuffle.
    """
    names = [f.name for f in fields]
    base = without(df if keep is None else df.select(*dict.fromkeys([*keep, text])), [n for n in names if n != text])
    kept = [c for c in base.columns if (keep is None or c in keep) and c not in names]
    out = StructType([base.schema[c] for c in kept] + list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            new = compute(batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in kept]
                + [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(new, types)],
                names=[*kept, *names],
            )

    return base.mapInArrow(run, out)
