"""Training-data pipeline over ``documents``.

Each stage takes all that its predecessor kept, is written as Parquet in the shared
folder, and is read again for the next. All stages but the last return the columns
of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.llm.common import written
from sentinela.llm.decontamination import find_contamination, is_contaminated
from sentinela.llm.packing import pack_documents
from sentinela.llm.pii import find_personal_data, redacted
from sentinela.llm.queries import CAPACITY, TOKENIZER, TOXIC
from sentinela.llm.simhash import one_of_each
from sentinela.llm.toxicity import toxicity_scores


def _shielded(docs: DataFrame) -> tuple[DataFrame, list[Column], dict[str, str]]:
    """``docs`` with all columns but ``doc_id`` and ``text`` under names that no operator uses, the
    way back to the columns of ``docs``, and the new name of each."""
    names = {c: c if c in ("doc_id", "text") else f"kept_column_{i}" for i, c in enumerate(docs.columns)}
    safe = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return safe, [F.col(n).alias(c) for c, n in names.items()], names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model fitted on this stage's input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    safe, back, _ = _shielded(docs)
    return toxicity_scores(spark, safe, labels).where(F.col("score") < TOXIC).select(*back)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash component."""
    safe, back, _ = _shielded(docs)
    return one_of_each(spark, safe).select(*back)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    safe, back, _ = _shielded(docs)
    return find_contamination(spark, safe, items, unnamed=True).where(~is_contaminated()).select(*back)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, personal data as [KIND]; ``n_chars`` follows the text."""
    safe, _, names = _shielded(docs)
    # in a projection of its own: beside a column named text, a lambda's "text" would be that one
    found = find_personal_data(spark, safe).withColumn("found", redacted(F.col("text"), F.col("spans")))
    out = {c: F.col(n) for c, n in names.items()}
    out["text"] = F.col("found")
    if "n_chars" in docs.columns:
        length = F.length("found").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.size("spans") > 0, length).otherwise(out["n_chars"])
    return found.select(*[v.alias(c) for c, v in out.items()])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(spark, docs, TOKENIZER, CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("best-fit packing", pack),
]

#: A fitted classifier, a bootstrap and a search are not SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), "stage_" + name.replace(" ", "_"))
    return docs
