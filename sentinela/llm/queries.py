"""One registered query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.llm.collocations import COLLOCATIONS_SQL, collocations
from sentinela.llm.common import written
from sentinela.llm.decontamination import find_contamination, is_contaminated
from sentinela.llm.filter_audit import AUDIT_SQL, audit
from sentinela.llm.html_text import main_text
from sentinela.llm.ngram_quality import judge, perplexities
from sentinela.llm.packing import pack_documents
from sentinela.llm.pii import KINDS, find_personal_data, spans_text
from sentinela.llm.sharding import shard_rows
from sentinela.llm.simhash import hex_fingerprint, near_duplicate_components
from sentinela.llm.toxicity import held_out, toxicity_scores
from sentinela.llm.vptree import nearest_neighbours
from sentinela.llm.warc import page_number, read_archives, write_archives
from sentinela.llm.winnowing import neighbour_fingerprints

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 2048
TOXIC = 0.3


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, _read(spark, sf_dir, "documents"), TOKENIZER, CAPACITY)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted: documents that ``labels`` marks as of good quality."""
    trusted = _read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    scored = perplexities(spark, _read(spark, sf_dir, "documents"), trusted, keep=["doc_id", "lang"])
    return judge(written(spark, scored, "perplexity"), trusted)


def op3_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight equal shards; growth to nine."""
    text = F.col("text")
    docs = _read(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return shard_rows(docs, "doc_id", [1.0] * 8, grown_weight=1.0)


def op4_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written to the shared folder and read back by the salvage reader."""
    path = write_archives(spark, _read(spark, sf_dir, "pages"))
    records = read_archives(spark, path, with_payload=False).where("reason IS NULL")
    return records.select(
        page_number("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number("refers_to").cast("long").alias("refers_to"),
    )


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark, _read(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    scored = toxicity_scores(spark, docs, labels, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(
        spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), keep=["doc_id"], unnamed=True
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op8_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark, _read(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(100)) == 0)


def op9_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest are of the base spans, ``spans`` of all."""
    found = find_personal_data(spark, _read(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_components(spark, _read(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op11_collocation_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, _read(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op13_winnowing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_fingerprints(spark, _read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_quality_classifier,
        op3_rendezvous_sharding,
        op4_warc_salvage,
        op5_html_main_text,
        op6_toxicity,
        op7_benchmark_decontamination,
        op8_vantage_point_search,
        op9_pii_bootstrap,
        op10_simhash_near_dedup,
        op11_collocation_automata,
        op12_filter_audit,
        op13_winnowing_fingerprints,
    )
}

_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS n, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS low FROM p),
d AS (SELECT page_id, list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(x, 10 * (i // 8) + 1, 10))::UBIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::BIGINT, 1)),
    lambda a, b: a || b) AS digest FROM h)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> low THEN low END AS refers_to
FROM h JOIN d USING (page_id)
"""

_HITS_SQL = r"""
WITH item AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS words
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
place AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size),
hit AS (SELECT p.doc_id, p.i, p.size, win.item FROM (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS words
        FROM place) p JOIN win ON p.size = win.size AND p.words = win.words),
words AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS l FROM hit GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(len(l), 0) AS n_items,
       sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op4_warc_salvage": _WARC_SQL,
    "op7_benchmark_decontamination": _HITS_SQL,
    "op11_collocation_automata": COLLOCATIONS_SQL,
    "op12_filter_audit": AUDIT_SQL,
}
