"""Registered queries: DuckDB SQL where there is one; the pipeline stage by stage."""

import os
from collections import defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from sentinela.llm.queries import CAPACITY, ORACLE_SQL, QUERIES
from sentinela.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"  # the smallest has too few toxic labels to learn from
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _rows(df):
    clean = lambda v: None if pd.isna(v) else v.item() if hasattr(v, "item") else v
    return sorted((tuple(clean(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE_SQL[name]).df()
    assert _rows(got) == _rows(want) and len(got)


def test_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    names = ["toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "best-fit packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, LARGER).collect(), docs.schema)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "toxicity":
            gone = set(before) - set(after)
            assert gone and sum(labels.get(i) == 0 for i in gone) <= 2
        if name == "simhash near-dedup":
            fps = {i: fingerprint(r.text) for i, r in before.items()}
            near = defaultdict(set)
            for a in fps:
                for b in fps:
                    if ((fps[a] ^ fps[b]) % 2**64).bit_count() <= 3:
                        near[a].add(b)
            left, groups = set(fps), []
            while left:
                todo, group = [min(left)], set()
                while todo:
                    x = todo.pop()
                    if x not in group:
                        group.add(x)
                        todo += near[x]
                groups.append(group)
                left -= group
            assert set(after) == {min(g) for g in groups}
        if name == "pii":
            assert set(after) == set(before) and all(r.n_chars == len(r.text) for r in after.values())
            changed = [i for i in after if after[i].text != before[i].text]
            assert changed and all("[" in after[i].text for i in changed)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, LARGER).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    room = defaultdict(int)
    for r in packed:
        room[r.sequence_id] += r.length
    assert max(room.values()) <= CAPACITY


def test_stages_take_empty_tables_nulls_and_clashing_names(spark):
    extra = ["score", "_score", "spans", "items", "n_hit", "hits", "_in_hits", "found", "_in_found", "_hits_email", "_gaps_card", "rid", "root"]
    extra += ["_gone", "_fp", "fp", "component_id", "piece", "c", "kept_column_0", "kept_column_7"]
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "write to a@b.org now", "en", "s", 20), (2, "write to a@b.org now", "en", "s", 20), (3, "w " * 50_000, "en", "s", 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.lit("x").alias(c) for c in extra])
    for one in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, one, SF)
            if name != "best-fit packing":
                assert out.columns == docs.columns
            n = out.count()
            assert n == 0 if one is not docs else n > 0
            if one is docs and name == "pii":
                got = [r for r in out.collect() if r.doc_id == 2]
                assert [(r.text, r.n_chars, r.spans) for r in got] == [("write to [EMAIL] now", 20, "x")] * 2
