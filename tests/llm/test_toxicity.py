"""Non-negative PU learning: the estimator, held-out accuracy, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentinela.llm.toxicity import ToxicityModel, class_prior, fit_pu, held_out, pu_risk, score_texts, toxicity_scores


def test_risk_is_unbiased():
    """With unlabelled = prior mixture, the corrected risk is the supervised one."""
    rng = np.random.default_rng(0)
    pos, neg, prior = rng.normal(1, 1, 40_000), rng.normal(-1, 1, 40_000), 0.3
    unl = np.r_[pos[:12_000], neg[:28_000]]
    p, n = pu_risk(pos, unl, prior)
    assert abs(p - prior * np.logaddexp(0, -pos).mean()) < 1e-9
    assert abs(n - (1 - prior) * np.logaddexp(0, neg).mean()) < 0.01


def test_separable_features_are_learnt():
    rng = random.Random(1)
    pos = [[0, *rng.sample(range(2, 30), 5)] for _ in range(200)]
    unl = [[0, *rng.sample(range(2, 30), 5)] for _ in range(60)] + [[1, *rng.sample(range(2, 30), 5)] for _ in range(540)]
    w = fit_pu(pos, unl, 30, 0.1)
    assert w[0] + w[-1] > 0 > w[1] + w[-1]


def _corpus(n):
    rng = random.Random(7)
    vocab = [a + b for a in "abcdefghij" for b in ("la", "mo", "ri", "tu")]
    out = []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = rng.choices(vocab, k=rng.randint(20, 200))
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Vile!", "nasty***", "rotten"]))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_held_out_accuracy_and_no_leak(spark):
    rows = _corpus(1200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").withColumn("score", F.lit("old"))
    labels = spark.createDataFrame([(i, x) for i, _, x in rows if i % 2] + [(None, 1), (99999, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity_scores(spark, docs, labels).withColumn("out", held_out()).collect()}
    assert len(got) == 1200
    wrong = sum((got[i].score >= 0.3) != bool(x) for i, _, x in rows if got[i].out)
    assert wrong <= 0.01 * 300
    # labels of the held-out fold change nothing
    flipped = labels.withColumn("toxic", F.when(held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity_scores(spark, docs, flipped).collect()}
    assert all(again[i] == got[i].score for i in got)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "vile " * 200_000), (None, "vile")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (3, None)], "doc_id long, toxic int")
    got = toxicity_scores(spark, docs, labels).collect()  # no positive at all
    assert len(got) == 4 and len({r.score for r in got}) == 1 and got[0].score < 0.3
    assert class_prior(labels.limit(0)) == 0.1
    assert toxicity_scores(spark, docs.limit(0), labels).count() == 0
    model = ToxicityModel({"vile": 6.0}, -3.0)
    got = {r.doc_id: r.score for r in score_texts(spark, docs, model).collect()}
    assert got[3] > 0.9 and got[None] > 0.9 and got[1] == got[2] < 0.1


@pytest.mark.parametrize("share", [0.3, 0.5])
def test_large_toxic_share(spark, share):
    """Words of toxic texts are features whatever the share of these is."""
    rng = random.Random(5)
    vocab = [a + b for a in "abcdefghij" for b in ("la", "mo", "ri", "tu")]
    rows = []
    for i in range(1000):
        toxic = rng.random() < share
        words = rng.choices(vocab, k=rng.randint(20, 60))
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Vile!", "nasty***", "rotten"]))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows if i % 2], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity_scores(spark, docs, labels).collect()}
    assert sum((got[i] >= 0.3) != bool(x) for i, _, x in rows) <= 20
