"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, other texts are unlabelled: the risk of
"not toxic" is taken over all unlabelled texts and corrected by the class prior,
and held at zero or above (non-negative estimator). The classifier is logistic
over the presence of words and word beginnings; it is trained with numpy on a bounded sample and
scores every whole text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from sentinela.llm.common import add_columns, written

#: Bounds of the fit: texts of either kind, and words kept as features.
MAX_POSITIVE, MAX_UNLABELLED, MAX_WORDS = 4_000, 8_000, 2_048

#: A word is a feature if its share among toxic texts is above that among the unlabelled
#: by so many standard errors, and by this factor above that among the texts that are not
#: toxic (the unlabelled without the prior's share of toxic ones).
MIN_Z, MIN_LIFT = 5.0, 4.0

_WORDS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> set[str]:
    """A text's words, and the beginnings of the longer ones."""
    words = set() if text is None else set(_WORDS(text.lower()))
    return words | {w[:4] + "*" for w in words if len(w) > 4}


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def pu_risk(f_pos: np.ndarray, f_unl: np.ndarray, prior: float) -> tuple[float, float]:
    """(prior x positive risk, corrected negative risk) with the logistic loss."""
    positive = prior * _softplus(-f_pos).mean()
    negative = _softplus(f_unl).mean() - prior * _softplus(f_pos).mean()
    return float(positive), float(negative)


def fit_pu(
    positives: list[list[int]],
    unlabelled: list[list[int]],
    n_features: int,
    prior: float,
    steps: int = 600,
    rate: float = 0.05,
    decay: float = 3e-5,
) -> np.ndarray:
    """Weights (bias last) by Adam on the non-negative risk of all rows. Where the
    corrected negative risk falls below zero, the step ascends it instead."""

    def matrix(rows: list[list[int]]) -> np.ndarray:
        x = np.zeros((len(rows), n_features + 1), np.float32)
        x[:, -1] = 1
        for i, r in enumerate(rows):
            x[i, r] = 1
        return x

    p, u = matrix(positives), matrix(unlabelled)
    w = np.zeros(n_features + 1, np.float32)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        fp, fu = p @ w, u @ w
        _, negative = pu_risk(fp, fu, prior)
        g = u.T @ _sigmoid(fu) / len(fu) - prior * (p.T @ _sigmoid(fp)) / len(fp)
        if negative >= 0:
            g = g - prior * (p.T @ _sigmoid(-fp)) / len(fp)
        else:
            g = -g
        g = g + decay * np.r_[w[:-1], 0.0]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = (w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return w


@dataclass
class ToxicityModel:
    """``weights`` by word, and the bias; ``prior`` is what it was trained with."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    prior: float = 0.0

    def score(self, text: str | None) -> float:
        get = self.weights.get
        return float(_sigmoid(self.bias + sum(get(w, 0.0) for w in words_of(text))))


def fit_toxicity(
    spark: SparkSession,
    docs: DataFrame,
    positive_ids: DataFrame,
    prior: float,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    max_words: int = MAX_WORDS,
    min_texts: int = 4,
    min_z: float = MIN_Z,
    min_lift: float = MIN_LIFT,
) -> ToxicityModel:
    """Train on ``docs`` (doc_id, text): rows whose id is in ``positive_ids``
    (doc_id) are confirmed toxic, all rows are unlabelled text.

    Equal texts count once, as copies would distort the prior. Both samples are
    the texts with the smallest hashes, at most ``max_positive`` and
    ``max_unlabelled`` of them: the fit's cost does not grow with the corpus.
    Without a positive text the model scores every text alike.
    """
    order = F.xxhash64("h", F.lit("pu sample"))
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("h"))
    texts = written(spark, texts, "pu_texts")
    toxic = positive_ids.select("doc_id").distinct()
    pos = texts.join(toxic, "doc_id", "left_semi").groupBy("h").agg(F.min("doc_id").alias("doc_id"))
    pos = pos.orderBy(order, "h").limit(max_positive).select("doc_id", F.lit(1).alias("p"))
    unl = texts.groupBy("h").agg(F.min("doc_id").alias("doc_id"))
    unl = unl.orderBy(order, "h").limit(max_unlabelled).select("doc_id", F.lit(0).alias("p"))
    # at most max_positive + max_unlabelled ids: a proven bound for the broadcast
    chosen = written(spark, pos.unionByName(unl), "pu_ids")
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}+"), F.lit(0)))
    longer = F.transform(F.filter(words, lambda w: F.length(w) > 4), lambda w: F.concat(F.substring(w, 1, 4), F.lit("*")))
    words = F.array_distinct(F.concat(words, longer))
    sample = written(
        spark, docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "p", words.alias("words")), "pu_sample"
    )
    n_pos, n_unl = (sample.where(F.col("p") == x).count() for x in (1, 0))
    if not n_pos or not n_unl:
        return ToxicityModel(prior=prior)
    share_pos, share_unl = F.sum("p") / n_pos, F.sum(1 - F.col("p")) / n_unl
    share_neg = F.greatest((share_unl - prior * share_pos) / (1.0 - prior), F.lit(0.0))
    both = F.count(F.lit(1)) / float(n_pos + n_unl)  # two-proportion test: the spread if the shares were equal
    noise = F.sqrt(both * (1.0 - both) * (1.0 / n_pos + 1.0 / n_unl))
    ranked = (
        sample.select("p", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(
            F.try_divide(share_pos - share_unl, noise).alias("z"),
            share_pos.alias("pos"), share_neg.alias("neg"), F.sum("p").alias("n"),
        )
        .where((F.col("z") >= min_z) & (F.col("n") >= min_texts) & (F.col("pos") >= min_lift * F.col("neg")))
        .orderBy(F.desc("z"), "word")
        .limit(max_words)
    )
    vocabulary = {r.word: i for i, r in enumerate(ranked.select("word").collect())}
    if not vocabulary:
        return ToxicityModel(prior=prior)
    known = F.array(*[F.lit(w) for w in vocabulary])
    rows = sample.select("p", F.array_intersect("words", known).alias("words")).collect()
    side: tuple[list, list] = ([], [])
    for r in rows:
        side[r.p].append([vocabulary[w] for w in r.words if w in vocabulary])
    w = fit_pu(side[1], side[0], len(vocabulary), prior)
    return ToxicityModel({x: float(w[i]) for x, i in vocabulary.items()}, float(w[-1]), prior)


def class_prior(labels: DataFrame, default: float = 0.1) -> float:
    """Share of toxic rows among labelled ones, kept within 0.01 and 0.9."""
    r = labels.where("toxic IS NOT NULL").agg(F.avg((F.col("toxic") == 1).cast("int")).alias("p")).first()
    return min(0.9, max(0.01, default if r.p is None else r.p))


def score_texts(
    spark: SparkSession,
    docs: DataFrame,
    model: ToxicityModel,
    text: str = "text",
    score: str = "score",
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the model's score (0 to 1) of each whole text; null and empty
    texts get the score of no words; an input column named ``score`` is replaced.
    The model goes to the tasks; its size is bounded by the fit's word limit."""
    # plain data: a broadcast stores objects of our classes by name, which workers without the package cannot load
    shared = spark.sparkContext.broadcast((model.weights, model.bias, model.prior))

    def compute(texts: list) -> list:
        one = ToxicityModel(*shared.value).score
        return [[one(t) for t in texts]]

    return add_columns(docs, text, [StructField(score, DoubleType())], compute, keep)


def held_out(doc_id="doc_id"):
    """Rows whose labels are never learnt from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def toxicity_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` from a model fitted on the training rows of
    ``labels`` (doc_id, toxic) and on the same rows' fold of ``docs``. Repeated,
    null or unmatched label rows do no harm; empty labels give one low score."""
    learn = labels.select("doc_id", "toxic").where("doc_id IS NOT NULL").where(~held_out())
    prior = class_prior(learn)
    fold = docs.select("doc_id", "text").where(~held_out())
    model = fit_toxicity(spark, fold, learn.where("toxic = 1"), prior)
    return score_texts(spark, docs, model, keep=keep)
