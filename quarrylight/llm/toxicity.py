"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(severity > k) = sigmoid(w . x - theta_k), k = 0, 1, 2: one weight vector is shared by the ordered thresholds theta.
Features are words and word beginnings; the ones kept are those whose presence goes best with the label over the
training sample (a bounded sample of labelled documents: at most ``per_class`` of each label). A word that carries any is a
mark. A text is judged by its densest passage, the ``PASSAGE`` words in a row with most marks, of equal ones the first: its value for a
feature is log(1 + words of the passage with it), and one more feature is log(1 + marks of the passage).
Labels say toxic or not. Where they have no grade of their own (``grade_col``), the grade of a toxic row is read off that rate of marks
per ``PASSAGE`` words (up to 2: grade 1, up to 5: 2, more: 3): a rate, so that a long text isn't graded up for its length.

Cases: a null or empty text, or one without letters, has no features: its severity is what the thresholds alone give.
Labels without an id, a label or a document are left out, with ``grade_col`` also those without a grade; a grade outside 0 to 3 raises an
error. A document labelled more than once has its highest label and grade. Without toxic rows to learn from nothing is toxic
(severity 0). Texts are scored whole, in one pass; repeated rows get equal results. An empty table gives an empty
one. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Remembered, documents, fold
from .features import LETTERS, sampled_texts, word_features

PER_CLASS, N_FEATURES, GRADES, STRONG, PASSAGE = {0: 6000, 1: 3000}, 2000, 3, 2.5, 50
KIND = T.StructType([T.StructField("grade", T.IntegerType()), T.StructField("expected_severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType())])


def _feature_sets(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: sorted({f for w in set(LETTERS.findall((t or "").lower())) for f in word_features(w)}))


def select_features(sample: DataFrame, text_col: str, label_col: str, n: int) -> list[tuple[str, float]]:
    """At most n features with their log-odds, by the size of the evidence (log-odds times toxic rows)."""
    sets = F.pandas_udf(_feature_sets, T.ArrayType(T.StringType()))
    totals = {r[0]: r[1] for r in sample.groupBy(label_col).count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    counts = sample.select(F.explode(sets(F.col(text_col))).alias("f"), F.col(label_col).alias("y")).groupBy("f").agg(F.sum("y").alias("c1"), F.count(F.lit(1)).alias("c"))
    odds = F.log((F.col("c1") + 0.5) / (n1 + 1.0)) - F.log((F.col("c") - F.col("c1") + 0.5) / (n0 + 1.0))
    best = counts.filter(F.col("c1") >= max(3, n1 // 100)).withColumn("odds", odds).filter(F.col("odds") > STRONG).orderBy(F.desc(F.col("odds") * F.col("c1")), "f").limit(n)
    return [(r["f"], r["odds"]) for r in best.collect()]


class Scorer:
    """The feature values of a text's densest passage, and its marks."""

    def __init__(self, features: list[tuple[str, float]]):
        at = {f: i for i, (f, _) in enumerate(features)}

        def of(word: str) -> tuple:
            return tuple(at[f] for f in word_features(word) if f in at)

        self.words, self.n = Remembered(of, 150_000, 64), len(features)

    def values(self, text: str | None) -> tuple[dict[int, float], int]:
        self.words.trim()
        marks = [(at, ids) for at, ids in enumerate(map(self.words.__getitem__, LETTERS.findall((text or "").lower()))) if ids]
        if not marks:
            return {}, 0
        first = start = most = 0
        for end, (at, _) in enumerate(marks):
            while at - marks[start][0] >= PASSAGE:
                start += 1
            if end - start + 1 > most:
                first, most = start, end - start + 1
        found: dict[int, int] = {}
        for _, ids in marks[first : first + most]:
            for i in ids:
                found[i] = found.get(i, 0) + 1
        return {i: math.log1p(c) for i, c in found.items()} | {self.n: math.log1p(most)}, most


def ordinal_loss(x: np.ndarray, n_features: int, at: np.ndarray, idx: np.ndarray, val: np.ndarray, grades: np.ndarray, each: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """The cumulative-link loss and its gradient by x: weights, first threshold, logs of the gaps, so that the thresholds stay ordered."""
    w, theta = x[:n_features], x[n_features] + np.concatenate([[0], np.cumsum(np.exp(x[n_features + 1 :]))])
    z = np.bincount(at, w[idx] * val, len(grades))[:, None] - theta[None, :]
    # likelihood of the grade: P(y > k-1) - P(y > k); its gradient through the two cumulative terms
    s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    p = np.concatenate([np.ones((len(grades), 1)), s, np.zeros((len(grades), 1))], axis=1)
    like = np.maximum(np.take_along_axis(p, grades[:, None], 1) - np.take_along_axis(p, grades[:, None] + 1, 1), 1e-9)[:, 0]
    slope = s * (1 - s)
    g = np.zeros_like(z)
    for k in range(GRADES):
        g[:, k] = ((grades == k + 1).astype(float) - (grades == k).astype(float)) * slope[:, k] / like
    g = -g * each[:, None]
    gw = np.bincount(idx, (g.sum(axis=1))[at] * val, n_features) + l2 * w
    gt = -g.sum(axis=0)
    grad = np.concatenate([gw, [gt.sum()], [gt[k:].sum() * np.exp(x[n_features + k]) for k in range(1, GRADES)]])
    return float(-(each * np.log(like)).sum() + l2 * (w @ w) / 2), grad


def fit_ordinal(rows: list[dict[int, float]], grades: np.ndarray, n_features: int, steps: int = 400, rate: float = 0.1, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by gradient descent with Adam on the cumulative-link likelihood."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    idx = np.array([i for r in rows for i in r], int)
    val = np.array([v for r in rows for v in r.values()], float)
    x = np.concatenate([np.zeros(n_features), [1.0], np.zeros(GRADES - 1)])
    m, v = np.zeros_like(x), np.zeros_like(x)
    each = np.full(len(rows), 1 / max(1, len(rows)))
    for t in range(1, steps + 1):
        grad = ordinal_loss(x, n_features, at, idx, val, grades, each, l2)[1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        x = x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x[:n_features], x[n_features] + np.concatenate([[0], np.cumsum(np.exp(x[n_features + 1 :]))])


def grades_of_marks(toxic: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """0 for clean rows; for toxic ones 1, 2 or 3 by the marks of their densest passage: up to 2, up to 5, more."""
    return np.where(toxic, 1 + (marks > 2) + (marks > 5), 0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", grade_col: str | None = None, per_class: dict = PER_CLASS) -> dict:
    """The model, a dict of plain values: features, weights, thresholds."""
    given = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if grade_col:
        given = given.filter(F.col(grade_col).isNotNull())
        span = given.agg(F.min(grade_col), F.max(grade_col)).first()
        if span[0] is not None and not 0 <= span[0] <= span[1] <= GRADES:
            raise ValueError(f"grades must lie between 0 and {GRADES}")
    keep = given.select(id_col, F.col(label_col).cast("int").alias(label_col))
    sample = sampled_texts(docs, keep, id_col, text_col, label_col, per_class, seed=9)
    features = select_features(sample, text_col, label_col, N_FEATURES)
    if not features:
        return {"features": [], "weights": [], "thresholds": [math.inf] * GRADES}
    graded = sample.withColumn("__grade", F.lit(-1))
    if grade_col:
        # as many rows as the sample has ids, at most
        known = given.groupBy(id_col).agg(F.max(F.col(grade_col).cast("int")).alias("__grade"))
        graded = sample.join(known, id_col)

    def describe(batches):
        scorer = Scorer(features)
        for pdf in batches:
            values = [scorer.values(t) for t in pdf[text_col]]
            yield pd.DataFrame({
                "toxic": pdf[label_col], "grade": pdf["__grade"], "marks": [m for _, m in values],
                "i": [sorted(v) for v, _ in values], "v": [[v[i] for i in sorted(v)] for v, _ in values],
            })

    # sorted: a sum in another order would give other weights
    rows = sorted(map(tuple, graded.select(text_col, label_col, "__grade").mapInPandas(describe, "toxic int, grade int, marks int, i array<int>, v array<double>").collect()))
    toxic, grade, marks = np.array([r[0] == 1 for r in rows]), np.array([r[1] for r in rows], int), np.array([r[2] for r in rows])
    w, theta = fit_ordinal([dict(zip(i, v, strict=True)) for *_, i, v in rows], grade if grade_col else grades_of_marks(toxic, marks), len(features) + 1)
    return {"features": features, "weights": w.tolist(), "thresholds": theta.tolist()}


def score_toxicity(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """docs with grade (the likeliest of 0 to 3), expected_severity (0 to 3), p_toxic and toxic (p_toxic >= 0.5)."""
    w, theta = model["weights"], model["thresholds"]

    def score(scorer: Scorer, text: str | None) -> tuple:
        z = math.fsum(w[i] * v for i, v in scorer.values(text)[0].items())
        p = [1 / (1 + math.exp(min(700, k - z))) for k in theta]
        each = [a - b for a, b in zip([1.0, *p], [*p, 0.0], strict=True)]
        return max(range(GRADES + 1), key=lambda k: each[k]), math.fsum(p), p[0]

    @F.pandas_udf(KIND)
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model["features"])
        for texts in batches:
            yield pd.DataFrame([score(scorer, t) for t in texts], columns=["grade", "expected_severity", "p_toxic"])

    made = ("grade", "expected_severity", "p_toxic", "toxic")
    found = docs.withColumn("__toxicity", scored(F.col(text_col)))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], "__toxicity.*", (F.col("__toxicity.p_toxic") >= 0.5).alias("toxic"))


def op9_toxicity(spark, sf_dir):
    """Learns from the labelled documents outside fold 0 of 5 and grades every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 5) != 0)
    return score_toxicity(docs, fit_toxicity(docs, labels)).drop("text").withColumn("held_out", fold("doc_id", 5) == 0)


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES = {}
