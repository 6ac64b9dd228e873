"""Quality from positive and unlabelled texts: the non-negative unbiased risk.

Trusted positives are labelled rows of quality 1; the unlabelled set is drawn from the whole corpus, labelled or
not. With the class prior pi and the logistic loss l, a linear scorer minimises
pi * E_p[l(+)] + max(0, E_u[l(-)] - pi * E_p[l(-)]): the second part is the negatives' risk, and where it falls
under zero its gradient is turned round, which keeps the fit from explaining the unlabelled rows away. The prior is
estimated from positives and unlabelled rows alone (``estimate_prior``): a scorer of positives against unlabelled rows is fitted on one
half of the sample; on the other half, the least ratio of unlabelled to positive rows above a bar, at the bar where its
upper confidence bound is least, is the prior, as the top of the scores holds hardly any negatives. On few rows that bound is loose and the prior too
high, so where rows of quality 0 are labelled, the fitted scores are set on the scale of probabilities (``calibrate``): a rising line through the logits of
trusted positives and labelled negatives, which keeps their order. All three sets are bounded (``N_POSITIVE``, ``N_UNLABELLED``, ``N_NEGATIVE`` documents, by least hash of
the id), so they are gathered and fitted with numpy on the driver; scoring reads every whole text once, in any partition.

Features: square roots of the shares of hashed byte trigrams, and a few ratios of marks, capitals, repeats and words
per line. Cases: a null or empty text has zero features and gets the score of the bias. Without positives, every score
is the prior (one half). Labels without id, value or document are left out. Repeated rows get equal scores; an id that stands
in several rows gives its least text to the sample. An empty table gives an empty one. Other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, documents, fold
from .features import byte_ngrams
from .quality_rules import MEASURES, measure

N_POSITIVE, N_UNLABELLED, N_NEGATIVE, BINS = 3000, 5000, 1000, 512


def describe(text: str | None) -> np.ndarray:
    m = dict(zip(MEASURES, measure(text), strict=True))
    grams = byte_ngrams(text, BINS).astype(np.float64)
    words, letters = max(1, m["n_words"]), max(1, m["n_upper"] + m["n_lower"])
    style = [
        min(1, m["n_symbols"] / words), min(1, m["n_bangs"] / words), m["n_upper"] / letters, m["n_repeat_words"] / words, m["n_dup_lines"] / max(1, m["n_lines"]),
        min(1, 5 * m["n_ends"] / words), min(1, 3 * m["n_stops"] / words), m["n_distinct"] / words, min(1, words / 50), min(1, m["word_chars"] / words / 20),
    ]
    return np.concatenate([np.sqrt(grams / max(1, grams.sum())), style]).astype(np.float32)


N_FEATURES = BINS + 10


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def nnpu_step(x: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float, l2: float) -> tuple[float, float, np.ndarray]:
    """(positive risk with the penalty, negative risk, direction to go down) at weights x, the last of which is the bias.

    The direction is the gradient of the sum; where the negative risk is under zero, it goes up that risk instead.
    """
    z_p, z_u = positive @ x[:-1] + x[-1], unlabelled @ x[:-1] + x[-1]
    p, u = _sigmoid(z_p), _sigmoid(z_u)
    of_ones = prior * np.mean(np.logaddexp(0, -z_p)) + l2 * float(x[:-1] @ x[:-1]) / 2
    negative = np.mean(np.logaddexp(0, z_u)) - prior * np.mean(np.logaddexp(0, z_p))
    # slopes of the losses by the score: l(+) has p - 1, l(-) has p
    du, dp = u / len(u), -prior * p / len(p)
    if negative < 0:
        du, dp = -du, -dp
    else:
        dp = dp + prior * (p - 1) / len(p)
    return float(of_ones), float(negative), np.concatenate([du @ unlabelled + dp @ positive + l2 * x[:-1], [du.sum() + dp.sum()]])


def _descend(x: np.ndarray, direction, steps: int, rate: float) -> np.ndarray:
    """Adam."""
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        g = direction(x).astype(x.dtype)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        x = (x - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(x.dtype)
    return x


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 500, rate: float = 0.05, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """(weights, bias) on the whole of both samples."""
    x = np.zeros(positive.shape[1] + 1, np.float32)
    x[-1] = np.log(prior / (1 - prior))
    x = _descend(x, lambda x: nnpu_step(x, positive, unlabelled, prior, l2)[2], steps, rate)
    return x[:-1], float(x[-1])


def ratio_at_the_top(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """The prior from scores: the ratio of the shares of unlabelled and of positive rows above a bar, where its upper confidence bound is least."""
    positive, unlabelled = np.sort(positive), np.sort(unlabelled)
    above = lambda scores: 1 - np.searchsorted(scores, positive, "left") / len(scores)
    q_p, q_u = above(positive), above(unlabelled)
    slack = np.sqrt(np.log(4 / doubt) / 2) * (1 / np.sqrt(len(unlabelled)) + 1 / np.sqrt(len(positive)))
    best = int(np.argmin((q_u + slack) / q_p))
    return float(min(1 - 1e-3, max(1e-3, q_u[best] / q_p[best])))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 200, rate: float = 0.05, l2: float = 1e-3) -> float:
    """The share of positives among the unlabelled rows, from these two samples alone."""
    (p1, p2), (u1, u2) = (positive[::2], positive[1::2]), (unlabelled[::2], unlabelled[1::2])
    if not len(p2) or not len(u2):
        return 0.5

    def direction(x: np.ndarray) -> np.ndarray:
        p, u = (_sigmoid(p1 @ x[:-1] + x[-1]) - 1) / (2 * len(p1)), _sigmoid(u1 @ x[:-1] + x[-1]) / (2 * len(u1))
        return np.concatenate([p @ p1 + u @ u1 + l2 * x[:-1], [p.sum() + u.sum()]])

    x = _descend(np.zeros(positive.shape[1] + 1, np.float32), direction, steps, rate)
    return ratio_at_the_top(p2 @ x[:-1], u2 @ x[:-1])


def calibrate(positive: np.ndarray, negative: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(slope, offset) of the logistic line through the scores of labelled rows, with targets drawn in as by one more row of each kind; no change without both kinds or if it would fall."""
    if not len(positive) or not len(negative):
        return 1.0, 0.0
    z = np.concatenate([positive, negative]).astype(np.float64)
    mean, spread = float(z.mean()), float(z.std()) or 1.0
    x = np.stack([(z - mean) / spread, np.ones(len(z))], axis=1)
    t = np.concatenate([np.full(len(positive), (len(positive) + 1) / (len(positive) + 2)), np.full(len(negative), 1 / (len(negative) + 2))])
    line = np.zeros(2)
    loss = lambda v: float(np.sum(np.logaddexp(0, x @ v) - t * (x @ v)))
    for _ in range(rounds):
        p = _sigmoid(x @ line)
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), x.T @ (p - t))
        while loss(line - step) > loss(line) and np.abs(step).max() > 1e-9:
            step = step / 2
        line = line - step
    slope = line[0] / spread
    return (float(slope), float(line[1] - slope * mean)) if slope > 0 else (1.0, 0.0)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", n_positive: int = N_POSITIVE, n_unlabelled: int = N_UNLABELLED, n_negative: int = N_NEGATIVE) -> dict:
    """The model: weights, bias, prior. docs and labels hold the rows that may be learned from."""
    of = lambda value: labels.filter(F.col(id_col).isNotNull() & (F.col(label_col) == value)).select(id_col)
    trusted, refused = bounded_sample(of(1), id_col, n_positive, 41), bounded_sample(of(0), id_col, n_negative, 43)
    drawn = bounded_sample(docs.filter(F.col(id_col).isNotNull()).select(id_col), id_col, n_unlabelled, 42)
    # ids of at most n_positive + n_unlabelled + n_negative documents
    chosen = trusted.withColumn("__part", F.lit(1)).unionByName(drawn.withColumn("__part", F.lit(0))).unionByName(refused.withColumn("__part", F.lit(2)))
    sample = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).groupBy(id_col, "__part").agg(F.min(text_col).alias(text_col))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"part": pdf["__part"], "h": [zlib.crc32(str(i).encode()) for i in pdf[id_col]], "x": [describe(t).tobytes() for t in pdf[text_col]]})

    # in an order of its own, so that the halves for the prior are the same in any run
    rows = sorted(map(tuple, sample.mapInPandas(work, "part int, h bigint, x binary").collect()))
    sides = [np.array([np.frombuffer(x, np.float32) for k, _, x in rows if k == part]) for part in (0, 1, 2)]
    if not len(sides[0]) or not len(sides[1]):
        return {"weights": np.zeros(N_FEATURES, np.float32), "bias": 0.0, "prior": 0.5}
    prior = estimate_prior(sides[1], sides[0])
    w, b = fit_nnpu(sides[1], sides[0], prior)
    slope, offset = calibrate(sides[1] @ w + b, sides[2] @ w + b if len(sides[2]) else sides[2])
    return {"weights": w * np.float32(slope), "bias": b * slope + offset, "prior": prior}


def score_quality(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """docs with score, the probability of label 1."""
    w, b = model["weights"].astype(np.float64), model["bias"]

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        z = np.array([float(describe(t) @ w) + b for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn("score", score(F.col(text_col)))


def op4_quality_classifier(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held = fold("doc_id", 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held)
    scored = score_quality(docs, fit_quality(docs.filter(~held), labels))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {"op4_quality_classifier": op4_quality_classifier}
ORACLES = {}
