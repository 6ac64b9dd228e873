"""Language by error-correcting output codes over hashed byte n-grams.

Each language has a codeword of bits; one binary classifier (logistic, on square roots of the shares of hashed byte
trigrams of the lower-cased text) predicts each bit. A text's margins are decoded by loss: the language whose codeword
has the least logistic loss, each bit weighted by how far its classifier is better than chance in training, wins. The
score is the share of that language among exp(-loss); ``ambiguous`` says that the runner-up's share is within
``MARGIN``. Up to 7 languages get every distinct split as a bit; more get random codewords, the best of seeded
trials by least distance.

The training sample is at most ``PER_LANG`` documents of each language and ``MAX_SAMPLE`` in all (those with the least
hash of their id; 4 KB each), so it is gathered and fitted with numpy on the driver; prediction reads every whole text
once, in any partition.

Cases: a null text or one without a letter is ``und`` with score 0. Null languages aren't learned; an id that stands
in several rows of a language gives its least text; an unlabelled
table predicts ``und`` throughout; a single language predicts that with score 1. More than ``MAX_LANGS`` languages raise
an error. Ties in the loss go to the language that sorts first. Repeated rows get equal results. An empty table gives
an empty one. Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, fold, materialize
from .features import byte_ngrams

PER_LANG, MAX_SAMPLE, MAX_LANGS, BINS, MARGIN = 1200, 12_000, 512, 2048, 0.2
KIND = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])


def codewords(n: int, seed: int = 8) -> np.ndarray:
    """(n, bits) of -1 and 1."""
    if n <= 7:
        bits = [[1 if j == 0 or not (b >> (j - 1)) & 1 else -1 for j in range(n)] for b in range(1, 1 << (n - 1))]
        return np.array(bits, int).T.reshape(n, -1)
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], (n, 10 * math.ceil(math.log2(n))))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        least = min(int((code[i] != code[i + 1 :]).sum(axis=1).min()) for i in range(n - 1))
        if least > far:
            best, far = code, least
    return best


def describe(text: str | None) -> np.ndarray:
    grams = byte_ngrams((text or "").lower(), BINS).astype(np.float32)
    return np.sqrt(grams / max(1.0, float(grams.sum())))


def language_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int) -> tuple[list[str], DataFrame]:
    """The languages, and at most per_lang rows of each, chosen on ids and languages alone."""
    usable = F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
    known = docs.filter(usable).select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"))
    counts = {r[0]: r[1] for r in known.groupBy("__lang").count().limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return [], docs
    per_lang = max(1, min(per_lang, MAX_SAMPLE // len(counts)))
    h = F.xxhash64(F.lit(8), F.col("__id"))
    # a threshold by language thins the rows to about twice the sample before any ranking
    limits = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, int(min(1.0, 2.0 * per_lang / n) * (1 << 30)) + 1)])
    thin = known.filter(F.pmod(h, F.lit(1 << 30)) < limits[F.col("__lang")]).distinct()
    chosen = thin.withColumn("__rank", F.row_number().over(Window.partitionBy("__lang").orderBy(h, "__id"))).filter(F.col("__rank") <= per_lang).drop("__rank")
    texts = docs.filter(usable).select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.col(text_col).alias("__text"))
    # at most MAX_SAMPLE ids; an id that stands in many rows of a language is one row of the sample
    return sorted(counts), materialize(texts.join(F.broadcast(chosen), ["__id", "__lang"]).groupBy("__id", "__lang").agg(F.min("__text").alias("__text")), "sample")


def fit_bits(x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.1, l2: float = 1e-5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, biases, bit weights): all bits' logistic classifiers at once, by Adam; y holds -1 and 1."""
    w = np.zeros((x.shape[1] + 1, y.shape[1]), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    x1 = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    for t in range(1, steps + 1):
        slope = -y / (1 + np.exp(np.clip(y * (x1 @ w), -30, 30))) / len(x)
        g = x1.T @ slope.astype(np.float32) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    right = ((x1 @ w > 0) == (y > 0)).mean(axis=0)
    return w[:-1], w[-1], np.maximum(right - 0.5, 0.01) * 2


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> dict:
    """The model: languages, codewords and the bits' classifiers. docs holds the rows that may be learned from."""
    langs, sample = language_sample(docs, id_col, text_col, lang_col, per_lang)
    if len(langs) < 2:
        return {"langs": langs}

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"lang": pdf["__lang"], "x": [describe(t).astype(np.float16).tobytes() for t in pdf["__text"]]})

    rows = sorted(map(tuple, sample.mapInPandas(work, "lang string, x binary").collect()))
    x = np.array([np.frombuffer(r[1], np.float16) for r in rows]).astype(np.float32)
    code = codewords(len(langs))
    at = {k: i for i, k in enumerate(langs)}
    w, b, bit = fit_bits(x, code[[at[r[0]] for r in rows]].astype(np.float32))
    return {"langs": langs, "code": code, "w": w, "b": b, "bit": bit}


def decode(margins: np.ndarray, code: np.ndarray, bit: np.ndarray) -> tuple[int, float, bool]:
    """(language, score, ambiguous) of one text's margins."""
    loss = (np.logaddexp(0, -code * margins[None, :]) * bit[None, :]).sum(axis=1)
    share = np.exp(loss.min() - loss)
    share /= share.sum()
    best = int(share.argmax())
    return best, float(share[best]), bool(share[best] - np.sort(share)[-2] < MARGIN)


def predict_language(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """docs with lang_pred, score (0 to 1) and ambiguous."""
    langs = model["langs"]

    @F.pandas_udf(KIND)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                if len(langs) < 2:
                    out.append((langs[0] if langs else "und", 1.0 if langs else 0.0, False))
                    continue
                k, score, doubt = decode(describe(t) @ model["w"] + model["b"], model["code"], model["bit"])
                out.append((langs[k], score, doubt))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "ambiguous"])

    lettered: Column = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    made = ("lang_pred", "score", "ambiguous")
    found = docs.withColumns({"__lettered": lettered, "__found": predicted(F.col(text_col))})
    columns = [F.when(F.col("__lettered"), F.col(f"__found.{c}")).otherwise(F.lit(x)).alias(c) for c, x in zip(made, ("und", 0.0, False), strict=True)]
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], *columns)


def op8_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held = fold("doc_id", 3) == 1
    model = fit_languages(docs.filter(~held).select("doc_id", "text", "lang"))
    return predict_language(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES = {"op8_language_id": op8_language_id}
ORACLES = {}
