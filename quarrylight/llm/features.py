"""Words, features and bounded training samples shared by the classifiers."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, materialize

LETTERS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """The word and its beginnings of three to six letters."""
    return [word, *(f"{word[:n]}*" for n in range(3, 1 + min(6, len(word))))]


def sampled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: dict, seed: int) -> DataFrame:
    """id, label and text of at most per_class[v] labelled documents of each class v, written once to the shared folder.

    A document labelled more than once has its highest label; one whose id stands in several rows gives its least text.

    The sample is chosen on ids alone; it has a proven bound (the sum of per_class), so it is broadcast to the
    one scan of the texts.
    """
    once, chosen = labels.groupBy(id_col).agg(F.max(label_col).alias(label_col)), None
    for k, (value, limit) in enumerate(sorted(per_class.items())):
        part = bounded_sample(once.filter(F.col(label_col) == value), id_col, limit, seed + k)
        chosen = part if chosen is None else chosen.unionByName(part)
    # an id that stands in many rows is one row of the sample, whatever the number
    return materialize(docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).groupBy(id_col, label_col).agg(F.min(text_col).alias(text_col)), "sample")


def byte_ngrams(text: str | None, bins: int, n: int = 3) -> np.ndarray:
    """Counts of hashed n-grams of the bytes of a text, blanks put around it, taken over slices of a long text."""
    raw = np.frombuffer(b" " + (text or "").encode() + b" ", np.uint8)
    total = np.zeros(bins, np.int64)
    for i in range(0, max(1, len(raw) - n + 1), 1 << 18):
        part = raw[i : i + (1 << 18) + n - 1].astype(np.uint32)
        h = np.zeros(max(0, len(part) - n + 1), np.uint32)
        for k in range(n):
            h = h * np.uint32(0x01000193) + part[k : len(part) - n + 1 + k]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        total += np.bincount((h >> np.uint32(11)) % np.uint32(bins), minlength=bins)
    return total
