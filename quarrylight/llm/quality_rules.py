"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

One pass over the texts measures each document; the measures, a few numbers a row, are written once. Every rule votes
good (1), bad (-1) or abstains (0) on them. The corpus is then reduced to the counts of its vote patterns (at most
3 ** rules rows, whatever its size), on which EM estimates the share of good documents and, for either class, how
often each rule gives each vote. The posterior probability of being good replaces the demand that all rules pass. A rule
is held to be no worse than chance, so that the classes can't trade places.

Words are runs of characters other than space, tab, newline, VT, FF and CR. Cases: a null text has no words; a text under 50
words fails the base. Documents on which all rules abstain get the share of good ones. Ties (posterior equal to
the bar) are kept. Repeated rows count as often as they stand. An empty table gives an empty one. Other columns
pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import STOP_WORDS, documents, materialize

STOPS = frozenset(w.encode() for line in STOP_WORDS for w in line.split())
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_bangs", "n_ends", "n_stops", "n_distinct")
SYMBOLS = [ord(c) for c in "#*$%&|<>"]
BLANK_CODES = [9, 10, 11, 12, 13, 32]


def repeated_words(ids: np.ndarray) -> int:
    """How many words stand in a three-word window that is found twice or more."""
    if len(ids) < 4:
        return 0
    m = int(ids.max()) + 1
    pairs = ids[:-1] * m + ids[1:]
    if m >= 1 << 20:  # keeps the product within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, count = np.unique(pairs[:-1] * m + ids[2:], return_inverse=True, return_counts=True)
    twice = count[at] > 1
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[k : k + len(twice)] |= twice
    return int(hit.sum())


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at just these six blanks
    lines = [x for x in raw.split(b"\n") if x.strip()]
    counts = np.zeros(256, np.int64)
    ends = 0
    for i in range(0, len(raw), 1 << 20):
        part = np.frombuffer(raw, np.uint8, min(1 << 20, len(raw) - i), i)
        counts += np.bincount(part, minlength=256)
    for mark in (b". ", b".\n", b"? ", b"! "):
        ends += raw.count(mark)
    ends += raw.rstrip()[-1:] in (b".", b"?", b"!")
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    stops = np.fromiter((w.strip(b".,;:!?").lower() in STOPS for w in codes), bool, len(codes))
    return (
        len(words), len(text) - int(counts[BLANK_CODES].sum()), int(counts[SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(ids),
        len(lines), int(counts[65:91].sum()), int(counts[97:123].sum()), int(counts[33]), ends, int(stops[ids].sum()) if len(ids) else 0, len(codes),
    )


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with MEASURES (long) in place of text_col."""
    fields = [f for f in docs.schema.fields if f.name != text_col and f.name not in MEASURES]

    def work(batches):
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(len(fields))]
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(fields)], *columns], [*(f.name for f in fields), *MEASURES])

    kept = docs.select(*[F.col(f"`{f.name}`") for f in fields], F.col(f"`{text_col}`"))
    return kept.mapInArrow(work, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"{m} bigint" for m in MEASURES)]))


def _per(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def rules() -> dict[str, Column]:
    """The votes, by name, as expressions over MEASURES."""

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    letters = F.col("n_upper") + F.col("n_lower")
    caps = F.col("n_upper") / F.greatest(letters, F.lit(1))
    mean = _per("word_chars", "n_words")
    return {
        "symbols": vote(_per("n_symbols", "n_words") > 0.2, _per("n_symbols", "n_words") < 0.02),
        "symbol_share": vote(_per("n_symbols", "word_chars") > 0.05, F.col("n_symbols") == 0),
        "dup_lines": vote((_per("n_dup_lines", "n_lines") > 0.4) & (F.col("n_lines") > 4), (F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2)),
        "repeats": vote(_per("n_repeat_words", "n_words") > 0.4, _per("n_repeat_words", "n_words") < 0.15),
        "word_length": vote((mean < 2.5) | (mean > 14), (mean > 3.5) & (mean < 10)),
        "capitals": vote((caps > 0.5) & (letters > 20), (caps < 0.2) & (letters > 20)),
        "bangs": vote(_per("n_bangs", "n_words") > 0.3, F.when(_per("n_bangs", "n_words") < 0.02, _per("n_ends", "n_words") > 0.02).otherwise(False)),
        "sentences": vote(_per("n_ends", "n_words") < 0.01, _per("n_ends", "n_words").between(0.03, 0.35)),
        "stop_words": vote(_per("n_stops", "n_words") < 0.02, _per("n_stops", "n_words") > 0.08),
        "variety": vote((_per("n_distinct", "n_words") < 0.15) & (F.col("n_words") < 2000), _per("n_distinct", "n_words") > 0.35),
    }


def fit_em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """(share of good, table[class, rule, vote + 1] of log probabilities) from distinct vote patterns and counts."""
    n, m = patterns.shape
    good = 1 / (1 + np.exp(-1.5 * patterns.sum(axis=1) - 0.5))
    share, table = 0.8, np.full((2, m, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        for v in range(3):
            table[:, :, v] = weight @ (patterns == v - 1) + 1
        table /= table.sum(axis=2, keepdims=True)
        # no worse than chance: bad documents get at least as many bad votes, good ones as many good votes
        for v, c in ((0, 0), (2, 1)):
            wrong = table[c, :, v] < table[1 - c, :, v]
            table[:, wrong, v] = table[:, wrong, v].mean(axis=0)
        table /= table.sum(axis=2, keepdims=True)
        before, share = share, float((weight[1].sum() + 4) / (counts.sum() + 5))
        log = np.log(table)
        odds = math.log(share / (1 - share)) + sum(log[1, r, patterns[:, r] + 1] - log[0, r, patterns[:, r] + 1] for r in range(m))
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if abs(share - before) < 1e-10:
            break
    return share, np.log(table)


def weak_quality(docs: DataFrame, text_col: str = "text", bar: float = 0.5) -> DataFrame:
    """docs without the text, with MEASURES, base_failed, p_quality and kept."""
    found = materialize(measured(docs, text_col), "measures")
    votes = rules()
    n = F.col("n_words")
    found = found.withColumn("base_failed", (n < 50) | (100 * F.col("n_repeat_words") > 50 * n))
    # what the base rejects needs no verdict, so it doesn't shape the two classes; at most 3 ** 10 rows
    seen = sorted(map(tuple, found.filter(~F.col("base_failed")).groupBy(*[v.alias(k) for k, v in votes.items()]).count().collect()))
    if seen:
        table = np.array(seen, np.int64)
        share, log = fit_em(table[:, :-1], table[:, -1].astype(float))
    else:
        share, log = 0.5, np.zeros((2, len(votes), 3))
    odds = F.lit(math.log(share / (1 - share)))
    for r, v in enumerate(votes.values()):
        gain = [float(log[1, r, k] - log[0, r, k]) for k in range(3)]
        odds = odds + F.when(v == -1, gain[0]).when(v == 1, gain[2]).otherwise(gain[1])
    out = found.withColumn("p_quality", 1 / (1 + F.exp(-odds)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_quality") >= bar))


def op1_quality_rules(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return weak_quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "p_quality", "kept")


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLES = {}
