"""Explainable scores of pages and sites: relevance, signal groups, authenticity, ladders, routes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocabulary as V


def relevance(
    url: Column, title: Column, section: Column, body: Column, leads: Mapping[str, Mapping[str, float]] = V.LEAD_KEYWORDS, identity: Mapping[str, float] = V.IDENTITY_KEYWORDS, negative: Mapping[str, float] = V.NEGATIVE_KEYWORDS, strong: Sequence[str] = (), head: int | None = None
) -> tuple[Column, Column]:
    """(score 0 to 1, label) of a page: keyword weights, section and date bonuses, minus what speaks against it, over 10.

    The whole body counts unless head limits it. Of each family and of identity the first 8 hits count. A corporate section without a strong word has .25 at most.
    Labels: likely from .7, maybe from .35.
    """
    hay = F.lower(F.concat_ws(" ", url, title, section, F.left(body, F.lit(head)) if head else body))
    total = F.lit(0.0)
    for words in leads.values():
        total = total + T.keyword_weight(hay, words, 8)
    total = total + T.keyword_weight(hay, identity, 8) * 0.5 - T.keyword_weight(hay, negative)
    total = total + F.when(section.isin("procurement", "tenders", "documents"), 1.5).when(section == "news", 0.5).otherwise(0.0)
    total = total + F.when(hay.rlike(r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}"), 0.8).otherwise(0.0)
    score = F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total / 10)), 3)
    if strong:
        none = F.size(T.keyword_hits(hay, strong)) == 0
        score = F.when(section.isin("about", "homepage", "news", "contacts") & none, F.least(score, F.lit(0.25))).otherwise(score)
    return score, F.when(score >= 0.7, "likely_relevant").when(score >= 0.35, "maybe_relevant").otherwise("not_relevant")


def lead_family(text: Column, leads: Mapping[str, Mapping[str, float]] = V.LEAD_KEYWORDS) -> Column:
    """The family with the greatest weight, of equals the first; null if none has any."""
    scores = {k: T.keyword_weight(text, w) for k, w in leads.items()}
    most = F.greatest(*scores.values()) if len(scores) > 1 else next(iter(scores.values()))
    found = F.lit(None).cast("string")
    for k in reversed(list(scores)):
        found = F.when(scores[k] == most, k).otherwise(found)
    return F.when(most > 0, found)


def signal_groups(evidence: DataFrame, key: Sequence[str], group: str, weight: str, caps: Mapping[str, float] = V.GROUP_CAPS) -> DataFrame:
    """Per key: the capped sum of each group and score = clip(.15 + positive - negative), 3 places."""
    capped = {g: F.round(F.least(F.coalesce(F.sum(F.when(F.col(group) == g, F.col(weight))), F.lit(0.0)), F.lit(cap)), 3) for g, cap in caps.items()}
    out = evidence.groupBy(*key).agg(*[c.alias(g) for g, c in capped.items()])
    total = F.lit(0.15)
    for g in caps:
        total = total - F.col(g) if g.endswith("_negative") else total + F.col(g)
    return out.withColumn("score", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)), 3))


def top_weighted(rows: DataFrame, key: Sequence[str], weight: str, tie: str, cap: float) -> DataFrame:
    """Per key the greatest weight plus .4 of the second and third, capped, 3 places."""
    w = Window.partitionBy(*key).orderBy(F.desc(weight), tie)
    ranked = rows.withColumn("__rank", F.row_number().over(w)).filter("__rank <= 3")
    part = F.when(F.col("__rank") == 1, F.col(weight)).otherwise(F.col(weight) * 0.4)
    return ranked.groupBy(*key).agg(F.round(F.least(F.lit(cap), F.sum(part)), 3).alias("score"), F.count(F.lit(1)).alias("n_used"))


def activity_verdict(score: Column, negative: Column, industrial: Column, product: Column, code: Column, generic: Column) -> Column:
    """The verdict ladder over a site's score and signal groups."""
    anchor = (industrial >= 0.14) | (code >= 0.28)
    mismatch = ((negative >= 0.55) & (score < 0.6)) | ((negative >= 0.3) & (negative >= F.greatest(F.lit(0.35), industrial + product + code - 0.1)))
    strong = (score >= 0.76) & anchor & ((product >= 0.22) | (code >= 0.28)) & (negative < 0.28)
    weak = (score >= 0.56) & (anchor | (product >= 0.18) | (code >= 0.2)) & (negative < 0.4)
    return F.when(mismatch, "mismatch").when(strong, "strong").when(weak, "weak").when((score >= 0.32) | (generic >= 0.06), "uncertain").otherwise("mismatch")


def viability(status: Column, text_length: Column, n_links: Column, has_contacts: Column, has_title: Column, dead: Column, bot_gate: Column) -> Column:
    """How much of a working site a page shows, 0 to 1."""
    num = lambda c, x: F.when(c, x).otherwise(0.0)
    total = num(status.between(200, 399), 0.2) + F.when(text_length >= 1400, 0.25).when(text_length >= 500, 0.16).when(text_length >= 220, 0.1).otherwise(0.0)
    total = total + F.when(n_links >= 10, 0.2).when(n_links >= 4, 0.12).otherwise(0.0) + num(has_contacts, 0.2) + num(has_title, 0.1) - num(dead, 0.45) - num(bot_gate, 0.2)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)), 3)


def authenticity(identity: Column, viable: Column, industrial: Column, penalty: Column) -> tuple[Column, Column]:
    """(score, status): .58 identity + .22 viability + .2 industrial - penalty; verified from .75, candidate from .55."""
    score = F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), identity * 0.58 + viable * 0.22 + industrial * 0.2 - penalty)), 3)
    return score, F.when((score >= 0.75) & (identity >= 0.52), "verified").when(score >= 0.55, "candidate").when(score >= 0.3, "suspicious").otherwise("rejected")


def needs_review(status: Column, score: Column, hard_negative: Column, inn_match: Column, email_match: Column) -> Column:
    """Whether a decision about a site goes to a reviewer: a candidate or suspicious one that neither a high score, an id on the page nor a hard negative settles."""
    open_ = status.isin("candidate", "suspicious") & (score < 0.82)
    return F.coalesce(open_ & ~(hard_negative & ~inn_match & ~email_match) & ~(inn_match & (score >= 0.62)), F.lit(False))


def record_needs_review(label: Column) -> Column:
    """Of page records only the ones in doubt go to a reviewer."""
    return F.coalesce(label == "maybe_relevant", F.lit(False))


def site_class(spa: Column, old_stack: Column, text_length: Column, n_links: Column) -> Column:
    """A to F by what a plain fetch shows."""
    return (
        F.when(spa & (text_length < 500), "D").when(spa, "C").when(old_stack, "B").when((text_length >= 1200) & (n_links >= 8), "A").when((text_length >= 350) | (n_links >= 3), "B").otherwise("F")
    )


def symptoms(tests: Mapping[str, Column]) -> Column:
    """The codes whose test holds, in their order; the first is the primary one."""
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in tests.items()]))


def route_family(rows: DataFrame, key: Sequence[str], path: Column, context: Column, families: Mapping[str, Sequence[str]]) -> DataFrame:
    """rows with family and route_score: 3.2 for each mark in the path, 2.4 in the context; strictly greater, so the first wins."""
    num = lambda c, x: F.when(c, x).otherwise(0.0)
    scores = {}
    for f, marks in families.items():
        total = F.lit(0.0)
        for m in marks:
            total = total + num(F.contains(path, F.lit(m)), 3.2) + num(F.contains(context, F.lit(m)), 2.4)
        scores[f] = F.round(total, 1)
    most = F.greatest(*scores.values())
    found = F.lit("other")
    for f in reversed(list(scores)):
        found = F.when(scores[f] == most, f).otherwise(found)
    return rows.withColumns({"route_score": most, "family": F.when(most > 0, found).otherwise("other")})


def decision_table(rows: DataFrame, table: Sequence[tuple], columns: str, on: Sequence[str]) -> DataFrame:
    """rows with the outcome of a decision table, which is broadcast: its size is that of the literal."""
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(list(table), columns)), list(on), "left")


def greedy_batches(terms: Column, cap: int) -> Column:
    """Terms of an ordered array packed into batches of at most cap characters with joining spaces; a fold, as each depends on the last."""
    start = F.array().cast("array<string>")
    size = lambda acc: F.char_length(F.element_at(acc, -1))

    def step(acc: Column, term: Column) -> Column:
        fits = (F.size(acc) > 0) & (size(acc) + 1 + F.char_length(term) <= cap)
        grown = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat_ws(" ", F.element_at(acc, -1), term)))
        return F.when(fits, grown).otherwise(F.array_append(acc, term))

    return F.aggregate(terms, start, step)


def greedy_batch_counts(rows: DataFrame, key: str, term: str, order: str, cap: int) -> DataFrame:
    """Per key the number of greedy_batches of its terms in order and the longest, without a list of the terms.

    Rows are dealt by ranges of (key, order). A range only has to know how long the open batch before it is, so it is folded from
    every length up to cap at once (from cap on, nothing fits) and gives one row; those are chained per key. A null term is a batch
    of its own.
    """
    kind = dict(rows.dtypes)[key]
    starts = cap + 1

    def fold(frames):
        open_key, at, state = None, 0, None

        def done():
            return pd.DataFrame({"k": pd.Series([open_key], dtype=object), "at": [at], "ends": [state[0].tolist()], "batches": [state[1].tolist()], "longest": [state[2].tolist()]})

        for pdf in frames:
            for k, n in zip(pdf["k"], pdf["n"], strict=True):
                k = None if pd.isna(k) else k
                if state is None or k != open_key:
                    if state is not None:
                        yield done()
                        at += 1
                    open_key, state = k, (np.arange(starts), np.zeros(starts, np.int64), np.full(starts, -1, np.int64))
                size, count, most = state
                # sizes over cap are kept as cap: nothing fits either way
                fits = (size + 1 + n <= cap) if n >= 0 else np.zeros(starts, bool)
                now = np.where(fits, size + 1 + n, n if n >= 0 else -1)
                state = (np.minimum(now, cap) if n >= 0 else np.full(starts, cap), count + ~fits, np.maximum(most, now))
        if state is not None:
            yield done()

    def chain(pdf):
        size, n, most = cap, 0, -1
        for _, r in pdf.sort_values(["part", "at"]).iterrows():
            n, most, size = n + r["batches"][size], max(most, r["longest"][size]), r["ends"][size]
        return pd.DataFrame({"k": pd.Series([pdf["k"].iloc[0]], dtype=object), "n_batches": [n], "longest": [most if most >= 0 else None]})

    lengths = rows.select(F.col(key).alias("k"), F.col(order).alias("o"), F.col(term).alias("t")).repartitionByRange("k", "o", "t").sortWithinPartitions("k", "o", "t")
    folded = lengths.select("k", F.coalesce(F.char_length("t"), F.lit(-1)).alias("n")).mapInPandas(fold, f"k {kind}, at int, ends array<int>, batches array<bigint>, longest array<bigint>")
    parts = folded.withColumn("part", F.spark_partition_id())
    return parts.groupBy("k").applyInPandas(chain, f"k {kind}, n_batches int, longest int").withColumnRenamed("k", key)
