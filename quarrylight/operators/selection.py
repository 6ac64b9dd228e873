"""Choosing rows: windows of rows, ordinals, semi and anti filters, resumption, top-k and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import PART, running_sum, with_range


def row_window(rows: DataFrame, order: Sequence[str | Column], start: int = 1, count: int | None = None) -> DataFrame:
    """Rows start to start + count - 1 (from 1) in an order; an order that ends with a key is total.

    A limit over a sort: each task keeps so many rows, none sorts the table.
    """
    if start < 1:
        raise ValueError("start is counted from 1")
    found = rows.orderBy(*order).offset(start - 1)
    return found if count is None else found.limit(count)


def row_ordinals(rows: DataFrame, ordinal: str, wanted: Sequence[int]) -> DataFrame:
    """The rows with the wanted ordinals, each once, with request_order; a missing one raises an error."""
    asked = rows.sparkSession.createDataFrame([(n, i) for i, n in enumerate(dict.fromkeys(wanted))], f"{ordinal} bigint, request_order int")
    found = asked.join(rows, ordinal, "left")
    present = [c for c in rows.columns if c != ordinal]
    missing = F.raise_error(F.concat(F.lit("no row has ordinal "), F.col(ordinal).cast("string"))).cast("int")
    checked = F.when(F.struct(*present).isNull() if not present else F.coalesce(*[F.col(c).isNotNull() for c in present], F.lit(False)), F.col("request_order")).otherwise(missing)
    return found.withColumn("request_order", checked)


def only_keys(rows: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return rows.join(keys, on, "left_semi")


def without_keys(rows: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return rows.join(keys, on, "left_anti")


def resumable(rows: DataFrame, done: DataFrame, key: str, source: str, status: str, active: Sequence[str]) -> DataFrame:
    """The rows that still need work: no status yet from one of the active sources."""
    ready = done.filter(F.col(source).isin(*active) & (F.coalesce(F.col(status), F.lit("")) != ""))
    whole = ready.groupBy(key).agg(F.count_distinct(source).alias("__n")).filter(F.col("__n") == len(set(active)))
    return rows.join(whole, key, "left_anti")


def top(rows: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def top_per_group(rows: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first k rows of each group with their rank. Spark keeps k rows a group in each task before it shuffles."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def seeded_sample(rows: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k rows by least hash: the same in any partitioning."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(k)


def frequent_terms(rows: DataFrame, text: str, order: str, k: int, pattern: str = r"[^a-z]+", least: int = 4) -> DataFrame:
    """The k most frequent words; of equal counts the one that comes first (by row order, then place)."""
    words = rows.select(order, F.posexplode(F.split(F.lower(text), pattern)).alias("place", "term")).filter(F.char_length("term") >= least)
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order, "place")).alias("first"))
    return counts.orderBy(F.desc("n"), "first").limit(k).select("term", "n")


def ready_first(rows: DataFrame, ready: str, order: str) -> DataFrame:
    """Queue order: ready rows first, each kind first in, first out."""
    return rows.orderBy(F.desc(ready), order)


def admit(rows: DataFrame, queue: str, key: str, kind: str, order: str, size: str, total: int, per_kind: int, max_bytes: int) -> DataFrame:
    """Admission of queued documents: repeats, too large ones, then caps per kind and in all, with the outcome as status.

    Caps count candidates in order of arrival within a queue, over ranges of the order, so that a long queue is many tasks.
    """
    again = F.row_number().over(Window.partitionBy(queue, key).orderBy(order)) > 1
    rows = rows.withColumn("__out", F.when(again, "duplicate").when(F.col(size) > max_bytes, "too_large"))
    fits = F.col("__out").isNull().cast("int")
    rows = running_sum(with_range(rows, order), [queue, kind], order, fits, "__kind")
    rows = rows.withColumn("__out", F.coalesce("__out", F.when(F.col("__kind") > per_kind, "kind_cap")))
    rows = running_sum(rows, [queue], order, fits, "__all")
    return rows.withColumn("status", F.coalesce("__out", F.when(F.col("__all") > total, "total_cap"), F.lit("admitted"))).drop("__out", "__kind", "__all", PART)
