"""Counts, sums and summaries of run events: hosts, costs, availability, timing, delays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def host_stats(events: DataFrame, host: str, kind: str, seconds: Column, value: str, at: str) -> DataFrame:
    """Per host: first and last time, events, and count, sum, min, max and mean of positive values (4 places)."""
    v = F.when(F.col(value) > 0, F.col(value))
    return events.groupBy(host).agg(
        F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count(F.lit(1)).alias("n_events"), F.count_distinct(kind).alias("n_kinds"),
        F.count(v).alias("n_timed"), F.round(F.sum(v), 4).alias("sum_elapsed"), F.min(v).alias("min_elapsed"), F.max(v).alias("max_elapsed"), F.round(F.avg(v), 4).alias("avg_elapsed"),
    )


def merge_stats(parts: DataFrame, host: str) -> DataFrame:
    """The same statistics from partial ones: sums of counts and sums, least and greatest of the rest."""
    return parts.groupBy(host).agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("n_events").alias("n_events"), F.sum("n_timed").alias("n_timed"),
        F.round(F.sum("sum_elapsed"), 4).alias("sum_elapsed"), F.min("min_elapsed").alias("min_elapsed"), F.max("max_elapsed").alias("max_elapsed"),
    )


def counts_by(rows: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def pivot_counts(rows: DataFrame, by: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Zero-filled counts of each of the values of a column, in one pass and without asking for the values."""
    return rows.groupBy(*by).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values])


def poisoned_sums(rows: DataFrame, groups: Sequence[str], amount: str, digits: int = 8) -> DataFrame:
    """Sums by each of the groups apart, as grouping sets; a group with an unknown amount has no sum."""
    summed = rows.groupingSets([[g] for g in groups], *groups).agg(
        *[F.grouping(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.count(F.lit(1)).alias("n"), F.when(F.bool_or(F.col(amount).isNull()), None).otherwise(F.round(F.sum(amount), digits)).alias("total")
    )
    pick = lambda of: F.coalesce(*[F.when(F.col(f"__g{i}") == 0, of(g)) for i, g in enumerate(groups)])
    return summed.select(pick(F.lit).alias("grouping"), pick(lambda g: F.col(g).cast("string")).alias("value"), "n", "total")


def delay_buckets(rows: DataFrame, bucket: Column, value: str, ok: Column) -> DataFrame:
    """Per bucket: attempts, successes, median and linearly interpolated 95th percentile, 3 places."""
    return rows.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"), F.round(F.percentile(value, F.lit(0.5)), 3).alias("median"), F.round(F.percentile(value, F.lit(0.95)), 3).alias("p95")
    )


def replay_summary(rows: DataFrame, by: Sequence[str], ok: Column, cost: str) -> DataFrame:
    """Per group: tries, successes, their share (6 places), cost and cost per success (8 places)."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"), F.round(F.sum(cost), 8).alias("cost")).withColumns(
        {"success_rate": F.round(F.col("n_ok") / F.col("n"), 6), "cost_per_success": F.round(F.try_divide(F.col("cost"), F.col("n_ok")), 8)}
    )


def case_summary(rows: DataFrame, by: Sequence[str], order: str, seconds: Column, ok: Column, blocked: Column) -> DataFrame:
    """Per case: rows a minute, share of successes and the order of the first block."""
    minutes = (F.max(seconds) - F.min(seconds)) / 60
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.try_divide(F.count(F.lit(1)).cast("double"), minutes), 4).alias("rows_per_minute"), F.round(F.count_if(ok) / F.count(F.lit(1)), 6).alias("success_rate"), F.min(F.when(blocked, F.col(order))).alias("first_block")
    )


def mask_signal(masked: Column, total: Column) -> Column:
    """high from max(10, 15 % of the rows) masked, medium from one, else low."""
    return F.when(masked >= F.greatest(F.lit(10), F.floor(total * 0.15)), "high").when(masked > 0, "medium").otherwise("low")


def recommend_delay(buckets: DataFrame, delay: str, ok: str, hard: str) -> DataFrame:
    """One row: with a hard block the nearest slower clean delay; else one slower than the fastest clean; else the slowest."""
    clean = (F.col(hard) == 0) & (F.col(ok) > 0)
    worst = buckets.agg(F.max(F.when(F.col(hard) > 0, F.col(delay))).alias("worst"), F.min(F.when(clean, F.col(delay))).alias("fastest"), F.max(delay).alias("slowest"))
    after = buckets.join(F.broadcast(worst)).agg(  # one row
        F.min(F.when(clean & (F.col(delay) > F.col("worst")), F.col(delay))).alias("safe"), F.min(F.when(clean & (F.col(delay) > F.col("fastest")), F.col(delay))).alias("next"),
        F.first("worst").alias("worst"), F.first("slowest").alias("slowest"),
    )
    return after.select(F.when(F.col("worst").isNotNull(), F.coalesce("safe", "slowest")).otherwise(F.coalesce("next", "slowest")).alias("delay"))


def pressure(rows: DataFrame, by: Sequence[str], elapsed: str, cooldown: str, gap: str, limits: tuple[float, float, float] = (600.0, 3600.0, 300.0)) -> DataFrame:
    """Per group the elapsed, cooldown and longest gap, and which of them presses most."""
    a, b, c = limits
    sums = rows.groupBy(*by).agg(F.round(F.sum(elapsed), 3).alias("elapsed"), F.round(F.sum(cooldown), 3).alias("cooldown"), F.max(gap).alias("max_gap"))
    slow, cold, idle = F.col("elapsed") > a, F.col("cooldown") > b, F.col("max_gap") > c
    return sums.withColumn("pressure", F.when(slow & cold, "elapsed_and_cooldown").when(cold, "cooldown").when(slow, "elapsed").when(idle, "idle").otherwise("none"))
