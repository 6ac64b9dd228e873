"""Agreement between sources: contacts that several sources give, domains they point to, and the best of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def consensus(items: DataFrame, entity: str, kind: str, key: str, source: str, value: str, order: str, masked: str | None = None) -> DataFrame:
    """One row per (entity, kind, key): how many distinct sources give it and the value of the first by order.

    Masked values don't count, but for addresses. Partial aggregation keeps a hot entity to one row per task.
    """
    if masked:
        items = items.filter(~F.coalesce(F.col(masked), F.lit(False)) | (F.col(kind) == "address"))
    items = items.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return items.groupBy(entity, kind, key).agg(F.count_distinct(source).alias("n_sources"), F.min_by(value, order).alias("sample"))


def trusted(agreed: DataFrame, entity: str, kind: str, key: str, given: DataFrame | None = None, least: int = 2) -> DataFrame:
    """Entity, kind, key, value, priority: what the input row gives first (0), then what enough sources agree on (1).

    given has the columns of the result without priority. A key keeps its first priority.
    """
    rows = agreed.filter(F.col("n_sources") >= least).select(entity, kind, key, F.col("sample").alias("value"), F.lit(1).alias("priority"))
    if given is not None:
        rows = given.select(entity, kind, key, "value", F.lit(0).alias("priority")).unionByName(rows)
    return rows.groupBy(entity, kind, key).agg(F.min_by("value", "priority").alias("value"), F.min("priority").alias("priority"))


def merge_ordered(frames: Sequence[DataFrame], key: Sequence[str], order: str) -> DataFrame:
    """The union of frames, the first of each key: earlier frames win, then the lower order."""
    tagged = [f.withColumn("__frame", F.lit(i)) for i, f in enumerate(frames)]
    whole = tagged[0]
    for f in tagged[1:]:
        whole = whole.unionByName(f, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy("__frame", order)
    return whole.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank", "__frame")


def resolve_domains(candidates: DataFrame, entity: str, domain: str, top: int = 6) -> DataFrame:
    """Ranks the domains of an entity.

    candidates has a row per hint: entity, domain, origin (input, site or email), source, url, n_tokens (words of the
    entity's name that the domain holds). Confidence adds .75 for the input, .32 for a site, .24 for an e-mail, .2 for two
    site sources, .18 for site and e-mail, .08 per token up to .16 and .08 more for the input, .99 at most.
    """
    has = lambda origin: F.bool_or(F.col("origin") == origin)
    sites = F.count_distinct(F.when(F.col("origin") == "site", F.col("source")))
    one = candidates.groupBy(entity, domain).agg(has("input").alias("by_input"), sites.alias("n_sites"), has("email").alias("by_email"), F.max("n_tokens").alias("n_tokens"), F.min("url").alias("url"))
    num = lambda c, x: F.when(c, x).otherwise(0.0)
    by_input, by_site, by_email, n = F.col("by_input"), F.col("n_sites") > 0, F.col("by_email"), F.col("n_tokens")
    total = num(by_input, 0.83) + num(by_site, 0.32) + num(by_email, 0.24) + num(F.col("n_sites") >= 2, 0.2) + num(by_site & by_email, 0.18) + F.least(F.lit(0.16), n * 0.08)
    one = one.withColumn("confidence", F.round(F.least(F.lit(0.99), total), 3))
    verified = by_input | (F.col("n_sites") >= 2) | (by_email & (n > 0) & (F.col("confidence") >= 0.55))
    rejected = ~by_input & ~by_site & (n == 0)
    one = one.withColumn("status", F.when(rejected, "rejected").when(verified, "verified").when(F.col("confidence") >= 0.28, "candidate").otherwise("rejected"))
    rank = F.when(F.col("status") == "verified", 0).when(F.col("status") == "candidate", 1).otherwise(2)
    w = Window.partitionBy(entity).orderBy(rank, F.desc("confidence"), "url")
    return one.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def best(rows: DataFrame, key: Sequence[str], order: Sequence[Column], top: int = 1) -> DataFrame:
    """The first rows of each key by a lexicographic order; the caller's last column breaks ties."""
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def pick_status(confirmed: Column, trusted_value: Column, resolved: Column, merged: Column) -> tuple[Column, Column]:
    """(value, status) of the best contact: a validated one, else trusted, else resolved, else merely merged."""
    value = F.coalesce(confirmed, trusted_value, resolved, merged)
    status = F.when(confirmed.isNotNull(), "validated").when(trusted_value.isNotNull(), "trusted").when(resolved.isNotNull(), "domain_resolution").when(merged.isNotNull(), "merged_only").otherwise("none")
    return value, status


def availability(status: Column, items: Column, absent: Column) -> Column:
    """open, masked, absent, blocked or unknown, for a field of a source with items array<struct<value, masked>>."""
    return availability_of(status, F.exists(items, lambda i: ~i["masked"]), F.size(items) > 0, absent)


def availability_of(status: Column, any_open: Column, any_item: Column, absent: Column) -> Column:
    """availability from whether there is an item that isn't masked, and any at all."""
    return F.when(any_open, "open").when(any_item, "masked").when(status.isin("blocked", "rate_limited", "bot_gate"), "blocked").when(absent, "absent").otherwise("unknown")
