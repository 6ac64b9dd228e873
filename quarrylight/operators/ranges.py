"""Running values of a key's rows over ranges of their order, so that a key with a third of all rows is many tasks.

Rows are cut into ranges of the order column (``with_range``); each (key, range) is one window partition. What a range
needs to know of those before it comes from one summary row per (key, range), over which the windows of this module run.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import shared_folder

PART = "__part"


def with_range(rows: DataFrame, order: str, n: int | None = None) -> DataFrame:
    """rows with __part, the range of the order column (numbers, dates or times), of n of about equal count; as many as a shuffle has partitions by default.

    The cuts are approximate quantiles, so a crowded stretch of the order is cut as finely as it is crowded; equal values share a range. Finding them reads
    the order column once more: an input that is dear to make goes through ``staged`` first.
    """
    at = F.col(order).cast("timestamp").cast("double") if rows.schema[order].dataType.typeName() in ("date", "timestamp", "timestamp_ntz") else F.col(order).cast("double")
    n = n or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.percentile_approx(at, [k / n for k in range(1, n)], max(10_000, 20 * n)).alias("cuts")).first()["cuts"] if n > 1 else None
    cuts = sorted(set(found or ()))
    if not cuts:
        return rows.withColumn(PART, F.lit(0))
    step = max(1, math.isqrt(len(cuts)))
    listed = lambda values: F.from_json(F.lit(json.dumps(values)), "array<double>")
    every, tops = listed(cuts), listed(cuts[::step])
    # how many cuts are below the value, in two steps
    coarse = F.size(F.filter(tops, lambda c: c < at))
    fine = F.size(F.filter(F.slice(every, (F.col("__coarse") - 1) * step + 1, step), lambda c: c < at))
    ranged = rows.withColumn("__coarse", coarse).withColumn(PART, F.when(at.isNull(), -1).when(F.col("__coarse") == 0, 0).otherwise((F.col("__coarse") - 1) * step + fine))
    return ranged.drop("__coarse")


def staged(rows: DataFrame, name: str) -> DataFrame:
    """rows written once to the shared folder and read from there, for what reads them several times."""
    path = f"{shared_folder(rows.sparkSession, name)}/rows"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def within(key: Sequence[str], *order) -> Window:
    return Window.partitionBy(*key, PART).orderBy(*order)


def with_carry(rows: DataFrame, key: Sequence[str], summary: Mapping[str, Column], carry: Mapping[str, Column]) -> DataFrame:
    """rows with the carry columns: aggregates of each (key, range), named in summary, and over them windows of the ranges before.

    The expressions of carry may use ``over``-ready columns of summary; they are evaluated with ``earlier(key)``.
    """
    parts = rows.groupBy(*key, PART).agg(*[v.alias(k) for k, v in summary.items()])
    carried = parts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col(PART).alias("__p"), *[v.alias(k) for k, v in carry.items()])
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)]
    return rows.join(carried, [*on, F.col(PART) == F.col("__p")]).drop("__p", *[f"__k{i}" for i in range(len(key))])


def earlier(key: Sequence[str]) -> Window:
    """The ranges of a key before the row's own."""
    return Window.partitionBy(*key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def running_sum(ranged: DataFrame, key: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """Rows of with_range with the sum of value over a key's rows up to and including each in order."""
    valued = ranged.withColumn("__v", value)
    carried = with_carry(valued, key, {"__s": F.sum("__v")}, {"__before": F.coalesce(F.sum("__s").over(earlier(key)), F.lit(0))})
    own = F.sum("__v").over(within(key, order).rowsBetween(Window.unboundedPreceding, 0))
    return carried.withColumn(name, F.col("__before") + own).drop("__v", "__before")


def since_reset(rows: DataFrame, key: Sequence[str], order: str, reset: Column, counted: Mapping[str, Column], most: Mapping[str, Column] | None = None) -> DataFrame:
    """rows with, since the key's last reset, that row and this one included: how many rows met each condition counted, and the greatest of each value in most."""
    no = F.lit(False)
    ranged = with_range(rows, order).withColumn("__island", F.sum(F.coalesce(reset, no).cast("int")).over(within(key, PART, order)))
    ranged = ranged.withColumns({f"__c_{k}": F.coalesce(v, no).cast("int") for k, v in counted.items()} | {f"__c_{k}": v for k, v in (most or {}).items()})
    fold = {k: F.sum for k in counted} | {k: F.max for k in most or {}}
    # per range: how many resets it has, and what stands after its last one
    islands = ranged.groupBy(*key, PART, "__island").agg(*[f(f"__c_{k}").alias(k) for k, f in fold.items()])
    parts = islands.groupBy(*key, PART).agg(F.max("__island").alias("__resets"), *[F.max_by(k, "__island").alias(k) for k in fold])
    run = Window.partitionBy(*key).orderBy(PART)
    parts = parts.withColumn("__run", F.sum((F.col("__resets") > 0).cast("int")).over(run))
    since = Window.partitionBy(*key, "__run").orderBy(PART)
    parts = parts.withColumns({k: f(k).over(since) for k, f in fold.items()}).withColumns({k: F.lag(k).over(run) for k in fold})
    carried = parts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col(PART).alias("__p"), *[F.col(k).alias(f"__b_{k}") for k in fold])
    on = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(key)]
    joined = ranged.join(carried, [*on, F.col(PART) == F.col("__p")])
    own, before = Window.partitionBy(*key, PART, "__island").orderBy(order), lambda k: F.when(F.col("__island") == 0, F.col(f"__b_{k}"))
    made = {k: F.sum(f"__c_{k}").over(own) + F.coalesce(before(k), F.lit(0)) for k in counted}
    made |= {k: F.greatest(F.max(f"__c_{k}").over(own), before(k)) for k in most or {}}
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *[v.alias(k) for k, v in made.items()])
