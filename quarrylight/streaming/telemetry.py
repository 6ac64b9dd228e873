"""Telemetry of a run folded from its events batch by batch: hosts, costs, spans of sources and drains of stages.

Each fold makes partial rows of a batch that merge by key, so a table holds one row per key (spans: one per stretch of time without a gap) however
many events came. ``apply_batch`` folds a batch into the four tables of a ledger, in which it counts once. ``summaries`` gives what the
batch operators give of all events: ``rollups.host_stats``, ``rollups.poisoned_sums``, ``timeline.interval_union`` and ``dossiers.drain_rollup``.

Columns of events: event_id, host, kind, seconds (null or not positive: not timed), stage, model, cost (null: unknown), owner, started and
finished (null: no span), queued, began, ended (null: no drain).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranges import PART, earlier, with_range
from ..operators.rollups import poisoned_sums
from .stores import Ledger

DIGITS, SLOWEST, LEAST_HOT = 8, 3, 10_000


def host_rows(events: DataFrame) -> DataFrame:
    timed = F.when(F.col("seconds") > 0, F.col("seconds"))
    return events.filter("host is not null").groupBy("host", "kind").agg(
        F.min("event_id").alias("first_seen"), F.max("event_id").alias("last_seen"), F.count(F.lit(1)).alias("n_events"), F.count(timed).alias("n_timed"),
        F.sum(timed).alias("sum_elapsed"), F.min(timed).alias("min_elapsed"), F.max(timed).alias("max_elapsed"),
    )


def merged_hosts(rows: DataFrame, by: tuple[str, ...] = ("host", "kind")) -> DataFrame:
    least, sums, most = ("first_seen", "min_elapsed"), ("n_events", "n_timed", "sum_elapsed"), ("last_seen", "max_elapsed")
    made = {c: F.min(c) for c in least} | {c: F.sum(c) for c in sums} | {c: F.max(c) for c in most}
    return rows.groupBy(*by).agg(*[made[c].alias(c) for c in rows.columns if c in made])


def cost_rows(events: DataFrame) -> DataFrame:
    return poisoned_sums(events.filter("stage is not null"), ["stage", "model"], "cost", DIGITS)


def merged_costs(rows: DataFrame) -> DataFrame:
    """A group whose cost was unknown once stays unknown."""
    return rows.groupBy("grouping", "value").agg(F.sum("n").alias("n"), F.when(F.bool_or(F.col("total").isNull()), None).otherwise(F.round(F.sum("total"), DIGITS)).alias("total"))


def span_rows(events: DataFrame) -> DataFrame:
    length = F.col("finished") - F.col("started")
    return events.filter("finished >= started").select("owner", "started", "finished", F.lit(1).cast("bigint").alias("n"), length.alias("seconds"), length.alias("longest"))


def span_sums() -> list[Column]:
    return [F.max("finished").alias("finished"), F.sum("n").alias("n"), F.sum("seconds").alias("seconds"), F.max("longest").alias("longest")]


def stretches(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of spans merged by key to one row per stretch without a gap, in one sort of each key's rows; of equal starts the order doesn't matter."""
    w = Window.partitionBy(*key).orderBy("started")
    before = F.max("finished").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = rows.withColumn("__fresh", F.coalesce(F.col("started") > before, F.lit(True)).cast("long"))
    numbered = fresh.withColumn("__stretch", F.sum("__fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*key, "__stretch").agg(F.min("started").alias("started"), *span_sums()).drop("__stretch")


def merged_spans(rows: DataFrame, least: int = LEAST_HOT) -> DataFrame:
    """One row per owner and stretch of time that its spans cover without a gap; touching spans are one.

    An owner with more rows than a shuffle partition has on average, and than least, is hot: its spans are cut into ranges of time. Fewer owners than partitions can be.
    """
    counted = rows.groupBy("owner").agg(F.count(F.lit(1)).alias("n"))
    found = counted.agg(F.sum("n").alias("total"), F.max("n").alias("most")).first()
    bar = max(least, (found["total"] or 0) / int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if (found["most"] or 0) <= bar:
        return stretches(rows, ["owner"])
    names = [r["owner"] for r in counted.filter(F.col("n") > bar).collect()]
    hot = F.when(F.col("owner").isNull(), None in names).otherwise(F.col("owner").isin([x for x in names if x is not None]))
    return stretches(rows.filter(~hot), ["owner"]).unionByName(hot_spans(rows.filter(hot)))


def hot_spans(rows: DataFrame) -> DataFrame:
    """merged_spans for owners that are many tasks each: stretches of each range of time, the first of which may go on what earlier ranges left open."""
    once = rows.groupBy("owner", "started").agg(*span_sums())  # many spans may start at one time
    local = stretches(with_range(once, "started"), ["owner", PART])
    before = local.groupBy("owner", PART).agg(F.max("finished").alias("__most"), F.max("started").alias("__last")).withColumn("__before", F.max("__most").over(earlier(["owner"])))
    # a range with any stretch of its own leaves its last one open, as only its first ones can be others'
    own = F.coalesce(F.col("__last") > F.col("__before"), F.lit(True))
    left = before.withColumn("__open", F.max(F.when(own, F.col("__last"))).over(earlier(["owner"]))).select(F.col("owner").alias("__owner"), F.col(PART).alias("__p"), "__before", "__open")
    joined = local.join(left, F.col("owner").eqNullSafe(F.col("__owner")) & (F.col(PART) == F.col("__p")))
    begun = F.when(F.col("started") <= F.col("__before"), F.col("__open")).otherwise(F.col("started"))
    return joined.groupBy("owner", begun.alias("__begun")).agg(F.min("started").alias("started"), *span_sums()).drop("__begun")


def drain_rows(events: DataFrame) -> DataFrame:
    wait, work = F.greatest(F.lit(0), F.col("began") - F.col("queued")), F.greatest(F.lit(0), F.col("ended") - F.col("began"))
    rows = events.filter("stage is not null and queued is not null and began is not null and ended is not null")
    sums = rows.groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.sum(wait).alias("waited"), F.max(wait).alias("longest_wait"), F.sum(work).alias("worked"), F.max(work).alias("longest_work"))
    place = F.row_number().over(Window.partitionBy("stage").orderBy(F.desc(F.col("ended") - F.col("queued")), "event_id"))
    top = rows.withColumn("__k", place).filter(F.col("__k") <= SLOWEST)
    return sums.join(top.groupBy("stage").agg(F.array_sort(F.collect_list(F.struct((F.col("queued") - F.col("ended")).alias("minus"), F.col("event_id").alias("item")))).alias("slowest")), "stage")


def merged_drains(rows: DataFrame) -> DataFrame:
    sums, most = ("n", "waited", "worked"), ("longest_wait", "longest_work")
    made = {c: F.sum(c) for c in sums} | {c: F.max(c) for c in most}
    slowest = F.slice(F.array_sort(F.flatten(F.collect_list("slowest"))), 1, SLOWEST)  # of at most two rows
    return rows.groupBy("stage").agg(*[(made[c] if c in made else slowest).alias(c) for c in rows.columns if c != "stage"])


FOLDS = {"hosts": (host_rows, merged_hosts), "costs": (cost_rows, merged_costs), "spans": (span_rows, merged_spans), "drains": (drain_rows, merged_drains)}


def apply_batch(ledger: Ledger, events: DataFrame, batch: int) -> bool:
    """Folds the events of a batch into the ledger's tables; False: they were in already."""
    if batch <= ledger.batch():
        return False
    events = events.persist()  # read by each fold
    try:
        return ledger.apply(batch, {name: made(events) for name, (made, _) in FOLDS.items()}, {name: merge for name, (_, merge) in FOLDS.items()})
    finally:
        events.unpersist()


def summaries(ledger: Ledger) -> dict[str, DataFrame]:
    hosts = ledger.table("hosts")
    kinds = hosts.groupBy("host").agg(F.count_distinct("kind").alias("n_kinds"))
    spans = ledger.table("spans").groupBy("owner").agg(F.sum("n").alias("n_spans"), F.sum("seconds").alias("sum_seconds"), F.max("longest").alias("max_seconds"), F.sum(F.col("finished") - F.col("started")).alias("union_seconds"))
    return {
        "hosts": merged_hosts(hosts, ("host",)).join(kinds, "host").withColumn("avg_elapsed", F.try_divide("sum_elapsed", "n_timed")),
        "costs": ledger.table("costs"),
        "spans": spans.withColumn("overlap_seconds", F.greatest(F.lit(0.0), F.col("sum_seconds") - F.col("union_seconds"))),
        "drains": ledger.table("drains").withColumn("slowest", F.transform("slowest", lambda x: x["item"])),
    }
