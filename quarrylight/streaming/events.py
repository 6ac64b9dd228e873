"""Structured Streaming over event logs: statistics, a state machine per key, first emission, windows with late data.

Each stream has a batch twin among the timeline and rollup operators; a batch is written by its id, so that a repeat of
it after a failure replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.timeline import BREAKER_SECONDS, BREAKER_STEPS, CHALLENGE_SECONDS, GATE_SECONDS
from ..sources.workspace import shared_folder


def read_events(spark: SparkSession, path: str, kind: str = "parquet", max_files: int = 16) -> DataFrame:
    """A stream of files; how many a batch takes bounds its size."""
    landed = spark.read.format(kind).load(path)
    stream = spark.readStream.format(kind).schema(landed.schema).option("maxFilesPerTrigger", max_files)
    folder, _, name = path.rstrip("/").rpartition("/")
    if [f.rpartition("/")[2] for f in landed.inputFiles()] == [name]:  # a stream reads folders; a single file is picked from its own
        return stream.option("pathGlobFilter", name).load(folder)
    return stream.load(path)


def valid_messages(events: DataFrame, kinds: Sequence[str], required: Sequence[str]) -> DataFrame:
    """The events with every required field and a known type; the others stop the stream."""
    whole = F.col("message_type").isin(*kinds)
    for c in required:
        whole = whole & F.col(c).isNotNull()
    return events.filter(F.when(F.coalesce(whole, F.lit(False)), True).otherwise(F.raise_error(F.lit("an event lacks a field or has an unknown type")).cast("boolean")))


def run_to_table(stream: DataFrame, mode: str, name: str, keep_last: Sequence[str] = ()) -> DataFrame:
    """Runs a stream over what there is and returns its table. In complete mode the last batch is the result; in
    update mode the last row of each of keep_last by batch."""
    spark = stream.sparkSession
    path = shared_folder(spark, name)

    def save(batch: DataFrame, i: int) -> None:
        batch.withColumn("__batch", F.lit(i)).write.mode("overwrite").parquet(f"{path}/rows/b={i:09d}")

    query = stream.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.parquet(f"{path}/rows").drop("b")
    if mode == "complete":
        last = rows.agg(F.max("__batch")).first()[0]
        return rows.filter(F.col("__batch") == last).drop("__batch")
    if keep_last:
        values = [c for c in rows.columns if c not in keep_last and c != "__batch"]
        return rows.groupBy(*keep_last).agg(F.max_by(F.struct(*values), "__batch").alias("v")).select(*keep_last, "v.*")
    return rows.drop("__batch")


def host_stats(events: DataFrame, host: str, value: str) -> DataFrame:
    """Running statistics of each host."""
    return events.groupBy(host).agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum(value), 2).alias("sum_value"), F.max(value).alias("max_value"))


def circuit_state(events: DataFrame, key: str, order: str, ban: Column, challenge: Column, success: Column) -> DataFrame:
    """The mode of each key after its events so far: bans and challenges count up, a success starts over.

    The state is two counters per key. Within a batch events are taken by their order, for which a key's orders and steps (9 bytes an event) are held
    at once; how many files a batch takes bounds them. Across batches events are taken in order of arrival.
    """
    step = F.when(success, 3).when(challenge, 2).when(ban, 1).otherwise(0).cast("tinyint")
    kind = events.schema[key].dataType.simpleString()

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bans, challenges = state.get if state.exists else (0, 0)
        orders, steps = map(np.concatenate, zip(*((pdf["__order"].to_numpy(), pdf["__step"].to_numpy()) for pdf in batches), strict=True))
        steps = steps[np.argsort(orders, kind="stable")]
        won = np.nonzero(steps == 3)[0]
        if len(won):
            bans = challenges = 0
            steps = steps[won[-1] + 1 :]
        bans, challenges = bans + int((steps == 1).sum()), challenges + int((steps == 2).sum())
        state.update((bans, challenges))
        mode = "paused" if bans >= 3 or challenges >= 2 else "survival" if bans >= 2 or challenges >= 1 else "conservative" if bans else "normal"
        yield pd.DataFrame({key: [group[0]], "bans": [bans], "challenges": [challenges], "mode": [mode]})

    rows = events.select(key, F.col(order).alias("__order"), step.alias("__step"))
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, bans int, challenges int, mode string", "bans int, challenges int", "update", GroupStateTimeout.NoTimeout)


def breaker_state(events: DataFrame, key: str, order: str, at: str, block_class: Column, reason: Column) -> DataFrame:
    """The streaming twin of timeline.breaker_ledger: the state of each key's breaker after its events so far, as mode, cooldown_until and a count per class.

    The state is five counters and a time per key; order as in circuit_state.
    """
    names, kind = [*BREAKER_STEPS], events.schema[key].dataType.simpleString()
    fields = ", ".join(f"n_{c.lower()} bigint" for c in names)
    codes = {c: i for i, c in enumerate(names)} | {"AUTH_REQUIRED": names.index("SOFT_BLOCK"), "SUCCESS": -1}
    code = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        *counts, until = state.get if state.exists else [0] * len(names) + [0.0]
        columns = map(np.concatenate, zip(*((pdf["o"].to_numpy(), pdf["c"].to_numpy(), pdf["a"].to_numpy(), pdf["g"].to_numpy()) for pdf in batches), strict=True))
        orders, classes, times, gates = columns
        for i in np.argsort(orders, kind="stable"):
            c = int(classes[i])
            if c < 0:
                counts, until = [0] * len(names), 0.0
                continue
            counts[c] += 1
            if names[c] in BREAKER_SECONDS:
                wait = BREAKER_SECONDS[names[c]] * 2 ** min(counts[c] - 1, 3)
            else:
                wait = CHALLENGE_SECONDS * counts[c] if names[c] == "CHALLENGE_LOOP" else GATE_SECONDS * counts[c] * bool(gates[i])
            until = max(until, float(times[i]) + wait) if wait else until
        state.update((*counts, until))
        step = max(BREAKER_STEPS[n][min(k, 3) - 1] if k else 0 for n, k in zip(names, counts, strict=True))
        mode = ("normal", "conservative", "survival", "paused")[step]
        yield pd.DataFrame([(group[0], mode, until, *counts)], columns=[key, "mode", "cooldown_until", *(f"n_{c.lower()}" for c in names)])

    rows = events.select(key, F.col(order).alias("o"), code[block_class].alias("c"), F.col(at).cast("double").alias("a"), F.coalesce(reason == "bot_gate", F.lit(False)).alias("g")).filter("c is not null")
    return rows.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, mode string, cooldown_until double, {fields}", f"{fields}, until double", "update", GroupStateTimeout.NoTimeout)


def emit_once(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first event of each key, whatever batch repeats it."""
    return events.dropDuplicates(list(keys))


def emit_once_within(events: DataFrame, keys: Sequence[str], at: str, late: str) -> DataFrame:
    """The first event of each key, where its repeats come at most late after it in event time.

    The state of a key goes when the watermark (late behind the greatest time seen) has passed its first event by late. A repeat after that is emitted
    anew; one that is behind the watermark is left out and counted by ``late_rows``.
    """
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))


def late_rows(progress: Sequence[dict]) -> list[tuple[int, int, int]]:
    """Of each batch its id, the rows in state after it, and the rows that came behind the watermark."""
    return [(p["batchId"], sum(o["numRowsTotal"] for o in p["stateOperators"]), sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"])) for p in progress]


def windowed_counts(events: DataFrame, at: str, by: Sequence[str], window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts in tumbling windows; events later than the watermark are left out."""
    return events.withWatermark(at, late).groupBy(F.window(at, window), *by).agg(F.count(F.lit(1)).alias("n"))


def last_attempts(events: DataFrame, key: str, order: str, columns: Sequence[str], n: int = 25) -> DataFrame:
    """The last n orders of each key so far, as an array in the order of arrival: state bounded by n per key."""
    kind, value = events.schema[key].dataType.simpleString(), events.schema[order].dataType.simpleString()

    def fold(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = list(state.get[0]) if state.exists else []
        for pdf in batches:
            kept += sorted(pdf[order].tolist())
        kept = sorted(kept)[-n:]
        state.update((kept,))
        yield pd.DataFrame({key: [group[0]], "last": [kept]})

    return events.select(key, order).groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, last array<{value}>", f"last array<{value}>", "update", GroupStateTimeout.NoTimeout)
