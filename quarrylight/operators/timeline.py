"""Events in order: interval unions, last-n ledgers, signals after success, runs of errors, gaps, waits.

Running values are taken over ranges of the order (``ranges``), so that the rows of a hot key are shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import earlier, since_reset, staged, with_carry, with_range, within


def interval_union(spans: DataFrame, key: Sequence[str], start: str, end: str) -> DataFrame:
    """Per key: sum, max, union (wall clock) and overlap of spans given in seconds; touching spans merge."""
    ranged = with_range(spans.filter(F.col(end) >= F.col(start)), start)
    carried = with_carry(ranged, key, {"__most": F.max(end)}, {"__before": F.max("__most").over(earlier(key))})
    here = F.max(end).over(within(key, start, end).rowsBetween(Window.unboundedPreceding, -1))
    # a span adds what reaches beyond everything that began before it
    covered = F.greatest(F.col("__before"), here, F.col(start))
    length = F.col(end) - F.col(start)
    added = carried.withColumn("__added", F.greatest(F.lit(0.0), F.col(end) - covered))
    return added.groupBy(*key).agg(F.count(F.lit(1)).alias("n_spans"), F.sum(length).alias("sum_seconds"), F.max(length).alias("max_seconds"), F.sum("__added").alias("union_seconds")).withColumn(
        "overlap_seconds", F.greatest(F.lit(0.0), F.col("sum_seconds") - F.col("union_seconds"))
    )


def last_n(events: DataFrame, key: Sequence[str], order: str, n: int = 25) -> DataFrame:
    """The last n events of each key by arrival, with their place from the end."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return events.withColumn("from_end", F.row_number().over(w)).filter(F.col("from_end") <= n)


def recent_outcomes(events: DataFrame, key: Sequence[str], order: str, tags: Sequence[str], outcome: str, n: int = 25) -> DataFrame:
    """Of the last n events of each key, how often each outcome stands under each of the tags (a tag, a proxy), null tags left out: key, tag_name, tag, outcome, n."""
    named = F.array(*[F.struct(F.lit(t).alias("tag_name"), F.col(t).cast("string").alias("tag")) for t in tags])
    rows = last_n(events.select(*key, order, *tags, outcome), key, order, n).select(*key, F.explode(named).alias("t"), outcome)
    return rows.filter("t.tag is not null").groupBy(*key, "t.tag_name", "t.tag", outcome).agg(F.count(F.lit(1)).alias("n"))


def active_signals(events: DataFrame, key: Sequence[str], order: str, signal: Column, success: Column) -> DataFrame:
    """The signals that came after the last success of their key."""
    last = events.groupBy(*key).agg(F.max(F.when(success, F.col(order))).alias("__last"))
    # only signals meet the one row of their key
    return events.filter(signal).join(last, list(key)).filter(F.col("__last").isNull() | (F.col(order) > F.col("__last"))).select(*[F.col(f"`{c}`") for c in events.columns])


def consecutive(events: DataFrame, key: Sequence[str], order: str, failed: Column, reset: Column) -> DataFrame:
    """events with run: how many failures in a row, this one included, since the last reset."""
    return since_reset(events, key, order, reset, {"run": failed})


def since_previous(events: DataFrame, key: Sequence[str], order: str, seconds: Column) -> DataFrame:
    """events with the seconds since the previous event of the key."""
    ranged = with_range(events.withColumn("__at", seconds), order)
    carried = with_carry(ranged, key, {"__last": F.max_by("__at", order)}, {"__before": F.last("__last").over(earlier(key))})
    before = F.coalesce(F.lag("__at").over(within(key, order)), F.col("__before"))
    return carried.withColumn("since_previous", F.col("__at") - before).select(*[F.col(f"`{c}`") for c in events.columns], "since_previous")


def clock_gaps(events: DataFrame, key: Sequence[str], order: str, seconds: Column, threshold: float) -> DataFrame:
    """Gaps over the threshold, and per key the wall time, the paused and the active part."""
    spaced = since_previous(events, key, order, seconds)
    gap = F.when(F.col("since_previous") > threshold, F.col("since_previous")).otherwise(0.0)
    wall = F.max(seconds) - F.min(seconds)
    return spaced.groupBy(*key).agg(wall.alias("wall_seconds"), F.sum(gap).alias("paused_seconds"), F.count_if(F.col("since_previous") > threshold).alias("n_gaps")).withColumn("active_seconds", F.col("wall_seconds") - F.col("paused_seconds"))


def queue_depth(spans: DataFrame, key: Sequence[str], start: str, end: str) -> DataFrame:
    """Per key the most spans open at once, and the total and longest wait. Ends come before starts of the same time."""
    ends = F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")))
    points = spans.select(*key, F.explode(ends).alias("p")).select(*key, "p.*")
    # equal steps at one time are one row, so the running sum doesn't depend on their order
    points = with_range(points.groupBy(*key, "at", "step").agg(F.sum("step").alias("change")), "at")
    carried = with_carry(points, key, {"__sum": F.sum("change")}, {"__open": F.coalesce(F.sum("__sum").over(earlier(key)), F.lit(0))})
    w = within(key, "at", "step").rowsBetween(Window.unboundedPreceding, 0)
    depth = carried.withColumn("depth", F.col("__open") + F.sum("change").over(w)).groupBy(*key).agg(F.max("depth").alias("max_depth"))
    waits = spans.groupBy(*key).agg(F.sum(F.col(end) - F.col(start)).alias("total_wait"), F.max(F.col(end) - F.col(start)).alias("max_wait"))
    return depth.join(waits, list(key))


#: The step (1 conservative, 2 survival, 3 paused) that the first, second and third event of a class leads to,
#: and the seconds of cooldown, doubled with each further event up to three times; a challenge waits 300 seconds times its number.
BREAKER_STEPS = {"RATE_LIMIT": (1, 2, 2), "SHADOW_THROTTLE": (1, 2, 2), "SOFT_BLOCK": (1, 2, 2), "HARD_BAN": (1, 2, 3), "CHALLENGE_LOOP": (2, 3, 3)}
BREAKER_SECONDS = {"RATE_LIMIT": 30, "HARD_BAN": 180, "SHADOW_THROTTLE": 45}
CHALLENGE_SECONDS, GATE_SECONDS = 300, 20


def breaker_ledger(events: DataFrame, key: Sequence[str], order: str, at: str, block_class: Column, reason: Column | None = None, given: Column | None = None) -> DataFrame:
    """events with the state of their key's breaker after each: mode, cooldown_until and a count per block class since the last success.

    The mode only rises until a success resets everything: it is the highest step that any count has reached. The cooldown ends at the latest of
    the ends since the success; given (seconds) goes before the rule's own. Rows without a class change nothing and are left out.
    """
    named = F.when(block_class == "AUTH_REQUIRED", "SOFT_BLOCK").otherwise(block_class)
    known = events.withColumn("__class", named).filter(F.col("__class").isNotNull())
    names = {c: f"n_{c.lower()}" for c in BREAKER_STEPS}
    counted = since_reset(known, key, order, F.col("__class") == "SUCCESS", {n: F.col("__class") == c for c, n in names.items()})
    own = F.coalesce(*[F.when(F.col("__class") == c, F.col(n)) for c, n in names.items()])
    seconds = F.lit(None).cast("double")
    for c, base in BREAKER_SECONDS.items():
        seconds = F.when(F.col("__class") == c, base * F.pow(F.lit(2.0), F.least(own - 1, F.lit(3)))).otherwise(seconds)
    seconds = F.when(F.col("__class") == "CHALLENGE_LOOP", (CHALLENGE_SECONDS * own).cast("double")).otherwise(seconds)
    if reason is not None:
        seconds = F.coalesce(seconds, F.when((reason == "bot_gate") & (F.col("__class") != "SUCCESS"), (GATE_SECONDS * F.coalesce(own, F.lit(1))).cast("double")))
    if given is not None:
        seconds = F.when(F.col("__class") != "SUCCESS", F.coalesce(given.cast("double"), seconds))
    step = F.greatest(F.lit(0), *[F.when(F.col(n) > 0, F.get(F.array(*map(F.lit, BREAKER_STEPS[c])), F.least(F.col(n), F.lit(3)).cast("int") - 1)).otherwise(0) for c, n in names.items()])
    # read several times below
    timed = staged(counted.withColumn("__until", F.when(seconds > 0, F.col(at) + seconds)), "breaker")
    held = since_reset(timed, key, order, F.col("__class") == "SUCCESS", {}, {"cooldown_until": F.col("__until")})
    mode = F.element_at(F.array(*map(F.lit, ("normal", "conservative", "survival", "paused"))), step + 1)
    return held.withColumns({"mode": mode, "cooldown_until": F.coalesce("cooldown_until", F.lit(0.0))}).drop("__class", "__until")


def phase_waits(rows: DataFrame, key: Sequence[str], times: Sequence[str]) -> DataFrame:
    """Waits between consecutive times of a row and the longest, of equals the first."""
    pairs = list(zip(times, times[1:], strict=False))
    waits = [F.greatest(F.lit(0.0), F.col(b).cast("double") - F.col(a).cast("double")).alias(f"{a}_to_{b}") for a, b in pairs]
    out = rows.select(*key, *waits)
    names = [f"{a}_to_{b}" for a, b in pairs]
    longest = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    which = F.lit(None).cast("string")
    for n in reversed(names):
        which = F.when(F.col(n) == longest, n).otherwise(which)
    return out.withColumn("longest_phase", which)


def latest_per_key(events: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The last event of each key (last wins), with the order of its first one (first position)."""
    values = [c for c in events.columns if c not in key]
    return events.groupBy(*key).agg(F.max_by(F.struct(*values), order).alias("v"), F.min(order).alias("first_position")).select(*key, "v.*", "first_position")


def emit_once(events: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The first event of each key and fingerprint."""
    values = [c for c in events.columns if c not in key]
    return events.groupBy(*key).agg(F.min_by(F.struct(*values), order).alias("v")).select(*key, "v.*")


def circuit_modes(events: DataFrame, key: Sequence[str], order: str, ban: Column, challenge: Column, success: Column) -> DataFrame:
    """events with mode: normal, conservative, survival or paused, by bans and challenges since the last success."""
    counted = since_reset(events, key, order, success, {"__bans": ban, "__challenges": challenge})
    bans, challenges = F.col("__bans"), F.col("__challenges")
    mode = F.when((bans >= 3) | (challenges >= 2), "paused").when((bans >= 2) | (challenges >= 1), "survival").when(bans >= 1, "conservative").otherwise("normal")
    return counted.withColumn("mode", mode).drop("__bans", "__challenges")
