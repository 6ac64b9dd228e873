"""Mixing sources to target weights by temperature. DataFrame functions only.

Token shares p of the sources become weights q in proportion to p ** alpha. The exponent is bisected on the driver
over one number per source to the least exponent (the flattest mix) at which no source is repeated more often than a limit
and, where a target is given, the entropy of q isn't above it. Limits that no exponent meets are an error. The token budget is given, or is the least with which
each document is seen at least once (``cover``: no document is lost, small sources are repeated).

Each source's budget is realised as passes over blocks: its documents are dealt to blocks of about ``BLOCK_DOCS``
by hash, every pass puts the blocks in another order and the documents of a block in another order, and the last
pass ends where the budget does. Positions come from two running sums, over the documents of a block and
over the block totals of a source, so that a source with a third of all rows is never one task. ``slot`` (the part of
its source's budget before a row) orders the rows of all sources into one even mix.

Cases: rows without an id are dealt by their text. A null source is a source of its own. Null or empty texts have no tokens and go with their block. A source
without tokens has no weight; its rows are kept once. Repeated rows (same id, source and text) are one unit, placed
together. Ties in a hash are ordered by id. An empty table gives an empty one. Other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents

BLOCK_DOCS, MAX_SOURCES, MAX_REPEAT, SEED = 2048, 100_000, 2.0, "mix"


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weights(tokens: list[int], alpha: float) -> list[float]:
    raw = [(t / max(tokens)) ** alpha for t in tokens]
    return [x / math.fsum(raw) for x in raw]


def entropy(q: list[float]) -> float:
    return -math.fsum(x * math.log(x) for x in q if x > 0)


def cover_budget(tokens: list[int], q: list[float]) -> float:
    return max(t / x for t, x in zip(tokens, q, strict=True))


def bisect_alpha(tokens: list[int], max_repeat: float | None = None, target_entropy: float | None = None, budget: float | None = None, low: float = 0.0, high: float = 1.0) -> float:
    """The least exponent in [low, high] that meets both limits, each where given; budget None: cover. An error if high doesn't."""

    def flat_enough(alpha: float, slack: float = 0.0) -> bool:
        q = weights(tokens, alpha)
        if target_entropy is not None and entropy(q) > target_entropy + slack:
            return False
        total = cover_budget(tokens, q) if budget is None else budget
        return max_repeat is None or max(x * total / t for t, x in zip(tokens, q, strict=True)) <= max_repeat + slack

    if not tokens or flat_enough(low):
        return low
    if not flat_enough(high, 1e-9):  # for rounding
        raise ValueError(f"no exponent up to {high} meets the limits: repeats {max_repeat}, entropy {target_entropy}, budget {budget}")
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if flat_enough(mid) else (mid, high)
    return high


def source_quotas(units: DataFrame, max_repeat: float | None, target_entropy: float | None, budget: float | None) -> list[tuple]:
    """(source, tokens, quota, share, blocks) per source: a list bounded by MAX_SOURCES, checked."""
    rows = units.groupBy("__source").agg(F.sum("__tokens").alias("t"), F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    some = sorted((r for r in rows if r["t"]), key=lambda r: (r["t"], r["__source"]))
    tokens = [r["t"] for r in some]
    q = weights(tokens, bisect_alpha(tokens, max_repeat, target_entropy, budget)) if tokens else []
    total = (cover_budget(tokens, q) if budget is None else budget) if tokens else 0
    blocks = lambda r: -(-r["n"] // BLOCK_DOCS)
    found = [(r["__source"], r["t"], round(x * total), x, blocks(r)) for r, x in zip(some, q, strict=True)]
    return found + [(r["__source"], 0, 0, 0.0, blocks(r)) for r in rows if not r["t"]]


def hashed(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]).cast("binary"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeat: float | None = MAX_REPEAT, target_entropy: float | None = None, budget: float | None = None) -> DataFrame:
    """One row per document and pass: __id, __source, __t (hash of the text), __tokens, epoch, block, slot, target_share."""
    source = F.coalesce(F.col(source_col).cast("string"), F.lit("\x00"))
    units = docs.select(F.col(id_col).alias("__id"), source.alias("__source"), F.xxhash64(text_col).alias("__t"), n_tokens(F.col(text_col)).alias("__tokens")).groupBy("__id", "__source", "__t").agg(F.sum("__tokens").alias("__tokens"))
    quotas = docs.sparkSession.createDataFrame(source_quotas(units, max_repeat, target_entropy, budget), "__source string, __total bigint, __quota bigint, target_share double, __blocks bigint")
    # at most MAX_SOURCES rows of five fields
    tied = units.join(F.broadcast(quotas), "__source")
    passes = F.when(F.col("__total") == 0, 1).otherwise(F.ceil(F.col("__quota") / F.greatest(F.col("__total"), F.lit(1))))
    name = F.coalesce(F.col("__id").cast("string"), F.concat(F.lit("t"), F.col("__t").cast("string")))
    block = F.conv(F.substring(hashed(SEED, name, F.lit("b")), 1, 8), 16, 10).cast("long") % F.col("__blocks")
    rows = tied.withColumn("block", block).withColumn("epoch", F.explode(F.sequence(F.lit(0), passes.cast("int") - 1)))
    rows = rows.withColumn("__order", hashed(SEED, F.col("epoch"), name))
    totals = rows.groupBy("__source", "epoch", "block").agg(F.sum("__tokens").alias("__sum"))
    before = Window.partitionBy("__source", "epoch").orderBy(hashed(SEED, F.col("epoch"), F.col("block")), "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0))).select(F.col("__source").alias("__s"), F.col("epoch").alias("__e"), F.col("block").alias("__b"), "__start")
    within = Window.partitionBy("__source", "epoch", "block").orderBy("__order", "__id", "__t").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__in", F.coalesce(F.sum("__tokens").over(within), F.lit(0)))
    placed = placed.join(starts, (F.col("__source") == F.col("__s")) & (F.col("epoch") == F.col("__e")) & (F.col("block") == F.col("__b")))
    done = F.col("epoch") * F.col("__total") + F.col("__start") + F.col("__in")
    kept = (F.col("epoch") == 0) & (F.col("__total") == 0) | (done < F.col("__quota")) | ((F.col("epoch") + 1) * F.col("__total") <= F.col("__quota"))
    slot = F.when(F.col("__quota") > 0, done / F.greatest(F.col("__quota"), F.lit(1))).otherwise(F.lit(0.0))
    return placed.withColumn("__done", done).filter(kept).select("__id", "__source", "__t", "__tokens", "epoch", "block", slot.alias("slot"), "target_share")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **target) -> DataFrame:
    """The rows of docs, each as often as its place in the mix says."""
    plan = mix_plan(docs, id_col, text_col, source_col, **target).groupBy("__id", "__source", "__t").agg(F.count(F.lit(1)).cast("int").alias("__copies"))
    keyed = docs.withColumns({"__i": F.col(id_col), "__x": F.xxhash64(text_col), "__y": F.coalesce(F.col(source_col).cast("string"), F.lit("\x00"))})
    joined = keyed.join(plan, F.col("__i").eqNullSafe(F.col("__id")) & (F.col("__x") == F.col("__t")) & (F.col("__y") == F.col("__source")))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_mixing(spark, sf_dir):
    plan = mix_plan(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return plan.select(F.col("__id").alias("doc_id"), F.when(F.col("__source") != "\x00", F.col("__source")).alias("source"), F.col("__tokens").alias("n_tokens"), "epoch", "block", "slot", F.round("target_share", 9).alias("target_share"))


OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents),
s AS (SELECT source, sum(n)::BIGINT AS t, ceil(count(*) / 2048)::BIGINT AS blocks FROM d GROUP BY source),
m AS (SELECT min(t)::DOUBLE AS lo, max(t)::DOUBLE AS hi FROM s),
bisect AS (SELECT 0 AS i, 0.0::DOUBLE AS a, 1.0::DOUBLE AS b FROM m
  UNION ALL SELECT i + 1, CASE WHEN pow(lo / hi, (a + b) / 2 - 1) <= 2.0 THEN a ELSE (a + b) / 2 END,
                   CASE WHEN pow(lo / hi, (a + b) / 2 - 1) <= 2.0 THEN (a + b) / 2 ELSE b END FROM bisect, m WHERE i < 60),
alpha AS (SELECT CASE WHEN pow(lo / hi, -1) <= 2.0 THEN 0.0 ELSE b END AS alpha FROM bisect, m WHERE i = 60),
q AS (SELECT source, t, blocks, round(pow(t / hi, alpha) * hi)::BIGINT AS quota, pow(t / hi, alpha) / sum(pow(t / hi, alpha)) OVER () AS share FROM s, m, alpha),
r AS (SELECT d.*, q.t, q.quota, q.share, ('0x' || substr(md5('mix:' || doc_id || ':b'), 1, 8))::BIGINT % blocks AS block,
             unnest(range(ceil(quota / t)::BIGINT)) AS epoch FROM d JOIN q USING (source)),
b AS (SELECT source, epoch, block, coalesce(sum(sum(n)) OVER (PARTITION BY source, epoch ORDER BY md5('mix:' || epoch || ':' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM r GROUP BY source, epoch, block),
p AS (SELECT r.*, epoch * t + start + coalesce(sum(n) OVER (PARTITION BY source, epoch, block ORDER BY md5('mix:' || epoch || ':' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
      FROM r JOIN b USING (source, epoch, block))
SELECT doc_id, source, n AS n_tokens, epoch::INTEGER AS epoch, block, done / quota AS slot, round(share, 9) AS target_share
FROM p WHERE done < quota OR (epoch + 1) * t <= quota
"""
QUERIES = {"op5_mixing": op5_mixing}
ORACLES = {"op5_mixing": OP5_SQL}
