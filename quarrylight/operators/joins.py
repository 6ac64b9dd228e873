"""Joins with a rule: tiers, fallbacks, full merges, token look-ups, contact keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import staged


def equi_lookup(rows: DataFrame, sources: DataFrame, on: str, order: str, value: str, most: int | None = None) -> DataFrame:
    """Each row with the values of its sources in their order, as an array (empty if there is none).

    An array holds all sources of its key; where a key can be hot, most keeps the first of them, of which each task sends no more.
    """
    if most is not None:
        place = F.row_number().over(Window.partitionBy(on).orderBy(order, value))
        sources = sources.withColumn("__k", place).filter(F.col("__k") <= most).drop("__k")
    found = sources.groupBy(on).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda x: x[value]).alias("found"))
    return rows.join(found, on, "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))


def first_match(rows: DataFrame, table: DataFrame, on: str, order: str) -> DataFrame:
    """A left join that takes the first row of table per key."""
    values = [c for c in table.columns if c != on]
    return rows.join(table.groupBy(on).agg(F.min_by(F.struct(*values), order).alias("__v")).select(on, "__v.*"), on, "left")


def fallback_join(rows: DataFrame, table: DataFrame, first: str, second: Sequence[str], value: str, order: str) -> DataFrame:
    """By the first key; where that finds nothing, by the second, composite one. Adds value and matched_by."""
    one = table.filter(F.col(first).isNotNull()).groupBy(first).agg(F.min_by(value, order).alias("__one"))
    two = table.groupBy(*second).agg(F.min_by(value, order).alias("__two"))
    found = rows.join(one, first, "left").join(two, list(second), "left")
    by = F.when(F.col("__one").isNotNull(), "first").when(F.col("__two").isNotNull(), "second")
    return found.withColumns({value: F.coalesce("__one", "__two"), "matched_by": by}).drop("__one", "__two")


def tiered_match(refs: DataFrame, targets: DataFrame, ref_id: str, target_id: str, tiers: Sequence[str]) -> DataFrame:
    """Matches references by the first tier (a column of both) that finds anything; more than one target there is no match.

    Adds target and tier, null where nothing or too much matched. One join per tier, over non-null keys only.
    """
    found = None
    for i, t in enumerate(tiers):
        # targets are one row per key before the join: a hot key makes no pairs. More than one target shows as a least and a greatest
        per_key = targets.filter(F.col(t).isNotNull()).groupBy(t).agg(F.min(target_id).alias("lo"), F.max(target_id).alias("hi"))
        matched = refs.filter(F.col(t).isNotNull()).select(ref_id, t).join(per_key, t).groupBy(ref_id).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        part = matched.select(ref_id, F.when(F.col("lo") == F.col("hi"), 1).otherwise(2).alias("n"), F.col("lo").alias("target"), F.lit(i).alias("tier"))
        found = part if found is None else found.unionByName(part)
    first = found.groupBy(ref_id).agg(F.min_by(F.struct("n", "target", "tier"), "tier").alias("m"))
    out = refs.join(first, ref_id, "left")
    one = F.col("m.n") == 1
    return out.withColumns({"target": F.when(one, F.col("m.target")), "tier": F.when(one, F.element_at(F.array(*map(F.lit, tiers)), F.col("m.tier") + 1))}).drop("m")


def merge_ledgers(left: DataFrame, right: DataFrame, key: Sequence[str], values: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """A full outer join that takes the first non-empty value of each field and joins lists without repeats."""
    r = right.select(*[F.col(k).alias(f"__k_{k}") for k in key], *[F.col(c).alias(f"__r_{c}") for c in (*values, *lists)])
    joined = left.join(r, [F.col(k) == F.col(f"__k_{k}") for k in key], "full_outer")
    blank = lambda c: F.when(F.col(c).cast("string") != "", F.col(c))
    empty = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    return joined.select(
        *[F.coalesce(F.col(k), F.col(f"__k_{k}")).alias(k) for k in key],
        *[F.coalesce(blank(c), blank(f"__r_{c}")).alias(c) for c in values],
        *[F.array_distinct(F.concat(empty(c), empty(f"__r_{c}"))).alias(c) for c in lists],
    )


def token_lookup(rows: DataFrame, row_id: str, row_tokens: Column, table: DataFrame, entry_id: str, entry_tokens: Column, least: int | None = 1, hot_rows: int = 100_000) -> DataFrame:
    """Pairs that share at least so many tokens (n_shared; None: all of the entry's), by an inverted index over the rarest tokens of each entry.

    An entry of k tokens shares one of its k - least + 1 rarest with any row that shares least of them, so only these are joined; the
    token sets of the pairs found are then compared whole. A frequent token makes pairs only for entries that have no rarer ones; where all tokens are needed
    and more than hot_rows rows hold even the rarest, an entry is looked up by its two rarest together.
    """
    b = table.select(entry_id, F.array_distinct(entry_tokens).alias("__b"))
    entries = b.select(entry_id, F.explode("__b").alias("token"))
    # the rows' tokens are made once; of them only those of some entry are kept, which is all that a comparison with an entry needs
    inverted = staged(rows.select(row_id, F.explode(F.array_distinct(row_tokens)).alias("token")).join(entries.select("token").distinct(), "token", "left_semi").select(row_id, "token"), "tokens")
    held = inverted.groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    rarest = entries.join(held, "token", "left").groupBy(entry_id).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "token"))).alias("t"))
    enough = F.size("t") if least is None else F.lit(least)
    probes = rarest.filter(F.size("t") >= enough).select(entry_id, F.explode(F.slice("t", F.lit(1), F.size("t") - (enough - 1))).alias("p")).filter("p.held > 0").select(entry_id, "p.token")
    if least is None:
        one, two = F.get("t", F.lit(0)), F.get("t", F.lit(1))
        hot = rarest.filter((F.size("t") > 1) & (one["held"] > hot_rows)).select(entry_id, one["token"].alias("token"), two["token"].alias("other"), two["held"].alias("held"))
        probes = probes.join(hot.select(entry_id), entry_id, "left_anti")
        with_hot = inverted.join(hot.select("token").distinct(), "token", "left_semi").join(inverted.select(row_id, F.col("token").alias("other")), row_id)
        both = with_hot.join(hot.filter("held > 0").drop("held"), ["token", "other"]).select(row_id, entry_id)
        found = inverted.join(probes, "token").select(row_id, entry_id).unionByName(both).distinct()
    else:
        found = inverted.join(probes, "token").select(row_id, entry_id).distinct()
    a = inverted.join(found.select(row_id), row_id, "left_semi").groupBy(row_id).agg(F.collect_set("token").alias("__a"))
    shared = F.size(F.array_intersect("__a", "__b")).cast("bigint")
    wanted = F.size("__b") if least is None else F.lit(least)
    return found.join(a, row_id).join(b, entry_id).filter(shared >= wanted).select(row_id, entry_id, shared.alias("n_shared"))


def best_lookup(pairs: DataFrame, row_id: str, entry_id: str, order: Sequence[Column]) -> DataFrame:
    """The best entry of each row, and whether another ties with it (order without a tie-breaker)."""
    w = Window.partitionBy(row_id).orderBy(*order)
    ranked = pairs.withColumn("__rank", F.rank().over(w)).filter("__rank = 1")
    return ranked.groupBy(row_id).agg(F.min(entry_id).alias(entry_id), (F.count(F.lit(1)) > 1).alias("ambiguous"))


def overlap(left: DataFrame, right: DataFrame, key: str, left_values: Sequence[str], right_values: Sequence[str]) -> DataFrame:
    """For one row per key on both sides: how many values of each pair of array columns agree."""
    joined = left.join(right, key)
    return joined.select(key, *[F.size(F.array_intersect(a, b)).alias(f"n_{a}") for a, b in zip(left_values, right_values, strict=True)])


def term_match(text: Column, tokens: Column, phrase: Column, keys: Column) -> Column:
    """Whether a term is in a text: its phrase as it stands, or every one of its stem keys among the tokens."""
    return text.contains(phrase) | F.forall(keys, lambda k: F.array_contains(tokens, k))


def id_mentions(pages: DataFrame, page: str, texts: Sequence[str], ids: DataFrame, id_col: str, most_lengths: int = 32) -> DataFrame:
    """page and id of every id (text of digits) that stands in one of a page's texts, also inside a longer run of digits.

    Runs of digits are cut into windows of the lengths that ids have, and these are joined with the ids by equality: the work grows with the digits of the pages, not with
    pages times ids. Ids that aren't all digits are nowhere; repeated ids and mentions count once. More lengths than most_lengths are an error.
    """
    known = ids.select(F.trim(id_col).alias(id_col)).filter(F.col(id_col).rlike("^[0-9]+$")).distinct()
    lengths = [r["n"] for r in known.select(F.char_length(id_col).alias("n")).distinct().limit(most_lengths + 1).collect()]
    if len(lengths) > most_lengths:
        raise ValueError(f"ids of more than {most_lengths} lengths")
    if not lengths:
        return pages.select(page, F.lit(None).cast("string").alias(id_col)).limit(0)
    text = F.concat_ws(" ", *[F.col(c) for c in texts])
    runs = F.array_distinct(F.regexp_extract_all(text, F.lit(f"([0-9]{{{min(lengths)},}})"), F.lit(1)))
    windows = F.flatten(F.array(*[F.flatten(F.transform(F.filter(runs, _as_long_as(n)), _windows(n))) for n in sorted(lengths)]))
    found = pages.select(page, F.explode(F.array_distinct(windows)).alias(id_col))
    return found.join(known, id_col).select(page, id_col).distinct()


def _as_long_as(n: int):
    return lambda run: F.char_length(run) >= n


def _windows(n: int):
    return lambda run: F.transform(F.sequence(F.lit(1), F.char_length(run) - n + 1), lambda i: F.substring(run, i, F.lit(n)))


def with_page_match(rows: DataFrame, mentions: DataFrame, page: str, id_col: str, out: str = "matches") -> DataFrame:
    """rows of (page, id) with out: whether the page mentions the id; a row without an id matches any page."""
    own = F.trim(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    known = mentions.select(F.col(page).alias("__p"), F.col(id_col).alias("__i"), F.lit(True).alias("__m"))
    joined = rows.join(known, (F.col(page) == F.col("__p")) & (own == F.col("__i")), "left")
    return joined.withColumn(out, F.coalesce("__m", own == "")).drop("__p", "__i", "__m")
