"""Places: clusters of settlements, address look-up over their aliases, zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import addresses
from . import joins


def clusters(places: DataFrame, key: Sequence[str], name: str, bucket: str, distance: str) -> DataFrame:
    """Places of one key as one: the name most given (of equals the longer, then the later), median and spread of the distance.

    More than one bucket makes a cluster ambiguous. Counts are taken per name first, so a hot key is small.
    """
    named = places.groupBy(*key, name).agg(F.count(F.lit(1)).alias("__n")).groupBy(*key).agg(F.max(F.struct("__n", F.char_length(name).alias("l"), F.col(name).alias("t"))).alias("m"))
    rest = places.groupBy(*key).agg(F.count(F.lit(1)).alias("n_variants"), F.round(F.median(distance), 3).alias("distance"), F.round(F.max(distance) - F.min(distance), 3).alias("spread"), F.count_distinct(bucket).alias("n_buckets"), F.min(bucket).alias("least"))
    return rest.join(named, list(key)).select(*key, F.col("m.t").alias(name), "n_variants", "distance", "spread", F.when(F.col("n_buckets") == 1, F.col("least")).alias(bucket), (F.col("n_buckets") > 1).alias("ambiguous"))


def address_lookup(rows: DataFrame, row_id: str, address: str, aliases: DataFrame, place_id: str, alias: str, priority: str, generic: Sequence[str] = ()) -> DataFrame:
    """The place whose alias an address holds as a phrase: candidates by shared tokens, then by containment; ranked by
    priority, tokens and length of the alias. Ties are ambiguous."""
    split = lambda c: F.filter(F.split(F.lower(c), r"(?U)[^\p{L}\p{N}]+"), lambda t: (F.char_length(t) > 1) & ~t.isin(*generic) if generic else F.char_length(t) > 1)
    keyed = aliases.withColumn("__alias", F.struct(place_id, alias))
    # an alias can only stand in an address that has all of its tokens
    pairs = joins.token_lookup(rows, row_id, split(F.col(address)), keyed, "__alias", split(F.col(alias)), None)
    held = pairs.select(row_id, "__alias.*").join(rows.select(row_id, address), row_id).join(aliases.select(place_id, alias, priority), [place_id, alias])
    space = lambda c: F.concat(F.lit(" "), F.array_join(split(c), " "), F.lit(" "))
    held = held.filter(F.contains(space(F.col(address)), space(F.col(alias))))
    w = Window.partitionBy(row_id).orderBy(F.desc(priority), F.desc(F.size(split(F.col(alias)))), F.desc(F.char_length(alias)))
    first = held.withColumn("__r", F.rank().over(w)).filter("__r = 1").groupBy(row_id).agg(F.count_distinct(place_id).alias("n"), F.min(place_id).alias(place_id), F.min(alias).alias(alias))
    return rows.select(row_id).join(first, row_id, "left").select(row_id, F.when(F.col("n") == 1, F.col(place_id)).alias(place_id), F.when(F.col("n") == 1, F.col(alias)).alias(alias), F.when(F.col("n").isNull(), "none").when(F.col("n") == 1, "matched").otherwise("ambiguous").alias("match"))


def city_lookup(rows: DataFrame, row_id: str, address: str, places: DataFrame, aliases: DataFrame) -> DataFrame:
    """The place of each address: row_id, match (no_address, not_found, matched, ambiguous), settlement, municipality, region, bucket, weight, distance, n_variants, spread.

    places: place_id, settlement, municipality, region, bucket, weight, outer, inner, distance, priority, n_variants; aliases: place_id, alias.
    Places whose alias an address holds as a phrase are ranked by hits of municipality and region, the municipality's, the region's,
    priority, tokens and length of the alias. Where several share the best rank and all are one federal city in different
    municipalities, a locality of that city that the address names by an alias of its own goes before; else, if the records agree on bucket, weight
    and polygons, they are one place, without municipality, at the median distance. The matches of one address are one array: phrases of a text.
    """
    norm = addresses.lookup_text
    words = lambda c: F.filter(F.split(c, " "), lambda w: (w != "") & ~w.isin(*addresses.GENERIC_WORDS))
    asked = rows.select(row_id, norm(F.col(address)).alias("__text"))
    named = aliases.select("place_id", norm(F.col("alias")).alias("__alias")).distinct().withColumn("__entry", F.struct("place_id", "__alias"))
    pairs = joins.token_lookup(asked, row_id, words(F.col("__text")), named, "__entry", words(F.col("__alias")), None).select(row_id, "__entry.*")
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    held = pairs.join(asked, row_id).filter(F.contains(pad(F.col("__text")), pad(F.col("__alias"))))
    known = places.withColumns({"__r": norm(F.col("region")), "__m": norm(F.col("municipality")), "__s": norm(F.col("settlement"))})
    hit = lambda c: ((F.col(c) != "") & F.contains(pad(F.col("__text")), pad(F.col(c)))).cast("int")
    rank = F.struct(F.size(F.split("__alias", " ")).alias("t"), F.char_length("__alias").alias("l"))
    one = held.groupBy(row_id, "place_id", "__text").agg(F.max(rank).alias("__rank"), F.collect_set("__alias").alias("__aliases")).join(known, "place_id")
    score = F.struct((hit("__m") + hit("__r")).alias("b"), hit("__m").alias("m"), hit("__r").alias("r"), F.col("priority").alias("p"), F.col("__rank.t").alias("t"), F.col("__rank.l").alias("l"))
    city = (F.col("__m") != "") & (F.col("__s") == F.col("__r"))
    match = F.struct(score.alias("score"), city.alias("city"), "__aliases", "__r", "__m", "__s", "place_id", "settlement", "municipality", "region", "bucket", "weight", "outer", "inner", "distance", "n_variants")
    grouped = one.groupBy(row_id).agg(F.array_sort(F.collect_list(match)).alias("all"), F.max(score).alias("top"))
    best = grouped.withColumn("best", F.filter("all", lambda x: x["score"] == F.col("top")))
    # places of one region, municipality and settlement count once
    keys = lambda c: F.array_distinct(F.transform(c, lambda x: F.struct(x["__r"], x["__m"], x["__s"])))
    first = F.get("best", F.lit(0))
    same = lambda x: x["city"] & (x["__r"] == first["__r"]) & (x["__s"] == first["__s"])
    federal = (F.size(keys(F.col("best"))) > 1) & (first["__r"] != "") & F.forall("best", same) & (F.size(F.array_distinct(F.transform("best", lambda x: x["__m"]))) > 1)
    others = F.flatten(F.transform("best", lambda x: x["__aliases"]))
    own = lambda x: F.filter(x["__aliases"], lambda a: ~F.array_contains(others, a))
    local = F.filter("all", lambda x: (x["__r"] == first["__r"]) & ~x["city"] & (F.size(own(x)) > 0))
    widest = lambda x: F.array_max(F.transform(own(x), lambda a: F.struct(F.size(F.split(a, " ")).alias("t"), F.char_length(a).alias("l"))))
    ranked = F.transform(local, lambda x: F.struct(x["score"].alias("score"), widest(x).alias("w"), x.alias("x")))
    best = best.withColumns({"federal": federal, "local": ranked})
    peak = F.array_max(F.transform("local", lambda x: F.struct(x["score"], x["w"])))
    at_peak = F.transform(F.filter("local", lambda x: F.struct(x["score"], x["w"]) == peak), lambda x: x["x"])
    best = best.withColumn("at_peak", at_peak)
    found_local = F.col("federal") & (F.size(keys(F.col("at_peak"))) == 1)
    alike = F.size(F.array_distinct(F.transform("best", lambda x: F.struct(x["bucket"], x["weight"], x["outer"], x["inner"])))) == 1
    single = F.size(keys(F.col("best"))) == 1
    collapsed = F.col("federal") & ~found_local & alike
    matched = F.when(found_local, F.get("at_peak", F.lit(0))).when(single | collapsed, first)
    distances = F.array_sort(F.transform("best", lambda x: x["distance"]))
    n = F.size("best")
    middle = (F.get(distances, F.floor((n - 1) / 2).cast("int")) + F.get(distances, F.floor(n / 2).cast("int"))) / 2
    shown = best.select(
        row_id, F.when(matched.isNotNull(), "matched").otherwise("ambiguous").alias("match"), matched["settlement"].alias("settlement"), F.when(collapsed, F.lit("")).otherwise(matched["municipality"]).alias("municipality"),
        matched["region"].alias("region"), matched["bucket"].alias("bucket"), matched["weight"].alias("weight"), F.when(collapsed, F.round(middle, 2)).otherwise(matched["distance"]).alias("distance"),
        F.when(collapsed, F.aggregate(F.transform("best", lambda x: x["n_variants"].cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)).otherwise(matched["n_variants"].cast("long")).alias("n_variants"),
        F.when(collapsed, F.round(F.array_max(distances) - F.array_min(distances), 2)).alias("spread"),
    )
    out = asked.join(shown, row_id, "left")
    status = F.coalesce("match", F.when(F.col("__text") == "", "no_address").otherwise("not_found"))
    return out.withColumn("match", status).drop("__text")


def name_signal(tokens: Column, strong: Sequence[str], weak: Sequence[str]) -> Column:
    """3 if a token begins with a strong prefix, 1 with a weak one, else 0."""
    begins = lambda marks: F.exists(tokens, lambda t: t.rlike("^(" + "|".join(marks) + ")"))
    return F.when(begins(strong), 3).when(begins(weak), 1).otherwise(0)


def admitted(bucket: Column, matched: Column, allowed: Sequence[str]) -> Column:
    """Only a matched place of a known bucket that isn't allowed is skipped."""
    return F.lit(True) if not allowed else ~F.coalesce(matched & bucket.isNotNull() & ~bucket.isin(*allowed), F.lit(False))
