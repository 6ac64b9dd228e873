"""Profiles of entities: fills by precedence, gates, digests, evidence, explanations, versioned assets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .ranges import staged


def present(c: Column, kind: str) -> Column:
    """The value, or null where it is blank: empty text, array or map."""
    if kind == "string":
        return F.nullif(F.trim(c), F.lit(""))
    return F.when(F.size(c) > 0, c) if kind.startswith(("array", "map")) else c


def back_fill(df: DataFrame, pairs: Mapping[str, str]) -> DataFrame:
    """Each column from its older twin where it is blank."""
    kinds = dict(df.dtypes)
    return df.withColumns({new: F.coalesce(present(F.col(new), kinds[new]), F.col(old)) for new, old in pairs.items()})


def merge_sections(preferred: DataFrame, fallback: DataFrame, key: str, fields: Sequence[str], whole: Mapping[str, Sequence[str]]) -> DataFrame:
    """Fields from the preferred side where present; blocks of fields are taken whole from the side whose first field, the status, is present."""
    every = [*fields, *(c for block in whole.values() for c in block)]
    kinds = dict(preferred.dtypes)
    other = fallback.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in every])
    joined = preferred.join(other, F.col(key) == F.col("__k"), "full_outer")
    out = {c: F.coalesce(present(F.col(c), kinds[c]), F.col(f"__{c}")) for c in fields}
    for block in whole.values():
        own = present(F.col(block[0]), kinds[block[0]]).isNotNull()
        out |= {c: F.when(own, F.col(c)).otherwise(F.col(f"__{c}")) for c in block}
    return joined.select(F.coalesce(key, "__k").alias(key), *[c.alias(n) for n, c in out.items()])


def query_string(params: Sequence[tuple[str, Column]]) -> Column:
    """Ordered parameters as a query string; blank ones are left out."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{k}="), F.url_encode(v))) for k, v in params])), "&")


def query_applied(expected: Column, echoed: Column) -> Column:
    """Whether every expected value is among those that the page gave back."""
    return F.size(F.array_except(expected, echoed)) == 0


def decision_summary(decisions: DataFrame, key: str, status: str, reasons: str, order: str, limit: int = 240) -> DataFrame:
    """Per key the first three reasons of its first verified decision, else of its first candidate."""
    rank = F.when(F.col(status) == "verified", 0).when(F.col(status) == "candidate", 1)
    first = decisions.withColumn("__rank", rank).filter("__rank is not null").groupBy(key).agg(F.min_by(reasons, F.struct("__rank", order)).alias("r"))
    return first.select(key, T.compact(F.array_join(F.slice("r", 1, 3), "; "), limit).alias("summary"))


def parse_gate(sites: DataFrame, key: str, url: str, order: str, status: Column, probed: Column, site_class: Column, worth: Column) -> DataFrame:
    """One row per normalised URL of a key, with mode: deep for candidates whose probe allows it, else surface."""
    w = Window.partitionBy(key, "__url").orderBy(order)
    one = sites.withColumn("__url", T.url(F.col(url))).filter("__url is not null").withColumn("__rank", F.row_number().over(w)).filter("__rank = 1")
    allowed = probed & ~site_class.isin("D", "E", "F") & (worth != "false")
    return one.withColumn("mode", F.when(status.isin("verified", "candidate") & allowed, "deep").otherwise("surface")).drop("__rank").withColumnRenamed("__url", "normal_url")


def restore_safe(pending: DataFrame, evidence: DataFrame, key: str, fingerprint: str, done: DataFrame) -> DataFrame:
    """Pending checkpoints that may be promoted: evidence of the same fingerprint, and not already among the results."""
    return pending.join(evidence.select(key, fingerprint).distinct(), [key, fingerprint], "left_semi").join(done, key, "left_anti")


def evidence_once(evidence: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The first of each distinct evidence, numbered within its entity in order (the first part of the key)."""
    values = [c for c in evidence.columns if c not in key]
    one = evidence.groupBy(*key).agg(F.min_by(F.struct(*values), order).alias("v")).select(*key, "v.*")
    return one.withColumn("evidence_no", F.row_number().over(Window.partitionBy(key[0]).orderBy(order)))


def source_digest(items: DataFrame, key: Sequence[str], kind: str, value: str, order: str, caps: Mapping[str, int], limit: int = 120) -> DataFrame:
    """Per key the first values of each kind, each cut to a length, as arrays."""
    w = Window.partitionBy(*key, kind).orderBy(order)
    ranked = items.filter(F.col(kind).isin(*caps)).withColumn("__rank", F.row_number().over(w))
    cap = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])
    kept = ranked.filter(F.col("__rank") <= cap[F.col(kind)])
    listed = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col(kind) == k, F.struct("__rank", F.col(value).alias("v"))))), lambda x: T.compact(x["v"], limit))
    return kept.groupBy(*key).agg(*[listed(k).alias(k) for k in caps])


def activity_terms(rows: DataFrame, key: str, text: str, order: str, banned: Sequence[str], most: int = 18, least: int = 5) -> DataFrame:
    """Per key its most frequent words that aren't banned, of equal counts the first."""
    split = F.split(F.lower(text), r"(?U)[^\p{L}]+")
    words = rows.select(key, order, F.explode(split).alias("term")).filter((F.char_length("term") >= least) & ~F.col("term").isin(*banned))
    # counts and first rows are plain numbers, which tasks add up in a hash table; places in a row are looked up for the words that lead only
    counts = words.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("__row"))
    lead = counts.withColumn("rank", F.rank().over(Window.partitionBy(key).orderBy(F.desc("n"), F.col("__row").asc_nulls_last()))).filter(F.col("rank") <= most).drop("rank")
    lead = staged(lead, "terms")
    wanted = lead.select(F.col(key).alias("__key"), "__row", F.col("term").alias("__term"))
    first = rows.select(key, order, text).join(wanted, F.col(key).eqNullSafe(F.col("__key")) & F.col(order).eqNullSafe(F.col("__row")))
    places = first.groupBy("__key", "__term").agg(F.min(F.nullif(F.array_position(split, F.col("__term")), F.lit(0))).alias("__place"))
    placed = lead.join(places, lead[key].eqNullSafe(places["__key"]) & (lead["term"] == places["__term"])).drop("__key", "__term")
    w = Window.partitionBy(key).orderBy(F.desc("n"), F.col("__row").asc_nulls_last(), "__place")
    return placed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).drop("__row", "__place")


def site_hints(hints: DataFrame, key: str, url: str, reason: str, order: str, most_sites: int = 5, most_reasons: int = 4) -> DataFrame:
    """Per key the first sites by registered domain with their reasons, masked ones left out."""
    given = hints.withColumn("domain", T.registered_domain(T.host(F.col(url)))).filter((F.col("domain") != "") & ~T.masked(F.col(url)))
    # one row per distinct reason, of which a window keeps the first few: no group is collected whole
    firsts = given.groupBy(key, "domain", F.col(reason).alias("__r")).agg(F.min_by(url, order).alias(url), F.min(order).alias("__o"))
    few = firsts.withColumn("__k", F.row_number().over(Window.partitionBy(key, "domain").orderBy("__o", "__r"))).filter(F.col("__k") <= most_reasons)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("__k", F.col("__r").alias("r")))), lambda x: x["r"])
    one = few.groupBy(key, "domain").agg(F.min_by(url, "__k").alias(url), F.min("__o").alias("__first"), listed.alias("reasons"))
    ranked = one.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("__first"))).filter(F.col("rank") <= most_sites)
    return ranked.select(key, "domain", url, "rank", "reasons")


def provenance(trace: Column, metadata: Column, guess: Column) -> tuple[Column, Column]:
    """(value, origin): what the trace says before the metadata before the guess."""
    t, m, g = (F.nullif(F.trim(c), F.lit("")) for c in (trace, metadata, guess))
    return F.coalesce(t, m, g), F.when(t.isNotNull(), "trace").when(m.isNotNull(), "metadata").when(g.isNotNull(), "guess").otherwise("none")


def explanation(groups: Mapping[str, Column], top: int = 3) -> Column:
    """The groups with most weight as text, greatest first, of equal ones by name."""
    parts = F.filter(F.array(*[F.struct((-c).alias("w"), F.lit(k).alias("k")) for k, c in groups.items()]), lambda x: x["w"] < 0)
    return F.array_join(F.transform(F.slice(F.array_sort(parts), 1, top), lambda x: F.concat(x["k"], F.lit(" "), F.format_number(-x["w"], 3))), ", ")


def load_asset(spark: SparkSession, path: str, versions: Mapping[int, str], key: str) -> DataFrame:
    """A versioned asset, one or more files of {version, records}: an unknown version, or a record without a key, is an error; old versions lack columns."""
    found = spark.read.option("multiLine", "true").schema("version int").json(path).select("version").distinct().limit(len(versions) + 1).collect()
    if not found or any(r["version"] not in versions for r in found):
        raise ValueError(f"unknown version {[r['version'] for r in found]}")
    widest = versions[max(versions)]
    parts = spark.read.option("multiLine", "true").schema(f"records array<struct<{widest}>>").json(path).select(F.explode("records").alias("r")).select("r.*")
    return parts.filter(F.when(F.col(key).isNotNull(), True).otherwise(F.raise_error(F.lit(f"a record lacks {key}")).cast("boolean")))


def write_asset(records: DataFrame, path: str, version: int, key: str, per_file: int = 1000) -> None:
    """Writes an asset as files of {version, records} of about per_file records each, dealt by the hash of the key; a record without a key is an error.

    Files of a rewrite stand beside nothing of the old one: the folder is replaced.
    """
    n = max(1, -(-records.count() // per_file))
    whole = records.filter(F.when(F.col(key).isNotNull(), True).otherwise(F.raise_error(F.lit(f"a record lacks {key}")).cast("boolean")))
    parts = whole.groupBy(F.pmod(F.xxhash64(key), F.lit(n)).alias("part")).agg(F.array_sort(F.collect_list(F.struct(*records.columns))).alias("records"))
    lines = parts.select("part", F.to_json(F.struct(F.lit(version).alias("version"), "records")).alias("value"))
    lines.repartition("part").write.mode("overwrite").partitionBy("part").text(path)


def manifest(files: DataFrame, path: str, content: str) -> DataFrame:
    """Files with size and sha256; a path that is absolute or leaves its folder is an error."""
    inside = ~F.col(path).rlike(r"^/|(^|/)\.\.(/|$)")
    checked = files.filter(F.when(inside, True).otherwise(F.raise_error(F.concat(F.lit("outside the archive: "), path)).cast("boolean")))
    return checked.select(path, F.octet_length(content).alias("size"), F.sha2(F.col(content).cast("binary"), 256).alias("checksum"))
