"""Record-level rules: cards, routes under budgets, merging of lists and maps, keyword terms, responses, ledgers of work."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.workspace import shared_folder


def lead_cards(records: DataFrame, key: str, kind: str, date: str, title: str, section: str, label: str, score: str, order: str, corporate: Sequence[str] = ("about", "contacts", "homepage")) -> DataFrame:
    """Records worth a card: likely or maybe relevant, on corporate sections only likely; one per kind, date and title's beginning."""
    good = (F.col(label) == "likely_relevant") | ((F.col(label) == "maybe_relevant") & ~F.col(section).isin(*corporate))
    w = Window.partitionBy(key, kind, date, F.lower(F.left(title, F.lit(80)))).orderBy(F.desc(score), order)
    return records.filter(good).withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def rank_routes(routes: DataFrame, site: str, family: str, host: str, path: str, score: str, total: int = 10, per_family: int = 3, per_host: int = 6, per_path: int = 2) -> DataFrame:
    """The routes of a site that fit its budget, in order of choice, and why the others don't.

    First the best of each family, then families in turn, ties to the smaller path. The turn of a route is its rank in its family, so
    the order of visits is known beforehand; ranks are counted over ranges, so that no task holds a site. Each choice depends on the
    counts so far, but only few routes of a family can be chosen at all (``could_be_chosen``): those are a site's group of pandas. It
    gives the turns at which caps were reached, and the outcome of every route follows from its own turn.
    """
    spark = routes.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    first_part = F.coalesce(F.get(F.split(F.col(path), "/"), F.lit(1)), F.lit(""))
    keyed = routes.withColumns({"__s": text(site), "__f": text(family), "__h": text(host), "__p": first_part, "__t": F.xxhash64(*routes.columns)})
    order = [F.desc(score), F.asc(path), F.asc("__t")]
    folder = f"{shared_folder(spark, 'routes')}/rows"
    keyed.repartitionByRange("__s", "__f", *order).withColumn("__part", F.spark_partition_id()).write.parquet(folder)
    ranged = spark.read.parquet(folder)
    before = Window.partitionBy("__s", "__f").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("__s", "__f", "__part").agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    ranked = ranged.join(offsets, ["__s", "__f", "__part"]).withColumn("__rank", F.col("__before") + F.row_number().over(Window.partitionBy("__s", "__f", "__part").orderBy(*order)))
    heads = ranked.filter("__rank = 1").select("__s", "__f", F.row_number().over(Window.partitionBy("__s").orderBy(*order)).alias("__turn"))
    few = could_be_chosen(ranked.select("__s", "__f", "__h", "__p", "__rank"), total, per_family, per_host, per_path).join(heads, ["__s", "__f"])

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        caps, used, out, n = {"f": per_family, "h": per_host, "p": per_path, "t": total}, {}, {}, 0
        for r in pdf.sort_values(["__rank", "__turn"]).to_dict("records"):
            at = (r["__rank"], r["__turn"])
            out[f"o:{r['__f']}"] = (0, r["__turn"], 0)
            keys = [("f", r["__f"]), ("h", r["__h"]), ("p", r["__p"]), ("t", "")]
            if any(used.get(k, 0) >= caps[k[0]] for k in keys):
                continue
            n += 1
            out[f"s:{r['__rank']}:{r['__f']}"] = (*at, n)
            for k in keys:
                used[k] = used.get(k, 0) + 1
                if used[k] == caps[k[0]]:
                    out[f"{k[0]}:{k[1]}"] = (*at, 0)
        return pd.DataFrame([(pdf["__s"].iloc[0], k, *v) for k, v in out.items()], columns=["__s", "key", "rank", "turn", "place"])

    marks = few.groupBy("__s").applyInPandas(choose, "__s string, key string, rank bigint, turn int, place int")
    marks = marks.groupBy("__s").agg(F.map_from_entries(F.collect_list(F.struct("key", F.struct("rank", "turn", "place")))).alias("__m"))
    mark = lambda kind, *of: F.try_element_at("__m", F.concat(F.lit(kind), *of))
    turn = mark("o:", F.col("__f"))["turn"]

    def past(cap: int, full: Column) -> Column:
        return F.lit(cap <= 0) | F.coalesce((F.col("__rank") > full["rank"]) | ((F.col("__rank") == full["rank"]) & (turn > full["turn"])), F.lit(False))

    chosen = mark("s:", F.col("__rank").cast("string"), F.lit(":"), F.col("__f"))["place"]
    outcome = F.when(chosen.isNotNull(), "selected").when(past(per_family, mark("f:", F.col("__f"))), "family_cap").when(past(per_host, mark("h:", F.col("__h"))), "host_cap").when(past(per_path, mark("p:", F.col("__p"))), "path_cap").otherwise("total_cap")
    return ranked.join(marks, "__s", "left").select(*routes.columns, F.coalesce(chosen, F.lit(0)).alias("place"), outcome.alias("outcome"))


def could_be_chosen(ranked: DataFrame, total: int, per_family: int, per_host: int, per_path: int) -> DataFrame:
    """The rows (__s, __f, __h, __p, __rank) that a site's caps don't rule out whatever else is chosen.

    A route is passed over only when a cap of its own is full, and caps stay full. So of one family, host and path only the first
    per_path can be chosen. Before a route that is chosen, its family has fewer than per_family chosen ones, and else routes of full
    hosts (at most total / per_host) and full paths (at most total / per_path), of which the same reasoning bounds the rows.
    """
    hosts, paths = total // max(1, per_host), total // max(1, per_path)
    of_path = per_path + hosts * per_path
    of_host = per_host + paths * per_path
    of_family = per_family + hosts * of_host + paths * of_path
    bounds = ((["__h", "__p"], per_path), (["__p"], of_path), (["__h"], of_host), ([], of_family))
    for keys, most in bounds:
        # tasks drop what is beyond the bound before the exchange
        w = Window.partitionBy("__s", "__f", *keys).orderBy("__rank")
        ranked = ranked.withColumn("__k", F.row_number().over(w)).filter(F.col("__k") <= most).drop("__k")
    return ranked


def distinct_sites(sites: Column) -> Column:
    """The first address of each registered domain."""
    keyed = F.transform(sites, lambda s: F.struct(T.registered_domain(T.host(s)).alias("d"), s.alias("s")))
    start = F.array().cast("array<struct<d:string,s:string>>")
    kept = F.aggregate(keyed, start, lambda a, x: F.when((x["d"] == "") | F.exists(a, lambda y: y["d"] == x["d"]), a).otherwise(F.array_append(a, x)))
    return F.transform(kept, lambda x: x["s"])


def site_counts(rows: DataFrame, key: str, url: str, order: str) -> DataFrame:
    """Per key how many registered domains its addresses have, and the first address with one: distinct_sites over rows, without a list."""
    domain = F.nullif(T.registered_domain(T.host(F.col(url))), F.lit(""))
    firsts = rows.groupBy(key, domain.alias("__d")).agg(F.min_by(url, order).alias("__u"), F.min(order).alias("__o"))
    return firsts.groupBy(key).agg(F.count("__d").cast("int").alias("n_sites"), F.min_by("__u", F.when(F.col("__d").isNotNull(), F.col("__o"))).alias("first_url"))


def distinct_longest(values: Column) -> Column:
    """Values without those that another holds; a longer one takes the place of the first it holds."""
    rest = F.array_distinct(F.filter(values, lambda v: v != ""))
    return F.filter(rest, lambda v: ~F.exists(rest, lambda o: (o != v) & F.contains(F.lower(o), F.lower(v)) & ((F.char_length(o) > F.char_length(v)) | (o < v))))


def merge_maps(base: Column, extra: Column) -> Column:
    """Both maps, the base's meaningful values first."""
    a, b = (F.coalesce(m, F.create_map().cast("map<string,string>")) for m in (base, extra))
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(F.nullif(x, F.lit("")), y))


def parse_terms(dsl: Column) -> Column:
    """Terms of a keyword list: separated by commas, semicolons or lines; [a b]n allows n words between, a trailing * any ending."""
    pieces = F.filter(F.transform(F.split(F.lower(F.coalesce(dsl, F.lit(""))), r"[,;\n]+"), T.one_space), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.regexp_replace(F.regexp_replace(p, r"\[|\]\d*$|\]", ""), r"\*", "").alias("term"), F.when(p.rlike(r"\]\d+$"), F.regexp_extract(p, r"\](\d+)$", 1).cast("int")).otherwise(0).alias("gap"), p.contains("*").alias("open"),
        ),
    )


def term_hits(text: Column, terms: Column) -> Column:
    """The terms (parse_terms) that a text has: words in order with at most gap others between; an open or long word by its beginning."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)[^\p{L}\p{N}]+"), lambda w: w != "")
    shown = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))

    def pattern(t: Column) -> Column:
        ends = F.when(t["open"], r"[^ ]*").otherwise(F.lit(""))
        parts = F.transform(F.split(t["term"], " "), lambda w: F.concat(F.lit(r"\Q"), w, F.lit(r"\E"), F.when(F.char_length(w) >= 4, r"[^ ]*").otherwise(ends)))
        return F.concat(F.lit(" "), F.array_join(parts, "%"), F.lit(" "))

    glue = lambda t: F.concat(F.lit("( [^ ]+){0,"), t["gap"].cast("string"), F.lit("} "))
    return F.transform(F.filter(terms, lambda t: F.regexp_like(shown, F.replace(pattern(t), F.lit("%"), glue(t)))), lambda t: t["term"])


def tender_status(error: Column, applied: Column, limited: Column, count: Column) -> Column:
    """error before not_applied before registration_limited before zero before visible."""
    return F.when(error, "error").when(~applied, "not_applied").when(limited, "registration_limited").when(count == 0, "zero").otherwise("visible")


def combine_batches(batches: DataFrame, key: str, status: str) -> DataFrame:
    """One status from those of a key's batches: partial error, error, visible, review, all zero."""
    any_ = lambda s: F.bool_or(F.col(status) == s)
    all_error = F.bool_and(F.col(status) == "error")
    combined = F.when(any_("error") & ~all_error, "partial_error").when(all_error, "error").when(any_("visible"), "visible").when(any_("not_applied") | any_("registration_limited"), "review").otherwise("all_zero")
    return batches.groupBy(key).agg(combined.alias("status"), F.count(F.lit(1)).alias("n_batches"))


def parse_response(df: DataFrame, raw: str) -> DataFrame:
    """df with answer (JSON text or null) and reason: parsed, refusal, incomplete, found_in_text, empty or invalid, from a model's stored response."""

    def read(x: str | None) -> tuple[str | None, str]:
        if not isinstance(x, str) or not x.strip():
            return None, "empty"
        try:
            given = json.loads(x)
        except ValueError:
            given = None
        if isinstance(given, dict):
            if given.get("parsed") is not None:
                return json.dumps(given["parsed"], ensure_ascii=False, sort_keys=True), "parsed"
            if given.get("refusal"):
                return None, "refusal"
            if given.get("status") == "incomplete":
                return None, "incomplete"
            x = str(given.get("text", ""))
        decoder = json.JSONDecoder()
        for m in re.finditer(r"[{\[]", x):
            try:
                found, _ = decoder.raw_decode(x, m.start())
            except ValueError:
                continue
            return json.dumps(found, ensure_ascii=False, sort_keys=True), "found_in_text"
        return None, "invalid"

    @F.pandas_udf("answer string, reason string")
    def parsed(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read(x) for x in texts], columns=["answer", "reason"]).astype(object)

    return df.withColumn("__r", parsed(F.col(raw))).select(*df.columns, "__r.answer", "__r.reason")


def activity_codes(text: Column) -> Column:
    """Codes with their labels, of a text that lists them: array<struct<code, label>>, each label up to the next code."""
    pieces = F.split(F.coalesce(text, F.lit("")), r"(?<![\d.])(?=\d{2}\.\d{1,2})")
    coded = F.filter(pieces, lambda p: p.rlike(r"^\d{2}\.\d{1,2}"))
    return F.transform(coded, lambda p: F.struct(F.regexp_extract(p, r"^(\d{2}\.\d{1,2}(?:\.\d{1,2})?)", 1).alias("code"), F.btrim(F.regexp_replace(p, r"^\d{2}\.\d{1,2}(\.\d{1,2})?", ""), F.lit(" -,;.—\n")).alias("label")))


def cooldown(n: Column, base: float = 30.0, most: int = 3) -> Column:
    """Seconds to wait after the n-th failure in a row: base, doubled up to so many times."""
    return F.when(n > 0, F.lit(base) * F.pow(F.lit(2.0), F.least(n - 1, F.lit(most)))).otherwise(0.0)


def work_ledger(events: DataFrame, key: Sequence[str], order: str, kind: str) -> DataFrame:
    """Work units as the log leaves them: acked once any ack came, else pending; repeats change nothing."""
    return events.groupBy(*key).agg(F.when(F.bool_or(F.col(kind) == "ack"), "acked").otherwise("pending").alias("state"), F.min(order).alias("first_seen"), F.count(F.lit(1)).alias("n_messages"))


def deferred_ledger(events: DataFrame, entity: str, source: str, order: str, ok: Column) -> DataFrame:
    """Per (entity, source) whether its last word resolved it, and per source how many failures in a row stand at the end."""
    last = events.groupBy(entity, source).agg(F.when(F.max_by(ok, order), "resolved").otherwise("unresolved").alias("resolution"))
    # a source is one row after each task's own aggregation, and joined back as such
    best = events.groupBy(source).agg(F.max(F.when(ok, F.col(order))).alias("__ok"))
    tail = events.filter(~ok).join(best, source).filter(F.col("__ok").isNull() | (F.col(order) > F.col("__ok")))
    runs = tail.groupBy(source).agg(F.count(F.lit(1)).alias("failures_in_a_row"))
    return last.join(runs, source, "left").withColumn("failures_in_a_row", F.coalesce("failures_in_a_row", F.lit(0)))


#: What the detail of a failure says where it passes by itself.
TRANSIENT_MARKS = (
    "connection reset", "connection aborted", "connectionerror", "connect timeout", "eof occurred", "failed to resolve", "getaddrinfo failed", "max retries exceeded", "nameresolutionerror", "name or service not known", "read timed out", "read timeout",
)


def deferred_cap(rows: Column) -> Column:
    """How many rows in a row a source may defer: two in a hundred of the run's, two at least."""
    return F.greatest(F.lit(2), F.ceil(rows * 0.02)).cast("int")


def outcome_class(source: Column, access: Column, status: Column, detail: Column, in_a_row: Column, cap: Column, systemic: Sequence[str], transient: Sequence[str] = ("http_503",), approved: Mapping[str, Sequence[str]] | None = None, excused: Mapping[str, Sequence[str]] | None = None) -> Column:
    """What a failed required source means: systemic_stop, non_defer_fail_fast or deferred_row_transient.

    Systemic statuses, and a guest behind a proxy or session, stop the run, unless the source is excused by a mark in the detail of a direct block. Deferred
    are request errors with a passing mark, transient statuses, and a source's approved statuses with such a mark; beyond the cap in a row they stop the run.
    """
    low = F.lower(F.coalesce(T.clean(detail), status))
    marked = lambda marks: low.rlike("|".join(re.escape(m) for m in marks))
    no = F.lit(False)
    excuse, own = no, no
    for name, marks in (excused or {}).items():
        excuse = excuse | ((source == name) & (status == "blocked") & (access == "direct") & marked(marks))
    for name, statuses in (approved or {}).items():
        own = own | ((source == name) & status.isin(*statuses) & marked(TRANSIENT_MARKS))
    stop = status.isin(*systemic) | (access.isin("proxy", "session") & (status == "guest"))
    passing = F.when(status == "request_error", marked(TRANSIENT_MARKS)).otherwise(status.isin(*transient) | own)
    return F.when(stop & ~excuse, "systemic_stop").when(~excuse & ~passing, "non_defer_fail_fast").when(in_a_row >= cap, "systemic_stop").otherwise("deferred_row_transient")


def fails_fast(source: Column, status: Column, access: Column, required: Sequence[str], fine: Sequence[str], direct_fine: Sequence[str], blocked: Sequence[str]) -> Column:
    """Whether a required source's status ends the run: no status, a guest of a session or proxy, an unset offline source, blocks, request errors and HTTP codes from 400."""
    status = F.coalesce(T.clean(status), F.lit(""))
    code = F.regexp_extract(status, r"^http_(\d+)$", 1).try_cast("int")
    bad = status.isin(*blocked, "request_error", "invalid_url", "not_configured") | F.coalesce(code >= 400, F.lit(False)) | (access.isin("session", "proxy") & (status == "guest"))
    return F.when(~F.coalesce(source.isin(*required), F.lit(False)), False).when(status == "", True).when(status.isin(*fine) | ((access == "direct") & status.isin(*direct_fine)), False).otherwise(F.coalesce(bad, F.lit(False)))


def first_text(*values: Column) -> Column:
    """The first text that isn't blank, one-spaced, of columns and arrays of texts in order; the empty text if there is none."""
    return F.coalesce(*map(T.clean, values), F.lit(""))


def baseline_samples(pages: DataFrame, site: str, order: str, hinted: Column, n: int = 3) -> DataFrame:
    """pages with is_sample: the first n without a hint, in order."""
    # each task drops what is beyond its own first n before the exchange
    first = pages.filter(~hinted).withColumn("__k", F.row_number().over(Window.partitionBy(site).orderBy(order))).filter(F.col("__k") <= n)
    last = first.groupBy(site).agg(F.max(order).alias("__last"))
    return pages.join(last, site, "left").withColumn("is_sample", F.coalesce(~hinted & (F.col(order) <= F.col("__last")), F.lit(False))).select(*pages.columns, "is_sample")


def merge_procedures(rows: DataFrame, key: Sequence[str], order: str, fields: Sequence[str], aliases: Mapping[str, str], status: str) -> DataFrame:
    """Rows of one key as one: each field the first that isn't blank, statuses by their aliases."""
    blank = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    named = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    rows = rows.withColumn(status, F.coalesce(named[F.col(status)], F.col(status)))
    return rows.groupBy(*key).agg(*[F.min_by(blank(c), F.when(blank(c).isNotNull(), F.col(order))).alias(c) for c in fields], F.count(F.lit(1)).alias("n_merged"))
