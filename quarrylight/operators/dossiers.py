"""Dossiers of entities: stage payloads, references to evidence, summaries of records and crawls, codecs, identities of work."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as DT

from ..functions import text as T
from .profiles import present
from .ranges import staged


def site_payloads(sites: DataFrame, key: str, url: str, order: str, candidates: DataFrame, source: str, status: str, confidence: str) -> DataFrame:
    """One row per site of a key that has a usable URL: site_url, selection_rank, selection_source, candidate_status, confidence (3 places).

    Each site meets the first candidate of its URL; without one it comes from merged_contacts.
    """
    named = sites.select(key, T.url(F.col(url)).alias("site_url"), F.col(order).alias("__o")).filter("site_url is not null")
    ranked = named.withColumn("selection_rank", F.row_number().over(Window.partitionBy(key).orderBy("__o")))
    first = candidates.select(F.col(key).alias("__k"), T.url(F.col(url)).alias("__u"), F.col(order).alias("__c"), F.col(source).alias("__source"), F.col(status).alias("__status"), F.col(confidence).alias("__confidence"))
    first = first.filter("__u is not null").groupBy("__k", "__u").agg(F.min_by(F.struct("__source", "__status", "__confidence"), "__c").alias("f"))
    joined = ranked.join(first, (F.col(key) == F.col("__k")) & (F.col("site_url") == F.col("__u")), "left")
    blank = lambda c: F.nullif(T.one_space(c), F.lit(""))
    return joined.select(key, "site_url", "selection_rank", F.coalesce(blank(F.col("f.__source")), F.lit("merged_contacts")).alias("selection_source"), blank(F.col("f.__status")).alias("candidate_status"), F.round("f.__confidence", 3).alias("confidence"))


def deep_parse_pick(decisions: DataFrame, key: str, url: str, belongs: str, order: str) -> DataFrame:
    """Per key the first decision with a URL that belongs to the entity, else the first with a URL."""
    usable = decisions.filter(F.coalesce(F.trim(url), F.lit("")) != "")
    return usable.groupBy(key).agg(F.min_by(url, F.struct(~F.coalesce(F.col(belongs), F.lit(False)), F.col(order))).alias(url))


def offline_notes(notes: Column, mode: Column, prefix: str, stale: str, refreshed: Column) -> Column:
    """The notes of a source that was read from a snapshot: its mode first, then that it is stale unless refreshed, then the others once each."""
    others = F.filter(F.coalesce(notes, F.array().cast("array<string>")), lambda n: ~F.startswith(n, F.lit(prefix)) & (n != stale))
    return F.array_distinct(F.concat(F.array(F.concat(F.lit(prefix), mode)), F.when(refreshed, F.array().cast("array<string>")).otherwise(F.array(F.lit(stale))), others))


#: The longest list of pieces that a want meets by locator and URL both (keys of longer ones meet pieces); the most pieces of a place and the most keys in one tile;
#: and how many times as many of either are dealt to one task together, so that few pieces and keys are in it.
LISTED, CROWDED, KEYS, NEAR = 100_000, 512, 256, (4, 8)


def met_places(wants: DataFrame, key: str, locator: str, url: str, kind: str, evidence: DataFrame, evidence_id: str, most: int | None) -> tuple[DataFrame, dict[str, DataFrame], dict[str, DataFrame], DataFrame]:
    """Wants with how many pieces they meet by locator, by URL and by both; the evidence of each; its numbered places; and the numbers by URL of what a locator and a URL share.

    A place is a locator or URL, and a kind of evidence or all. Pieces without an id are one, the last. Keys of several wants, and wants that share more than LISTED pieces, are not __single.
    """
    rows = wants.withColumns({"__of": F.when(F.coalesce(F.col(kind), F.lit("unknown")) == "unknown", "*").otherwise(F.concat(F.lit("="), F.col(kind))), "__n": F.count(F.lit(1)).over(Window.partitionBy(key))})
    sides, places = {}, {}
    for by in (locator, url):
        side = evidence.filter(F.col(by).isNotNull()).select(F.col(by).alias("__by"), F.col(kind).alias("__kind"), evidence_id)
        if most is not None:
            place = F.row_number().over(Window.partitionBy("__by", "__kind").orderBy(F.asc_nulls_last(evidence_id)))
            side = side.distinct().withColumn("__n", place).filter(F.col("__n") <= most).drop("__n")
        sides[by] = side
        both = side.select("__by", F.explode(F.array(F.lit("*"), F.concat(F.lit("="), F.col("__kind")))).alias("__of"), evidence_id).filter("__of is not null").distinct()
        places[by] = both.withColumn("__no", F.row_number().over(Window.partitionBy("__by", "__of").orderBy(F.asc_nulls_last(evidence_id))))
        sized = both.groupBy(F.col("__by").alias(by), "__of").agg(F.count(F.lit(1)).alias(f"__n_{by}"), F.min(evidence_id).alias(f"__first_{by}"))
        rows = rows.join(sized, [by, "__of"], "left")
    other = places[locator].select(F.col("__by").alias("__clash"), F.col("__of").alias("__of2"), F.col(evidence_id).alias("__id2"))
    shared = places[url].join(other, (F.col("__of") == F.col("__of2")) & F.col(evidence_id).eqNullSafe(F.col("__id2"))).select("__clash", "__by", "__of", F.col("__no").cast("bigint").alias("__no"))
    clashes = shared.groupBy(F.col("__clash").alias(locator), F.col("__by").alias(url), "__of").agg(F.count(F.lit(1)).alias("__n_both"))
    rows = rows.join(clashes, [locator, url, "__of"], "left").fillna(0, [f"__n_{locator}", f"__n_{url}", "__n_both"])
    rows = rows.withColumn("__single", (F.col("__n") == 1) & F.col(key).isNotNull() & (F.col("__n_both") <= LISTED))
    return staged(rows, "wants"), sides, places, shared


def ref_tiles(rows: DataFrame, key: str, locator: str, url: str, places: dict[str, DataFrame], shared: DataFrame, evidence_id: str) -> DataFrame:
    """References of keys of one want as tiles: __ids, up to CROWDED pieces of a place in order, __keys, up to KEYS keys that all have them, and __before, the number before the first. Tiles near each other have the same __deal.

    No pair is shuffled, and a tile is as small as its lists, however long a place's. Keys of a tile have as many pieces by locator, and those that meet some piece twice have the same locator.
    """
    tiles, cut = None, max(CROWDED, 1)
    group = ["__by", "__of", "__before", "__clash"]
    for by in (locator, url):
        before = F.lit(0).cast("bigint") if by == locator else F.col(f"__n_{locator}")
        clash = F.when(F.lit(by == url) & (F.col("__n_both") > 0), F.col(locator))
        asked = rows.filter(F.col(f"__n_{by}") > 0).select(key, F.col(by).alias("__by"), "__of", before.alias("__before"), clash.alias("__clash")).alias("a")
        sized = asked.groupBy(*group).agg(F.count(F.lit(1)).alias("__size")).alias("s")
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"s.{c}")) for c in group]
        part = F.pmod(F.xxhash64(key), F.ceil(F.col("__size") / (KEYS * NEAR[1]))).alias("__part")
        lists = asked.join(sized, same).groupBy(*[f"a.{c}" for c in group], part).agg(F.collect_list(key).alias("__all"))
        slices = F.transform(F.sequence(F.lit(0), F.floor((F.size("__all") - 1) / KEYS).cast("int")), lambda n: F.slice("__all", n * KEYS + 1, KEYS))
        low = F.floor((F.col("__no") - 1) / cut) * cut
        pieces = places[by].groupBy("__by", "__of", low.alias("__low")).agg(F.transform(F.array_sort(F.collect_list(F.struct("__no", F.col(evidence_id).alias("i")))), lambda x: x["i"]).alias("__ids"))
        ids, gone = F.col("__ids"), F.lit(0)
        if by == url:
            lists = lists.join(shared.groupBy("__clash", "__by", "__of").agg(F.collect_list("__no").alias("__twice")), ["__clash", "__by", "__of"], "left")
            left = F.array_except(F.sequence(F.col("__low") + 1, F.col("__low") + F.size("__ids")), "__twice")
            ids = F.when(F.col("__twice").isNull(), ids).otherwise(F.transform(left, lambda n: F.get("__ids", (n - F.col("__low") - 1).cast("int"))))
            gone = F.when(F.col("__twice").isNull(), gone).otherwise(F.size(F.filter("__twice", lambda n: n <= F.col("__low"))))
        deal = F.xxhash64(*group, "__part", F.floor(F.col("__low") / (cut * NEAR[0]))).alias("__deal")
        part = lists.join(pieces, ["__by", "__of"]).select(F.explode(slices).alias("__keys"), ids.alias("__ids"), (F.col("__before") + F.col("__low") - gone).cast("int").alias("__before"), deal)
        tiles = part if tiles is None else tiles.unionByName(part)
    return tiles


def resolve_refs(wants: DataFrame, key: str, order: str, locator: str, url: str, kind: str, evidence: DataFrame, evidence_id: str, most: int | None = None) -> DataFrame:
    """Evidence that records refer to: key, evidence_id, ref_no. First by locator, then by URL, each piece once per key.

    most keeps the first references of each key. Then no want meets more than most pieces of a locator or URL and kind, so that a URL with many pieces
    and many wants isn't their product; the first most of all are the same, as no want needs more of one place than that.

    A wanted kind other than null or unknown must be the evidence's. Evidence has columns locator, url, kind of the same names.

    Without most the rows are a product by nature. Their order is free: a tile gives the keys of one piece after the other, so that pieces and numbers are
    runs and keys repeat, which files of columns store in a small part of what pieces key by key take. Tiles are dealt to as many tasks as a shuffle has.
    """
    rows, sides, places, shared = met_places(wants, key, locator, url, kind, evidence, evidence_id, most)
    tiles = ref_tiles(rows.filter("__single"), key, locator, url, places, shared, evidence_id)
    dealt = (tiles if most is None else tiles.filter(F.col("__before") < most)).repartition(int(wants.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__deal")
    # a writer gives up its dictionary of keys where its first page repeats none, so tiles of many pieces come first
    dealt = dealt.sortWithinPartitions(F.desc(F.size("__ids")), "__deal")
    listed = dealt.select("__keys", "__before", F.posexplode("__ids").alias("__p", evidence_id)).select(F.explode("__keys").alias(key), evidence_id, (F.col("__before") + F.col("__p") + 1).alias("ref_no"))
    found = listed.unionByName(numbered_refs(rows.filter("not __single"), key, order, locator, url, kind, sides, evidence_id))
    return found if most is None else found.filter(F.col("ref_no") <= most)


def numbered_refs(wants: DataFrame, key: str, order: str, locator: str, url: str, kind: str, sides: dict[str, DataFrame], evidence_id: str) -> DataFrame:
    """References of keys of several wants: each want meets the pieces, and a piece counts where its key meets it first."""
    fits = lambda w: F.coalesce(F.col(w) == "unknown", F.lit(True)) | (F.col(w) == F.col("__kind"))
    found = None
    for phase, (by, side) in enumerate(sides.items()):
        part = wants.join(side, F.col(by) == F.col("__by")).filter(fits(kind)).select(key, evidence_id, F.struct(F.lit(phase).alias("p"), F.col(order).alias("o")).alias("__at"))
        found = part if found is None else found.unionByName(part)
    once = found.groupBy(key, evidence_id).agg(F.min("__at").alias("__at"))
    return once.withColumn("ref_no", F.row_number().over(Window.partitionBy(key).orderBy("__at", F.asc_nulls_last(evidence_id)))).drop("__at")


def count_refs(wants: DataFrame, key: str, order: str, locator: str, url: str, kind: str, evidence: DataFrame, evidence_id: str) -> DataFrame:
    """Per key n_refs and first_ref of what resolve_refs finds: for keys of one want from the counts of places, without a row or list of references."""
    rows, sides, _, _ = met_places(wants, key, locator, url, kind, evidence, evidence_id, None)
    n = F.col(f"__n_{locator}") + F.col(f"__n_{url}") - F.col("__n_both")
    first = F.when(F.col(f"__n_{locator}") > 0, F.col(f"__first_{locator}")).otherwise(F.col(f"__first_{url}"))
    direct = rows.filter("__single").select(key, n.alias("n_refs"), first.alias("first_ref")).filter("n_refs > 0")
    return direct.unionByName(counted(numbered_refs(rows.filter("not __single"), key, order, locator, url, kind, sides, evidence_id), key, evidence_id))


def counted(refs: DataFrame, key: str, evidence_id: str) -> DataFrame:
    return refs.groupBy(key).agg(F.count(F.lit(1)).alias("n_refs"), F.min_by(evidence_id, "ref_no").alias("first_ref"))


def rebind(procedures: DataFrame, key: str, order: str, fields: Sequence[str], refs: DataFrame, evidence_id: str) -> DataFrame:
    """Procedures of one key as one, each field the first that isn't blank, with n_refs and first_ref of the evidence that resolve_refs or count_refs found; empty ones go."""
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    merged = procedures.groupBy(key).agg(*[F.min_by(blank(c), F.when(blank(c).isNotNull(), F.col(order))).alias(c) for c in fields])
    bound = refs if "n_refs" in refs.columns else counted(refs, key, evidence_id)
    out = merged.join(bound, key, "left").withColumn("n_refs", F.coalesce("n_refs", F.lit(0)))
    return out.filter(F.coalesce(*fields).isNotNull() | (F.col("n_refs") > 0))


def record_summary(records: DataFrame, key: str, order: str, kind: str, family: str, fingerprint: str, label: str, sample: str) -> DataFrame:
    """Per key: how many records, pages and documents, distinct relevant and non-sample fingerprints, lead evidence outside the sample, and the families in order of first sight.

    Families are a vocabulary, so their list is bounded; fingerprints are counted, not listed.
    """
    relevant, lead = F.col(label) != "not_relevant", F.col(label) == "likely_relevant"
    counts = records.groupBy(key).agg(
        F.count(F.lit(1)).alias("record_count"), F.count_if(F.col(kind) == "page").alias("page_records"), F.count_if(F.col(kind) == "document").alias("document_records"),
        F.count_distinct(F.when(relevant, F.col(fingerprint))).alias("n_relevant"), F.count_distinct(F.when(~F.col(sample), F.col(fingerprint))).alias("n_non_sample"), F.count_if(lead & ~F.col(sample)).alias("non_sample_evidence"),
    )
    seen = records.filter(lead & (F.coalesce(F.col(family), F.lit("")) != "")).groupBy(key, family).agg(F.min(order).alias("__o"))
    families = seen.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__o", F.col(family).alias("f")))), lambda x: x["f"]).alias("families"))
    return counts.join(families, key, "left").withColumn("families", F.coalesce("families", F.array().cast("array<string>")))


def lead_evidence(records: DataFrame, key: str, label: str, sample: str, score: str, fingerprint: str, most: int) -> DataFrame:
    """The first lead records of a key as evidence: outside the sample first, then by score, then by fingerprint."""
    order = Window.partitionBy(key).orderBy(F.col(sample).cast("int"), F.desc(score), fingerprint)
    return records.filter(F.col(label) == "likely_relevant").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def history(results: DataFrame, parsers: DataFrame, key: str) -> DataFrame:
    """Snapshots of the results and of the parser as history: at most two rows a key, event_type and payload (JSON); a side with nothing to tell gives none."""
    rows = None
    for n, (side, name) in enumerate(((results, "result_layer_snapshot"), (parsers, "site_parser_snapshot"))):
        fields = [c for c in side.columns if c != key]
        kinds = dict(side.dtypes)
        told = F.coalesce(*[present(F.col(c), kinds[c]).cast("string") for c in fields]).isNotNull()
        part = side.filter(told).select(key, F.lit(n).alias("event_no"), F.lit(name).alias("event_type"), F.to_json(F.struct(*fields)).alias("payload"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def reprocess_inputs(refresh: DataFrame, plans: DataFrame, key: str) -> DataFrame:
    """What to process again: a key's refresh plans, and only where it has none its site plans. Columns key, input_type, payload (JSON)."""
    told = lambda df: df.filter(F.coalesce(*[present(F.col(c), dict(df.dtypes)[c]).cast("string") for c in df.columns if c != key]).isNotNull())
    shape = lambda df, name: df.select(key, F.lit(name).alias("input_type"), F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("payload"))
    first = told(refresh)
    return shape(first, "site_refresh_plan").unionByName(shape(told(plans).join(first.select(key).distinct(), key, "left_anti"), "site_plan"))


def crawl_counts(records: DataFrame, run: str, site: str, route: str, kind: str, fingerprint: str) -> DataFrame:
    """Raw and canonical (distinct fingerprint) pages and documents by run, by site and by route, in one pass; grain says which."""
    page, document = F.col(kind) == "page", F.col(kind) == "document"
    out = records.groupingSets([[run], [run, site], [run, site, route]], run, site, route).agg(
        F.grouping_id().alias("__g"), F.count_if(page).alias("raw_pages"), F.count_if(document).alias("raw_documents"),
        F.count_distinct(F.when(page, F.col(fingerprint))).alias("pages"), F.count_distinct(F.when(document, F.col(fingerprint))).alias("documents"),
    )
    return out.withColumn("grain", F.when(F.col("__g") == 0, "route").when(F.col("__g") == 1, "site").otherwise("run")).drop("__g")


def merge_crawls(parts: DataFrame, key: str, order: str, families: str, pages: str, documents: str, dry_run: str, embargo: str) -> DataFrame:
    """Parts of a crawl as one: sums of pages and documents, families in order of first sight, dry_run if all were, trust_embargo if any had."""
    sums = parts.groupBy(key).agg(F.count(F.lit(1)).alias("n_parts"), F.sum(F.coalesce(pages, F.lit(0))).alias("page_records"), F.sum(F.coalesce(documents, F.lit(0))).alias("document_records"), F.bool_and(F.coalesce(dry_run, F.lit(False))).alias("dry_run"), F.bool_or(F.coalesce(embargo, F.lit(False))).alias("trust_embargo"))
    seen = parts.select(key, order, F.posexplode(families).alias("__i", "f")).filter(F.trim("f") != "").groupBy(key, "f").agg(F.min(F.struct(order, "__i")).alias("__o"))
    listed = seen.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__o", "f"))), lambda x: x["f"]).alias("visited_route_families"))
    return sums.join(listed, key, "left").withColumn("visited_route_families", F.coalesce("visited_route_families", F.array().cast("array<string>")))


def record_context(title: Column, content: Column, section: Column, url: Column, stop: Sequence[str]) -> Column:
    """What a record is matched on: its normal texts, all of them together, and the stems of their words without stop words."""
    normal = lambda c: F.lower(T.one_space(F.coalesce(c, F.lit(""))))
    path = normal(F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z]+://|#.*$", ""), r"[/_.?=&-]+", " "))
    parts = [normal(title), normal(content), normal(section), path]
    combined = F.array_join(F.filter(F.array(*parts), lambda p: p != ""), " ")
    words = F.filter(F.split(combined, r"(?U)[^\p{L}\p{N}]+"), lambda w: w != "")
    keys = F.array_sort(F.array_distinct(F.transform(F.filter(words, lambda w: ~w.isin(*stop)), T.stem)))
    return F.struct(parts[0].alias("title"), parts[1].alias("content"), parts[2].alias("section"), parts[3].alias("url_path"), combined.alias("combined"), keys.alias("keys"))


def compacted(df: DataFrame, limits: Sequence[Mapping[str, tuple[int | None, int | None]]], budget: int) -> DataFrame:
    """df with payload (JSON) and level: fields cut to (items of an array, characters of a text), by the first of the limits that fits the budget, else by the last.

    Arrays of texts take both limits; None leaves a side uncut. Fields without a limit stay as they are; blank ones go.
    """
    kinds = dict(df.dtypes)

    def cut(field: str, items: int | None, chars: int | None) -> Column:
        c = F.col(f"`{field}`")
        if kinds[field].startswith("array"):
            c = c if items is None else F.slice(c, 1, items)
            return F.filter(F.transform(c, lambda x: T.compact(x, chars)), lambda x: x != "") if chars is not None and kinds[field] == "array<string>" else c
        return c if chars is None else T.compact(c, chars)

    named = sorted({f for level in limits for f in level})
    made = [F.to_json(F.struct(*[present(cut(f, *level.get(f, (None, None))), kinds[f]).alias(f) for f in named])) for level in limits]
    fitting = F.coalesce(*[F.when(F.char_length(m) <= budget, F.struct(F.lit(i).alias("level"), m.alias("payload"))) for i, m in enumerate(made)], F.struct(F.lit(len(made) - 1).alias("level"), made[-1].alias("payload")))
    return df.withColumn("__c", fitting).select(*df.columns, "__c.level", "__c.payload")


def work_identity(boundary: Column, scope: Column, inn: Column, name: Column, row: Column, sites: Column, payload: Column, explicit: Sequence[str]) -> Column:
    """The fingerprint of a unit of work: for explicit boundaries of boundary, scope, company, hosts and domains alone, so that other edits don't change it; else of the whole payload."""
    blank = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    company = F.coalesce(F.concat(F.lit("inn:"), blank(inn)), F.concat(F.lit("name:"), F.lower(blank(name))), F.when(row > 0, F.concat(F.lit("row:"), row.cast("string"))), F.lit(""))
    known = lambda c: F.sort_array(F.array_distinct(F.filter(c, lambda x: x != "")))
    hosts = known(F.transform(F.coalesce(sites, F.array().cast("array<string>")), lambda s: F.coalesce(T.host(s), F.lit(""))))
    identity = F.struct(boundary.alias("execution_boundary"), scope.alias("scope"), company.alias("company_key"), hosts.alias("host_keys"), known(F.transform(hosts, T.registered_domain)).alias("domain_keys"))
    return F.sha2(F.when(boundary.isin(*explicit), F.to_json(identity)).otherwise(payload), 256)


def cast_profile(raw: Column, schema: DT.StructType) -> Column:
    """A JSON object as a struct of plain fields by tolerant casts: what can't be read is null, unknown fields go; null for anything but an object."""
    given = F.from_json(raw, "map<string,string>", {"mode": "PERMISSIVE"})
    return F.when(given.isNotNull(), F.struct(*[F.try_element_at(given, F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in schema.fields]))


def assemble_profiles(base: DataFrame, key: str, sections: Mapping[str, DataFrame]) -> DataFrame:
    """base with each section as a struct (null where none of its fields is meaningful) and n_sections; a section frame has one row per key."""
    out = base
    for name, frame in sections.items():
        fields = [c for c in frame.columns if c != key]
        kinds = dict(frame.dtypes)
        told = F.coalesce(*[present(F.col(c), kinds[c]).cast("string") for c in fields]).isNotNull()
        out = out.join(frame.filter(told).select(key, F.struct(*fields).alias(name)), key, "left")
    return out.withColumn("n_sections", sum((F.col(n).isNotNull().cast("int") for n in sections), F.lit(0)))


def encode_records(df: DataFrame, key: str, version: str) -> DataFrame:
    """key and document: the other columns as a JSON object with its contract version."""
    return df.select(key, F.to_json(F.struct(F.lit(version).alias("contract_version"), *[c for c in df.columns if c != key]), {"ignoreNullFields": "false"}).alias("document"))


def decode_records(df: DataFrame, key: str, document: str, schema: DT.StructType, versions: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """key and the fields of schema from a document; an unknown version, broken JSON or a required field without a value is an error."""
    whole = DT.StructType([DT.StructField("contract_version", DT.StringType()), *schema.fields])
    read = df.select(key, F.from_json(document, whole).alias("d"))
    version = F.col("d.contract_version")
    good = F.coalesce(version.isin(*versions), F.lit(False))
    for c in required:
        good = good & F.col(f"d.{c}").isNotNull()
    wrong = F.concat(F.lit("no valid document of a known version under "), F.col(key).cast("string"))
    return read.filter(F.when(good, True).otherwise(F.raise_error(wrong).cast("boolean"))).select(key, *[f"d.{f.name}" for f in schema.fields])


def contact_key(kind: Column, value: Column) -> Column:
    """What two contacts of a kind agree on: digits of phones, lower-case e-mails and addresses, registered domains of sites; null if nothing is left."""
    low = F.lower(T.one_space(value))
    key = F.when(kind == "phone", T.digits(value)).when(kind == "email", low).when(kind == "website", T.registered_domain(T.host(value))).otherwise(low)
    return F.nullif(key, F.lit(""))


def contact_sources(wanted: DataFrame, found: DataFrame, entity: str, kind: str, value: str, source: str) -> DataFrame:
    """wanted with n_sources and first_source: of the sources that show the same contact of the entity, by contact_key; a site also counts where an e-mail is at its domain."""
    keyed = found.select(entity, kind, contact_key(F.col(kind), F.col(value)).alias("__key"), source)
    mailed = found.filter(F.col(kind) == "email").select(entity, F.lit("website").alias(kind), F.nullif(T.registered_domain(F.substring_index(F.col(value), "@", -1)), F.lit("")).alias("__key"), source)
    seen = keyed.unionByName(mailed).filter("__key is not null").groupBy(entity, kind, "__key").agg(F.count_distinct(source).alias("n_sources"), F.min(source).alias("first_source"))
    own = wanted.withColumn("__key", contact_key(F.col(kind), F.col(value)))
    return own.join(seen, [entity, kind, "__key"], "left").withColumn("n_sources", F.coalesce("n_sources", F.lit(0))).drop("__key")


def work_sync(handoffs: DataFrame, units: DataFrame, explicit: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """What becomes of the unit of work of each key handed off: explicit where execution rows say so, kept where the fingerprint is the same, else replaced or new; keys of explicit rows alone stay."""
    old = units.select(F.col(key).alias("__k"), F.col(fingerprint).alias("__f"))
    own = explicit.select(F.col(key).alias("__e"), F.col(fingerprint).alias("__ef"))
    joined = handoffs.select(key, fingerprint).join(own, F.col(key) == F.col("__e"), "full_outer").withColumn("__key", F.coalesce(key, "__e")).join(old, F.col("__key") == F.col("__k"), "left")
    action = F.when(F.col("__e").isNotNull(), "explicit").when(F.col("__k").isNull(), "new").when(F.col(fingerprint).eqNullSafe(F.col("__f")), "kept").otherwise("replaced")
    return joined.select(F.col("__key").alias(key), F.coalesce("__ef", fingerprint).alias(fingerprint), action.alias("action"))


def benchmark_records(records: DataFrame, identity: str, ok: Column, has_text: Column, relevance: Column, score: str, order: str, limit: int) -> DataFrame:
    """The first records for a benchmark, each identity once: successes first, then those with text, by relevance, score and order."""
    rank = F.struct(F.when(ok, 0).otherwise(1).alias("a"), F.when(has_text, 0).otherwise(1).alias("b"), relevance.alias("c"), (-F.col(score)).alias("d"), F.col(order).alias("e"))
    once = records.withColumn("__rank", rank).groupBy(identity).agg(F.min("__rank").alias("__rank"), F.min_by(order, "__rank").alias(order), F.min_by(score, "__rank").alias(score))
    return once.orderBy("__rank").limit(limit).drop("__rank")


def ordered_evidence(evidence: DataFrame, key: Sequence[str], weight: str, group: str, source: str, text: str, most: int) -> DataFrame:
    """The first pieces of evidence of a key, by weight, then group, source and text, with their place."""
    order = Window.partitionBy(*key).orderBy(F.desc(weight), group, source, text)
    return evidence.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def drain_rollup(spans: DataFrame, stage: str, queued: str, started: str, ended: str, item: str, most: int = 3) -> DataFrame:
    """Per stage: spans, total and longest wait and work in seconds, and the items of the longest spans."""
    wait, work = F.greatest(F.lit(0), F.col(started) - F.col(queued)), F.greatest(F.lit(0), F.col(ended) - F.col(started))
    sums = spans.groupBy(stage).agg(F.count(F.lit(1)).alias("n"), F.sum(wait).alias("waited"), F.max(wait).alias("longest_wait"), F.sum(work).alias("worked"), F.max(work).alias("longest_work"))
    ranked = spans.select(stage, item, (F.col(ended) - F.col(queued)).alias("__t")).withColumn("__k", F.row_number().over(Window.partitionBy(stage).orderBy(F.desc("__t"), item))).filter(F.col("__k") <= most)
    top = ranked.groupBy(stage).agg(F.transform(F.array_sort(F.collect_list(F.struct("__k", F.col(item).alias("i")))), lambda x: x["i"]).alias("slowest"))
    return sums.join(top, stage)


def region_report(places: DataFrame, bucket: str, region: str, inside: Column, most: int = 5) -> DataFrame:
    """Counts per bucket, and per region of the places inside a zone for the regions with most of them: part, name, n."""
    buckets = places.groupBy(F.col(bucket).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("bucket").alias("part"), "name", "n")
    regions = places.filter(inside).groupBy(F.col(region).alias("name")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name").limit(most)
    return buckets.unionByName(regions.select(F.lit("region").alias("part"), "name", "n"))


def first_present(results: DataFrame, key: str, order: str, fields: Sequence[str]) -> DataFrame:
    """Per key each field from the first of its results, in order, that has it."""
    kinds = dict(results.dtypes)
    has = {c: present(F.col(c), kinds[c]) for c in fields}
    return results.groupBy(key).agg(*[F.min_by(v, F.when(v.isNotNull(), F.col(order))).alias(c) for c, v in has.items()])


def distinct_items(items: Column) -> Column:
    """The items of an array once each, letter case and blanks aside, as they first stand."""
    shown = F.filter(F.transform(items, T.one_space), lambda x: x != "")
    low = F.transform(shown, F.lower)
    return F.filter(shown, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)


def bullets(items: Column, most: int, more: str = "+ {} more") -> Column:
    """The first items as lines with a bullet, and a line that counts the rest."""
    own = distinct_items(items)
    rest = F.size(own) - most
    lines = F.transform(F.slice(own, 1, most), lambda x: F.concat(F.lit("• "), x))
    left, right = more.split("{}")
    return F.array_join(F.when(rest > 0, F.array_append(lines, F.concat(F.lit(left), rest.cast("string"), F.lit(right)))).otherwise(lines), "\n")


def markdown_report(title: Column, sections: Sequence[tuple[str, Column]]) -> Column:
    """A report of an entity: a title and a heading with its text for each section that has any."""
    shown = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c), F.lit("")) != "", F.concat(F.lit(f"## {name}\n\n"), F.trim(c))) for name, c in sections]))
    return F.array_join(F.concat(F.array(F.concat(F.lit("# "), title)), shown), "\n\n")
