"""Queries for dossiers: breakers, city look-up, payloads, references, summaries, codecs, identities, and functions over built texts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as DT

from ..functions import addresses as A
from ..functions import numbers as N
from ..functions import text as T
from ..operators import dossiers as D
from ..operators import geo, joins, profiles, records, scoring, selection, timeline
from .contacts import DOMAIN_SQL, HOST_SQL, URL_SQL


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def breaker_class():
    """Event types as block classes."""
    k, v = F.col("event_type"), F.col("value")
    hard = F.when((k == "error") & (F.col("user_id") % 2 == 0), "HARD_BAN").when(k == "error", "RATE_LIMIT").when(k == "signup", "CHALLENGE_LOOP")
    return F.when(k == "purchase", "SUCCESS").otherwise(hard.when((k == "view") & (v > 80), "SHADOW_THROTTLE").when((k == "click") & (v < 20), "AUTH_REQUIRED"))


def breaker_ledger(spark, d):
    """The last state of each user's breaker; event types stand for block classes."""
    ev = table(spark, d, "events").select("user_id", "event_id", F.floor(N.wall_seconds("ts")).alias("at"), "event_type", "value")
    states = timeline.breaker_ledger(ev, ["user_id"], "event_id", "at", breaker_class(), F.when(F.col("event_id") % 2 == 0, "bot_gate"))
    last = F.struct("mode", F.col("cooldown_until").cast("bigint").alias("cooldown_until"), *[c for c in states.columns if c.startswith("n_")])
    return states.groupBy("user_id").agg(F.max_by(last, "event_id").alias("s"), F.count_if(F.col("mode") == "paused").alias("n_paused")).select("user_id", "s.*", "n_paused")


BREAKER_SQL = """
WITH c AS (SELECT user_id, event_id, floor(epoch_us(ts) / 1e6)::BIGINT AS t, CASE WHEN event_type = 'purchase' THEN 'SUCCESS' WHEN event_type = 'error' AND user_id % 2 = 0 THEN 'HARD_BAN' WHEN event_type = 'error' THEN 'RATE_LIMIT' WHEN event_type = 'signup' THEN 'CHALLENGE_LOOP'
    WHEN event_type = 'view' AND value > 80 THEN 'SHADOW_THROTTLE' WHEN event_type = 'click' AND value < 20 THEN 'SOFT_BLOCK' END AS c FROM events),
i AS (SELECT *, sum((c = 'SUCCESS')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM c WHERE c IS NOT NULL),
n AS (SELECT *, sum((c = 'RATE_LIMIT')::INT) OVER w AS r, sum((c = 'SHADOW_THROTTLE')::INT) OVER w AS s, sum((c = 'SOFT_BLOCK')::INT) OVER w AS o, sum((c = 'HARD_BAN')::INT) OVER w AS h, sum((c = 'CHALLENGE_LOOP')::INT) OVER w AS l FROM i WINDOW w AS (PARTITION BY user_id, k ORDER BY event_id)),
u AS (SELECT *, CASE c WHEN 'RATE_LIMIT' THEN t + 30 * pow(2, least(r - 1, 3)) WHEN 'SHADOW_THROTTLE' THEN t + 45 * pow(2, least(s - 1, 3)) WHEN 'HARD_BAN' THEN t + 180 * pow(2, least(h - 1, 3)) WHEN 'CHALLENGE_LOOP' THEN t + 300 * l
    WHEN 'SOFT_BLOCK' THEN CASE WHEN event_id % 2 = 0 THEN t + 20 * o END END AS e FROM n),
m AS (SELECT *, coalesce(max(e) OVER (PARTITION BY user_id, k ORDER BY event_id), 0)::BIGINT AS until, greatest(least(r, 2), least(s, 2), least(o, 2), least(h, 3), CASE WHEN l >= 2 THEN 3 WHEN l = 1 THEN 2 ELSE 0 END) AS step FROM u),
f AS (SELECT *, ['normal', 'conservative', 'survival', 'paused'][(step + 1)::BIGINT] AS mode FROM m)
SELECT user_id, arg_max(mode, event_id) AS mode, arg_max(until, event_id) AS cooldown_until, arg_max(r, event_id)::BIGINT AS n_rate_limit, arg_max(s, event_id)::BIGINT AS n_shadow_throttle, arg_max(o, event_id)::BIGINT AS n_soft_block,
  arg_max(h, event_id)::BIGINT AS n_hard_ban, arg_max(l, event_id)::BIGINT AS n_challenge_loop, count(*) FILTER (mode = 'paused') AS n_paused FROM f GROUP BY user_id
"""


def city_lookup(spark, d):
    """Regions as cities of two municipalities, nations as their localities; region 3 differs in its buckets, so it stays ambiguous."""
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    place = lambda of, i, s, m, b, w, dist: of.select(i.alias("place_id"), s.alias("settlement"), m.alias("municipality"), F.col("r_name").alias("region"), b.alias("bucket"), w.alias("weight"), F.lit(False).alias("outer"), F.lit(False).alias("inner"), dist.cast("double").alias("distance"), F.lit(0).alias("priority"), F.lit(1).alias("n_variants"))
    r, n = F.col("r_regionkey"), F.col("n_nationkey")
    core = F.when(r == 3, "core").otherwise("outside")
    places = place(region, F.concat(F.lit("n"), r.cast("string")), F.col("r_name"), F.lit("north side"), F.lit("outside"), F.lit(0), r * 10)
    places = places.unionByName(place(region, F.concat(F.lit("s"), r.cast("string")), F.col("r_name"), F.lit("south side"), core, F.when(r == 3, 5).otherwise(0), r * 10 + 4))
    places = places.unionByName(place(nation.join(region, F.col("n_regionkey") == r), F.concat(F.lit("l"), n.cast("string")), F.col("n_name"), F.lit("old district"), F.lit("outside"), F.lit(1), n))
    aliases = places.select("place_id", F.col("settlement").alias("alias"))
    home = table(spark, d, "customer").join(nation, F.col("c_nationkey") == n).join(region, F.col("n_regionkey") == r)
    k = F.col("c_custkey") % 5
    address = F.when(k == 0, F.concat(F.col("r_name"), F.lit(", street 1"))).when(k == 1, F.concat(F.col("r_name"), F.lit(" / "), F.lower("n_name"), F.lit("; 7"))).when(k == 2, F.col("n_name")).when(k == 3, F.lit("nowhere at all"))
    return geo.city_lookup(home.select("c_custkey", address.alias("address")), "c_custkey", "address", places, aliases)


CITY_SQL = """
WITH h AS (SELECT c_custkey, c_custkey % 5 AS k, n_name, n_nationkey, r_name, r_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
t AS (SELECT *, CASE WHEN k = 3 THEN 'not_found' WHEN k = 4 THEN 'no_address' WHEN k = 0 AND r_regionkey = 3 THEN 'ambiguous' ELSE 'matched' END AS match, k = 0 AND r_regionkey <> 3 AS city, k IN (1, 2) AS place FROM h)
SELECT c_custkey, match, CASE WHEN city THEN r_name WHEN place THEN n_name END AS settlement, CASE WHEN city THEN '' WHEN place THEN 'old district' END AS municipality, CASE WHEN city OR place THEN r_name END AS region,
  CASE WHEN city OR place THEN 'outside' END AS bucket, CASE WHEN city THEN 0 WHEN place THEN 1 END AS weight, CASE WHEN city THEN r_regionkey * 10 + 2.0 WHEN place THEN n_nationkey END::DOUBLE AS distance,
  CASE WHEN city THEN 2 WHEN place THEN 1 END::BIGINT AS n_variants, CASE WHEN city THEN 4.0 END::DOUBLE AS spread FROM t
"""


def review_queue(spark, d):
    k = F.col("o_orderkey")
    status = F.when(k % 4 == 0, "candidate").when(k % 4 == 1, "suspicious").when(k % 4 == 2, "verified")
    score = (k % 100) / 100.0
    return table(spark, d, "orders").select("o_orderkey", scoring.needs_review(status, score, k % 3 == 0, k % 5 == 0, k % 7 == 0).alias("site"), scoring.record_needs_review(F.when(k % 2 == 0, "maybe_relevant")).alias("record"))


REVIEW_SQL = """
SELECT o_orderkey, o_orderkey % 4 < 2 AND (o_orderkey % 100) / 100.0 < 0.82 AND NOT (o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0) AND NOT (o_orderkey % 5 = 0 AND (o_orderkey % 100) / 100.0 >= 0.62) AS site, o_orderkey % 2 = 0 AS record FROM orders
"""


def offline_notes(spark, d):
    k = F.col("c_custkey")
    notes = F.array(F.lit("mode=live"), F.col("c_mktsegment"), F.lit("stale"), F.lit("x"), F.col("c_mktsegment"))
    found = D.offline_notes(F.when(k % 5 != 0, notes), F.lit("offline file=s.json"), "mode=", "stale", k % 2 == 0)
    return table(spark, d, "customer").select("c_custkey", F.array_join(found, "|").alias("notes"))


def stage_payloads(spark, d):
    pages = table(spark, d, "pages").withColumn("entity", F.col("page_id") % 10)
    found = pages.filter(F.col("page_id") % 3 == 0).select("entity", "url", "page_id", F.when(F.col("page_id") % 2 == 0, F.lit(" search  hit ")).alias("source"), F.lit("candidate").alias("status"), (F.col("page_id") / 7.0).alias("confidence"))
    return D.site_payloads(pages, "entity", "url", "page_id", found, "source", "status", "confidence")


PAYLOAD_SQL = f"""
WITH p AS (SELECT page_id, page_id % 10 AS entity, url AS site_url FROM (SELECT page_id, {URL_SQL} AS url FROM pages)),
c AS (SELECT entity, site_url, arg_min(CASE WHEN page_id % 2 = 0 THEN 'search hit' END, page_id) AS source, min(page_id) AS m FROM p WHERE page_id % 3 = 0 GROUP BY 1, 2),
f AS (SELECT entity, site_url, CASE WHEN m % 2 = 0 THEN 'search hit' END AS source, round(m / 7.0, 3)::DOUBLE AS confidence FROM c)
SELECT p.entity, p.site_url, row_number() OVER (PARTITION BY p.entity ORDER BY page_id) AS selection_rank, coalesce(f.source, 'merged_contacts') AS selection_source, CASE WHEN f.entity IS NOT NULL THEN 'candidate' END AS candidate_status, f.confidence
FROM p LEFT JOIN f ON f.entity = p.entity AND f.site_url = p.site_url
"""


def deep_parse_pick(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("u"), F.col("o_orderkey").cast("string"))).otherwise("").alias("url"), (F.col("o_orderstatus") == "F").alias("belongs"))
    return D.deep_parse_pick(rows, "o_custkey", "url", "belongs", "o_orderkey")


def _refs(spark, d, found):
    """Customers refer to suppliers by number and by nation, as records do to evidence by locator and URL."""
    k = F.col("c_custkey")
    wants = table(spark, d, "customer").select("c_custkey", F.lit(0).alias("ord"), F.concat(F.lit("s"), (k % 150).cast("string")).alias("locator"), F.when(k % 2 == 0, F.col("c_nationkey").cast("string")).alias("url"), F.when(k % 3 == 0, "odd").when(k % 3 == 1, "unknown").alias("kind"))
    s = F.col("s_suppkey")
    evidence = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("s"), s.cast("string")).alias("locator"), F.col("s_nationkey").cast("string").alias("url"), F.when(s % 2 == 1, "odd").otherwise("even").alias("kind"))
    return found(wants, "c_custkey", "ord", "locator", "url", "kind", evidence, "s_suppkey")


REFS_SQL = """
SELECT c_custkey, s_suppkey, row_number() OVER (PARTITION BY c_custkey ORDER BY p, s_suppkey) AS ref_no FROM (SELECT c_custkey, s_suppkey, CASE WHEN c_custkey % 150 = s_suppkey THEN 0 ELSE 1 END AS p FROM customer JOIN supplier
  ON (c_custkey % 150 = s_suppkey OR (c_custkey % 2 = 0 AND c_nationkey = s_nationkey)) AND (c_custkey % 3 <> 0 OR s_suppkey % 2 = 1))
"""


def evidence_refs(spark, d):
    return _refs(spark, d, D.resolve_refs)


def procedure_rebind(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise(" ").alias("title"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("state"))
    return D.rebind(rows, "c_custkey", "o_orderkey", ["title", "state"], _refs(spark, d, D.count_refs), "s_suppkey")


REBIND_SQL = f"""
WITH r AS (SELECT c_custkey, count(*) AS n_refs, arg_min(s_suppkey, ref_no) AS first_ref FROM ({REFS_SQL}) GROUP BY 1),
p AS (SELECT o_custkey AS c_custkey, arg_min(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 = 0) AS title, arg_min(o_orderstatus, o_orderkey) FILTER (o_orderkey % 2 = 0) AS state FROM orders GROUP BY 1)
SELECT c_custkey, title, state, coalesce(n_refs, 0) AS n_refs, first_ref FROM p LEFT JOIN r USING (c_custkey) WHERE title IS NOT NULL OR state IS NOT NULL OR n_refs > 0
"""


def _records(spark, d):
    k = F.col("doc_id")
    return table(spark, d, "documents").select("doc_id", "source", F.when(k % 2 == 0, "page").otherwise("document").alias("kind"), F.col("lang").alias("family"), F.sha1(F.col("text").cast("binary")).alias("fingerprint"), F.when(k % 3 == 0, "likely_relevant").when(k % 3 == 1, "maybe_relevant").otherwise("not_relevant").alias("label"), (k % 5 == 0).alias("sample"), (k % 11).alias("score"))


def record_summary(spark, d):
    found = D.record_summary(_records(spark, d), "source", "doc_id", "kind", "family", "fingerprint", "label", "sample")
    return found.withColumn("families", F.array_join("families", ","))


SUMMARY_SQL = """
WITH r AS (SELECT doc_id, source, doc_id % 2 = 0 AS page, lang, sha1(text) AS f, doc_id % 3 AS l, doc_id % 5 = 0 AS sample FROM documents),
c AS (SELECT source, count(*) AS record_count, count(*) FILTER (page) AS page_records, count(*) FILTER (NOT page) AS document_records, count(DISTINCT CASE WHEN l < 2 THEN f END) AS n_relevant, count(DISTINCT CASE WHEN NOT sample THEN f END) AS n_non_sample, count(*) FILTER (l = 0 AND NOT sample) AS non_sample_evidence FROM r GROUP BY 1),
g AS (SELECT source, string_agg(lang, ',' ORDER BY m) AS families FROM (SELECT source, lang, min(doc_id) AS m FROM r WHERE l = 0 AND coalesce(lang, '') <> '' GROUP BY 1, 2) GROUP BY 1)
SELECT c.*, coalesce(g.families, '') AS families FROM c LEFT JOIN g ON c.source IS NOT DISTINCT FROM g.source
"""


def lead_evidence(spark, d):
    return D.lead_evidence(_records(spark, d), "source", "label", "sample", "score", "fingerprint", 5).select("source", "place", "fingerprint", "score")


EVIDENCE_SQL = """
WITH r AS (SELECT source, sha1(text) AS fingerprint, doc_id % 11 AS score, row_number() OVER (PARTITION BY source ORDER BY (doc_id % 5 = 0)::INT, doc_id % 11 DESC, sha1(text)) AS place FROM documents WHERE doc_id % 3 = 0) SELECT source, place, fingerprint, score FROM r WHERE place <= 5
"""


def history_events(spark, d):
    k = F.col("c_custkey")
    rows = table(spark, d, "customer")
    results = rows.select("c_custkey", F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("status"), F.when(k % 4 == 0, F.col("c_name")).alias("notes"))
    parsers = rows.select("c_custkey", F.when(k % 3 == 0, F.col("c_nationkey").cast("string")).alias("route"))
    return D.history(results, parsers, "c_custkey")


HISTORY_SQL = """
SELECT c_custkey, 0 AS event_no, 'result_layer_snapshot' AS event_type, '{"status":"' || c_mktsegment || '"' || CASE WHEN c_custkey % 4 = 0 THEN ',"notes":"' || c_name || '"' ELSE '' END || '}' AS payload FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, 1, 'site_parser_snapshot', '{"route":"' || c_nationkey || '"}' FROM customer WHERE c_custkey % 3 = 0
"""


def reprocess_inputs(spark, d):
    k = F.col("c_custkey")
    rows = table(spark, d, "customer")
    refresh = rows.filter(k % 2 == 0).select("c_custkey", F.when(k % 4 == 0, F.col("c_mktsegment")).alias("cadence"))
    return D.reprocess_inputs(refresh, rows.select("c_custkey", F.col("c_name").alias("site")), "c_custkey")


def crawl_counts(spark, d):
    pages = table(spark, d, "pages").select(F.lit("run").alias("run"), T.host(F.col("url")).alias("site"), T.section(F.col("url")).alias("route"), F.when(F.col("page_id") % 4 == 0, "document").otherwise("page").alias("kind"), F.sha1(F.left("html", F.lit(60)).cast("binary")).alias("fingerprint"))
    return D.crawl_counts(pages, "run", "site", "route", "kind", "fingerprint")


def _crawl_sql():
    from .contacts import _section_sql

    return f"""
WITH p AS (SELECT 'run' AS run, host AS site, {_section_sql()} AS route, page_id % 4 = 0 AS doc, sha1(left(html, 60)) AS f FROM (SELECT page_id, html, url, {HOST_SQL} AS host FROM pages))
SELECT run, site, route, CASE WHEN grouping(site) = 1 THEN 'run' WHEN grouping(route) = 1 THEN 'site' ELSE 'route' END AS grain, count(*) FILTER (NOT doc) AS raw_pages, count(*) FILTER (doc) AS raw_documents, count(DISTINCT CASE WHEN NOT doc THEN f END) AS pages, count(DISTINCT CASE WHEN doc THEN f END) AS documents
FROM p GROUP BY GROUPING SETS ((run), (run, site), (run, site, route))"""


def crawl_merge(spark, d):
    k = F.col("o_orderkey")
    parts = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.array("o_orderstatus", F.lit(" "), F.substring("o_orderpriority", 1, 1)).alias("families"), (k % 7).alias("pages"), F.when(k % 2 == 0, k % 3).alias("documents"), (k % 5 != 0).alias("dry_run"), (k % 9 == 0).alias("embargo"))
    found = D.merge_crawls(parts, "o_custkey", "o_orderkey", "families", "pages", "documents", "dry_run", "embargo")
    return found.withColumn("visited_route_families", F.array_join("visited_route_families", ","))


CRAWL_SQL = """
WITH p AS (SELECT o_custkey, o_orderkey AS k, o_orderstatus AS a, left(o_orderpriority, 1) AS b FROM orders),
f AS (SELECT o_custkey, f, min((k, i)) AS m FROM (SELECT o_custkey, k, 0 AS i, a AS f FROM p UNION ALL SELECT o_custkey, k, 2, b FROM p) GROUP BY 1, 2),
l AS (SELECT o_custkey, string_agg(f, ',' ORDER BY m) AS visited_route_families FROM f GROUP BY 1)
SELECT o_custkey, count(*) AS n_parts, sum(o_orderkey % 7)::BIGINT AS page_records, coalesce(sum(o_orderkey % 3) FILTER (o_orderkey % 2 = 0), 0)::BIGINT AS document_records, bool_and(o_orderkey % 5 <> 0) AS dry_run, bool_or(o_orderkey % 9 = 0) AS trust_embargo, any_value(visited_route_families) AS visited_route_families
FROM orders JOIN l USING (o_custkey) GROUP BY 1
"""


def record_context(spark, d):
    pages = table(spark, d, "pages")
    found = D.record_context(F.regexp_extract("html", r"(?i)<title[^>]*>([^<]*)</title>", 1), F.lit(None).cast("string"), T.section(F.col("url")), F.col("url"), ["http", "the", "and"])
    return pages.select("page_id", found.alias("c")).select("page_id", F.sha1(F.col("c.combined").cast("binary")).alias("sha1"), F.array_join("c.keys", " ").alias("keys"))


def _context_sql():
    from .contacts import _section_sql

    return rf"""
WITH p AS (SELECT page_id, lower(trim(regexp_replace(regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1), '[\s\x1C-\x1F\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}\x0B]+', ' ', 'g'))) AS t, {_section_sql()} AS s, lower(trim(regexp_replace(regexp_replace(regexp_replace(url, '^[A-Za-z]+://|#.*$', '', 'g'), '[/_.?=&-]+', ' ', 'g'), '\s+', ' ', 'g'))) AS u FROM pages),
c AS (SELECT page_id, array_to_string(list_filter([t, s, u], lambda x: x <> ''), ' ') AS combined FROM p),
w AS (SELECT page_id, combined, list_filter(string_split_regex(combined, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '' AND x NOT IN ('http', 'the', 'and')) AS ws FROM c)
SELECT page_id, sha1(combined) AS sha1, array_to_string(list_sort(list_distinct(list_transform(ws, lambda x: CASE WHEN length(x) >= 12 THEN left(x, 10) WHEN length(x) >= 9 THEN left(x, 8) WHEN length(x) >= 6 THEN left(x, 6) ELSE x END))), ' ') AS keys FROM w"""


def payload_budget(spark, d):
    """Order lines of a part's name and type as a payload within 90 characters, by the second limits where the first don't fit."""
    rows = table(spark, d, "part").select("p_partkey", F.array("p_name", "p_brand", "p_type").alias("items"), F.concat_ws(" ", "p_name", "p_brand", "p_type", "p_name").alias("title"))
    return D.compacted(rows, [{"items": (2, 10), "title": (None, 24)}, {"items": (1, 8), "title": (None, 12)}], 56).select("p_partkey", "level", "payload")


PAYLOAD_BUDGET_SQL = """
WITH p AS (SELECT p_partkey, [p_name, p_brand, p_type] AS l, p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_name AS t FROM part),
c AS (SELECT p_partkey, list_transform(l[1:2], lambda x: CASE WHEN length(x) > 10 THEN rtrim(left(x, 9)) || '…' ELSE x END) AS a, list_transform(l[1:1], lambda x: CASE WHEN length(x) > 8 THEN rtrim(left(x, 7)) || '…' ELSE x END) AS b,
  CASE WHEN length(t) > 24 THEN rtrim(left(t, 23)) || '…' ELSE t END AS s, CASE WHEN length(t) > 12 THEN rtrim(left(t, 11)) || '…' ELSE t END AS u FROM p),
j AS (SELECT p_partkey, '{"items":["' || array_to_string(a, '","') || '"],"title":"' || s || '"}' AS x, '{"items":["' || array_to_string(b, '","') || '"],"title":"' || u || '"}' AS y FROM c)
SELECT p_partkey, CASE WHEN length(x) <= 56 THEN 0 ELSE 1 END AS level, CASE WHEN length(x) <= 56 THEN x ELSE y END AS payload FROM j
"""


def work_identity(spark, d):
    k = F.col("page_id")
    url = F.col("url")
    found = D.work_identity(F.when(k % 3 == 0, "deep_parse").otherwise("handoff"), F.lit("site"), F.when(k % 2 == 0, k.cast("string")), F.when(k % 5 == 0, F.lit(" Some Name ")), k.cast("int"), F.array(url, F.lit("http://b.example.org/x"), url), F.concat(F.lit("p"), k.cast("string")), ["deep_parse"])
    return table(spark, d, "pages").select("page_id", found.alias("fingerprint"))


IDENTITY_SQL = f"""
WITH h AS (SELECT page_id, {HOST_SQL} AS host FROM pages), g AS (SELECT *, {DOMAIN_SQL} AS domain FROM h),
c AS (SELECT *, CASE WHEN page_id % 2 = 0 THEN 'inn:' || page_id WHEN page_id % 5 = 0 THEN 'name:some name' WHEN page_id > 0 THEN 'row:' || page_id ELSE '' END AS company, list_sort(list_distinct([host, 'b.example.org'])) AS hs, list_sort(list_distinct([domain, 'example.org'])) AS ds FROM g)
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN sha256('{{"execution_boundary":"deep_parse","scope":"site","company_key":"' || company || '","host_keys":["' || array_to_string(hs, '","') || '"],"domain_keys":["' || array_to_string(ds, '","') || '"]}}') ELSE sha256('p' || page_id) END AS fingerprint FROM c
"""
PROFILE = DT.StructType([DT.StructField("k", DT.IntegerType()), DT.StructField("type", DT.StringType()), DT.StructField("value", DT.DoubleType()), DT.StructField("day", DT.DateType())])


def profile_cast(spark, d):
    k = F.col("event_id")
    raw = F.concat(F.lit('{"k": "'), F.when(k % 3 == 0, F.lit("many")).otherwise((k % 50).cast("string")), F.lit('", "type": "'), F.col("event_type"), F.lit('", "value": '), F.when(k % 2 == 0, (k % 10).cast("string")).otherwise("null"), F.lit(', "day": "'), F.when(k % 4 == 0, F.lit("2024-02-30")).otherwise("2024-02-28"), F.lit('", "more": 1}'))
    found = D.cast_profile(F.when(k % 13 != 0, raw).otherwise("no object"), PROFILE)
    return table(spark, d, "events").select("event_id", found.alias("p")).select("event_id", F.col("p").isNotNull().alias("read"), "p.*")


def profile_assembly(spark, d):
    base = table(spark, d, "customer").select("c_custkey", "c_name")
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderpriority").alias("priority"))
    money = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"), F.when(F.col("c_custkey") % 2 == 0, F.lit(" ")).alias("note"))
    found = D.assemble_profiles(base, "c_custkey", {"orders": orders, "money": money})
    return found.select("c_custkey", "c_name", "orders.n_orders", "orders.priority", "money.balance", F.col("n_sections").cast("int").alias("n_sections"))


ASSEMBLY_SQL = """
WITH o AS (SELECT o_custkey, count(*) AS n_orders, max(o_orderpriority) AS priority FROM orders GROUP BY 1)
SELECT c_custkey, c_name, n_orders, priority, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance, (n_orders IS NOT NULL)::INT + (c_acctbal > 0)::INT AS n_sections FROM customer LEFT JOIN o ON c_custkey = o_custkey
"""


def record_codec(spark, d):
    """Orders as documents and back: the same values."""
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("status"), "o_totalprice", F.array("o_orderpriority", "o_orderstatus").alias("tags"))
    schema = DT.StructType([f for f in rows.schema.fields if f.name != "o_orderkey"])
    found = D.decode_records(D.encode_records(rows, "o_orderkey", "v1"), "o_orderkey", "document", schema, ["v1"], ["o_totalprice"])
    return found.withColumn("tags", F.array_join("tags", "|"))


def text_functions(spark, d):
    """Slugs, snippets, lists of sites, merged maps and explanations over the names of parts."""
    k, name = F.col("p_partkey"), F.col("p_name")
    merged = records.merge_maps(F.create_map(F.lit("a"), F.when(k % 2 == 0, name).otherwise(""), F.lit("b"), F.lit("x")), F.create_map(F.lit("a"), F.lit("other"), F.lit("c"), F.col("p_brand")))
    weights = {"x": (k % 3) / 10.0, "y": (k % 5) / 10.0, "z": F.lit(0.0)}
    sites = T.split_sites(F.concat(name, F.lit(" | "), F.col("p_brand"), F.lit(", ,"), F.col("p_type")))
    return table(spark, d, "part").select(
        "p_partkey", T.slug(F.concat(F.lit(" "), name, F.lit("  #"), F.col("p_brand"))).alias("slug"), F.array_join(sites, ";").alias("sites"), F.array_join(F.array(*[F.coalesce(merged[c], F.lit("-")) for c in "abc"]), ";").alias("merged"),
        profiles.explanation(weights).alias("why"), T.tables_text(F.array(F.array(F.array(name, F.col("p_brand")), F.array(F.col("p_type"))))).alias("rows"), F.array_join(records.distinct_longest(F.array(name, F.col("p_type"), F.concat(name, F.lit(" s")), F.lit(""))), ";").alias("longest"),
    )


TEXT_SQL = r"""
SELECT p_partkey, regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g') AS slug, p_name || ';' || p_brand || ';' || p_type AS sites, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE 'other' END || ';x;' || p_brand AS merged,
  CASE WHEN p_partkey % 3 = 0 AND p_partkey % 5 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN 'x 0.' || (p_partkey % 3) || '00' WHEN p_partkey % 3 = 0 THEN 'y 0.' || (p_partkey % 5) || '00'
       WHEN p_partkey % 3 >= p_partkey % 5 THEN 'x 0.' || (p_partkey % 3) || '00, y 0.' || (p_partkey % 5) || '00' ELSE 'y 0.' || (p_partkey % 5) || '00, x 0.' || (p_partkey % 3) || '00' END AS why,
  p_name || ' | ' || p_brand || chr(10) || p_type AS rows, CASE WHEN contains(lower(p_name || ' s'), lower(p_type)) THEN '' ELSE p_type || ';' END || p_name || ' s' AS longest FROM part
"""


def address_functions(spark, d):
    """Components, cleaning and look-up form of addresses built from orders."""
    k = F.col("o_orderkey")
    house = F.concat(F.lit("г. Город, ул. Лесная, д. "), (k % 90 + 1).cast("string"))
    address = F.concat(F.lpad((k % 900_000 + 100_000).cast("string"), 6, "0"), F.lit(", обл, "), F.when(k % 2 == 0, house).otherwise("р-н Дальний, село Ёлкино"), F.when(k % 3 == 0, F.lit(" тел. 123")).otherwise(""))
    rows = table(spark, d, "orders").select("o_orderkey", address.alias("a"))
    return rows.select("o_orderkey", F.array_join(A.components(F.col("a")), ",").alias("parts"), A.sanitize(F.col("a")).alias("address"), A.lookup_text(F.col("a")).alias("lookup"))


ADDRESS_SQL = """
WITH a AS (SELECT o_orderkey, (o_orderkey % 900000 + 100000)::VARCHAR AS z, (o_orderkey % 90 + 1)::VARCHAR AS h, o_orderkey % 2 = 0 AS city, o_orderkey % 3 = 0 AS phone FROM orders)
SELECT o_orderkey, CASE WHEN city THEN 'postal,region,city,street,house' ELSE 'postal,region,district,settlement' END AS parts, z || CASE WHEN city THEN ', обл, г. Город, ул. Лесная, д. ' || h ELSE ', обл, р-н Дальний, село Ёлкино' END AS address,
  z || CASE WHEN city THEN ' область город город ул лесная д ' || h ELSE ' область район дальний село елкино' END || CASE WHEN phone THEN ' тел 123' ELSE '' END AS lookup FROM a
"""


def geo_gate(spark, d):
    """Rows that a geo gate admits, in the order of a queue."""
    k = F.col("c_custkey")
    ok = geo.admitted(F.when(k % 4 == 0, "core").when(k % 4 == 1, "outer").when(k % 4 == 2, "outside"), k % 3 != 0, ["core", "outer"])
    return table(spark, d, "customer").select("c_custkey", ok.alias("admitted"))


def known_contacts(spark, d):
    """How many of a customer's known values the orders show, for customers on both sides."""
    left = table(spark, d, "customer").select("c_custkey", F.array(F.lit("O"), (F.col("c_custkey") % 5 + 1).cast("string")).alias("known"))
    right = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_union(F.collect_set("o_orderstatus"), F.collect_set(F.substring("o_orderpriority", 1, 1))).alias("seen"))
    return joins.overlap(left, right, "c_custkey", ["known"], ["seen"])


def term_matches(spark, d):
    """Which documents have a term: its phrase, or all its stem keys among the document's."""
    low = F.lower("text")
    tokens = F.array_distinct(F.transform(F.split(low, "[^a-z]+"), T.stem))
    docs = table(spark, d, "documents").select("doc_id", low.alias("low"), tokens.alias("tokens"))
    return docs.select("doc_id", joins.term_match(F.col("low"), F.col("tokens"), F.lit("of the"), F.array(F.lit("and"), F.lit("was"))).alias("has"))


def legacy_fill(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select("p_partkey", F.when(k % 2 == 0, F.col("p_name")).otherwise(" ").alias("name"), F.col("p_brand").alias("old_name"))
    return profiles.back_fill(rows, {"name": "old_name"}).select("p_partkey", "name")


def ready_queue(spark, d):
    """The first 40 of a queue: ready rows before others, each kind first in, first out; and a seeded sample is as large as asked."""
    rows = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("ready"))
    return selection.ready_first(rows, "ready", "o_orderkey").limit(40)


def activity_code_list(spark, d):
    k = F.col("p_partkey")
    text = F.concat(F.lit("main: "), (k % 80 + 10).cast("string"), F.lit(".11 - "), F.col("p_name"), F.lit("; 62.0"), (k % 10).cast("string"), F.lit(" "), F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", F.explode(records.activity_codes(text)).alias("c")).select("p_partkey", "c.code", "c.label")


def contact_sources(spark, d):
    """Mail addresses and sites of customers, and the suppliers of the same tenth that show them."""
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    mail = lambda n, at: F.concat(F.lit("User"), n.cast("string"), F.lit(at))
    wanted = table(spark, d, "customer").select((k % 10).alias("entity"), F.when(k % 2 == 0, "email").otherwise("website").alias("kind"), F.when(k % 2 == 0, mail(F.col("c_nationkey"), "@One.example.org")).otherwise(F.concat(F.lit("https://www.n"), F.col("c_nationkey").cast("string"), F.lit(".org/x"))).alias("value"), "c_custkey")
    found = table(spark, d, "supplier").select((s % 10).alias("entity"), F.lit("email").alias("kind"), F.when(s % 2 == 0, mail(F.col("s_nationkey"), "@one.example.org")).otherwise(F.concat(F.lit("a@mail.n"), F.col("s_nationkey").cast("string"), F.lit(".org"))).alias("value"), F.concat(F.lit("s"), (s % 3).cast("string")).alias("source"))
    return D.contact_sources(wanted, found, "entity", "kind", "value", "source").select("c_custkey", "n_sources", "first_source")


CONTACT_SQL = """
WITH w AS (SELECT c_custkey, c_custkey % 10 AS e, c_custkey % 2 = 0 AS mail, c_nationkey AS n FROM customer),
f AS (SELECT s_suppkey % 10 AS e, s_suppkey % 2 = 0 AS mail, s_nationkey AS n, count(DISTINCT s_suppkey % 3) AS c, min('s' || (s_suppkey % 3)) AS first FROM supplier GROUP BY 1, 2, 3)
SELECT c_custkey, coalesce(c, 0) AS n_sources, first AS first_source FROM w LEFT JOIN f USING (e, mail, n)
"""


def work_sync(spark, d):
    k = F.col("o_orderkey")
    orders = table(spark, d, "orders")
    handoffs = orders.filter(k % 5 != 0).select("o_orderkey", F.col("o_orderstatus").alias("fp"))
    units = orders.filter(k % 2 == 0).select("o_orderkey", F.when(k % 4 == 0, F.col("o_orderstatus")).otherwise("X").alias("fp"))
    return D.work_sync(handoffs, units, orders.filter(k % 7 == 0).select("o_orderkey", F.lit("E").alias("fp")), "o_orderkey", "fp")


SYNC_SQL = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'E' ELSE o_orderstatus END AS fp, CASE WHEN o_orderkey % 7 = 0 THEN 'explicit' WHEN o_orderkey % 2 = 1 THEN 'new' WHEN o_orderkey % 4 = 0 OR o_orderstatus = 'X' THEN 'kept' ELSE 'replaced' END AS action
FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 7 = 0
"""


def benchmark_records(spark, d):
    k = F.col("doc_id")
    docs = table(spark, d, "documents").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("identity"), "n_chars")
    return D.benchmark_records(docs, "identity", k % 3 == 0, F.col("n_chars") > 200, k % 4, "n_chars", "doc_id", 40)


def ordered_evidence(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", (F.col("l_quantity") % 7).cast("int").alias("weight"), F.col("l_returnflag").alias("grp"), F.col("l_orderkey").alias("source"), F.col("l_linenumber").alias("text"))
    return D.ordered_evidence(rows, ["l_suppkey"], "weight", "grp", "source", "text", 4)


def drain_rollup(spark, d):
    at = F.floor(N.wall_seconds("ts"))
    rows = table(spark, d, "events").select("event_type", "event_id", at.alias("q"), (at + F.floor(F.col("value"))).alias("s"), (at + F.floor(F.col("value") * 3)).alias("e"))
    return D.drain_rollup(rows, "event_type", "q", "s", "e", "event_id").withColumn("slowest", F.array_join(F.col("slowest").cast("array<string>"), ","))


DRAIN_SQL = """
WITH s AS (SELECT event_type, event_id, floor(value)::BIGINT AS w, floor(value * 3)::BIGINT AS t FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY t DESC, event_id) AS k FROM s)
SELECT event_type, count(*) AS n, sum(w)::BIGINT AS waited, max(w) AS longest_wait, sum(t - w)::BIGINT AS worked, max(t - w) AS longest_work, string_agg(event_id::VARCHAR, ',' ORDER BY k) FILTER (k <= 3) AS slowest FROM r GROUP BY 1
"""


def region_report(spark, d):
    rows = table(spark, d, "customer").select(F.when(F.col("c_custkey") % 3 == 0, "core").otherwise("outside").alias("bucket"), F.col("c_nationkey").cast("string").alias("region"))
    return D.region_report(rows, "bucket", "region", F.col("bucket") == "core", 5)


def company_metadata(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(k % 3 == 0, F.col("o_orderpriority")).otherwise(" ").alias("name"), F.when(k % 4 == 0, F.array("o_orderstatus")).otherwise(F.array().cast("array<string>")).alias("codes"))
    return D.first_present(rows, "o_custkey", "o_orderkey", ["name", "codes"]).withColumn("codes", F.array_join("codes", ","))


def report_texts(spark, d):
    k = F.col("p_partkey")
    items = F.array("p_name", F.upper("p_name"), F.col("p_brand"), F.lit(" "), F.col("p_type"))
    return table(spark, d, "part").select("p_partkey", D.markdown_report(F.col("p_name"), [("Items", D.bullets(items, 2)), ("Size", F.when(k % 2 == 0, F.col("p_size").cast("string")))]).alias("report"))


def deferred_outcomes(spark, d):
    k, v = F.col("event_id"), F.col("event_type")
    source, access = F.when(k % 2 == 0, "a").otherwise("b"), F.when(k % 3 == 0, "direct").when(k % 3 == 1, "proxy").otherwise("session")
    status = F.when(v == "error", "request_error").when(v == "view", "http_503").when(v == "click", "blocked").when(v == "signup", "guest").otherwise("http_403")
    detail = F.when(k % 5 == 0, " Read  timed out ").when(k % 5 == 1, "no route")
    found = records.outcome_class(source, access, status, detail, k % 7, records.deferred_cap(F.lit(150)), ["blocked", "captcha"], ("http_503",), {"a": ["http_403"]}, {"a": ["read timed"]})
    fast = records.fails_fast(source, F.when(k % 11 != 0, status).otherwise(" "), access, ["a"], ["ok"], ["http_403"], ["blocked"])
    return table(spark, d, "events").select("event_id", found.alias("outcome"), fast.alias("fails_fast"), records.first_text(detail, F.lit(" "), v).alias("shown"))


OUTCOME_SQL = """
WITH e AS (SELECT event_id AS k, event_type AS v, event_id % 2 = 0 AS a, ['direct', 'proxy', 'session'][(event_id % 3 + 1)::INT] AS access, CASE event_type WHEN 'error' THEN 'request_error' WHEN 'view' THEN 'http_503' WHEN 'click' THEN 'blocked' WHEN 'signup' THEN 'guest' ELSE 'http_403' END AS s, event_id % 5 = 0 AS timed FROM events),
x AS (SELECT *, a AND s = 'blocked' AND access = 'direct' AND timed AS excused, (s = 'request_error' AND timed) OR s = 'http_503' OR (a AND s = 'http_403' AND timed) AS passing FROM e)
SELECT k AS event_id, CASE WHEN (s = 'blocked' OR (access <> 'direct' AND s = 'guest')) AND NOT excused THEN 'systemic_stop' WHEN NOT excused AND NOT passing THEN 'non_defer_fail_fast' WHEN k % 7 >= 3 THEN 'systemic_stop' ELSE 'deferred_row_transient' END AS outcome,
  CASE WHEN NOT a THEN false WHEN k % 11 = 0 THEN true WHEN access = 'direct' AND s = 'http_403' THEN false ELSE s <> 'guest' OR access <> 'direct' END AS fails_fast, CASE WHEN timed THEN 'Read timed out' WHEN k % 5 = 1 THEN 'no route' ELSE v END AS shown FROM x
"""

QUERIES = {f.__name__: f for f in (
    breaker_ledger, city_lookup, review_queue, offline_notes, stage_payloads, deep_parse_pick, evidence_refs, procedure_rebind, record_summary, lead_evidence, history_events, reprocess_inputs, crawl_counts, crawl_merge, record_context,
    payload_budget, work_identity, profile_cast, profile_assembly, record_codec, text_functions, address_functions, geo_gate, known_contacts, term_matches, legacy_fill, ready_queue, activity_code_list, contact_sources, work_sync, benchmark_records, ordered_evidence, drain_rollup,
    region_report, company_metadata, report_texts, deferred_outcomes,
)}
ORACLES = {
    "contact_sources": CONTACT_SQL, "work_sync": SYNC_SQL, "drain_rollup": DRAIN_SQL, "deferred_outcomes": OUTCOME_SQL,
    "benchmark_records": "WITH r AS (SELECT doc_id, sha1(text) AS identity, n_chars, (CASE WHEN doc_id % 3 = 0 THEN 0 ELSE 1 END, CASE WHEN n_chars > 200 THEN 0 ELSE 1 END, doc_id % 4, -n_chars, doc_id) AS k FROM documents), o AS (SELECT identity, arg_min(doc_id, k) AS doc_id, arg_min(n_chars, k) AS n_chars, min(k) AS k FROM r GROUP BY 1) SELECT identity, doc_id, n_chars FROM o ORDER BY k LIMIT 40",
    "ordered_evidence": "SELECT * FROM (SELECT l_suppkey, (l_quantity % 7)::INT AS weight, l_returnflag AS grp, l_orderkey AS source, l_linenumber AS text, row_number() OVER (PARTITION BY l_suppkey ORDER BY (l_quantity % 7)::INT DESC, l_returnflag, l_orderkey, l_linenumber) AS place FROM lineitem) WHERE place <= 4",
    "region_report": "SELECT 'bucket' AS part, CASE WHEN c_custkey % 3 = 0 THEN 'core' ELSE 'outside' END AS name, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT * FROM (SELECT 'region', c_nationkey::VARCHAR AS name, count(*) AS n FROM customer WHERE c_custkey % 3 = 0 GROUP BY 2 ORDER BY n DESC, name LIMIT 5)",
    "company_metadata": "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 = 0) AS name, arg_min(o_orderstatus, o_orderkey) FILTER (o_orderkey % 4 = 0) AS codes FROM orders GROUP BY 1",
    "report_texts": "SELECT p_partkey, '# ' || p_name || chr(10) || chr(10) || '## Items' || chr(10) || chr(10) || '• ' || p_name || chr(10) || '• ' || p_brand || chr(10) || '+ 1 more' || CASE WHEN p_partkey % 2 = 0 THEN chr(10) || chr(10) || '## Size' || chr(10) || chr(10) || p_size ELSE '' END AS report FROM part",
    "breaker_ledger": BREAKER_SQL, "city_lookup": CITY_SQL, "review_queue": REVIEW_SQL, "stage_payloads": PAYLOAD_SQL, "evidence_refs": REFS_SQL, "procedure_rebind": REBIND_SQL, "record_summary": SUMMARY_SQL, "lead_evidence": EVIDENCE_SQL,
    "history_events": HISTORY_SQL, "crawl_counts": _crawl_sql(), "crawl_merge": CRAWL_SQL, "record_context": _context_sql(), "payload_budget": PAYLOAD_BUDGET_SQL, "work_identity": IDENTITY_SQL, "profile_assembly": ASSEMBLY_SQL, "text_functions": TEXT_SQL, "address_functions": ADDRESS_SQL,
    "offline_notes": "SELECT c_custkey, 'mode=offline file=s.json' || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '|stale' END || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '|' || c_mktsegment || '|x' END AS notes FROM customer",
    "deep_parse_pick": "SELECT o_custkey, 'u' || arg_min(o_orderkey, (o_orderstatus <> 'F', o_orderkey)) AS url FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1",
    "reprocess_inputs": """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'site_refresh_plan' ELSE 'site_plan' END AS input_type, CASE WHEN c_custkey % 4 = 0 THEN '{"cadence":"' || c_mktsegment || '"}' ELSE '{"site":"' || c_name || '"}' END AS payload FROM customer""",
    "profile_cast": "SELECT event_id, event_id % 13 <> 0 AS read, CASE WHEN event_id % 13 <> 0 AND event_id % 3 <> 0 THEN event_id % 50 END::INT AS k, CASE WHEN event_id % 13 <> 0 THEN event_type END AS type, CASE WHEN event_id % 13 <> 0 AND event_id % 2 = 0 THEN event_id % 10 END::DOUBLE AS value, CASE WHEN event_id % 13 <> 0 AND event_id % 4 <> 0 THEN DATE '2024-02-28' END AS day FROM events",
    "record_codec": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status, o_totalprice, o_orderpriority || '|' || o_orderstatus AS tags FROM orders",
    "geo_gate": "SELECT c_custkey, NOT (c_custkey % 4 = 2 AND c_custkey % 3 <> 0) AS admitted FROM customer",
    "known_contacts": "SELECT c_custkey, bool_or(o_orderstatus = 'O')::INT + bool_or(left(o_orderpriority, 1) = (c_custkey % 5 + 1)::VARCHAR)::INT AS n_known FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1",
    "term_matches": "WITH w AS (SELECT doc_id, lower(text) AS low, string_split_regex(lower(text), '[^a-z]+') AS ws FROM documents) SELECT doc_id, contains(low, 'of the') OR (list_contains(ws, 'and') AND list_contains(ws, 'was')) AS has FROM w",
    "legacy_fill": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_brand END AS name FROM part",
    "ready_queue": "SELECT o_orderkey, o_orderstatus = 'F' AS ready FROM orders ORDER BY ready DESC, o_orderkey LIMIT 40",
    "activity_code_list": "SELECT p_partkey, (p_partkey % 80 + 10) || '.11' AS code, p_name AS label FROM part UNION ALL SELECT p_partkey, '62.0' || (p_partkey % 10), p_type FROM part",
}
