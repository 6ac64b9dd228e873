"""Queries over pages and documents: URLs, domains, sections, contacts, text functions, scores, entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T
from ..operators import consensus, entities, joins, scoring, selection


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Latin words for the driver's tables, which hold no Cyrillic.
WORDS = {"the": 1.0, "tion": 0.5, "and": 1.0, "ing": 0.25}
GROUPS = {"common": {"the": 1.0, "and": 1.0}, "ending": {"tion": 0.5, "ment": 0.5}, "rare": {"benchmark": 3.0}}
PAGE_HINTS = {"news": ("/news", "news."), "blog": ("/blog", "blog."), "shop": ("/shop", "/product"), "about": ("/about", "/contact")}


def url_registered_domain(spark, d):
    """The flagship: pages by host and registered domain, with the first normalised URL of each."""
    pages = table(spark, d, "pages").select("page_id", T.url(F.col("url")).alias("url"))
    hosts = pages.withColumn("host", T.host(F.col("url"))).withColumn("domain", T.registered_domain(F.col("host")))
    return hosts.groupBy("host", "domain").agg(F.count(F.lit(1)).alias("n_pages"), F.min_by("url", "page_id").alias("first_url"))


HOST_SQL = r"regexp_replace(regexp_replace(regexp_replace(regexp_extract(regexp_replace(lower(url), '^[a-z]+://', ''), '^([^/?#]*)', 1), '^[^@]*@', ''), ':\d+$', ''), '^www\.', '')"
URL_SQL = f"lower(regexp_extract(url, '(?i)^(https?)://', 1)) || '://' || {HOST_SQL} || rtrim(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/')"
DOMAIN_SQL = "CASE WHEN len(string_split(host, '.')) > 2 THEN string_split(host, '.')[-2] || '.' || string_split(host, '.')[-1] ELSE host END"
PAGES_SQL = f"(SELECT page_id, html, {URL_SQL} AS url, {HOST_SQL} AS host FROM pages)"


def section_guess_counts(spark, d):
    pages = table(spark, d, "pages").select("page_id", T.section(F.col("url")).alias("section"))
    return pages.groupBy("section").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page"))


def _section_sql():
    from ..functions import vocabulary as V

    ends = "|".join(e.replace(".", r"\.") for e in V.DOCUMENT_EXTENSIONS)
    whens = "".join(f" WHEN {' OR '.join(f'contains(lower(url), {m!r})' for m in marks)} THEN '{k}'" for k, marks in V.SECTION_HINTS.items())
    return f"CASE WHEN regexp_matches(regexp_extract(lower(url), '^([^?#]*)', 1), '({ends})$') THEN 'files'{whens} ELSE 'homepage' END"


def corporate_pages(spark, d):
    """Pages whose domain can be a company's, by predicate."""
    pages = table(spark, d, "pages").select("page_id", T.registered_domain(T.host(F.col("url"))).alias("domain"))
    return pages.groupBy("domain").agg(F.bool_and(T.is_corporate(F.col("domain"), ("example.net", "x.com"))).alias("corporate"), F.count(F.lit(1)).alias("n"))


def domain_resolution_rank(spark, d):
    """Hosts ranked within their registered domain as hints of different origin."""
    pages = table(spark, d, "pages").select("page_id", T.host(F.col("url")).alias("host"))
    origin = F.when(F.col("page_id") % 7 == 0, "input").when(F.col("page_id") % 3 == 0, "email").otherwise("site")
    hints = pages.select(T.registered_domain(F.col("host")).alias("entity"), F.col("host").alias("domain"), origin.alias("origin"), (F.col("page_id") % 5).alias("source"), F.concat(F.lit("https://"), "host").alias("url"), (F.col("page_id") % 3).alias("n_tokens"))
    return consensus.resolve_domains(hints, "entity", "domain", 6)


DOMAIN_RANK_SQL = f"""
WITH h AS (SELECT page_id, host, {DOMAIN_SQL} AS entity, CASE WHEN page_id % 7 = 0 THEN 'input' WHEN page_id % 3 = 0 THEN 'email' ELSE 'site' END AS origin FROM {PAGES_SQL}),
g AS (SELECT entity, host AS domain, bool_or(origin = 'input') AS by_input, count(DISTINCT CASE WHEN origin = 'site' THEN page_id % 5 END) AS n_sites,
             bool_or(origin = 'email') AS by_email, max(page_id % 3) AS n_tokens, 'https://' || host AS url FROM h GROUP BY entity, host),
c AS (SELECT *, round(least(0.99, CASE WHEN by_input THEN 0.83 ELSE 0 END + CASE WHEN n_sites > 0 THEN 0.32 ELSE 0 END + CASE WHEN by_email THEN 0.24 ELSE 0 END
             + CASE WHEN n_sites >= 2 THEN 0.2 ELSE 0 END + CASE WHEN n_sites > 0 AND by_email THEN 0.18 ELSE 0 END + least(0.16, n_tokens * 0.08)), 3)::DOUBLE AS confidence FROM g),
s AS (SELECT *, CASE WHEN NOT by_input AND n_sites = 0 AND n_tokens = 0 THEN 'rejected' WHEN by_input OR n_sites >= 2 OR (by_email AND n_tokens > 0 AND confidence >= 0.55) THEN 'verified'
             WHEN confidence >= 0.28 THEN 'candidate' ELSE 'rejected' END AS status FROM c)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY CASE status WHEN 'verified' THEN 0 WHEN 'candidate' THEN 1 ELSE 2 END, confidence DESC, url) AS rank FROM s) WHERE rank <= 6
"""


def email_extract(spark, d):
    docs = table(spark, d, "documents").select("doc_id", T.emails(F.col("text")).alias("found"))
    return docs.filter(F.size("found") > 0).select("doc_id", F.size("found").alias("n"), F.array_join(F.array_sort("found"), ",").alias("emails"), F.array_join(F.array_sort(F.array_compact(F.transform("found", T.email_site))), ",").alias("sites"))


def phone_candidates(spark, d):
    """Runs of digits that could be phones, with the digits alone; North American numbers by the same rule with another country."""
    found = entities.entity_values(table(spark, d, "documents"), "doc_id", "text", {"phone": r"\+?\d[\d ()-]{8,14}\d"})
    return found.select("doc_id", "pos", T.digits(F.col("value")).alias("digits"), T.phone(F.col("value"), "1", "1").alias("phone")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count("phone").alias("n_valid"), F.max("digits").alias("most"))


def whitespace_norm_len(spark, d):
    docs = table(spark, d, "documents")
    x = T.one_space(F.col("text"))
    return docs.select("doc_id", F.char_length(x).alias("n"), F.sha1(x.cast("binary")).alias("sha1"), T.compact(F.col("text"), 40).alias("head"))


def doc_fingerprint_dups(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("fingerprint"))
    return docs.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")


def keyword_score(spark, d):
    low = F.lower("text")
    return table(spark, d, "documents").select("doc_id", T.keyword_weight(low, WORDS).alias("score"), F.array_join(T.keyword_hits(low, [*WORDS]), ",").alias("hits"))


def relevance_score(spark, d):
    docs = table(spark, d, "documents")
    section = F.when(F.col("doc_id") % 4 == 0, "documents").when(F.col("doc_id") % 4 == 1, "about").when(F.col("doc_id") % 4 == 2, "news").otherwise("other")
    score, label = scoring.relevance(F.lit(""), F.lit(""), section, F.col("text"), GROUPS, {"ation": 2.0, "erre": 1.0}, {"ou": 1.0}, ["benchmark", "tion"])
    return docs.select("doc_id", score.alias("score"), label.alias("label"), F.coalesce(scoring.lead_family(F.lower("text"), GROUPS), F.lit("-")).alias("family"))


RELEVANCE_SQL = r"""
WITH d AS (SELECT doc_id, lower(text) AS low, CASE doc_id % 4 WHEN 0 THEN 'documents' WHEN 1 THEN 'about' WHEN 2 THEN 'news' ELSE 'other' END AS section, lower('  ' || CASE doc_id % 4 WHEN 0 THEN 'documents' WHEN 1 THEN 'about' WHEN 2 THEN 'news' ELSE 'other' END || ' ' || text) AS hay FROM documents),
k AS (SELECT *, contains(hay, 'the')::INT + contains(hay, 'and')::INT + 0.5 * contains(hay, 'tion')::INT + 0.5 * contains(hay, 'ment')::INT + 3 * contains(hay, 'benchmark')::INT
   + 0.5 * (2 * contains(hay, 'ation')::INT + contains(hay, 'erre')::INT) - contains(hay, 'ou')::INT + CASE section WHEN 'documents' THEN 1.5 WHEN 'news' THEN 0.5 ELSE 0 END
   + CASE WHEN regexp_matches(hay, '[0-9]{2}\.[0-9]{2}\.[0-9]{4}') THEN 0.8 ELSE 0 END AS total FROM d),
s AS (SELECT *, CASE WHEN section IN ('about', 'news') AND NOT contains(hay, 'benchmark') AND NOT contains(hay, 'tion') THEN least(0.25, round(least(1, greatest(0, total / 10)), 3)) ELSE round(least(1, greatest(0, total / 10)), 3) END::DOUBLE AS score FROM k),
f AS (SELECT *, contains(low, 'the')::INT + contains(low, 'and')::INT AS a, 0.5 * contains(low, 'tion')::INT + 0.5 * contains(low, 'ment')::INT AS b, 3 * contains(low, 'benchmark')::INT AS c FROM s)
SELECT doc_id, score, CASE WHEN score >= 0.7 THEN 'likely_relevant' WHEN score >= 0.35 THEN 'maybe_relevant' ELSE 'not_relevant' END AS label,
  CASE WHEN greatest(a, b, c) <= 0 THEN '-' WHEN a >= greatest(b, c) THEN 'common' WHEN b >= c THEN 'ending' ELSE 'rare' END AS family FROM f
"""


def pattern_group_caps(spark, d):
    """Signal groups by language as site: capped sums and the score."""
    groups = [("industrial_identity_positive", "ation", 0.05), ("product_or_process_positive", "ment", 0.11), ("generic_corporate_weak", "the", 0.03), ("dealer_negative", "worthless", 0.02), ("reseller_negative", "idiot", 0.02)]
    docs = table(spark, d, "documents").select("source", "lang", F.lower("text").alias("low"))
    hits = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(w)), F.struct(F.lit(g).alias("grp"), F.lit(x).alias("weight"))) for g, w, x in groups]))
    evidence = docs.select("source", "lang", F.explode(hits).alias("e")).select("source", "lang", "e.*")
    caps = {g: {"industrial_identity_positive": 0.35, "product_or_process_positive": 0.45, "generic_corporate_weak": 0.15, "dealer_negative": 0.55, "reseller_negative": 0.55}[g] for g, _, _ in groups}
    return scoring.signal_groups(evidence, ["source", "lang"], "grp", "weight", caps)


CAPS_SQL = """
WITH h AS (SELECT source, lang, lower(text) AS low FROM documents),
g AS (SELECT source, lang, count(*) FILTER (contains(low, 'ation')) AS a, count(*) FILTER (contains(low, 'ment')) AS b, count(*) FILTER (contains(low, 'the')) AS c, count(*) FILTER (contains(low, 'worthless')) AS e, count(*) FILTER (contains(low, 'idiot')) AS f
      FROM h WHERE contains(low, 'ation') OR contains(low, 'ment') OR contains(low, 'the') OR contains(low, 'worthless') OR contains(low, 'idiot') GROUP BY source, lang),
s AS (SELECT source, lang, round(least(0.35, a * 0.05), 3)::DOUBLE AS industrial_identity_positive, round(least(0.45, b * 0.11), 3)::DOUBLE AS product_or_process_positive, round(least(0.15, c * 0.03), 3)::DOUBLE AS generic_corporate_weak,
      round(least(0.55, e * 0.02), 3)::DOUBLE AS dealer_negative, round(least(0.55, f * 0.02), 3)::DOUBLE AS reseller_negative FROM g)
SELECT *, round(least(1, greatest(0, 0.15 + industrial_identity_positive + product_or_process_positive + generic_corporate_weak - dealer_negative - reseller_negative)), 3)::DOUBLE AS score FROM s
"""


def activity_verdicts(spark, d):
    groups = pattern_group_caps(spark, d)
    verdict = scoring.activity_verdict(F.col("score"), F.col("dealer_negative") + F.col("reseller_negative"), F.col("industrial_identity_positive"), F.col("product_or_process_positive"), F.lit(0.0), F.col("generic_corporate_weak"))
    return groups.select("source", "lang", "score", verdict.alias("verdict"))


VERDICT_SQL = f"""
WITH g AS ({CAPS_SQL}), n AS (SELECT *, dealer_negative + reseller_negative AS neg, industrial_identity_positive AS i, product_or_process_positive AS p FROM g)
SELECT source, lang, score, CASE WHEN (neg >= 0.55 AND score < 0.6) OR (neg >= 0.3 AND neg >= greatest(0.35, i + p - 0.1)) THEN 'mismatch'
  WHEN score >= 0.76 AND i >= 0.14 AND p >= 0.22 AND neg < 0.28 THEN 'strong' WHEN score >= 0.56 AND (i >= 0.14 OR p >= 0.18) AND neg < 0.4 THEN 'weak'
  WHEN score >= 0.32 OR generic_corporate_weak >= 0.06 THEN 'uncertain' ELSE 'mismatch' END AS verdict FROM n
"""


def top3_weighted_by_group(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select("lang", "quality", "doc_id", (F.least(F.col("n_chars"), F.lit(5000)) / 10000.0).alias("weight"))
    return scoring.top_weighted(rows, ["lang", "quality"], "weight", "doc_id", 0.85)


def site_authenticity(spark, d):
    """Authenticity of pages from what their HTML shows, all by arithmetic over flags."""
    pages = table(spark, d, "pages")
    html = F.lower("html")
    n_links = F.regexp_count(html, F.lit("<a "))
    viable = scoring.viability(F.lit(200), F.char_length("html"), n_links, html.contains("@"), html.contains("<title"), html.contains("404"), html.contains("captcha"))
    identity = F.when(html.contains("contact"), 0.9).when(html.contains("about"), 0.6).otherwise(0.3)
    score, status = scoring.authenticity(identity, viable, F.lit(0.5), F.when(html.contains("cookie"), 0.1).otherwise(0.0))
    return pages.select("page_id", viable.alias("viability"), score.alias("authenticity"), status.alias("status"), scoring.site_class(html.contains("react"), html.contains("bitrix"), F.char_length("html"), n_links).alias("site_class"))


AUTH_SQL = """
WITH p AS (SELECT page_id, lower(html) AS h, length(html) AS n, len(regexp_extract_all(lower(html), '<a ')) AS links FROM pages),
v AS (SELECT *, round(least(1, greatest(0, 0.2 + CASE WHEN n >= 1400 THEN 0.25 WHEN n >= 500 THEN 0.16 WHEN n >= 220 THEN 0.1 ELSE 0 END + CASE WHEN links >= 10 THEN 0.2 WHEN links >= 4 THEN 0.12 ELSE 0 END
  + 0.2 * contains(h, '@')::INT + 0.1 * contains(h, '<title')::INT - 0.45 * contains(h, '404')::INT - 0.2 * contains(h, 'captcha')::INT)), 3)::DOUBLE AS viability,
  CASE WHEN contains(h, 'contact') THEN 0.9 WHEN contains(h, 'about') THEN 0.6 ELSE 0.3 END AS identity FROM p),
a AS (SELECT *, round(least(1, greatest(0, identity::DOUBLE * 0.58::DOUBLE + viability * 0.22::DOUBLE + 0.1::DOUBLE - 0.1::DOUBLE * contains(h, 'cookie')::INT)), 3) AS authenticity FROM v)
SELECT page_id, viability, authenticity, CASE WHEN authenticity >= 0.75 AND identity >= 0.52 THEN 'verified' WHEN authenticity >= 0.55 THEN 'candidate' WHEN authenticity >= 0.3 THEN 'suspicious' ELSE 'rejected' END AS status,
  CASE WHEN contains(h, 'react') AND n < 500 THEN 'D' WHEN contains(h, 'react') THEN 'C' WHEN contains(h, 'bitrix') THEN 'B' WHEN n >= 1200 AND links >= 8 THEN 'A' WHEN n >= 350 OR links >= 3 THEN 'B' ELSE 'F' END AS site_class FROM a
"""


def route_families(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.lower("url").alias("path"), F.lower("html").alias("context"))
    return scoring.route_family(pages, ["page_id"], F.col("path"), F.col("context"), PAGE_HINTS).select("page_id", "family", "route_score")


def _route_sql():
    term = lambda marks: " + ".join(f"3.2 * contains(lower(url), '{m}')::INT + 2.4 * contains(lower(html), '{m}')::INT" for m in marks)
    names = [*PAGE_HINTS]
    whens = " ".join(f"WHEN {n} = greatest({', '.join(names)}) THEN '{n}'" for n in names)
    return f"WITH s AS (SELECT page_id, {', '.join(f'round({term(m)}, 1)::DOUBLE AS {n}' for n, m in PAGE_HINTS.items())} FROM pages) SELECT page_id, CASE WHEN greatest({', '.join(names)}) <= 0 THEN 'other' {whens} END AS family, greatest({', '.join(names)}) AS route_score FROM s"


def page_symptoms(spark, d):
    html = F.lower("html")
    codes = scoring.symptoms({"no_title": ~html.contains("<title"), "few_links": F.regexp_count(html, F.lit("<a ")) < 2, "scripted": html.contains("<script"), "form": html.contains("<form"), "short": F.char_length("html") < 800})
    return table(spark, d, "pages").select("page_id", F.array_join(codes, ",").alias("codes"), F.coalesce(F.get(codes, 0), F.lit("none")).alias("primary_code"))


SYMPTOM_SQL = """
WITH c AS (SELECT page_id, list_filter([CASE WHEN NOT contains(lower(html), '<title') THEN 'no_title' END, CASE WHEN len(regexp_extract_all(lower(html), '<a ')) < 2 THEN 'few_links' END, CASE WHEN contains(lower(html), '<script') THEN 'scripted' END,
  CASE WHEN contains(lower(html), '<form') THEN 'form' END, CASE WHEN length(html) < 800 THEN 'short' END], lambda x: x IS NOT NULL) AS l FROM pages)
SELECT page_id, array_to_string(l, ',') AS codes, coalesce(l[1], 'none') AS primary_code FROM c
"""


def entity_merge(spark, d):
    found = entities.entity_values(table(spark, d, "documents"), "doc_id", "text", {"email": entities.PATTERNS["email"], "ip": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"})
    return entities.merge_entities(found, "kind", "value", "doc_id", ["doc_id", "pos"])


ENTITY_SQL = r"""
WITH e AS (SELECT doc_id, 'email' AS kind, unnest(l) AS v, unnest(range(len(l))) AS pos FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') AS l FROM documents)
 UNION ALL SELECT doc_id, 'ip', unnest(l), unnest(range(len(l))) FROM (SELECT doc_id, regexp_extract_all(text, '\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}') AS l FROM documents)),
n AS (SELECT doc_id, kind, trim(lower(v), ' .,:;)') AS value, pos FROM e)
SELECT kind, value, (min((doc_id, pos)))[1] AS first_doc_id, (min((doc_id, pos)))[2]::INT AS first_pos, count(DISTINCT doc_id) AS n_holders, count(*) AS n_mentions FROM n WHERE value <> '' GROUP BY kind, value
"""


def entity_evidence(spark, d):
    """Entities with offsets and snippets, which SQL has no words for."""
    return entities.entity_snippets(table(spark, d, "documents"), "doc_id", "text")


def conversation_excerpt(spark, d):
    return entities.excerpt(table(spark, d, "conversations"), "conv_id", "turn", "text", ["please", "price", "tion", "how"])


def inverted_index_lookup(spark, d):
    """Documents that share four or more longer words with a benchmark item, and the best item of each."""
    split = lambda c: F.filter(F.split(F.lower(c), "[^a-z]+"), lambda t: F.char_length(t) >= 9)
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    pairs = joins.token_lookup(docs, "doc_id", split(F.col("text")), items, "item_id", split(F.col("text")), 4)
    return joins.best_lookup(pairs, "doc_id", "item_id", [F.desc("n_shared")])


LOOKUP_SQL = """
WITH a AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS t FROM documents), b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{9,}')) AS t FROM benchmark),
p AS (SELECT doc_id, item_id, count(*) AS n FROM a JOIN b USING (t) GROUP BY 1, 2 HAVING count(*) >= 4),
r AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY n DESC) AS k FROM p)
SELECT doc_id, min(item_id) AS item_id, count(*) > 1 AS ambiguous FROM r WHERE k = 1 GROUP BY doc_id
"""


def stem_key_match(spark, d):
    words = table(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("word")).filter(F.char_length("word") >= 6)
    stems = words.select("doc_id", T.stem(F.col("word")).alias("stem"))
    return stems.groupBy("stem").agg(F.count_distinct("doc_id").alias("n_docs"), F.min("doc_id").alias("first_doc")).filter("n_docs >= 5")


STEM_SQL = """
WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN length(w) >= 12 THEN left(w, 10) WHEN length(w) >= 9 THEN left(w, 8) ELSE left(w, 6) END AS stem FROM w WHERE length(w) >= 6)
SELECT stem, count(DISTINCT doc_id) AS n_docs, min(doc_id) AS first_doc FROM s GROUP BY stem HAVING count(DISTINCT doc_id) >= 5
"""


def frequent_terms(spark, d):
    return selection.frequent_terms(table(spark, d, "documents"), "text", "doc_id", 50)


TERMS_SQL = """
WITH w AS (SELECT doc_id, unnest(l) AS t, unnest(range(len(l))) AS p FROM (SELECT doc_id, string_split_regex(lower(text), '[^a-z]+') AS l FROM documents))
SELECT t AS term, count(*) AS n FROM w WHERE length(t) >= 4 GROUP BY t ORDER BY n DESC, min((doc_id, p)) LIMIT 50
"""


def date_guess(spark, d):
    text = F.concat_ws(" ", F.lit("issued"), F.date_format("o_orderdate", "dd.MM.yyyy"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    iso = F.concat(F.lit("on "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" as agreed"))
    return table(spark, d, "orders").select("o_orderkey", T.date_guess(F.when(F.col("o_orderkey") % 2 == 0, text).otherwise(iso)).alias("guess"))


def valid_inn_sample(spark, d):
    """Order keys spelled as ten-digit ids, kept where the check digit fits."""
    orders = table(spark, d, "orders").select("o_orderkey", F.lpad((F.col("o_orderkey") * 7919 + 1000000007).cast("string"), 10, "7").alias("inn"))
    return orders.filter(T.valid_inn(F.col("inn")))


INN_SQL = """
WITH o AS (SELECT o_orderkey, lpad((o_orderkey * 7919 + 1000000007)::VARCHAR, 10, '7') AS inn FROM orders),
d AS (SELECT *, list_transform(range(1, 11), lambda i: substr(inn, i, 1)::INT) AS g FROM o)
SELECT o_orderkey, inn FROM d WHERE length(inn) = 10 AND (2*g[1] + 4*g[2] + 10*g[3] + 3*g[4] + 5*g[5] + 9*g[6] + 4*g[7] + 6*g[8] + 8*g[9]) % 11 % 10 = g[10]
"""


def name_token_signal(spark, d):
    from ..operators import geo

    parts = table(spark, d, "part").select("p_partkey", T.name_tokens(F.col("p_name"), 4).alias("tokens"))
    return parts.select("p_partkey", F.array_join(F.array_sort("tokens"), " ").alias("tokens"), geo.name_signal(F.col("tokens"), ["al", "st"], ["co", "br"]).alias("signal"))


NAME_SQL = """
WITH t AS (SELECT p_partkey, list_filter(list_distinct(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}]+')), lambda x: length(x) >= 4) AS l FROM part)
SELECT p_partkey, array_to_string(list_sort(l), ' ') AS tokens, CASE WHEN len(list_filter(l, lambda x: regexp_matches(x, '^(al|st)'))) > 0 THEN 3 WHEN len(list_filter(l, lambda x: regexp_matches(x, '^(co|br)'))) > 0 THEN 1 ELSE 0 END AS signal FROM t
""".replace("\\\\", "\\")


def greedy_batch(spark, d):
    """Part names of a brand, in order, packed into batches of 200 characters."""
    return scoring.greedy_batch_counts(table(spark, d, "part"), "p_brand", "p_name", "p_partkey", 200)


BATCH_SQL = """
WITH RECURSIVE p AS (SELECT p_brand, length(p_name) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part),
f AS (SELECT p_brand, k, n AS open, 1 AS batches, n AS longest FROM p WHERE k = 1
  UNION ALL SELECT p.p_brand, p.k, CASE WHEN f.open + 1 + p.n <= 200 THEN f.open + 1 + p.n ELSE p.n END, f.batches + (f.open + 1 + p.n > 200)::INT, greatest(f.longest, CASE WHEN f.open + 1 + p.n <= 200 THEN f.open + 1 + p.n ELSE p.n END) FROM f JOIN p ON p.p_brand = f.p_brand AND p.k = f.k + 1)
SELECT p_brand, arg_max(batches, k)::INT AS n_batches, arg_max(longest, k)::INT AS longest FROM f GROUP BY 1
"""


def usage_cost(spark, d):
    prices = ("0.75", "0.075", "4.50")
    ev = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("stage"), (F.col("l_quantity") * 100).cast("bigint").alias("i"), (F.col("l_quantity") * 30).cast("bigint").alias("c"), F.col("l_linenumber").cast("bigint").alias("o"))
    return ev.groupBy("stage").agg(F.sum(N.usage_cost(F.col("i"), F.col("c"), F.col("o"), prices)).cast("double").alias("cost"), F.count(F.lit(1)).alias("n"))


COST_SQL = """
WITH e AS (SELECT l_returnflag AS stage, (l_quantity * 100)::BIGINT AS i, (l_quantity * 30)::BIGINT AS c, l_linenumber::BIGINT AS o FROM lineitem)
SELECT stage, sum(round(((i - least(c, i)) * 0.75::DECIMAL(10,4) + least(c, i) * 0.075::DECIMAL(10,4) + o * 4.5::DECIMAL(10,4))::DECIMAL(24,4)::DOUBLE / 1000000, 8)::DECIMAL(30,8))::DOUBLE AS cost, count(*) AS n FROM e GROUP BY stage
"""

QUERIES = {f.__name__: f for f in (
    url_registered_domain, section_guess_counts, corporate_pages, domain_resolution_rank, email_extract, phone_candidates, whitespace_norm_len, doc_fingerprint_dups, keyword_score, relevance_score, pattern_group_caps, activity_verdicts,
    top3_weighted_by_group, site_authenticity, route_families, page_symptoms, entity_merge, entity_evidence, conversation_excerpt, inverted_index_lookup, stem_key_match, frequent_terms, date_guess, valid_inn_sample, name_token_signal, greedy_batch, usage_cost,
)}
ORACLES = {
    "greedy_batch": BATCH_SQL,
    "url_registered_domain": f"SELECT host, {DOMAIN_SQL} AS domain, count(*) AS n_pages, arg_min(url, page_id) AS first_url FROM {PAGES_SQL} GROUP BY host, domain",
    "section_guess_counts": f"SELECT {_section_sql()} AS section, count(*) AS n, min(page_id) AS first_page FROM pages GROUP BY 1",
    "corporate_pages": f"SELECT {DOMAIN_SQL} AS domain, bool_and({DOMAIN_SQL} NOT IN ('example.net', 'x.com') AND contains({DOMAIN_SQL}, '.')) AS corporate, count(*) AS n FROM {PAGES_SQL} GROUP BY 1",
    "domain_resolution_rank": DOMAIN_RANK_SQL,
    "email_extract": r"""WITH e AS (SELECT doc_id, list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), lambda x: trim(lower(x), ' .,:;'))) AS l FROM documents)
SELECT doc_id, len(l) AS n, array_to_string(list_sort(l), ',') AS emails, array_to_string(list_sort(list_transform(list_filter(l, lambda x: string_split(x, '@')[-1] NOT IN ('gmail.com', 'googlemail.com', 'mail.ru', 'bk.ru', 'inbox.ru', 'list.ru', 'yandex.ru', 'ya.ru', 'yandex.com', 'rambler.ru', 'lenta.ru', 'icloud.com', 'outlook.com', 'hotmail.com', 'live.com', 'yahoo.com', 'proton.me', 'protonmail.com', 'ru.net')), lambda x: 'https://' || string_split(x, '@')[-1])), ',') AS sites FROM e WHERE len(l) > 0""",
    "whitespace_norm_len": r"WITH n AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM documents) SELECT doc_id, length(x) AS n, sha1(x) AS sha1, CASE WHEN length(x) > 40 THEN rtrim(left(x, 39)) || '…' ELSE x END AS head FROM n",
    "doc_fingerprint_dups": "SELECT sha1(text) AS fingerprint, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1",
    "keyword_score": "SELECT doc_id, (contains(lower(text), 'the')::INT + 0.5 * contains(lower(text), 'tion')::INT + contains(lower(text), 'and')::INT + 0.25 * contains(lower(text), 'ing')::INT)::DOUBLE AS score, array_to_string(list_filter(['the', 'tion', 'and', 'ing'], lambda w: contains(lower(text), w)), ',') AS hits FROM documents",
    "relevance_score": RELEVANCE_SQL, "pattern_group_caps": CAPS_SQL, "activity_verdicts": VERDICT_SQL,
    "top3_weighted_by_group": "WITH r AS (SELECT lang, quality, doc_id, least(n_chars, 5000) / 10000.0::DOUBLE AS w FROM documents JOIN labels USING (doc_id)), k AS (SELECT *, row_number() OVER (PARTITION BY lang, quality ORDER BY w DESC, doc_id) AS k FROM r) SELECT lang, quality, round(least(0.85, sum(CASE WHEN k = 1 THEN w ELSE w * 0.4 END)), 3)::DOUBLE AS score, count(*) AS n_used FROM k WHERE k <= 3 GROUP BY lang, quality",
    "site_authenticity": AUTH_SQL, "route_families": _route_sql(), "page_symptoms": SYMPTOM_SQL, "entity_merge": ENTITY_SQL, "inverted_index_lookup": LOOKUP_SQL, "stem_key_match": STEM_SQL, "frequent_terms": TERMS_SQL,
    "date_guess": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS guess FROM orders", "valid_inn_sample": INN_SQL, "name_token_signal": NAME_SQL, "usage_cost": COST_SQL,
}
