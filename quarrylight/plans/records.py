"""Queries for the record-level rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import records as R
from ..operators import scoring
from .contacts import DOMAIN_SQL, HOST_SQL


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lead_cards(spark, d):
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select("doc_id", "source", "lang", (k % 9).alias("day"), F.col("text").alias("title"), F.when(k % 2 == 0, "about").otherwise("news").alias("section"), F.when(k % 3 == 0, "likely_relevant").when(k % 3 == 1, "maybe_relevant").otherwise("not_relevant").alias("label"), F.col("n_chars").alias("score"))
    return R.lead_cards(rows, "source", "lang", "day", "title", "section", "label", "score", "doc_id").select("doc_id")


def route_budget(spark, d):
    url = F.lower("url")
    rows = table(spark, d, "pages").select("page_id", T.registered_domain(T.host(url)).alias("site"), T.host(url).alias("host"), F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1).alias("path"), F.col("url").alias("address"))
    scored = scoring.route_family(rows, ["page_id"], F.col("path"), F.lower("address"), {"news": ("news",), "blog": ("blog",), "item": ("item", "product")})
    return R.rank_routes(scored.drop("address"), "site", "family", "host", "path", "route_score").groupBy("site", "outcome").agg(F.count(F.lit(1)).alias("n"))


def distinct_sites(spark, d):
    return R.site_counts(table(spark, d, "pages").select("page_id", "url", (F.col("page_id") % 10).alias("g")), "g", "url", "page_id")


def keyword_terms(spark, d):
    terms = R.parse_terms(F.lit("the, [is of]2; tion*, anhathe"))
    return table(spark, d, "documents").select("doc_id", F.array_join(R.term_hits(F.col("text"), terms), "|").alias("hits"))


def batch_statuses(spark, d):
    k, v = F.col("event_id"), F.col("event_type")
    rows = table(spark, d, "events").select("user_id", R.tender_status(v == "error", k % 7 != 0, k % 5 == 0, (k % 3)).alias("status"))
    return R.combine_batches(rows, "user_id", "status")


STATUS_SQL = """
WITH s AS (SELECT user_id, CASE WHEN event_type = 'error' THEN 'error' WHEN event_id % 7 = 0 THEN 'not_applied' WHEN event_id % 5 = 0 THEN 'registration_limited' WHEN event_id % 3 = 0 THEN 'zero' ELSE 'visible' END AS s FROM events)
SELECT user_id, CASE WHEN bool_or(s = 'error') AND NOT bool_and(s = 'error') THEN 'partial_error' WHEN bool_and(s = 'error') THEN 'error' WHEN bool_or(s = 'visible') THEN 'visible' WHEN bool_or(s IN ('not_applied', 'registration_limited')) THEN 'review' ELSE 'all_zero' END AS status, count(*) AS n_batches FROM s GROUP BY 1
"""


def response_parse(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, F.to_json(F.struct(F.from_json("props", "k int").alias("parsed")))).when(F.col("event_id") % 4 == 1, F.lit('{"refusal": "no"}')).when(F.col("event_id") % 4 == 2, F.concat(F.lit("so "), "props", F.lit(" it is"))).otherwise(F.lit("")).alias("raw"))
    return R.parse_response(rows, "raw").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count("answer").alias("n_answers"))


def work_ledger(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id", F.when(F.col("event_id") % 6 == 0, "ack").otherwise("pending").alias("kind"))
    return R.work_ledger(rows, ["user_id", "event_type"], "event_id", "kind")


def deferred_ledger(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return R.deferred_ledger(rows, "user_id", "event_type", "event_id", F.col("value") > 20)


DEFERRED_SQL = """
WITH l AS (SELECT user_id, event_type, CASE WHEN arg_max(value > 20, event_id) THEN 'resolved' ELSE 'unresolved' END AS resolution FROM events GROUP BY 1, 2),
k AS (SELECT event_type, max(event_id) FILTER (value > 20) AS m FROM events GROUP BY 1), r AS (SELECT event_type, count(*) AS n FROM events JOIN k USING (event_type) WHERE NOT value > 20 AND (m IS NULL OR event_id > m) GROUP BY 1)
SELECT user_id, event_type, resolution, coalesce(n, 0) AS failures_in_a_row FROM l LEFT JOIN r USING (event_type)
"""


def cooldown_steps(spark, d):
    rows = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("n"))
    return rows.select("user_id", R.cooldown(F.col("n")).alias("seconds"))


def baseline_samples(spark, d):
    rows = table(spark, d, "pages").select("page_id", T.host(F.col("url")).alias("host"), F.contains("url", F.lit("?")).alias("hinted"))
    return R.baseline_samples(rows, "host", "page_id", F.col("hinted"), 2).filter("is_sample").select("page_id", "host")


def procedures_merge(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("title"), F.col("o_orderstatus").alias("state"))
    return R.merge_procedures(rows, ["o_custkey"], "o_orderkey", ["title", "state"], {"O": "open", "F": "closed"}, "state")


QUERIES = {f.__name__: f for f in (lead_cards, route_budget, distinct_sites, keyword_terms, batch_statuses, response_parse, work_ledger, deferred_ledger, cooldown_steps, baseline_samples, procedures_merge)}
ORACLES = {
    "lead_cards": "WITH r AS (SELECT doc_id, row_number() OVER (PARTITION BY source, lang, doc_id % 9, lower(left(text, 80)) ORDER BY n_chars DESC, doc_id) AS k FROM documents WHERE doc_id % 3 = 0 OR (doc_id % 3 = 1 AND doc_id % 2 <> 0)) SELECT doc_id FROM r WHERE k = 1",
    "baseline_samples": f"SELECT page_id, host FROM (SELECT page_id, {HOST_SQL} AS host, row_number() OVER (PARTITION BY {HOST_SQL} ORDER BY page_id) AS k FROM pages WHERE NOT contains(url, '?')) WHERE k <= 2",
    "distinct_sites": f"WITH h AS (SELECT page_id, url, {HOST_SQL} AS host FROM pages) SELECT page_id % 10 AS g, count(DISTINCT {DOMAIN_SQL})::INT AS n_sites, arg_min(url, page_id) AS first_url FROM h GROUP BY 1",
    "keyword_terms": r"""WITH s AS (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), ' ') || ' ' AS t FROM documents)
SELECT doc_id, array_to_string(list_filter([CASE WHEN contains(t, ' the ') THEN 'the' END, CASE WHEN regexp_matches(t, ' is( [^ ]+){0,2} of ') THEN 'is of' END, CASE WHEN contains(t, ' tion') THEN 'tion' END, CASE WHEN contains(t, ' anhathe') THEN 'anhathe' END], lambda x: x IS NOT NULL), '|') AS hits FROM s""",
    "batch_statuses": STATUS_SQL, "deferred_ledger": DEFERRED_SQL,
    "response_parse": "SELECT CASE event_id % 4 WHEN 0 THEN 'parsed' WHEN 1 THEN 'refusal' WHEN 2 THEN 'found_in_text' ELSE 'empty' END AS reason, count(*) AS n, count(*) FILTER (event_id % 4 IN (0, 2)) AS n_answers FROM events GROUP BY 1",
    "work_ledger": "SELECT user_id, event_type, CASE WHEN bool_or(event_id % 6 = 0) THEN 'acked' ELSE 'pending' END AS state, min(event_id) AS first_seen, count(*) AS n_messages FROM events GROUP BY 1, 2",
    "cooldown_steps": "SELECT user_id, CASE WHEN n > 0 THEN 30.0 * pow(2, least(n - 1, 3)) ELSE 0 END::DOUBLE AS seconds FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS n FROM events GROUP BY 1)",
    "procedures_merge": "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) FILTER (o_orderkey % 2 = 0) AS title, CASE arg_min(o_orderstatus, o_orderkey) WHEN 'O' THEN 'open' WHEN 'F' THEN 'closed' ELSE arg_min(o_orderstatus, o_orderkey) END AS state, count(*) AS n_merged FROM orders GROUP BY 1",
}
