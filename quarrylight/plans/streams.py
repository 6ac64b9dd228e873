"""Queries that run a stream to its end, and those over parsed pages and written tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T
from ..operators import scoring, timeline
from ..sources import pages as P
from ..sources import sinks
from ..streaming import events as S
from .contacts import HOST_SQL
from .dossiers import BREAKER_SQL, breaker_class
from .runs import CIRCUIT_SQL


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_host_stats(spark, d):
    return S.run_to_table(S.host_stats(S.read_events(spark, f"{d}/events.parquet"), "user_id", "value"), "complete", "stream-hosts")


def stream_circuit_state(spark, d):
    kind = F.col("event_type")
    stream = S.circuit_state(S.read_events(spark, f"{d}/events.parquet"), "user_id", "event_id", kind == "error", kind == "signup", kind == "purchase")
    return S.run_to_table(stream, "update", "stream-circuits", ["user_id"]).select("user_id", "mode")


def stream_breaker_state(spark, d):
    """The same final states as breaker_ledger's."""
    ev = S.read_events(spark, f"{d}/events.parquet").withColumn("at", F.floor(N.wall_seconds("ts")))
    found = S.run_to_table(S.breaker_state(ev, "user_id", "event_id", "at", breaker_class(), F.when(F.col("event_id") % 2 == 0, "bot_gate")), "update", "stream-breakers", ["user_id"])
    return found.withColumn("cooldown_until", F.col("cooldown_until").cast("bigint"))


def stream_emit_once(spark, d):
    stream = S.emit_once(S.read_events(spark, f"{d}/events.parquet").select("user_id", "event_type", "props"), ["user_id", "event_type", "props"])
    return S.run_to_table(stream, "append", "stream-once").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_distinct"))


def stream_last_attempts(spark, d):
    found = S.run_to_table(S.last_attempts(S.read_events(spark, f"{d}/events.parquet"), "user_id", "event_id", [], 25), "update", "stream-last", ["user_id"])
    return found.select("user_id", F.array_join(F.transform("last", lambda x: x.cast("string")), ",").alias("last"))


def page_records(spark, d):
    found = P.page_records(table(spark, d, "pages"), "page_id", "url", "html")
    return found.select("page_id", "title", F.char_length("text").alias("n_text"), "n_links", F.size("rows").alias("n_rows"), "fingerprint", T.section(F.lower("url")).alias("section"))


def page_titles(spark, d):
    html = table(spark, d, "pages")
    return html.select("page_id", F.trim(F.regexp_extract("html", r"(?i)<title[^>]*>([^<]*)</title>", 1)).alias("title"), F.regexp_count("html", F.lit("(?i)<a ")).alias("n_links"))


def site_probe(spark, d):
    pages = P.probe(table(spark, d, "pages").withColumn("host", T.host(F.col("url"))), "html")
    return pages.select("page_id", "host", "is_spa", "old_stack", "n_links", "text_length", scoring.site_class(F.col("is_spa"), F.col("old_stack"), F.col("text_length"), F.col("n_links")).alias("site_class"))


PROBE_SQL = rf"""
WITH p AS (SELECT page_id, {HOST_SQL} AS host, lower(html) AS h FROM pages),
f AS (SELECT page_id, host, regexp_matches(h, 'data-reactroot|__next_data__|id=["'']__next["'']|id=["''](app|root)["'']') AS is_spa, regexp_matches(h, 'bitrix|\.aspx|asp\.net|windows-1251') AS old_stack, len(regexp_extract_all(h, '<a[ >]'))::INT AS n_links,
  length(regexp_replace(trim(regexp_replace(regexp_replace(h, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>|[\s]+', ' ', 'g')), ' +', ' ', 'g'))::INT AS text_length FROM p)
SELECT *, CASE WHEN is_spa AND text_length < 500 THEN 'D' WHEN is_spa THEN 'C' WHEN old_stack THEN 'B' WHEN text_length >= 1200 AND n_links >= 8 THEN 'A' WHEN text_length >= 350 OR n_links >= 3 THEN 'B' ELSE 'F' END AS site_class FROM f
"""


def recent_outcomes(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", (F.col("event_id") % 3).alias("proxy"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("tag"), (F.col("value") > 50).alias("ok"))
    return timeline.recent_outcomes(ev, ["user_id"], "event_id", ["proxy", "tag"], "ok", 25)


RECENT_SQL = """
WITH r AS (SELECT user_id, event_id, (event_id % 3)::VARCHAR AS proxy, CASE WHEN event_id % 2 = 0 THEN event_type END AS tag, value > 50 AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events)
SELECT user_id, 'proxy' AS tag_name, proxy AS tag, ok, count(*) AS n FROM r WHERE k <= 25 GROUP BY ALL UNION ALL SELECT user_id, 'tag', tag, ok, count(*) FROM r WHERE k <= 25 AND tag IS NOT NULL GROUP BY ALL
"""


def page_sections(spark, d):
    """Headings of pages as a parser sees them, and whether text stands under one that ends in a stop."""
    found = P.page_records(table(spark, d, "pages"), "page_id", "url", "html")
    return found.select("page_id", F.size("sections").alias("n_sections"), F.coalesce(F.char_length(P.section_of(F.col("sections"), (r"\S",))) > 0, F.lit(False)).alias("has_text"), P.access_boundary(F.lit("success"), F.when(F.col("page_id") % 9 == 0, 403), F.col("text")).alias("boundary"))


SECTIONS_SQL = r"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<(script|style|noscript|template|title)[^>]*>.*?</(script|style|noscript|template|title)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g') AS h FROM pages),
t AS (SELECT page_id, string_split_regex(h, '(?is)<h[1-4][^>]*>') AS parts FROM p),
bare AS (SELECT page_id, regexp_replace(parts[1], '(?s)<[^>]*>', ' ', 'g') AS before, list_transform(parts[2:], lambda x: regexp_replace(regexp_replace(x, '(?is)^.*?</h[1-4]>', ''), '(?s)<[^>]*>', ' ', 'g')) AS under,
  list_transform(parts[2:], lambda x: regexp_replace(regexp_extract(x, '(?is)^(.*?)</h[1-4]>', 1), '(?s)<[^>]*>', ' ', 'g')) AS heads FROM t)
SELECT page_id, (len(list_filter(heads, lambda x: true)) + CASE WHEN regexp_matches(before, '\S') THEN 1 ELSE 0 END)::INT AS n_sections, coalesce(regexp_matches(list_filter(list_zip(heads, under), lambda x: regexp_matches(x[1], '\S'))[1][2], '\S'), false) AS has_text,
  CASE WHEN page_id % 9 = 0 THEN 'blocked' END AS boundary FROM bare
"""


def mojibake_repair(spark, d):
    """Texts mended where bytes were read in the wrong charset: the damage is made here, so that the result is known."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    spoiled = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")).otherwise(F.col("text")))
    return P.mended(spoiled, "text").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("digest"))


def flat_export(spark, d):
    """Customers with a status column for each order priority."""
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lower(F.substring("o_orderpriority", 1, 1)).alias("source"), F.col("o_orderstatus").alias("status"))
    return sinks.flat_export(table(spark, d, "customer"), orders, "c_custkey", {"name": F.col("c_name"), "segment": F.lower("c_mktsegment")}, ["1", "2", "3"])


def run_summary(spark, d):
    state = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed").otherwise("running")
    return sinks.run_summary(table(spark, d, "orders").withColumn("status", state), "status")


QUERIES = {f.__name__: f for f in (stream_host_stats, stream_circuit_state, stream_breaker_state, stream_emit_once, stream_last_attempts, page_records, page_sections, page_titles, recent_outcomes, site_probe, mojibake_repair, flat_export, run_summary)}
ORACLES = {
    "stream_breaker_state": f"SELECT * EXCLUDE (n_paused) FROM ({BREAKER_SQL})", "site_probe": PROBE_SQL, "recent_outcomes": RECENT_SQL,
    "page_sections": SECTIONS_SQL,
    "stream_host_stats": "SELECT user_id, count(*) AS n_events, round(sum(value), 2) AS sum_value, max(value) AS max_value FROM events GROUP BY 1",
    "stream_circuit_state": f"SELECT user_id, mode FROM (SELECT user_id, event_id, mode, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM ({CIRCUIT_SQL.replace('count(*) AS n, count(DISTINCT user_id) AS n_users FROM r GROUP BY 1', 'user_id, event_id FROM r')})) WHERE k = 1",
    "stream_emit_once": "SELECT user_id, count(DISTINCT event_type || props) AS n_distinct FROM events GROUP BY 1",
    "stream_last_attempts": "SELECT user_id, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS last FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k <= 25 GROUP BY 1",
    "mojibake_repair": "SELECT doc_id, sha1(text) AS digest FROM documents",
    "page_titles": "SELECT page_id, trim(regexp_extract(html, '(?i)<title[^>]*>([^<]*)</title>', 1)) AS title, len(regexp_extract_all(html, '(?i)<a ')) AS n_links FROM pages",
    "flat_export": "SELECT c_custkey, c_name AS name, lower(c_mktsegment) AS segment, " + ", ".join(f"coalesce(max(CASE WHEN o_orderpriority LIKE '{k}%' THEN o_orderstatus END), '') AS \"{k}_status\"" for k in "123") + " FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3",
    "run_summary": "SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_completed, count(*) FILTER (o_orderstatus = 'P') AS n_failed, CASE WHEN count(*) = 0 THEN 'suppressed' WHEN count(*) FILTER (o_orderstatus = 'F') = count(*) THEN 'all_completed' WHEN count(*) FILTER (o_orderstatus IN ('F', 'P')) = count(*) THEN 'terminal' ELSE 'partial' END AS export_state FROM orders",
}
