"""Queries for profiles of entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profiles as P
from .contacts import DOMAIN_SQL, HOST_SQL


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def section_merge(spark, d):
    """Customers before suppliers, field by field, and the balance block whole."""
    one = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "ok").alias("status"), F.col("c_acctbal").alias("balance"))
    two = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("old").alias("status"), F.col("s_acctbal").alias("balance"))
    return P.merge_sections(one, two, "key", ["name"], {"money": ["status", "balance"]})


SECTION_SQL = """
WITH a AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'ok' END AS status, c_acctbal AS balance FROM customer WHERE c_acctbal > 0)
SELECT coalesce(a.key, s_suppkey) AS key, coalesce(a.name, s_name) AS name, CASE WHEN a.status IS NOT NULL THEN a.status WHEN s_suppkey IS NOT NULL THEN 'old' END AS status, CASE WHEN a.status IS NOT NULL THEN a.balance ELSE s_acctbal END AS balance
FROM a FULL JOIN supplier ON a.key = s_suppkey
"""


def decision_summary(spark, d):
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "F", "verified").when(F.col("o_orderstatus") == "O", "candidate").otherwise("rejected").alias("status"), F.array(F.col("o_orderpriority"), k.cast("string")).alias("reasons"))
    return P.decision_summary(rows, "o_custkey", "status", "reasons", "o_orderkey")


def parse_gate(spark, d):
    k = F.col("page_id")
    pages = table(spark, d, "pages").select("page_id", (k % 5).alias("entity"), "url")
    status = F.when(k % 3 == 0, "verified").when(k % 3 == 1, "candidate").otherwise("rejected")
    return P.parse_gate(pages, "entity", "url", "page_id", status, k % 4 != 0, F.when(k % 7 == 0, "D").otherwise("A"), F.lit("true")).select("entity", "page_id", "mode")


GATE_SQL = f"""
WITH n AS (SELECT page_id, page_id % 5 AS entity, lower(regexp_extract(url, '(?i)^(https?)://', 1)) || '://' || {HOST_SQL} || rtrim(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/') AS u FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY entity, u ORDER BY page_id) AS k FROM n)
SELECT entity, page_id, CASE WHEN page_id % 3 < 2 AND page_id % 4 <> 0 AND page_id % 7 <> 0 THEN 'deep' ELSE 'surface' END AS mode FROM r WHERE k = 1
"""


def restore_safe(spark, d):
    """Orders as checkpoints, line items as evidence by flag, returned customers as done."""
    pending = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderstatus") == "F", "R").otherwise("N").alias("fp"))
    evidence = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_returnflag").alias("fp"))
    done = table(spark, d, "lineitem").filter("l_discount > 0.09").select(F.col("l_orderkey").alias("key"))
    return P.restore_safe(pending, evidence, "key", "fp", done)


def evidence_once(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", F.get_json_object("props", "$.k").alias("k"), "event_id")
    return P.evidence_once(rows, ["user_id", "event_type", "k"], "event_id")


def source_digest(spark, d):
    items = table(spark, d, "orders").select("o_custkey", F.col("o_orderstatus").alias("kind"), F.col("o_orderpriority").alias("value"), "o_orderkey")
    found = P.source_digest(items, ["o_custkey"], "kind", "value", "o_orderkey", {"F": 3, "O": 2})
    return found.select("o_custkey", F.array_join("F", "|").alias("f"), F.array_join("O", "|").alias("o"))


DIGEST_SQL = """
WITH r AS (SELECT o_custkey, o_orderstatus AS s, o_orderpriority AS v, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS k FROM orders WHERE o_orderstatus IN ('F', 'O')),
k AS (SELECT * FROM r WHERE k <= CASE s WHEN 'F' THEN 3 ELSE 2 END)
SELECT o_custkey, coalesce(string_agg(v, '|' ORDER BY k) FILTER (s = 'F'), '') AS f, coalesce(string_agg(v, '|' ORDER BY k) FILTER (s = 'O'), '') AS o FROM k GROUP BY 1
"""


def activity_terms(spark, d):
    return P.activity_terms(table(spark, d, "documents"), "source", "text", "doc_id", ["there", "their"])


ACTIVITY_SQL = r"""
WITH w AS (SELECT source, doc_id, unnest(l) AS term, unnest(range(len(l))) AS p FROM (SELECT source, doc_id, string_split_regex(lower(text), '[^\p{L}]+') AS l FROM documents)),
c AS (SELECT source, term, count(*) AS n, min((doc_id, p)) AS f FROM w WHERE length(term) >= 5 AND term NOT IN ('there', 'their') GROUP BY 1, 2),
r AS (SELECT source, term, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, f) AS rank FROM c) SELECT * FROM r WHERE rank <= 18
"""


def site_hints(spark, d):
    pages = table(spark, d, "pages").select("page_id", (F.col("page_id") % 8).alias("entity"), "url", F.concat(F.lit("reason"), (F.col("page_id") % 3).cast("string")).alias("reason"))
    found = P.site_hints(pages, "entity", "url", "reason", "page_id", 2)
    return found.select("entity", "domain", "url", "rank", F.array_join("reasons", ",").alias("reasons"))


HINTS_SQL = f"""
WITH h AS (SELECT page_id, page_id % 8 AS entity, url, 'reason' || (page_id % 3) AS reason, {HOST_SQL} AS host FROM pages), g AS (SELECT *, {DOMAIN_SQL} AS domain FROM h),
q AS (SELECT entity, domain, reason, min(page_id) AS p FROM g GROUP BY 1, 2, 3), s AS (SELECT entity, domain, string_agg(reason, ',' ORDER BY p) AS reasons FROM q GROUP BY 1, 2),
o AS (SELECT entity, domain, arg_min(url, page_id) AS url, row_number() OVER (PARTITION BY entity ORDER BY min(page_id)) AS rank FROM g GROUP BY 1, 2)
SELECT entity, domain, url, rank, reasons FROM o JOIN s USING (entity, domain) WHERE rank <= 2
"""


def provenance(spark, d):
    k = F.col("c_custkey")
    value, origin = P.provenance(F.when(k % 4 == 0, F.col("c_name")).otherwise(" "), F.when(k % 3 == 0, F.col("c_mktsegment")), F.when(k % 2 == 0, F.lit("guess")))
    return table(spark, d, "customer").select("c_custkey", value.alias("value"), origin.alias("origin"))


def file_manifest(spark, d):
    return P.manifest(table(spark, d, "pages").select(F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.col("html").alias("content")), "path", "content")


def query_params(spark, d):
    found = P.query_string([("key", F.col("c_custkey").cast("string")), ("segment", F.col("c_mktsegment")), ("empty", F.lit(""))])
    applied = P.query_applied(F.array("c_mktsegment"), F.array(F.lit("BUILDING"), F.lit("MACHINERY")))
    return table(spark, d, "customer").select("c_custkey", found.alias("query"), applied.alias("applied"))


QUERIES = {f.__name__: f for f in (section_merge, decision_summary, parse_gate, restore_safe, evidence_once, source_digest, activity_terms, site_hints, provenance, file_manifest, query_params)}
ORACLES = {
    "section_merge": SECTION_SQL,
    "decision_summary": "WITH r AS (SELECT o_custkey, o_orderkey, o_orderpriority || '; ' || o_orderkey AS s, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS k FROM orders) SELECT o_custkey, arg_min(s, (k, o_orderkey)) AS summary FROM r WHERE k IS NOT NULL GROUP BY 1",
    "parse_gate": GATE_SQL,
    "restore_safe": "SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN 'R' ELSE 'N' END AS fp FROM orders WHERE (o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'R' ELSE 'N' END) IN (SELECT (l_orderkey, l_returnflag) FROM lineitem) AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.09)",
    "evidence_once": "WITH f AS (SELECT user_id, event_type, props->>'$.k' AS k, min(event_id) AS event_id FROM events GROUP BY 1, 2, 3) SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS evidence_no FROM f",
    "source_digest": DIGEST_SQL, "activity_terms": ACTIVITY_SQL, "site_hints": HINTS_SQL,
    "provenance": "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 2 = 0 THEN 'guess' END AS value, CASE WHEN c_custkey % 4 = 0 THEN 'trace' WHEN c_custkey % 3 = 0 THEN 'metadata' WHEN c_custkey % 2 = 0 THEN 'guess' ELSE 'none' END AS origin FROM customer",
    "file_manifest": "SELECT 'pages/' || page_id || '.html' AS path, octet_length(encode(html)) AS size, sha256(html) AS checksum FROM pages",
    "query_params": "SELECT c_custkey, 'key=' || c_custkey || '&segment=' || c_mktsegment AS query, c_mktsegment IN ('BUILDING', 'MACHINERY') AS applied FROM customer",
}
