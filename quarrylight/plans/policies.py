"""Queries over the rules of attempts, routes, plans and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import policies as P
from ..operators import scoring


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def signal_tags(spark, d):
    k = F.col("event_id")
    status = F.when(k % 7 == 0, "HTTP_429").when(k % 7 == 1, " rate_limited").when(k % 7 == 2, "bot_gate").when(k % 7 == 3, "challenge_page").when(k % 7 == 4, "http_403")
    tags = P.signal_tags(status, F.when(k % 5 == 0, "bot_gate").when(k % 5 == 1, "js challenge"), F.when(k % 4 == 0, 429).when(k % 4 == 1, 403), F.when(k % 11 == 0, True), F.when(k % 3 == 0, F.col("value") - 5))
    return table(spark, d, "events").select("event_id", F.array_join(tags, ",").alias("tags"))


TAGS_SQL = """
SELECT event_id, array_to_string(list_filter([CASE WHEN event_id % 3 = 0 AND value - 5 > 0 THEN 'cooldown' END, CASE WHEN event_id % 4 = 0 OR event_id % 7 IN (0, 1) THEN 'http_429' END, CASE WHEN event_id % 4 = 1 OR event_id % 7 = 4 THEN 'http_403' END,
  CASE WHEN event_id % 7 = 2 OR event_id % 5 = 0 THEN 'bot_gate' END, CASE WHEN event_id % 11 = 0 OR event_id % 7 = 3 OR event_id % 5 = 1 THEN 'challenge' END], lambda x: x IS NOT NULL), ',') AS tags FROM events
"""


def hard_negatives(spark, d):
    k = F.col("doc_id")
    url = F.when(k % 13 == 0, "https://www.yandex.ru/maps").otherwise("https://plant.example/a")
    text = F.concat_ws(" ", F.left("text", F.lit(300)), F.when(k % 5 == 0, "Page NOT\nfound"), F.when(k % 7 == 0, "Buy this domain"), F.when(k % 9 == 0, "A business  directory"))
    found = P.hard_negatives(F.when(k % 11 == 0, 503).when(k % 11 == 1, 200), url, text, k % 6 == 0)
    return table(spark, d, "documents").select("doc_id", F.array_join(found, ",").alias("found"))


NEGATIVES_SQL = r"""
WITH t AS (SELECT doc_id, doc_id % 13 = 0 AS portal, lower(CASE WHEN doc_id % 13 = 0 THEN 'https://www.yandex.ru/maps' ELSE 'https://plant.example/a' END || chr(10) || trim(regexp_replace(coalesce(left(text, 300), '') || CASE WHEN doc_id % 5 = 0 THEN ' page not found' ELSE '' END || CASE WHEN doc_id % 7 = 0 THEN ' buy this domain' ELSE '' END || CASE WHEN doc_id % 9 = 0 THEN ' a business directory' ELSE '' END, '\s+', ' ', 'g'))) AS t FROM documents)
SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 11 = 0 THEN 'http_503' END, CASE WHEN contains(t, '404') OR contains(t, 'page not found') THEN 'soft_404' END, CASE WHEN contains(t, 'buy this domain') THEN 'domain_parking' END, CASE WHEN contains(t, 'business directory') THEN 'directory_portal' END,
  CASE WHEN doc_id % 6 = 0 THEN 'anti_bot_gate' END, CASE WHEN portal THEN 'non_corporate_domain' END], lambda x: x IS NOT NULL), ',') AS found FROM t
"""
MODES, FAMILIES, SECTIONS = ("Requests", "hybrid", "playwright", "skip", None), ("api/v1", "Search", "company/about", "catalog", "blog", "tenders", None), ("files", "images", "misc")


def route_transport(spark, d):
    of = lambda values, k: F.get(F.array(*[F.lit(v).cast("string") for v in values]), (k % len(values)).cast("int"))
    k = F.col("event_id")
    found = P.route_transport(of(MODES, k), of(FAMILIES, F.floor(k / 5)), of(SECTIONS, F.floor(k / 35)))
    return table(spark, d, "events").select("event_id", found.alias("p")).select("event_id", "p.*")


def sql_list(values):
    return "[" + ", ".join("NULL" if v is None else f"'{v.lower()}'" for v in values) + "]"


def sql_any(text, marks):
    return "(" + " OR ".join(f"contains({text}, '{m}')" for m in marks) + ")"


TRANSPORT_SQL = f"""
WITH e AS (SELECT event_id, coalesce({sql_list(MODES)}[event_id % 5 + 1], 'requests') AS m, coalesce({sql_list(FAMILIES)}[event_id // 5 % 7 + 1], '') AS f, {sql_list(SECTIONS)}[event_id // 35 % 3 + 1] AS s FROM events),
r AS (SELECT *, CASE WHEN {sql_any("f || ' ' || s", P.NO_BROWSER)} THEN 'route_family_no_browser' WHEN f IN {P.BROWSER_FIRST} THEN 'route_family_browser_first' WHEN s IN {P.HIGH_VALUE_SECTIONS} OR f IN {P.HIGH_VALUE_FAMILIES} THEN 'route_family_high_value'
  WHEN {sql_any("f || ' ' || s", P.ESCALATED)} THEN 'route_family_browser_allowed' ELSE 'route_family_requests_only' END AS r FROM e)
SELECT event_id, CASE WHEN m = 'skip' THEN 'skip' WHEN m = 'playwright' OR m = 'hybrid' AND r = 'route_family_browser_first' THEN 'playwright' ELSE 'requests' END AS transport, m = 'playwright' OR r NOT IN ('route_family_no_browser', 'route_family_requests_only') AS browser_allowed,
  r = 'route_family_browser_first' AS browser_first, CASE WHEN m = 'playwright' THEN 'requested_playwright' ELSE r END AS reason FROM r
"""


def deep_checks(spark, d):
    k = F.col("c_custkey")
    worth = F.when(k % 5 == 0, "True").when(k % 5 == 1, "limited").when(k % 5 == 2, "false").when(k % 5 == 3, "")
    return table(spark, d, "customer").select("c_custkey", P.allows_deep_check(F.when(k % 3 != 0, "success").when(k % 2 == 0, "failed"), F.element_at(F.split(F.lit("A,B,C,D,E,F"), ","), (k % 6 + 1).cast("int")), worth).alias("allowed"))


def response_facts(spark, d):
    """Stored responses made from events: with text, a refusal, nothing, parsed parts, or no JSON at all."""
    k, v = F.col("event_id"), F.col("user_id")
    item = F.when(k % 5 == 0, '[{"content": [{"type": "output_text", "text": "a"}, {"type": "output_text"}, {"type": "reasoning"}]}]').when(k % 5 == 1, '[{"content": [{"type": "refusal"}]}, {"id": 1}]').when(k % 5 == 2, "[]").when(k % 5 == 3, '[{"content": [{"type": "output_text", "parsed": {"x": 1}}]}]')
    usage = F.concat(F.lit('{"input_tokens": '), (v * 10).cast("string"), F.lit(', "output_tokens": '), v.cast("string"), F.when(k % 2 == 0, F.concat(F.lit(', "input_tokens_details": {"cached_tokens": '), (v * 4).cast("string"), F.lit("}"))).otherwise(F.lit("")), F.lit("}"))
    raw = F.when(k % 5 == 4, "no answer").otherwise(F.concat(F.lit('{"status": "'), F.when(k % 3 == 0, "incomplete").otherwise("completed"), F.lit('", "incomplete_details": '), F.when(k % 3 == 0, '{"reason": "max_output_tokens"}').otherwise("null"), F.lit(', "output": '), item, F.lit(', "usage": '), usage, F.lit("}")))
    found = table(spark, d, "events").select("event_id", P.response_facts(raw, ("0.75", "0.075", "4.50")).alias("f")).select("event_id", "f.*")
    return found.withColumns({"content_types": F.array_join("content_types", ","), "cost": F.col("cost").cast("double")})


FACTS_SQL = """
WITH e AS (SELECT event_id, event_id % 5 AS k, event_id % 5 <> 4 AS ok, user_id * 10 AS i, user_id AS o, CASE WHEN event_id % 2 = 0 AND event_id % 5 <> 4 THEN user_id * 4 ELSE 0 END AS c, event_id % 3 = 0 AS short FROM events)
SELECT event_id, CASE WHEN ok THEN i END AS input_tokens, c AS cached_tokens, CASE WHEN ok THEN o END AS output_tokens, CASE WHEN ok THEN round(((i - c) * 0.75 + c * 0.075 + o * 4.5) / 1000000, 8) END AS cost, CASE WHEN ok THEN CASE WHEN short THEN 'incomplete' ELSE 'completed' END END AS status,
  CASE WHEN ok AND short THEN 'max_output_tokens' END AS incomplete_reason, k IN (0, 1, 3) AS has_output, CASE k WHEN 0 THEN 'output_text,reasoning' WHEN 1 THEN 'refusal' WHEN 3 THEN 'output_text' ELSE '' END AS content_types, k IN (0, 3) AS has_text, k = 3 AS has_parsed, k = 1 AS has_refusal FROM e
"""


def rows_to_search(spark, d):
    """Customers that are neither done (all their orders final) nor waiting (an order in work)."""
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    done = orders.groupBy("c_custkey").agg(F.bool_and(F.col("o_orderstatus") == "F").alias("f")).filter("f")
    return P.rows_to_search(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", done, orders.filter("o_orderstatus = 'P'"))


def route_accounting(spark, d):
    """What the budget of each site gave to its families of routes, with caps of depth."""
    url = F.lower("url")
    rows = table(spark, d, "pages").select("page_id", T.registered_domain(T.host(url)).alias("site"), T.host(url).alias("host"), F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1).alias("path"), F.col("url").alias("address"))
    scored = scoring.route_family(rows, ["page_id"], F.col("path"), F.lower("address"), {"news": ("news",), "blog": ("blog",), "item": ("item", "product")})
    planned = P.planned_routes(scored.drop("address"), "site", "family", "host", "path", "route_score", {"news": 1}, 2)
    return P.budget_accounting(planned, "site", "family", "outcome", "depth", 3, ("depth_cap", "family_cap", "host_cap", "path_cap", "total_cap"))


QUERIES = {f.__name__: f for f in (signal_tags, hard_negatives, route_transport, deep_checks, response_facts, rows_to_search, route_accounting)}
ORACLES = {
    "signal_tags": TAGS_SQL, "hard_negatives": NEGATIVES_SQL, "route_transport": TRANSPORT_SQL, "response_facts": FACTS_SQL,
    "deep_checks": "SELECT c_custkey, c_custkey % 3 <> 0 AND c_custkey % 6 < 3 AND c_custkey % 5 < 2 AS allowed FROM customer",
    "rows_to_search": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING bool_and(o_orderstatus = 'F') OR bool_or(o_orderstatus = 'P'))",
}
