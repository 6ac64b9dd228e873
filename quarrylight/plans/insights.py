"""Queries over what a run found, and over pages that mention ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import insights as I
from ..operators import joins


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FLAGS = {"with_phone": "c_custkey % 2 = 0", "with_email": "c_custkey % 3 = 0", "with_site": "c_custkey % 5 = 0", "with_nothing": "c_custkey % 2 <> 0 AND c_custkey % 3 <> 0 AND c_custkey % 5 <> 0", "with_leads": "c_acctbal > 5000"}
MASKED = "CASE WHEN o_orderkey % 4 = 0 THEN array('phones', 'profile') WHEN o_orderkey % 4 = 1 THEN array('finance') WHEN o_orderkey % 4 = 2 THEN array() END"


def found_by_run(spark, d):
    """Customers as companies, their orders as results of sources: the priority is the source, the status that of the result."""
    companies = table(spark, d, "customer")
    results = table(spark, d, "orders").select(F.col("o_orderpriority").alias("source"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.expr(MASKED).cast("array<string>").alias("masked"), (F.col("o_orderkey") % 9 == 0).alias("blocked"))
    return companies, results


def insight_rows(companies, results):
    total = companies.count()
    parts = [
        I.coverage(companies, {k: F.expr(v) for k, v in FLAGS.items()}),
        I.value_counts(companies.select(F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("domain_status"), (F.col("c_nationkey") % 6).alias("site_class")), ["domain_status", "site_class"], "not_found"),
        I.source_insights(results, "source", "status", "masked", F.col("blocked"), total),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def run_insights(spark, d):
    return insight_rows(*found_by_run(spark, d))


INSIGHT_SQL = f"""
WITH o AS (SELECT o_orderpriority AS name, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE 'unknown' END AS status, CASE o_orderkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS m, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS c, o_orderkey % 9 = 0 AS b FROM orders),
s AS (SELECT name, count(*) FILTER (m > 0) AS companies_masked, count(*) FILTER (c > 0) AS companies_contact_masked, sum(m)::BIGINT AS fields_masked, sum(c)::BIGINT AS contact_fields_masked, count(*) FILTER (b) AS companies_blocked FROM o GROUP BY 1),
g AS (SELECT *, CASE WHEN companies_contact_masked >= greatest(10, floor((SELECT count(*) FROM customer) * 0.15)) THEN 2 WHEN companies_contact_masked > 0 THEN 1 ELSE 0 END::BIGINT AS signal FROM s)
SELECT 'coverage' AS section, 'companies' AS name, metric, value FROM (UNPIVOT (SELECT count(*) AS companies, {", ".join(f"count(*) FILTER ({v}) AS {k}" for k, v in FLAGS.items())} FROM customer) ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'domain_status', CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment ELSE 'not_found' END, 'n', count(*) FROM customer GROUP BY 2
UNION ALL SELECT 'site_class', (c_nationkey % 6)::VARCHAR, 'n', count(*) FROM customer GROUP BY 2
UNION ALL SELECT 'source_status', name, status, count(*) FROM o GROUP BY 2, 3
UNION ALL SELECT 'source_masks', name, metric, value FROM (UNPIVOT g ON COLUMNS(* EXCLUDE (name)) INTO NAME metric VALUE value)
"""


def run_report(spark, d):
    """The report of a run: coverage, statuses and masks, and the first companies without anything or with a doubtful balance."""
    companies, results = found_by_run(spark, d)
    shown = I.examples(companies, {"nothing": F.expr(FLAGS["with_nothing"]), "negative": F.col("c_acctbal") < 0}, "c_custkey", F.concat_ws(" — ", F.col("c_custkey").cast("string"), "c_name"), 5)
    titles = {"coverage": "Coverage", "source_status": "Source Statuses", "source_masks": "Mask Summary By Source", "nothing": "No Contact Companies", "negative": "Negative Balances"}
    return I.insight_lines(insight_rows(companies, results), shown, titles)


REPORT_SQL = f"""
WITH r AS ({INSIGHT_SQL}), v AS (SELECT section, name, string_agg(metric || '=' || value, ', ' ORDER BY metric || '=' || value) AS t FROM r GROUP BY ALL),
e AS (SELECT 'nothing' AS section, c_custkey, c_name FROM customer WHERE {FLAGS["with_nothing"]} UNION ALL SELECT 'negative', c_custkey, c_name FROM customer WHERE c_acctbal < 0),
k AS (SELECT section, c_custkey || ' — ' || c_name AS text, row_number() OVER (PARTITION BY section ORDER BY c_custkey) AS place FROM e),
b AS (SELECT section, '- `' || name || '`: ' || t AS line, name FROM v WHERE section IN ('coverage', 'source_status', 'source_masks') UNION ALL SELECT section, '- ' || text, lpad(place::VARCHAR, 6, '0') FROM k WHERE place <= 5),
h AS (SELECT section, line, name FROM b UNION ALL SELECT DISTINCT section, '## ' || CASE section WHEN 'coverage' THEN 'Coverage' WHEN 'source_status' THEN 'Source Statuses' WHEN 'source_masks' THEN 'Mask Summary By Source' WHEN 'nothing' THEN 'No Contact Companies' ELSE 'Negative Balances' END, '' FROM b)
SELECT CASE section WHEN 'coverage' THEN 0 WHEN 'source_status' THEN 1 WHEN 'source_masks' THEN 2 WHEN 'nothing' THEN 3 ELSE 4 END AS part, row_number() OVER (PARTITION BY section ORDER BY name, line)::INT AS place, line FROM h
"""


def mention_pages(spark, d):
    """Orders as pages: some name the id of their customer, some inside a longer run of digits, some another's."""
    k = F.col("o_orderkey")
    inn = lambda c: F.lpad((c * 7919 % 1000000000 + 1000000000).cast("string"), 10, "0")
    own = inn(F.col("o_custkey"))
    text = F.when(k % 4 == 0, F.concat(F.lit("INN "), own, F.lit(", since 1999"))).when(k % 4 == 1, F.concat(F.lit("No 9"), own, F.lit("55"))).when(k % 4 == 2, F.concat(F.lit("INN "), inn(F.col("o_custkey") + 1)))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(k % 8 == 3, F.concat(F.lit("Company "), own)).otherwise(F.lit("Company")).alias("title"), text.alias("text"))


def inn_mentions(spark, d):
    """Which pages mention which companies."""
    ids = table(spark, d, "customer").select(F.lpad((F.col("c_custkey") * 7919 % 1000000000 + 1000000000).cast("string"), 10, "0").alias("inn"))
    return joins.id_mentions(mention_pages(spark, d), "o_orderkey", ["title", "text"], ids, "inn")


def inn_page_match(spark, d):
    """Whether a page is that of its own company; every ninth has no id to hold against it."""
    pages = mention_pages(spark, d)
    rows = pages.select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.lpad((F.col("o_custkey") * 7919 % 1000000000 + 1000000000).cast("string"), 10, "0")).alias("inn"))
    return joins.with_page_match(rows, joins.id_mentions(pages, "o_orderkey", ["title", "text"], rows, "inn"), "o_orderkey", "inn").select("o_orderkey", "matches")


PAGES_SQL = """
SELECT o_orderkey, (o_custkey * 7919 % 1000000000 + 1000000000)::VARCHAR AS own, CASE WHEN o_orderkey % 8 = 3 THEN 'Company ' || (o_custkey * 7919 % 1000000000 + 1000000000) ELSE 'Company' END || ' ' ||
  coalesce(CASE o_orderkey % 4 WHEN 0 THEN 'INN ' || (o_custkey * 7919 % 1000000000 + 1000000000) || ', since 1999' WHEN 1 THEN 'No 9' || (o_custkey * 7919 % 1000000000 + 1000000000) || '55' WHEN 2 THEN 'INN ' || ((o_custkey + 1) * 7919 % 1000000000 + 1000000000) END, '') AS t FROM orders
"""
QUERIES = {f.__name__: f for f in (run_insights, run_report, inn_mentions, inn_page_match)}
ORACLES = {
    "run_insights": INSIGHT_SQL, "run_report": REPORT_SQL,
    "inn_mentions": f"SELECT DISTINCT o_orderkey, inn FROM ({PAGES_SQL}) JOIN (SELECT DISTINCT (c_custkey * 7919 % 1000000000 + 1000000000)::VARCHAR AS inn FROM customer) ON contains(t, inn)",
    "inn_page_match": f"SELECT o_orderkey, o_orderkey % 9 = 0 OR contains(t, own) AS matches FROM ({PAGES_SQL})",
}
