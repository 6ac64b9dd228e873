"""Queries that write the given tables as files of a format and read these back: what comes out must be what the tables hold."""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import profiles
from ..sources import pages, readers, sinks
from ..sources.workspace import shared_folder


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_line_files(df, path, part):
    """The single line (value) of each part as a file of its own."""
    df.repartition(part).write.partitionBy(part).text(path)
    return path


def csv_documents(spark, d):
    """Customers through CSV files: the scan finds delimiter and charset, the header is the first row of each file."""
    path = shared_folder(spark, "csv")
    sinks.write_csv(table(spark, d, "customer").select("c_custkey", "c_name", F.concat_ws("; ", "c_mktsegment", F.lit("a")).alias("note")), f"{path}/rows")
    rows = readers.documents(spark, f"{path}/rows").filter("status = 'read'").select(F.explode(F.flatten("tables")).alias("r"))
    return rows.filter(F.col("r")[0] != "c_custkey").select(F.col("r")[0].cast("bigint").alias("c_custkey"), F.col("r")[1].alias("c_name"), F.col("r")[2].alias("note"))


def text_documents(spark, d):
    """Names of parts through text files."""
    path = shared_folder(spark, "texts")
    table(spark, d, "part").select(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name")).write.text(f"{path}/rows")
    lines = readers.documents(spark, f"{path}/rows").filter("format = 'txt'").select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    return lines.select(F.substring_index("line", "|", 1).cast("bigint").alias("p_partkey"), F.substring_index("line", "|", -1).alias("p_name"))


def json_documents(spark, d):
    """Suppliers through JSON files of text and tables, one file per nation."""
    cells = F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))), lambda s: F.array(s["s_suppkey"].cast("string"), s["s_name"]))
    found = table(spark, d, "supplier").groupBy("s_nationkey").agg(cells.alias("t"))
    files = found.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit(".json")).alias("path"), F.to_json(F.struct(F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("text"), F.array("t").alias("tables"))).cast("binary").alias("content"))
    rows = readers.parsed_files(files)
    return rows.select("text", F.explode(F.flatten("tables")).alias("r")).select("text", F.col("r")[0].cast("bigint").alias("s_suppkey"), F.col("r")[1].alias("s_name"))


def workbook_tables(spark, d):
    """Suppliers through workbooks of at most a hundred rows."""
    books = sinks.workbooks(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), ["s_suppkey"], 100)
    files = books.select(F.concat(F.lit("b"), F.col("book_no").cast("string"), F.lit(".xlsx")).alias("path"), "content")
    rows = readers.parsed_files(files).select(F.explode(F.flatten("tables")).alias("r")).filter(F.col("r")[0] != "s_suppkey")
    return rows.select(F.col("r")[0].cast("bigint").alias("s_suppkey"), F.col("r")[1].alias("s_name"), F.col("r")[2].cast("int").alias("s_nationkey"))


def company_sheets(spark, d):
    """Customers as company sheets: the header is known by name, rows without id and name go."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.when(k % 4 != 0, k.cast("string")).alias("ИНН"), F.when(k % 3 != 0, F.col("c_name")).alias(" Название "), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("Сайт"))
    books = sinks.workbooks(rows, [k], 200)
    files = books.select(F.concat(F.lit("b"), F.col("book_no").cast("string"), F.lit(".xlsx")).alias("path"), "content")
    return readers.company_rows(files).select("inn", "company_name", "xlsx_site")


def docx_bytes(text):
    """A minimal document of a paragraph per line."""
    body = "".join(f"<w:p><w:r><w:t>{escape(x)}</w:t></w:r></w:p>" for x in text.split("\n"))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
    return raw.getvalue()


def archived(kind):
    """Record batches of (name, text) to (path, content): each text in a file of the kind, with a member outside of an archive's folder."""

    def work(batches):
        for pdf in batches:
            out = []
            for name, text in zip(pdf["name"], pdf["text"], strict=True):
                if kind == "docx":
                    out.append((f"{name}.docx", docx_bytes(text)))
                    continue
                raw = io.BytesIO()
                with zipfile.ZipFile(raw, "w") as z:
                    z.writestr("in/text.txt", text)
                    z.writestr("../out.txt", "x")
                out.append((f"{name}.zip", raw.getvalue()))
            yield pd.DataFrame(out, columns=["path", "content"])

    return work


def named_conversations(spark, d):
    turns = table(spark, d, "conversations").filter("text is not null")
    return turns.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("name"), F.regexp_replace("text", r"[\x00-\x1f]+", " ").alias("text")).filter("trim(text) <> ''")


def docx_texts(spark, d):
    """Turns of conversations through docx files."""
    rows = readers.parsed_files(named_conversations(spark, d).mapInPandas(archived("docx"), "path string, content binary"))
    return rows.select(F.substring_index("path", ".", 1).alias("name"), "status", F.sha1(F.col("text").cast("binary")).alias("digest"))


def archive_members(spark, d):
    """Turns of conversations through zip archives; the member outside of the folder is refused."""
    rows = readers.parsed_files(named_conversations(spark, d).mapInPandas(archived("zip"), "path string, content binary"))
    return rows.select(F.substring_index("path", ".zip", 1).alias("name"), "depth", "status", F.sha1(F.col("text").cast("binary")).alias("digest"))


def json_event_log(spark, d):
    """Events through JSON lines, with blank, broken and foreign lines among them that are skipped."""
    path = shared_folder(spark, "events")
    ev = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    sinks.write_json_lines(ev, f"{path}/log")
    ev.select(F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, '{"event_id": 1, ').otherwise("[1, 2]")).write.mode("append").text(f"{path}/log")
    return readers.json_events(spark, f"{path}/log", "event_id bigint, user_id bigint, event_type string, value double")


def strict_event_log(spark, d):
    """Events through JSON lines where each must be whole."""
    path = shared_folder(spark, "strict")
    sinks.write_json_lines(table(spark, d, "events").select("event_id", "event_type"), f"{path}/log")
    return readers.strict_events(spark, f"{path}/log", "event_id bigint, event_type string", ("event_id", "event_type")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


def offline_index(spark, d):
    """Orders as requests of an offline snapshot, several for a customer: the last one of an id wins."""
    def request(x):
        inn = x["o_custkey"].cast("string")
        return F.struct(inn.alias("request"), F.lit(1).alias("result_count"), (x["o_orderkey"] % 5).cast("int").alias("search_count"), F.array(F.create_map(F.lit("inn"), inn, F.lit("status"), x["o_orderstatus"])).alias("result"))

    # a file holds the requests of some fifty customers
    parts = table(spark, d, "orders").groupBy(F.floor(F.col("o_custkey") / 50).alias("part")).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))), request).alias("requests"))
    path = one_line_files(parts.select("part", F.to_json(F.struct("requests")).alias("value")), f"{shared_folder(spark, 'snapshot')}/files", "part")
    found = readers.offline_snapshot(spark, path)
    return found.select("inn", "result_count", "search_count", F.col("entity")["status"].alias("status"))


def run_states(spark, d):
    """States of customers in the older of two versions."""
    path = shared_folder(spark, "states")
    sinks.write_json_lines(table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("inn"), F.col("c_mktsegment").alias("status")), f"{path}/v1")
    schemas = {1: "inn string, status string", 2: "inn string, status string, sources map<string,string>"}
    return readers.run_state(spark, f"{path}/v1", 1, schemas).select("inn", "status", F.col("sources").isNull().alias("old"))


def settlement_rows(spark, d):
    """Customers as settlements on a grid, through CSV: zones of two squares around the centre, and the weight of each."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(
        k.cast("string").alias("source_id"), F.lit("R").alias("region"), F.col("c_name").alias("settlement"), F.concat(F.lit(" Full  "), k.cast("string")).alias("full_name"), (k * 10).cast("string").alias("population"),
        (55 + (k % 41 - 20) / 10 + 0.05).cast("string").alias("latitude_dd"), (37 + (k % 37 - 18) / 10 + 0.05).cast("string").alias("longitude_dd"),
    )
    path = f"{shared_folder(spark, 'settlements')}/rows"
    sinks.write_csv(rows, path)
    square = lambda r: [(55 - r, 37 - r), (55 - r, 37 + r), (55 + r, 37 + r), (55 + r, 37 - r)]
    found = readers.settlements(spark, path, (55.0, 37.0), square(1.5), square(0.5))
    return found.select("source_id", "full_name", "population", "geo_bucket", "geo_weight", F.col("municipality").isNull().alias("lacks"))


def replay_fixture_rows(spark, d):
    """Events of one stage as fixtures of a replay."""
    path = f"{shared_folder(spark, 'fixtures')}/rows"
    sinks.write_json_lines(table(spark, d, "events").select(F.lit("site").alias("stage"), "event_id", F.col("event_type").alias("answer")), path)
    return readers.replay_fixtures(spark, path).groupBy("stage", "answer").agg(F.count(F.lit(1)).alias("n"))


def keyword_batch_terms(spark, d):
    """Types of parts as terms of a batch per brand, with the counts that the reader holds them to."""
    terms = F.array_sort(F.collect_set("p_type"))
    batches = table(spark, d, "part").groupBy("p_brand").agg(terms.alias("terms")).select("p_brand", F.struct(F.col("p_brand").alias("name"), "terms", F.size("terms").alias("term_count"), F.char_length(F.array_join("terms", " ")).alias("char_count")).alias("b"))
    path = one_line_files(batches.select("p_brand", F.to_json(F.struct(F.array("b").alias("batches"))).alias("value")), f"{shared_folder(spark, 'batches')}/files", "p_brand")
    return readers.keyword_batches(spark, path).select("name", "pos", "term")


def content_record_rows(spark, d):
    """Content records of text files: the text in one space, its digest, the name as title."""
    rows = readers.parsed_files(table(spark, d, "documents").select(F.concat(F.lit("a/d"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.encode("text", "UTF-8").alias("content")))
    return readers.content_records(rows).select("title", "section", (F.col("text").isNotNull()).alias("has_text"), F.col("url"))


def published_rows(spark, d):
    """Two generations: the second counts, the first stays beside it."""
    path = f"{shared_folder(spark, 'published')}/nations"
    sinks.publish(table(spark, d, "nation").filter("n_nationkey < 5"), path, "one")
    sinks.publish(table(spark, d, "customer").select("c_custkey", "c_nationkey"), path + "2", "one")
    sinks.publish(table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") + 1).alias("c_nationkey")), path + "2", "two")
    return sinks.published(spark, path + "2")


def newest_revisions(spark, d):
    """Three revisions of customers, fewer each time: of each its newest."""
    path = f"{shared_folder(spark, 'revisions')}/rows"
    for k in (1, 2, 3):
        sinks.append_revision(table(spark, d, "customer").filter(F.col("c_custkey") % k == 0).select("c_custkey", F.concat(F.col("c_name"), F.lit(f" r{k}")).alias("name")), path, f"r{k}")
    return sinks.latest_revisions(spark, path, "c_custkey")


def asset_records(spark, d):
    """An asset of an older version, written and loaded: the column it lacks is null."""
    path = f"{shared_folder(spark, 'asset')}/files"
    profiles.write_asset(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), path, 1, "id", 100)
    return profiles.load_asset(spark, path, {1: "id:bigint,name:string", 2: "id:bigint,name:string,zone:string"}, "id").select("id", "name", F.col("zone").isNull().alias("old"))


def recognition_admission(spark, d):
    """What becomes of the recognition of documents that are taken for scans."""
    k, n = F.col("doc_id"), F.col("n_chars")
    said = lambda on: readers.ocr_admission(F.floor(n / 100) + 1, F.when(k % 3 == 0, 0).otherwise(n), k % 5 == 0, n * 1000, on)
    return table(spark, d, "documents").select("doc_id", said(True).alias("admission"), said(False).alias("without"))


def sitemap_addresses(spark, d):
    """Addresses of pages through a sitemap for each thousand pages: those of the first one's domain."""
    groups = table(spark, d, "pages").groupBy(F.floor(F.col("page_id") / 10).alias("part")).agg(F.array_sort(F.collect_list(F.struct("page_id", "url"))).alias("u"))
    xml = groups.select("part", F.concat(F.lit("<urlset>"), F.array_join(F.transform("u", lambda x: F.concat(F.lit("<url><loc> "), x["url"], F.lit(" </loc></url>"))), "\n"), F.lit("</urlset>")).alias("xml"))
    return xml.select("part", F.explode(pages.sitemap_urls(F.col("xml"))).alias("url"))


def iso_elapsed(spark, d):
    """Seconds from an order to its last shipment, parsed from ISO texts; never negative, null where one is missing."""
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("l"))
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = table(spark, d, "orders").join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", text("o_orderdate").alias("a"), F.when(F.col("o_orderkey") % 7 != 0, text("l")).alias("b"))
    return rows.select("o_orderkey", N.elapsed_seconds(F.to_timestamp("a"), F.to_timestamp("b")).alias("seconds"))


def query_echo(spark, d):
    """Whether every status that a query asks for is among those a customer's orders give back."""
    seen = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("seen"))
    want = F.when(F.col("o_custkey") % 2 == 0, F.array(F.lit("F"), F.lit("O"))).otherwise(F.array(F.lit("P")))
    return seen.select("o_custkey", profiles.query_applied(want, F.col("seen")).alias("applied"))


QUERIES = {f.__name__: f for f in (
    csv_documents, text_documents, json_documents, workbook_tables, company_sheets, docx_texts, archive_members, json_event_log, strict_event_log, offline_index, run_states, settlement_rows, replay_fixture_rows, keyword_batch_terms,
    content_record_rows, published_rows, newest_revisions, asset_records, recognition_admission, sitemap_addresses, iso_elapsed, query_echo,
)}
TURNS_SQL = r"SELECT conv_id || '-' || turn AS name, regexp_replace(text, '[\x00-\x1f]+', ' ', 'g') AS t FROM conversations WHERE text IS NOT NULL AND trim(regexp_replace(text, '[\x00-\x1f]+', ' ', 'g')) <> ''"
DOMAIN_OF = r"lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1))"
ORACLES = {
    "csv_documents": "SELECT c_custkey, c_name, c_mktsegment || '; a' AS note FROM customer",
    "text_documents": "SELECT p_partkey, p_name FROM part",
    "json_documents": "SELECT 'nation ' || s_nationkey AS text, s_suppkey, s_name FROM supplier",
    "workbook_tables": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "company_sheets": "SELECT CASE WHEN c_custkey % 4 <> 0 THEN c_custkey::VARCHAR END AS inn, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS company_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS xlsx_site FROM customer WHERE c_custkey % 12 <> 0",
    "docx_texts": f"SELECT name, 'read' AS status, sha1(t) AS digest FROM ({TURNS_SQL})",
    "archive_members": f"SELECT name, d AS depth, CASE k WHEN 0 THEN 'expanded' WHEN 1 THEN 'read' ELSE 'blocked_path' END AS status, CASE WHEN k = 1 THEN sha1(t) END AS digest FROM ({TURNS_SQL}), (VALUES (0, 0), (1, 1), (2, 1)) v(k, d)",
    "json_event_log": "SELECT event_id, user_id, event_type, value FROM events",
    "strict_event_log": "SELECT event_type, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1",
    "offline_index": "SELECT o_custkey::VARCHAR AS inn, 1 AS result_count, (arg_max(o_orderkey, o_orderkey) % 5)::INT AS search_count, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey",
    "run_states": "SELECT c_custkey::VARCHAR AS inn, c_mktsegment AS status, true AS old FROM customer",
    "settlement_rows": "WITH p AS (SELECT *, abs((c_custkey % 41 - 20) / 10 + 0.05) AS y, abs((c_custkey % 37 - 18) / 10 + 0.05) AS x FROM customer), z AS (SELECT *, CASE WHEN greatest(x, y) < 0.5 THEN 'core' WHEN greatest(x, y) < 1.5 THEN 'outer_band' ELSE 'outside' END AS b FROM p) SELECT c_custkey::VARCHAR AS source_id, 'Full ' || c_custkey AS full_name, c_custkey * 10 AS population, b AS geo_bucket, CASE b WHEN 'core' THEN 5 WHEN 'outer_band' THEN 1 ELSE 0 END AS geo_weight, true AS lacks FROM z",
    "replay_fixture_rows": "SELECT 'site' AS stage, event_type AS answer, count(*) AS n FROM events GROUP BY 2",
    "keyword_batch_terms": "SELECT p_brand AS name, (row_number() OVER (PARTITION BY p_brand ORDER BY p_type) - 1)::INT AS pos, p_type AS term FROM (SELECT DISTINCT p_brand, p_type FROM part)",
    "content_record_rows": r"SELECT 'd' || doc_id || '.txt' AS title, 'documents' AS section, regexp_matches(coalesce(text, ''), '\S') AS has_text, 'a/d' || doc_id || '.txt' AS url FROM documents",
    "published_rows": "SELECT c_custkey, c_nationkey + 1 AS c_nationkey FROM customer",
    "newest_revisions": "SELECT c_custkey, c_name || ' r' || k AS name, 'r' || k AS revision FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 3 WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS k FROM customer)",
    "asset_records": "SELECT c_custkey AS id, c_name AS name, true AS old FROM customer",
    "recognition_admission": "SELECT doc_id, CASE WHEN NOT (doc_id % 3 = 0 OR n_chars = 0 OR doc_id % 5 = 0) THEN 'not_needed' WHEN n_chars // 100 + 1 > 24 OR n_chars * 1000 > 4000000 THEN 'budget_skipped' ELSE 'admitted' END AS admission, CASE WHEN NOT (doc_id % 3 = 0 OR n_chars = 0 OR doc_id % 5 = 0) THEN 'not_needed' WHEN n_chars // 100 + 1 > 24 OR n_chars * 1000 > 4000000 THEN 'budget_skipped' ELSE 'not_configured' END AS without FROM documents",
    "sitemap_addresses": f"WITH p AS (SELECT page_id // 10 AS part, page_id, url, regexp_extract({DOMAIN_OF}, '([^.]+\\.[^.]+\\.[^.]+|[^.]+\\.[^.]+)$', 1) AS host, array_to_string(string_split({DOMAIN_OF}, '.')[-2:], '.') AS dom FROM pages), f AS (SELECT part, arg_min(dom, page_id) AS dom FROM p GROUP BY 1) SELECT DISTINCT p.part, p.url FROM p JOIN f ON p.part = f.part AND p.dom = f.dom",
    "iso_elapsed": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 AND l IS NOT NULL THEN greatest(0, epoch(l) - epoch(o_orderdate)) END::DOUBLE AS seconds FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS l FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey",
    "query_echo": "SELECT o_custkey, CASE WHEN o_custkey % 2 = 0 THEN bool_or(o_orderstatus = 'F') AND bool_or(o_orderstatus = 'O') ELSE bool_or(o_orderstatus = 'P') END AS applied FROM orders GROUP BY 1",
}
