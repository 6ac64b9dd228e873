"""Readers of landed files: company sheets, offline snapshots, event logs, run states, keyword batches, documents of any format.

Live sources aren't called; what they gave is read from files. Formats without a parser here give a row with status
unsupported_format rather than an error.
"""

from __future__ import annotations

import csv
import io
import json
import re
import tarfile
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import addresses, numbers
from ..functions import text as X

#: Header names of the company sheet.
SHEET_COLUMNS = {"инн": "inn", "название": "company_name", "сайт": "xlsx_site", "телефон": "xlsx_phone", "комментарий": "comment", "коммент": "comment"}
COMPANY = ("inn", "company_name", "xlsx_site", "xlsx_phone", "comment")
CHARSETS = ("utf-8-sig", "utf-8", "cp1251", "latin-1")


def decode(raw: bytes) -> str:
    """The first charset that fits."""
    for charset in CHARSETS[:-1]:
        try:
            return raw.decode(charset)
        except UnicodeDecodeError:
            continue
    return raw.decode(CHARSETS[-1])


def csv_rows(text: str) -> list[list[str]]:
    """Rows with the delimiter (comma, semicolon or tab) that gives most cells in the first 20 lines."""
    head = text.splitlines()[:20]
    best = max(",;\t", key=lambda d: sum(len(r) for r in csv.reader(head, delimiter=d)))
    return [r for r in csv.reader(io.StringIO(text), delimiter=best) if any(c.strip() for c in r)]


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "w": "http://schemas.openxmlformats.org/wordprocessingml/2006/main"}


def xlsx_tables(raw: bytes) -> list[list[list[str]]]:
    """The rows of each sheet, cells as text; integral numbers without a fraction."""
    book = zipfile.ZipFile(io.BytesIO(raw))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        shared = ["".join(t.text or "" for t in s.iter(f"{{{_NS['m']}}}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
    names = sorted((n for n in book.namelist() if re.match(r"xl/worksheets/sheet\d+\.xml$", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    tables = []
    for n in names:
        rows = []
        for r in ElementTree.fromstring(book.read(n)).iter(f"{{{_NS['m']}}}row"):
            cells: list[str] = []
            for c in r.findall("m:c", _NS):
                at = 0
                for letter in re.match(r"[A-Z]*", c.get("r", ""))[0]:
                    at = at * 26 + ord(letter) - 64
                value = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")) if c.get("t") == "inlineStr" else (v.text or "" if (v := c.find("m:v", _NS)) is not None else "")
                value = shared[int(value)] if c.get("t") == "s" and value else re.sub(r"^(-?\d+)\.0+$", r"\1", value)
                cells += [""] * (max(at - 1, 0) - len(cells)) if at else []
                cells.append(value)
            rows.append(cells)
        tables.append(rows)
    return tables


def docx_parts(raw: bytes) -> tuple[str, list[list[list[str]]]]:
    """(paragraphs outside tables, tables)."""
    w = f"{{{_NS['w']}}}"
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml")).find(f"{w}body")
    line = lambda x: "".join(t.text or "" for t in x.iter(f"{w}t"))
    tables = [[[line(c) for c in r.findall(f"{w}tc")] for r in t.findall(f"{w}tr")] for t in body.findall(f"{w}tbl")]
    return "\n".join(x for p in body.findall(f"{w}p") if (x := line(p))), tables


def read_document(path: str, raw: bytes, depth: int = 0, most: int = 3) -> list[dict]:
    """Rows of one file; an archive gives a row for itself and one for each member, down to a depth, none outside its folder."""
    suffix = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    row = {"path": path, "format": suffix, "depth": depth, "size": len(raw), "text": None, "tables": None, "status": "read"}
    try:
        if suffix == "csv":
            row["tables"] = [csv_rows(decode(raw))]
        elif suffix == "txt":
            row["text"] = decode(raw)
        elif suffix == "json":
            given = json.loads(decode(raw))
            row["text"] = given.get("text", "") if isinstance(given, dict) else json.dumps(given, ensure_ascii=False)
            row["tables"] = given.get("tables") if isinstance(given, dict) else None
        elif suffix == "xlsx":
            row["tables"] = xlsx_tables(raw)
        elif suffix == "docx":
            row["text"], row["tables"] = docx_parts(raw)
        elif suffix == "zip":
            members = []
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                for m in z.infolist():
                    inside = f"{path}!/{m.filename}"
                    blocked = m.filename.startswith("/") or ".." in m.filename.split("/")
                    if m.is_dir():
                        continue
                    if blocked or depth >= most:
                        members.append({**row, "path": inside, "depth": depth + 1, "status": "blocked_path" if blocked else "depth_limit", "size": m.file_size})
                    else:
                        members += read_document(inside, z.read(m), depth + 1, most)
            return [{**row, "status": "expanded"}, *members]
        elif suffix in ("tar", "tgz", "gz", "bz2", "xz") and (suffix != "gz" or path.lower().endswith(".tar.gz")):
            members = []
            with tarfile.open(fileobj=io.BytesIO(raw)) as t:
                for m in t.getmembers():
                    inside = f"{path}!/{m.name}"
                    blocked = m.name.startswith("/") or ".." in m.name.split("/")
                    if m.isdir():
                        continue
                    if blocked or not m.isfile() or depth >= most:
                        members.append({**row, "path": inside, "depth": depth + 1, "status": "blocked_path" if blocked or not m.isfile() else "depth_limit", "size": m.size})
                    else:
                        members += read_document(inside, t.extractfile(m).read(), depth + 1, most)
            return [{**row, "status": "expanded"}, *members]
        else:
            row["status"] = "unsupported_format"
    except Exception as x:  # a broken file is a row of the ledger, not the end of the scan
        row["status"] = f"failed: {type(x).__name__}"
    return [row]


DOCUMENT = "path string, format string, depth int, size bigint, text string, tables array<array<array<string>>>, status string"


#: A frame of parsed files is handed on at so many rows, or so many characters of text and bytes of files.
ROWS_AT_ONCE, SIZE_AT_ONCE = 500, 4 << 20


def parsed_frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of files, many to a frame: one of its own costs more than a small file's parsing."""
    frame = lambda rows: pd.DataFrame(rows, columns=["path", "format", "depth", "size", "text", "tables", "status"]).astype({"text": object})
    rows, size = [], 0
    for pdf in batches:
        for p, c in zip(pdf["path"], pdf["content"], strict=True):
            found = read_document(p, c or b"")
            rows += found
            size += sum(r["size"] + len(r["text"] or "") for r in found)
            if len(rows) >= ROWS_AT_ONCE or size >= SIZE_AT_ONCE:
                yield frame(rows)
                rows, size = [], 0
    if rows:
        yield frame(rows)


def parsed_files(files: DataFrame) -> DataFrame:
    """Files (path, content) as rows of text and tables; a file is one row, so it must fit a task. A null content is an empty file."""
    return files.select("path", "content").mapInPandas(parsed_frames, DOCUMENT)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Every file under a path as rows of text and tables."""
    return parsed_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path))


def content_records(docs: DataFrame) -> DataFrame:
    """Documents as content records: text from the tables where there is none, title from the name, section documents."""
    text = F.coalesce(X.clean(F.col("text")), X.clean(X.tables_text(F.col("tables"))))
    return docs.filter("status = 'read'").select(F.col("path").alias("url"), F.lit("documents").alias("section"), F.element_at(F.split("path", "/"), -1).alias("title"), text.alias("text"), F.sha1(F.coalesce(text, F.col("path")).cast("binary")).alias("fingerprint"))


def company_rows(files: DataFrame) -> DataFrame:
    """Company sheets (path, content; xlsx or csv): row_index from 2, rows without id and name dropped; a missing header is an error."""

    def work(batches):
        for pdf in batches:
            for p, raw in zip(pdf["path"], pdf["content"], strict=True):
                rows = xlsx_tables(raw)[0] if p.lower().endswith(".xlsx") else csv_rows(decode(raw))
                names = [SHEET_COLUMNS.get(" ".join(c.lower().split())) for c in rows[0]] if rows else []
                if "inn" not in names or "company_name" not in names:
                    raise ValueError(f"{p} lacks a header of: инн, название")
                out = [{"row_index": i, **{n: v.strip() or None for n, v in zip(names, r, strict=False) if n}} for i, r in enumerate(rows[1:], 2)]
                yield pd.DataFrame([r for r in out if r.get("inn") or r.get("company_name")], columns=["row_index", *COMPANY], dtype=object)

    return files.select("path", "content").mapInPandas(work, "row_index int, " + ", ".join(f"{c} string" for c in COMPANY))


def companies(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the company sheets under a path."""
    return company_rows(spark.read.format("binaryFile").load(path))


SNAPSHOT = "requests array<struct<request:string,result_count:int,search_count:int,result:array<map<string,string>>>>"


def offline_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """An offline index: the last request of an id wins, with the first result of that id."""
    requests = spark.read.schema(SNAPSHOT).option("multiLine", "true").json(path).select(F.posexplode("requests").alias("pos", "r"))
    keyed = requests.select(X.digits(F.col("r.request")).alias("inn"), "pos", "r.result_count", "r.search_count", F.col("r.result").alias("results"))
    own = F.get(F.filter("results", lambda m: X.digits(m["inn"]) == F.col("inn")), 0)
    last = keyed.withColumn("entity", own).groupBy("inn").agg(F.max_by(F.struct("result_count", "search_count", F.map_entries("entity").alias("e")), "pos").alias("v"))
    return last.select("inn", "v.result_count", "v.search_count", F.map_from_entries("v.e").alias("entity"))


def json_events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of JSON lines: blank, broken and non-object lines are skipped."""
    lines = spark.read.text(path).filter(F.trim("value").startswith("{"))
    full = T._parse_datatype_string(schema).add("_broken", "string")
    parsed = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("e"))
    return parsed.filter("e._broken is null").select("e.*").drop("_broken")


def strict_events(spark: SparkSession, path: str, schema: str, required: tuple[str, ...]) -> DataFrame:
    """The same where a broken line or a missing field is an error."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("e")).select("e.*")
    whole = F.lit(True)
    for c in required:
        whole = whole & F.col(c).isNotNull()
    return parsed.filter(F.when(whole, True).otherwise(F.raise_error(F.lit(f"an event lacks one of {', '.join(required)}")).cast("boolean")))


def run_state(spark: SparkSession, path: str, version: int, schemas: dict[int, str]) -> DataFrame:
    """A run's entries from either version of its snapshot, older ones with null for what they lack. A missing or repeated id is an error."""
    newest = T._parse_datatype_string(schemas[max(schemas)])
    found = spark.read.schema(schemas[version]).json(path)
    whole = spark.createDataFrame([], newest).unionByName(found, allowMissingColumns=True)
    bad = whole.groupBy("inn").count().filter("inn is null or count > 1")
    if not bad.isEmpty():
        raise ValueError("the snapshot has a missing or repeated id")
    return whole


SETTLEMENT = ("source_id", "region", "municipality", "settlement", "settlement_type", "full_name", "population", "latitude_dd", "longitude_dd")


def settlements(spark: SparkSession, path: str, centre: tuple[float, float], outer: list[tuple[float, float]], inner: list[tuple[float, float]]) -> DataFrame:
    """A CSV of settlements (header, UTF-8 with or without a mark) with look-up forms of its names, and zone, weight and distance to the centre (2 places).

    Columns that the file lacks are null; a row without usable coordinates is an error, as it could be in no zone.
    """
    given = spark.read.option("header", "true").option("encoding", "UTF-8").csv(path)
    given = given.toDF(*[c.lstrip("\ufeff").strip() for c in given.columns])
    text = given.select(*[(X.clean(F.col(c)) if c in given.columns else F.lit(None).cast("string")).alias(c) for c in SETTLEMENT])
    lat, lon = F.col("latitude_dd").try_cast("double"), F.col("longitude_dd").try_cast("double")
    usable = lat.between(-90, 90) & lon.between(-180, 180)
    placed = text.filter(F.when(usable, True).otherwise(F.raise_error(F.concat(F.lit("no coordinates: "), F.coalesce("source_id", "full_name", F.lit("?")))).cast("boolean"))).withColumns({"latitude_dd": lat, "longitude_dd": lon, "population": F.col("population").try_cast("bigint")})
    zone = numbers.zone(F.col("latitude_dd"), F.col("longitude_dd"), outer, inner)
    distance = numbers.haversine_km(F.col("latitude_dd"), F.col("longitude_dd"), F.lit(centre[0]), F.lit(centre[1]))
    named = {f"{c}_normalized": addresses.lookup_text(F.col(c)) for c in ("region", "municipality", "settlement", "full_name")}
    return placed.withColumns(named | {"geo_bucket": zone, "geo_weight": numbers.zone_weight(zone), "distance_km": F.round(distance, 2)})


def replay_fixtures(spark: SparkSession, path: str) -> DataFrame:
    """Fixtures of one stage; more than one stage is an error."""
    found = spark.read.json(path)
    if found.select("stage").distinct().limit(2).count() > 1:
        raise ValueError("fixtures of more than one stage")
    return found


def keyword_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batches with their terms in order; declared counts of terms and characters must agree."""
    batches = spark.read.schema("batches array<struct<name:string,terms:array<string>,term_count:int,char_count:int>>").option("multiLine", "true").json(path).select(F.explode("batches").alias("b")).select("b.*")
    right = (F.size("terms") == F.col("term_count")) & (F.char_length(F.array_join("terms", " ")) == F.col("char_count"))
    checked = batches.filter(F.when(right, True).otherwise(F.raise_error(F.concat(F.lit("counts disagree in batch "), "name")).cast("boolean")))
    return checked.select("name", F.posexplode("terms").alias("pos", "term"))


def ocr_admission(pages: Column, text_length: Column, image_only: Column, size: Column, configured: bool, max_pages: int = 24, max_bytes: int = 4_000_000) -> Column:
    """What becomes of a PDF's recognition: not_needed, budget_skipped, not_configured or admitted."""
    needed = (text_length == 0) | image_only
    return F.when(~needed, "not_needed").when((pages > max_pages) | (size > max_bytes), "budget_skipped").otherwise("admitted" if configured else "not_configured")
