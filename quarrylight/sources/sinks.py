"""Sinks: flat exports, workbooks, staged generations, revisions, run summaries, text reports."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Mapping, Sequence
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def flat_export(results: DataFrame, sources: DataFrame, key: str, columns: Mapping[str, Column], active: Sequence[str]) -> DataFrame:
    """One flat row per entity: the given columns and <source>_status for each active source, blank where it has none."""
    status = sources.groupBy(key).agg(*[F.max(F.when(F.col("source") == s, F.col("status"))).alias(f"{s}_status") for s in active])
    out = results.select(key, *[c.alias(n) for n, c in columns.items()]).join(status, key, "left")
    return out.na.fill("", [f"{s}_status" for s in active])


def joined(values: Column, mark: str = " | ") -> Column:
    """An array as one cell."""
    return F.coalesce(F.array_join(values, mark), F.lit(""))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per task: a wide export isn't drawn through one."""
    df.write.mode("overwrite").option("header", "true").option("encoding", "UTF-8").csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """A JSON object per line, null fields kept, one file per task."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def workbook(header: Sequence[str], rows: Sequence[Sequence], sheet: str = "Sheet1", links: bool = False) -> bytes:
    """An xlsx file of one sheet with a frozen header row; numbers as numbers, all else as text, addresses as links on request."""

    def name(k: int) -> str:
        out = ""
        while k >= 0:
            k, out = k // 26 - 1, chr(65 + k % 26) + out
        return out

    def cell(v, k: int, i: int) -> str:
        at = f"{name(k)}{i}"
        if v is None or v != v:
            return ""
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{at}"><v>{v!r}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape("".join(c for c in str(v) if c >= " " or c in chr(9) + chr(10)))}</t></is></c>'

    table = [list(header), *rows]
    body = "".join(f'<row r="{i}">{"".join(cell(v, k, i) for k, v in enumerate(r))}</row>' for i, r in enumerate(table, 1))
    found = [(f"{name(k)}{i}", v) for i, r in enumerate(rows, 2) for k, v in enumerate(r) if isinstance(v, str) and v.startswith(("http://", "https://"))] if links else []
    linked = f"<hyperlinks>{''.join(f'<hyperlink ref={quoteattr(at)} r:id={quoteattr(f'rId{n}')}/>' for n, (at, _) in enumerate(found, 1))}</hyperlinks>" if found else ""
    space, office = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package, types = "http://schemas.openxmlformats.org/package/2006/relationships", "application/vnd.openxmlformats-officedocument.spreadsheetml"
    frozen = '<sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews>'
    files = {
        "[Content_Types].xml": f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{types}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{types}.worksheet+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{space}" xmlns:r="{office}"><sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{space}" xmlns:r="{office}">{frozen}<sheetData>{body}</sheetData>{linked}</worksheet>',
    }
    if found:
        files["xl/worksheets/_rels/sheet1.xml.rels"] = f'<Relationships xmlns="{package}">{"".join(f"<Relationship Id={quoteattr(f"rId{n}")} Type={quoteattr(office + "/hyperlink")} Target={quoteattr(v)} TargetMode={quoteattr("External")}/>" for n, (_, v) in enumerate(found, 1))}</Relationships>'
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for path, text in files.items():
            z.writestr(path, f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>{text}')
    return raw.getvalue()


def workbooks(df: DataFrame, order: Sequence[str | Column], per_book: int = 100_000, sheet: str = "Sheet1", links: bool = False) -> DataFrame:
    """df as xlsx files of at most per_book rows in order: book_no, n_rows, content. Each range of rows is written where it lies, none is drawn through one task."""
    names = df.columns

    def write(batches):
        held = []
        for pdf in batches:
            held += pdf.astype(object).where(pdf.notna(), None).values.tolist()
            while len(held) >= per_book:
                yield pd.DataFrame({"n_rows": [per_book], "content": [workbook(names, held[:per_book], sheet, links)]})
                held = held[per_book:]
        if held:
            yield pd.DataFrame({"n_rows": [len(held)], "content": [workbook(names, held, sheet, links)]})

    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInPandas(write, "n_rows int, content binary").select(F.monotonically_increasing_id().alias("book_no"), "n_rows", "content")


def publish(df: DataFrame, path: str, generation: str) -> None:
    """Writes a generation beside the others; it counts once its pointer row is written, which is last."""
    df.write.mode("overwrite").parquet(f"{path}/gen={generation}")
    df.sparkSession.createDataFrame([(generation,)], "generation string").withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/_pointers")


def published(spark: SparkSession, path: str) -> DataFrame:
    """The generation whose pointer is the last."""
    last = spark.read.parquet(f"{path}/_pointers").agg(F.max_by("generation", "at")).first()[0]
    return spark.read.parquet(f"{path}/gen={last}")


def append_revision(dossiers: DataFrame, path: str, revision: str) -> None:
    """Adds a revision of each entity; none is ever changed."""
    dossiers.withColumn("revision", F.lit(revision)).write.mode("append").partitionBy("revision").parquet(path)


def latest_revisions(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest revision of each entity, by an aggregate that each task combines first."""
    rows = spark.read.parquet(path).withColumn("revision", F.col("revision").cast("string"))
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), "revision").alias("v")).select(key, "v.*")


def run_summary(results: DataFrame, status: str) -> DataFrame:
    """One row: rows, rows by state, and the state of the export (suppressed, all_completed, terminal or partial)."""
    done, failed = F.count_if(F.col(status) == "completed"), F.count_if(F.col(status) == "failed")
    out = results.agg(F.count(F.lit(1)).alias("n"), done.alias("n_completed"), failed.alias("n_failed"))
    n, a, b = F.col("n"), F.col("n_completed"), F.col("n_failed")
    return out.withColumn("export_state", F.when(n == 0, "suppressed").when(a == n, "all_completed").when(a + b == n, "terminal").otherwise("partial"))


def report_lines(df: DataFrame, template: str, columns: Sequence[str]) -> DataFrame:
    """A text line per row, for write.text."""
    return df.select(F.format_string(template, *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("value"))
