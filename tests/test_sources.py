import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quarrylight.sources import pages, readers, sinks
from quarrylight.streaming import events


def xlsx(rows):
    cells = "".join(f"<row r='{i}'>" + "".join(f"<c r='{chr(65 + k)}{i}' t='inlineStr'><is><t>{v}</t></is></c>" for k, v in enumerate(r) if v is not None) + "</row>" for i, r in enumerate(rows, 1))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'><sheetData>{cells}</sheetData></worksheet>")
    return raw.getvalue()


def test_company_sheet(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(xlsx([["ИНН", " Название ", "Сайт"], ["7707083893", "Завод", None], [None, None, "x.ru"], ["1", None, None]]))
    rows = readers.companies(spark, str(tmp_path)).orderBy("row_index").collect()
    assert [(r.row_index, r.inn, r.company_name, r.xlsx_site) for r in rows] == [(2, "7707083893", "Завод", None), (4, "1", None, None)]
    (tmp_path / "a.xlsx").write_bytes(xlsx([["ИНН"], ["1"]]))
    with pytest.raises(Exception, match="lacks a header"):
        readers.companies(spark, str(tmp_path)).collect()


def test_documents_of_every_format(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("имя;x\nа;1\n".encode("cp1251"))
    (tmp_path / "b.txt").write_text("﻿hello", encoding="utf-8")
    (tmp_path / "c.json").write_text(json.dumps({"text": "body", "tables": [[["p", "q"]]]}))
    (tmp_path / "d.pdf").write_bytes(b"%PDF")
    (tmp_path / "e.xlsx").write_bytes(b"broken")
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("in.txt", "inside")
        z.writestr("../out.txt", "outside")
    docs = {r.path.rsplit("/", 1)[-1] if "!" not in r.path else r.path.split("!/")[1]: r for r in readers.documents(spark, str(tmp_path)).collect()}
    assert docs["a.csv"].tables == [[["имя", "x"], ["а", "1"]]] and docs["b.txt"].text == "hello"
    assert docs["c.json"].text == "body" and docs["d.pdf"].status == "unsupported_format" and docs["e.xlsx"].status.startswith("failed")
    assert docs["f.zip"].status == "expanded" and docs["in.txt"].text == "inside" and docs["../out.txt"].status == "blocked_path"
    records = {r.title: r for r in readers.content_records(readers.documents(spark, str(tmp_path))).collect()}
    assert records["a.csv"].text == "имя | x а | 1"


def test_parsed_files_share_frames():
    """A frame for each file took most of the time of small ones; large ones still part early."""
    import pandas as pd

    small = pd.DataFrame({"path": [f"{i}.txt" for i in range(1200)], "content": [b"x"] * 1200})
    large = pd.DataFrame({"path": ["a.txt", "b.txt", "c.zip"], "content": [b"y" * (readers.SIZE_AT_ONCE // 2), None, b"no archive"]})
    frames = list(readers.parsed_frames(iter([small, large])))
    assert [len(f) for f in frames] == [500, 500, 201, 2] and list(frames[2]["text"])[-1] == "y" * (readers.SIZE_AT_ONCE // 2) and list(frames[3]["text"])[0] == ""


def test_offline_snapshot_last_request_wins(spark, tmp_path):
    data = {"requests": [{"request": "1", "result": [{"inn": "1", "n": "old"}], "result_count": 1, "search_count": 1}, {"request": "1", "result": [{"inn": "2"}, {"inn": "1", "n": "new"}], "result_count": 2, "search_count": 1}, {"request": "3", "result": [], "result_count": 0, "search_count": 1}]}
    (tmp_path / "s.json").write_text(json.dumps(data))
    found = {r.inn: r for r in readers.offline_snapshot(spark, str(tmp_path / "s.json")).collect()}
    assert found["1"].entity["n"] == "new" and found["1"].result_count == 2 and not found["3"].entity


def test_event_logs(spark, tmp_path):
    (tmp_path / "log").write_text('{"a": 1}\n\nbroken\n[1]\n{"a": "x"}\n{"a": 2}\n')
    assert sorted(r.a for r in readers.json_events(spark, str(tmp_path / "log"), "a int").collect()) == [1, 2]
    (tmp_path / "ok").write_text('{"a": 1}\n\n')
    assert readers.strict_events(spark, str(tmp_path / "ok"), "a int", ("a",)).count() == 1
    (tmp_path / "bad").write_text('{"b": 1}\n')
    with pytest.raises(Exception, match="lacks one of"):
        readers.strict_events(spark, str(tmp_path / "bad"), "a int", ("a",)).collect()


def test_run_state_versions(spark, tmp_path):
    (tmp_path / "v1").write_text('{"inn": "1", "status": "ok"}\n')
    schemas = {1: "inn string, status string", 2: "inn string, status string, sources map<string,string>"}
    row = readers.run_state(spark, str(tmp_path / "v1"), 1, schemas).first()
    assert row.inn == "1" and row.sources is None
    (tmp_path / "v1").write_text('{"inn": "1"}\n{"inn": "1"}\n')
    with pytest.raises(ValueError):
        readers.run_state(spark, str(tmp_path / "v1"), 1, schemas)


def test_keyword_batches_and_fixtures(spark, tmp_path):
    (tmp_path / "k.json").write_text(json.dumps({"batches": [{"name": "b", "terms": ["лом", "труба"], "term_count": 2, "char_count": 9}]}))
    assert [r.term for r in readers.keyword_batches(spark, str(tmp_path / "k.json")).orderBy("pos").collect()] == ["лом", "труба"]
    (tmp_path / "k.json").write_text(json.dumps({"batches": [{"name": "b", "terms": ["лом"], "term_count": 2, "char_count": 9}]}))
    with pytest.raises(Exception, match="counts disagree"):
        readers.keyword_batches(spark, str(tmp_path / "k.json")).collect()
    (tmp_path / "f.json").write_text('{"stage": "a"}\n{"stage": "b"}\n')
    with pytest.raises(ValueError):
        readers.replay_fixtures(spark, str(tmp_path / "f.json"))


def test_recognition_is_admitted_within_the_budget(spark):
    rows = spark.createDataFrame([(1, 10, False, 5), (1, 0, False, 5), (30, 0, False, 5), (1, 9, True, 5_000_000)], "p int, t int, i boolean, s int")
    state = lambda c: [r.x for r in rows.select(readers.ocr_admission(F.col("p"), F.col("t"), F.col("i"), F.col("s"), c).alias("x")).collect()]
    assert state(True) == ["not_needed", "admitted", "budget_skipped", "budget_skipped"] and state(False)[1] == "not_configured"


HTML = """<html><head><title> Our  plant </title><meta name="description" content="d"><script>var x = "<a href='n'>";</script></head>
<body><p>Call <a href="tel:+74951234567">us</a></p><table><tr><td>a</td><td itemprop="name">b c</td></tr></table><a href="/x">more</a></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "https://a.ru", HTML), (2, "https://b.ru", None), (3, "u", "<p>broken <b")], "i bigint, u string, h string")
    found = {r.i: r for r in pages.page_records(df, "i", "u", "h").collect()}
    r = found[1]
    assert r.title == "Our plant" and r.description == "d" and r.n_links == 2 and r.phones == ["+74951234567"] and r.rows == [["a", "b c"]] and r.itemprops == {"name": ["b c"]}
    assert "var x" not in r.text and found[2].text == "" and len({x.fingerprint for x in found.values()}) == 3
    assert pages.probe(df, "h").filter("i = 1").first().n_links == 3


def test_mending():
    assert pages.mend("Завод".encode().decode("latin-1")) == "Завод" and pages.mend("Ñandú â ð") == "Ñandú â ð" and pages.mend(None) is None


@pytest.mark.parametrize("text", ["ESPAÑA", "ÑÑ A", "Ã, Ð", "it’s", "中文", "😀 ok", "a\ufffdb", "\x85 Ê"])
def test_mending_of_every_letter(text):
    """Text whose only signs looked like signs once mended, or had another first byte, stayed spoiled."""
    assert pages.mend(text.encode().decode("latin-1")) == text == pages.mend(text)


def test_sitemap(spark):
    xml = "<urlset><url><loc> https://a.ru/1 </loc></url><loc>https://b.ru/2</loc><loc>https://www.a.ru/3</loc></urlset>"
    assert spark.createDataFrame([(xml,)], "x string").select(pages.sitemap_urls(F.col("x")).alias("u")).first().u == ["https://a.ru/1", "https://www.a.ru/3"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.publish(df, str(tmp_path / "p"), "1")
    sinks.publish(df.limit(1), str(tmp_path / "p"), "2")
    assert sinks.published(spark, str(tmp_path / "p")).count() == 1
    sinks.append_revision(df, str(tmp_path / "r"), "20240101")
    sinks.append_revision(df.filter("k = 1").withColumn("v", F.lit("new")), str(tmp_path / "r"), "20240102")
    assert sorted((r.k, r.v) for r in sinks.latest_revisions(spark, str(tmp_path / "r"), "k").collect()) == [(1, "new"), (2, "b")]
    sources = spark.createDataFrame([(1, "x", "ok")], "k int, source string, status string")
    flat = {r.k: r for r in sinks.flat_export(df, sources, "k", {"v": F.col("v")}, ["x", "y"]).collect()}
    assert (flat[1].x_status, flat[1].y_status, flat[2].x_status) == ("ok", "", "")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 2
    assert [r.value for r in sinks.report_lines(df, "%s: %s", ["k", "v"]).collect()] == ["1: a", "2: b"]


def test_streams_over_several_batches(spark, tmp_path):
    rows = [(i, 1 + i % 2, t, float(i)) for i, t in enumerate("bbsbbbcsb" * 3)]
    schema = "n int, k int, t string, v double"
    for i in range(0, len(rows), 5):
        spark.createDataFrame(rows[i : i + 5], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    read = lambda: events.read_events(spark, str(tmp_path / "in"), max_files=1)
    stats = {r.k: r.n_events for r in events.run_to_table(events.host_stats(read(), "k", "v"), "complete", "t").collect()}
    assert stats == {1: 14, 2: 13}
    kind = F.col("t")
    modes = {r.k: (r.bans, r.challenges) for r in events.run_to_table(events.circuit_state(read(), "k", "n", kind == "b", kind == "c", kind == "s"), "update", "t", ["k"]).collect()}
    want = {}
    for n, k, t, _ in rows:
        b, c = want.get(k, (0, 0))
        want[k] = (0, 0) if t == "s" else (b + (t == "b"), c + (t == "c"))
    assert modes == want
    last = {r.k: r.last for r in events.run_to_table(events.last_attempts(read(), "k", "n", [], 4), "update", "t", ["k"]).collect()}
    assert last == {k: [n for n, j, *_ in rows if j == k][-4:] for k in (1, 2)}
    once = events.run_to_table(events.emit_once(read().select("k", "t"), ["k", "t"]), "append", "t").collect()
    assert sorted(map(tuple, once)) == sorted({(k, t) for _, k, t, _ in rows})


def test_assets_are_written_and_loaded(spark, tmp_path):
    from quarrylight.operators import profiles

    versions = {1: "id:bigint,name:string", 2: "id:bigint,name:string,zone:string"}
    df = spark.createDataFrame([(i, None if i % 3 else f"n{i}") for i in range(25)], "id bigint, name string")
    profiles.write_asset(df, str(tmp_path / "a"), 1, "id", 10)
    assert len(list((tmp_path / "a").glob("part=*"))) == 3
    assert sorted(map(tuple, profiles.load_asset(spark, str(tmp_path / "a"), versions, "id").collect())) == [(i, None if i % 3 else f"n{i}", None) for i in range(25)]
    profiles.write_asset(df.limit(2), str(tmp_path / "a"), 1, "id")
    assert profiles.load_asset(spark, str(tmp_path / "a"), versions, "id").count() == 2
    with pytest.raises(Exception, match="lacks id"):
        profiles.write_asset(df.withColumn("id", F.lit(None).cast("bigint")), str(tmp_path / "b"), 1, "id")
    profiles.write_asset(df, str(tmp_path / "c"), 7, "id")
    with pytest.raises(ValueError, match="unknown version"):
        profiles.load_asset(spark, str(tmp_path / "c"), versions, "id")


def test_files_from_any_table(spark):
    rows = spark.createDataFrame([("a.txt", bytearray(b"x")), ("b.txt", None), ("c.csv", bytearray(b"p;q\n1;2\n")), ("d", bytearray(b"?")), ("a.txt", bytearray(b"x"))], "path string, content binary")
    found = sorted((r.path, r.status, r.text, r.tables) for r in readers.parsed_files(rows).collect() if r.path != "c.csv")
    assert found == [("a.txt", "read", "x", None), ("a.txt", "read", "x", None), ("b.txt", "read", "", None), ("d", "unsupported_format", None, None)]
    assert readers.parsed_files(rows.filter("path = 'c.csv'")).first().tables == [[["p", "q"], ["1", "2"]]] and readers.parsed_files(rows.limit(0)).count() == 0


def test_elapsed_time_needs_both_ends(spark):
    from quarrylight.functions import numbers as N

    rows = spark.sql("select timestamp'2024-01-01 00:00:00' a, timestamp'2024-01-01 00:01:30' b, cast(null as timestamp) n")
    assert tuple(rows.select(N.elapsed_seconds(F.col("a"), F.col("b")), N.elapsed_seconds(F.col("b"), F.col("a")), N.elapsed_seconds(F.col("a"), F.col("n")), N.elapsed_seconds(F.col("n"), F.col("a"))).first()) == (90.0, 0.0, None, None)
