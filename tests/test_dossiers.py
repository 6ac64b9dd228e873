import io
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from quarrylight.functions import addresses
from quarrylight.operators import dossiers, entities, geo
from quarrylight.operators.records import rank_routes
from quarrylight.sources import pages, readers, sinks

TESTDATA = "/root/testdata/sf0.001"


def test_lookup_text(spark):
    rows = {"г. Москва, р-н Арбат": "город москва район арбат", "Вн.тер.г муниципальный округ Озеро, обл": "озеро область", "д. 5, пос. Ёлки": "д 5 поселок елки", "": "", None: ""}
    df = spark.createDataFrame([(k,) for k in rows], "x string")
    assert {r.x: r.y for r in df.withColumn("y", addresses.lookup_text(F.col("x"))).collect()} == rows


def city_places(spark, bucket="outside"):
    fields = "place_id string, settlement string, municipality string, region string, bucket string, weight int, outer boolean, inner boolean, distance double, priority int, n_variants int"
    rows = [("c1", "Большой", "Округ один", "Большой", "outside", 0, False, False, 10.0, 0, 2), ("c2", "Большой", "Округ два", "Большой", bucket, 0, False, False, 16.0, 0, 3), ("l1", "Малино", "Округ два", "Большой", "outside", 0, False, False, 20.0, 0, 1), ("o", "Далекий", "", "Край", "outside", 0, False, False, 90.0, 0, 1)]
    aliases = [("c1", "г. Большой"), ("c1", "Большой"), ("c2", "г. Большой"), ("c2", "Большой"), ("l1", "Малино"), ("o", "Далекий")]
    return spark.createDataFrame(rows, fields), spark.createDataFrame(aliases, "place_id string, alias string")


def test_federal_city_ties(spark):
    rows = spark.createDataFrame([(1, "г. Большой, ул. Новая"), (2, "г. Большой, Малино, 3"), (3, "Далекий"), (4, "нет такого"), (5, None), (6, "Большой, Округ два")], "i int, a string")
    places, aliases = city_places(spark)
    found = {r.i: (r["match"], r.settlement, r.municipality, r.distance, r.n_variants) for r in geo.city_lookup(rows, "i", "a", places, aliases).collect()}
    assert found[1] == ("matched", "Большой", "", 13.0, 5) and found[2][:2] == ("matched", "Малино")
    assert found[3][:2] == ("matched", "Далекий") and found[4][0] == "not_found" and found[5][0] == "no_address"
    assert found[6][:3] == ("matched", "Большой", "Округ два")
    split, _ = city_places(spark, "core")
    assert geo.city_lookup(rows.filter("i = 1"), "i", "a", split, aliases).first()["match"] == "ambiguous"


def test_codec_refuses_what_it_does_not_know(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "y", 3)], "k int, v string, n int")
    schema = df.drop("k").schema
    coded = dossiers.encode_records(df, "k", "v2")
    assert sorted(map(tuple, dossiers.decode_records(coded, "k", "document", schema, ["v1", "v2"]).collect())) == [(1, "x", None), (2, "y", 3)]
    for versions, required in ((["v1"], []), (["v2"], ["n"])):
        with pytest.raises(Exception, match="no valid document"):
            dossiers.decode_records(coded, "k", "document", schema, versions, required).collect()


def test_identity_ignores_edits_of_explicit_work(spark):
    df = spark.createDataFrame([("deep_parse", "p1"), ("deep_parse", "p2"), ("handoff", "p1"), ("handoff", "p2")], "b string, p string")
    found = [r.f for r in df.select(dossiers.work_identity(F.col("b"), F.lit("s"), F.lit("1"), F.lit(""), F.lit(1), F.array(F.lit("https://a.ru/x")), F.col("p"), ["deep_parse"]).alias("f")).collect()]
    assert found[0] == found[1] and found[2] != found[3]


CARD = """<h1>Завод</h1><meta itemprop="tel" content="1"><span itemprop="tel">2</span><address>г. Тула, ул. Мира, 1</address><a href="mailto:a@b.ru?subject=x">m</a><a href="tel:+7 1">t</a>
<table><tr><td>ИНН:</td><td>77-07</td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table><h2>Контакты</h2><p>тут</p><dl><dt>Директор</dt><dd>Иванов</dd></dl>"""


def test_cards(spark):
    df = spark.createDataFrame([(1, "u", CARD), (2, "v", "429 Too Many Requests"), (3, "w", None)], "i int, u string, h string")
    records = pages.page_records(df, "i", "u", "h")
    fields = pages.card_fields(F.col("pairs"), {"inn": ("инн", "taxpayer"), "head": ("директор",), "none": ("x",)}, ("inn",))
    found = {r.i: r for r in records.select("*", fields.alias("card"), pages.section_of(F.col("sections"), ("контакты",)).alias("contacts")).collect()}
    r = found[1]
    assert r.card.asDict() == {"inn": "7707", "head": "Иванов", "none": None} and r.contacts == "тут Директор Иванов"
    assert r.itemprops == {"tel": ["1", "2"]} and r.emails == ["a@b.ru"] and r.phones == ["+7 1"] and r.addresses == ["г. Тула, ул. Мира, 1"] and found[3].card.inn is None
    gate = {r.i: r.b for r in df.select("i", pages.access_boundary(F.lit("success"), F.when(F.col("i") == 3, 403), F.col("h"), ("доступ ограничен",)).alias("b")).collect()}
    assert gate == {1: None, 2: "rate_limited", 3: "blocked"}


def test_robots(spark):
    text = "User-agent: *\nSitemap: https://a.ru/s.xml\nsitemap:  https://a.ru/t.xml\nSitemap: https://a.ru/s.xml"
    assert spark.createDataFrame([(text,)], "x string").select(pages.robots_sitemaps(F.col("x")).alias("s")).first().s == ["https://a.ru/s.xml", "https://a.ru/t.xml"]


def test_workbooks_read_back(spark):
    df = spark.createDataFrame([(i, f"<v & {i}>", "https://a.ru/x" if i % 2 else None, i / 4) for i in range(25)], "k int, v string, url string, x double").repartition(3)
    books = sinks.workbooks(df, ["k"], 10, "Report", True).orderBy("book_no").collect()
    assert sum(b.n_rows for b in books) == 25 and max(b.n_rows for b in books) <= 10 and len({b.book_no for b in books}) == len(books)
    rows = []
    for b in books:
        table = readers.xlsx_tables(bytes(b.content))[0]
        assert table[0] == ["k", "v", "url", "x"]
        rows += table[1:]
        names = zipfile.ZipFile(io.BytesIO(bytes(b.content))).namelist()
        assert "xl/worksheets/_rels/sheet1.xml.rels" in names
    assert [r[:2] for r in rows] == [[str(i), f"<v & {i}>"] for i in range(25)]
    sinks_rows = [r for r in rows if r[0] == "3"]
    assert sinks_rows == [["3", "<v & 3>", "https://a.ru/x", "0.75"]]


def test_tar_archives(tmp_path, spark):
    import tarfile

    (tmp_path / "in.txt").write_text("inside")
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        t.add(tmp_path / "in.txt", "x/in.txt")
        t.add(tmp_path / "in.txt", "../out.txt")
    found = {r.path.split("!/")[-1]: r.status for r in readers.documents(spark, str(tmp_path / "a.tar.gz")).collect()}
    assert found["x/in.txt"] == "read" and found["../out.txt"] == "blocked_path"


def test_json_lines(spark, tmp_path):
    sinks.write_json_lines(spark.createDataFrame([(1, None)], "k int, v string"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first().value == '{"k":1,"v":null}'


# whole results of queries that have no SQL, against plain Python


def rows_of(spark, name):
    return spark.read.parquet(f"{TESTDATA}/{name}.parquet").collect()


def test_entity_evidence_by_brute_force(spark):
    from quarrylight.plans.contacts import entity_evidence

    want = set()
    for d in rows_of(spark, "documents"):
        for kind, p in entities.PATTERNS.items():
            for m in re.finditer(p, d.text or ""):
                value = (m[1] if m.re.groups else m[0]).lower().strip(" .,:;)")
                want.add((d.doc_id, kind, m.start(), value, " ".join((d.text or "")[max(0, m.start() - 120) : m.end() + 120].split())))
    found = {tuple(r) for r in entity_evidence(spark, TESTDATA).select("doc_id", "kind", "start", "value", "snippet").collect()}
    assert found == want and len(want) > 10


def test_phone_candidates_by_brute_force(spark):
    from quarrylight.plans.contacts import phone_candidates

    def number(x):
        raw = re.sub(r"(?i)^\s*(tel:|тел\.?)|(доб|ext|внутр).*$", "", x)
        d = re.sub(r"[^0-9]", "", raw)
        if len(d) == 10 and re.search(r"[+() -]", raw):
            d = "1" + d
        return len(d) == 11 and d[0] == "1" and d[1] not in "012" and (d[1] != "8" or d[1:4] == "800")

    want = {}
    for d in rows_of(spark, "documents"):
        found = [v.strip(" .,:;)") for v in re.findall(r"\+?\d[\d ()-]{8,14}\d", d.text or "")]
        if found:
            want[d.doc_id] = (len(found), sum(map(number, found)), max(re.sub(r"\D", "", v) for v in found))
    assert {r.doc_id: (r.n, r.n_valid, r.most) for r in phone_candidates(spark, TESTDATA).collect()} == want and want


def test_excerpts_by_brute_force(spark):
    from quarrylight.plans.contacts import conversation_excerpt

    talks = {}
    for r in rows_of(spark, "conversations"):
        talks.setdefault(r.conv_id, []).append((r.turn, r.text or ""))
    found = {r.conv_id: (r.n_kept, r.n_chars, r.excerpt) for r in conversation_excerpt(spark, TESTDATA).collect()}
    for key, turns in talks.items():
        texts = [" ".join(t.split()) for _, t in sorted(turns, key=lambda x: x[0])]
        points = []
        for i, t in enumerate(texts):
            hits = sum(w in t.lower() for w in ("please", "price", "tion", "how"))
            points.append((6 + min(4, hits) if hits else 0) + int(":" in t) + int(bool(re.search(r"\d", t))) + (2 if i < 2 else 0) - (1 if len(t) > 280 else 0))
        order = sorted(range(len(texts)), key=lambda i: (-points[i], i))
        chosen = []
        for limit, least in ((720, 3), (1000, -9)):
            for i in order:
                if i not in chosen and texts[i] and points[i] >= max(least, 0) and sum(len(texts[j]) for j in chosen) + len(texts[i]) <= limit:
                    chosen.append(i)
        assert found[key] == (len(chosen), sum(len(texts[i]) for i in chosen), "\n".join(texts[i] for i in sorted(chosen)))
    assert found.keys() == talks.keys()


def test_page_records_by_another_parser(spark):
    from quarrylight.plans.streams import page_records

    found = {r.page_id: r for r in page_records(spark, TESTDATA).collect()}
    for p in rows_of(spark, "pages"):
        html = re.sub(r"(?is)<(script|style|noscript|template)\b.*?</\1>|<!--.*?-->", "", p.html)
        r = found[p.page_id]
        assert r.n_links == len(re.findall(r"(?i)</a>", html)) and r.n_rows == len(re.findall(r"(?i)<tr\b", html))
        assert r.title == " ".join(__import__("html").unescape(re.search(r"(?is)<title>(.*?)</title>", html)[1]).split())
        bare = re.sub(r"(?s)<[^>]*>", " ", re.sub(r"(?is)<title>.*?</title>", "", html))
        assert re.sub(r"\s+", "", __import__("html").unescape(bare)) == re.sub(r"\s+", "", pages.read_page(p.html).text()) and r.n_text == len(pages.read_page(p.html).text())


def test_route_budget_by_brute_force(spark):
    from quarrylight.functions import text as T
    from quarrylight.operators import scoring
    from quarrylight.plans.records import route_budget, table

    url = F.lower("url")
    rows = table(spark, TESTDATA, "pages").select("page_id", T.registered_domain(T.host(url)).alias("site"), T.host(url).alias("host"), F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1).alias("path"), F.col("url").alias("address"))
    scored = scoring.route_family(rows, ["page_id"], F.col("path"), F.lower("address"), {"news": ("news",), "blog": ("blog",), "item": ("item", "product")}).drop("address")
    tied = scored.withColumn("tie", F.xxhash64(*scored.columns)).collect()
    want = {}
    for site in {r.site for r in tied}:
        own = sorted((r for r in tied if r.site == site), key=lambda r: (-r.route_score, r.path, r.tie))
        queues, turns = {}, []
        for r in own:
            queues.setdefault(r.family, []).append(r)
        heads = sorted(queues, key=lambda f: (-queues[f][0].route_score, queues[f][0].path, queues[f][0].tie))
        for k in range(max(map(len, queues.values()))):
            turns += [queues[f][k] for f in heads if k < len(queues[f])]
        used = {}
        for r in turns:
            part = (r.path or "").split("/")
            caps = [(("f", r.family), 3, "family_cap"), (("h", r.host), 6, "host_cap"), (("p", part[1] if len(part) > 1 else ""), 2, "path_cap"), (("t",), 10, "total_cap")]
            full = next((name for key, cap, name in caps if used.get(key, 0) >= cap), None)
            if full is None:
                for key, *_ in caps:
                    used[key] = used.get(key, 0) + 1
            want[site, full or "selected"] = want.get((site, full or "selected"), 0) + 1
    assert {(r.site, r.outcome): r.n for r in route_budget(spark, TESTDATA).collect()} == want
    assert rank_routes(scored, "site", "family", "host", "path", "route_score").count() == len(tied)


def test_settlements(spark, tmp_path):
    (tmp_path / "s.csv").write_bytes("\ufeffsource_id,region,settlement,latitude_dd,longitude_dd,population\n1,Край,г. Центр,55.0,37.0,10\n2,Край,Малое,55.2,37.0,x\n3,Край,Далекое,60,50,\n".encode())
    square = lambda r: [(55 - r, 37 - r), (55 - r, 37 + r), (55 + r, 37 + r), (55 + r, 37 - r)]
    found = {r.source_id: r for r in readers.settlements(spark, str(tmp_path / "s.csv"), (55.0, 37.0), square(0.5), square(0.1)).collect()}
    assert [(found[k].geo_bucket, found[k].geo_weight, found[k].population) for k in "123"] == [("core", 5, 10), ("outer_band", 1, None), ("outside", 0, None)]
    assert found["1"].settlement_normalized == "город центр" and found["1"].distance_km == 0 and abs(found["2"].distance_km - 22.24) < 0.02 and found["1"].municipality is None
    (tmp_path / "s.csv").write_text("source_id,latitude_dd,longitude_dd\n1,x,37\n")
    with pytest.raises(Exception, match="no coordinates"):
        readers.settlements(spark, str(tmp_path / "s.csv"), (55.0, 37.0), square(0.5), square(0.1)).collect()
