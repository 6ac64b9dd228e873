"""Element trees against a second parser, scoped rules on odd pages, run insights and id mentions on odd rows."""

import random
import time
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from quarrylight.operators import insights, joins
from quarrylight.plans import listings
from quarrylight.sources import elements as E



def parsed(spark, *pages):
    return E.page_elements(spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "k int, html string"), "html")


def one(spark, html, value):
    return parsed(spark, html).select(value.alias("v")).first().v


# trees


def random_page(rnd, depth=0):
    """Well-formed HTML that an XML parser reads too."""
    tag = rnd.choice(["div", "p", "ul", "li", "table", "tr", "td", "span", "footer", "a", "section"])
    attrs = "".join(f' {k}="{rnd.choice("abc")}{rnd.randrange(9)}"' for k in rnd.sample(["class", "id", "href", "title"], rnd.randrange(3)))
    inner = "".join(rnd.choice([f" w{rnd.randrange(99)} ", "\n", "x", "<br/>", "<img src='1'/>"]) if depth > 4 or rnd.random() < 0.5 else random_page(rnd, depth + 1) for _ in range(rnd.randrange(5)))
    return f"<{tag}{attrs}>{inner}</{tag}>"


def naive_nodes(html):
    """Number, last descendant, ancestors, tag, attributes and text of each element, by an XML parser."""
    out, parts = [], []

    def walk(e, path):
        n = len(out)
        out.append(None)
        words = []

        def add(t):
            if t and t.strip():
                words.append(t.strip())
                parts.append(t.strip())

        add(e.text)
        for child in e:
            words.extend(walk(child, [*path, n]))
            add(child.tail)
        out[n] = (n, len(out) - 1, path, e.tag, dict(e.attrib), " ".join(" ".join(words).split()))
        return words

    walk(ET.fromstring(html), [])
    return " ".join(parts), out


def test_trees_by_a_second_parser(spark):
    rnd = random.Random(4)
    pages = [random_page(rnd) for _ in range(80)]
    found = parsed(spark, *pages).withColumn("texts", F.transform(F.col("nodes"), lambda x: E.text_of(F.col("page_text"), x))).orderBy("k").collect()
    for html, r in zip(pages, found, strict=True):
        text, nodes = naive_nodes(html)
        assert " ".join(r.page_text.split()) == " ".join(text.split())
        assert [(x.n, x.last, x.path, x.tag, x.attrs, t) for x, t in zip(r.nodes, r.texts, strict=True)] == nodes


def test_trees_of_odd_pages(spark):
    pages = [None, "", "no tags", "<p>a<p>b</i>c", "<div><script>var a = '<p>';</script>x<!-- y --><style>z</style></div>", "</div><b>q", "<a href=x HREF=y>&amp;&copy;</a>", "<br><br/><img src=1>t"]
    r = {x.k: x for x in parsed(spark, *pages).collect()}
    assert len(r) == len(pages) and r[0].page_text == "" and r[0].nodes == [] and r[2].page_text == "no tags"
    assert [(x.tag, x.path) for x in r[3].nodes] == [("p", []), ("p", [0])] and r[3].page_text == "a b c"
    assert r[4].page_text == "x" and [x.tag for x in r[4].nodes] == ["div", "script", "style"]
    assert [x.tag for x in r[5].nodes] == ["b"] and r[6].nodes[0].attrs == {"href": "x"} and r[6].page_text == "&©"
    assert [x.tag for x in r[7].nodes] == ["br", "br", "img"] and r[7].page_text == "t"
    same = spark.createDataFrame([(1, "<p>a</p>", "old", 2.5)] * 2, "k int, html string, nodes string, score double")
    assert E.page_elements(same, "html").columns == ["k", "score", "page_text", "nodes"] and E.page_elements(same, "html").count() == 2


def trees(read, pages):
    found = E.Elements()
    for html in pages:
        found.begin()
        if read(found, html) is False:
            found.drop()
        else:
            found.finish()
    return found.texts, found.array().to_pylist()


def by_parser(found, html):
    parser = E.Parser(found)
    parser.feed(html)
    parser.close()


def test_plain_pages_by_the_parser():
    rnd = random.Random(8)
    pieces = ["<p>", "</p>", '<div class="a b" id="x">', "</div>", '<a href="/x?a=1">', "</a>", '<a href="/x?a=1&amp;b">', "text ", " & ", "&amp;", "&lt", "<br/>", "<br>", "<script>", "</script>", '<script>var a="<tr></b>";</script>', "<STYLE>a</STYLE>", "<!-- c -->", "<!-- a-b -->", "<!doctype html>", "<title>a</title>", "<title>a<b></title>", "<title/>", "<", ">", '"', "<i x='1'>", "<i x>", '<I X="1" x="2">', "</I>", "</i >", "<p/>", "<textarea>a</textarea>", "<template>q", "<ſcript>", "<!", "</", "é"]
    pages = ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(9))) for _ in range(6000)]
    plain = [h for h in pages if trees(lambda e, x: e.plain(x), [h])[0]]
    assert len(plain) > 1000 and len(plain) < len(pages)
    assert trees(lambda e, x: e.plain(x), pages) == trees(by_parser, plain)
    whole = E.Elements()
    for h in pages:
        whole.page(h)
    assert (whole.texts, whole.array().to_pylist()) == trees(by_parser, pages)


# cards


def test_links_in_footers_are_left_out(spark):
    html = '<div><a href="http://a.x/">a</a><div class="Page-FOOTER"><p><a href="http://b.x/">b</a></p></div><div id="copyright1"><a href="http://c.x/">c</a></div><a href="http://a.x/">again</a><a href="/rel">r</a></div>'
    assert one(spark, html, E.card_sites(F.col("nodes"))) == ["http://a.x/"]
    scoped = html.replace("<div><a", '<div><div class="company-info__contact site"><a href="http://own.x/">o</a></div><a', 1)
    assert one(spark, scoped, E.card_sites(F.col("nodes"))) == ["http://own.x/"]
    assert one(spark, '<footer><a data-track-click="x,CONTACTS,site" href="http://t.x/">t</a></footer>', E.card_sites(F.col("nodes"))) == ["http://t.x/"]
    assert one(spark, "", E.card_sites(F.col("nodes"))) == []


def test_cards_of_a_small_file_are_spread(spark, tmp_path):
    spark.range(0, 400, 1, 1).selectExpr("id as c_custkey", "id % 25 as c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spread = listings.card_pages(spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread >= spark.sparkContext.defaultParallelism
    assert listings.card_scopes(spark, str(tmp_path)).filter("sites <> '' and reader is not null").count() == 400


def test_contacts_with_notes(spark):
    html = '<div id="contacts-row"><div class="company-info__contact"><a href="tel:+7 1"> 8 495 </a><i class="company-info__contact-notice">day</i></div><a href="TEL:22"></a><a href="mailto:A@B.ru">x</a></div><a href="tel:33">33</a><a data-track-click="contacts,phone" href="tel:44">44</a>'
    assert [tuple(x) for x in one(spark, html, E.card_contacts(F.col("page_text"), F.col("nodes"), "tel"))] == [("8 495", "day"), ("22", ""), ("44", "")]
    assert [tuple(x) for x in one(spark, html, E.card_contacts(F.col("page_text"), F.col("nodes"), "mailto"))] == [("a@b.ru", "")]


def test_addresses_from_parts(spark):
    html = '<div itemprop="address"><b itemprop="postalCode">101</b><b itemprop="streetAddress">Street 5</b></div><div itemprop="address">Street 5</div><div itemprop="address"><i itemprop="streetAddress"></i></div>'
    assert one(spark, html, E.structured_addresses(F.col("page_text"), F.col("nodes"))) == ["101 Street 5", "101, Street 5"]
    pairs = F.create_map(F.lit("Юридический Адрес"), F.lit("City,  Street 5, 1"), F.lit("ИНН"), F.lit("77"))
    assert one(spark, "<p></p>", E.structured_addresses(F.col("page_text"), F.col("nodes"), pairs)) == ["City, Street 5, 1"]


@pytest.mark.parametrize(
    ("inner", "own", "want"),
    [("<b>v</b>", "", "open"), ('<b class="plug-value js-popup-open">v</b>', "", "masked"), ('<b class="js-popup-open" data-popup="demo">v</b>', "", "masked"), ("v", 'class="js-popup-open" data-popup="demo"', "masked"), ("v", 'class="js-popup-open"', "open"), ('<b class="plug-value">v</b>', "", "open"), ("Сведения ОТСУТСТВУЮТ", "", "absent"), (" ", "", "absent")],
)
def test_masks_by_class(spark, inner, own, want):
    html = f'<p id="v" {own}>{inner}</p><i class="plug-value js-popup-open">outside</i>'
    assert one(spark, html, E.value_state(F.col("page_text"), F.col("nodes"), F.get(F.filter(F.col("nodes"), lambda x: x["id"] == "v"), 0))) == want


def test_readers(spark):
    for mark, want in (("true", "authorized"), ("1", "authorized"), ("FALSE", "guest"), ("0", "guest"), ("", "unknown"), ("x", "unknown")):
        assert one(spark, f'<div id="main_info" data-user="{mark}"></div>', E.access_state(F.col("nodes"))) == want
    assert one(spark, None, E.access_state(F.col("nodes"))) == "unknown"


def test_contacts_of_sites(spark):
    html = '<p>Call +7 (495) 123-45-67 or mail Info@Site.ru.</p><a href="tel:84951234567">x</a><a href="mailto:b@site.ru?subject=1">m</a><a href="tel:1">bad</a><footer>Street <b>5</b></footer>'
    r = one(spark, html, E.site_contacts(F.col("page_text"), F.col("nodes")))
    assert r.phones == ["+7 495 123-45-67"] and r.emails == ["info@site.ru", "b@site.ru"] and r.footer == "Street 5"
    pages = spark.createDataFrame([("https://www.site.ru/a/b?x=1", '<a href="/contacts">a</a><a href="me/about#t">b</a><a href="//m.site.ru/kontakt">c</a><a href="https://other.ru/contacts">d</a><a href="/x">Контакты</a><a href="mailto:contact@site.ru">e</a><a href="/contacts#2">f</a><a href="/news">n</a>'), (None, '<a href="/contacts">a</a>')], "url string, html string")
    found = E.page_elements(pages, "html").select(E.contact_links(F.col("nodes"), F.col("url"), F.col("page_text")).alias("v")).collect()
    assert found[0].v == ["https://www.site.ru/contacts", "https://www.site.ru/a/me/about", "https://m.site.ru/kontakt", "https://www.site.ru/x"] and found[1].v == []


# lists


def items(spark, html):
    rows = parsed(spark, html).select(F.posexplode(E.list_items(F.col("page_text"), F.col("nodes"))).alias("pos", "i")).select("pos", "i.*")
    return E.item_fields(rows).orderBy("pos").collect()


def test_rows_and_their_fields(spark):
    html = """<table><tr><td><a href="https://b.ru/tender/12345/?x=1#y">Подробнее</a></td><td>Закупка лома</td><td>Самарская область / Самара</td><td>Металл / Лом</td><td>Аукцион #12345</td><td>1 200 000,50 руб.</td><td>с 01.02.2024 по 03.02.2024</td></tr>
    <tr><td>Тендер № 77777</td><td><a href="/x-tender12346.html">Title</a></td><td>Регион: Тула Отрасль: Лес Цена - 5 ₽ Дата начала 01.01.2024 Документы a</td><td>См. док.</td></tr></table>
    <ul><li><a href="/tender/12347">L</a> <a href="/tender/12347/">L again</a></li><li><a href="/tender/search/12348">s</a><a href="/tender/123">short</a><a>none</a></li></ul>
    <section class="result-list"><div><div><h2><a href="/tender/12349">Deep</a></h2></div></div><a href="/file/1.pdf">f</a></section><a href="/tender/12350">alone</a>"""
    rows = items(spark, html)
    assert [r.item_id for r in rows] == ["12345", "77777", "12347", "12349", "12350"]
    a, b, c, d, e = rows
    assert (a.title, a.region, a.industry, a.price_text, a.date_text, a.procedure_text, a.has_document) == ("Подробнее", "Самарская область / Самара", "Металл / Лом", "1 200 000,50 руб.", "01.02.2024 01.02.2024".replace("01.02.2024 01", "01.02.2024 03"), "Аукцион #12345", False)
    assert (b.title, b.region, b.industry, b.price_text, b.date_text, b.has_document) == ("Title", "Тула", "Лес", "5 ₽", "01.01.2024", True)
    assert c.title == "L" and c.snippet == "L L again" and c.region is None and c.cells == []
    assert d.snippet == "Deep f" and d.has_document and e.title == "alone"
    assert items(spark, None) == [] and items(spark, "<p>x</p>") == []


def test_items_read_their_own_row(spark):
    """Time of a page of many rows is about that of as many rows on several pages."""
    def page(first, n):
        return "<table>" + "".join(f'<tr><td><a href="/tender/{100000 + i}">Lot {i}</a></td><td>Цена: {i} руб.</td><td>Регион:  Тула</td></tr>' for i in range(first, first + n)) + "</table>"

    def took(pages):
        found = parsed(spark, *pages).select(F.explode(E.list_items(F.col("page_text"), F.col("nodes"))).alias("i")).select("i.*")
        rows = found.select("item_id", "title", "snippet").collect()
        assert sorted(rows) == [(str(100000 + i), f"Lot {i}", f"Lot {i} Цена: {i} руб. Регион: Тула") for i in range(4000)]
        began = time.time()
        found.write.format("noop").mode("overwrite").save()
        return time.time() - began

    assert took([page(0, 4000)]) < 5 * took([page(100 * i, 100) for i in range(40)]) + 2


def test_signals_in_order(spark):
    none, yes, no = F.lit(None).cast("int"), F.lit(True), F.lit(False)
    html = '<li><a href="/tender/11111">Лом</a></li><li><a href="/tender/22222">Лом и бумага</a></li>'
    terms = (F.array(F.lit("лом")), F.array(F.lit("бумага")))
    say = lambda h, *args: tuple(one(spark, h, E.list_signal(E.list_items(F.col("page_text"), F.col("nodes")), *args, *terms)))
    assert say(html, no, yes, yes, none) == ("visible", 2, ["11111"])
    assert say(html, yes, yes, no, none)[0] == "error" and say(html, no, no, no, none)[0] == "not_applied"
    assert say("", no, yes, yes, F.lit(5)) == ("registration_limited", 0, []) and say("", no, yes, no, none)[0] == "zero" and say("", no, yes, no, F.lit(3))[0] == "visible"


# insights


def test_insights_by_brute_force(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", " b ", "", None]), rnd.choice(["ok", "blocked", None]), rnd.choice([None, [], ["phones"], ["emails", "x"], ["x", "y"]]), rnd.choice([True, False, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "source string, status string, masked array<string>, blocked boolean")
    want = {}
    for source, status, masked, blocked in rows:
        name = (source or "").strip()
        if name:
            k = ("source_status", name, status or "unknown")
            want[k] = want.get(k, 0) + 1
            m, c = masked or [], [x for x in masked or [] if x in insights.CONTACT_FIELDS]
            for metric, v in (("companies_masked", bool(m)), ("companies_contact_masked", bool(c)), ("fields_masked", len(m)), ("contact_fields_masked", len(c)), ("companies_blocked", bool(blocked))):
                want[("source_masks", name, metric)] = want.get(("source_masks", name, metric), 0) + v
    for name in ("a", "b"):
        want[("source_masks", name, "signal")] = 2 if want[("source_masks", name, "companies_contact_masked")] >= max(10, int(100 * 0.15)) else 1
    found = insights.source_insights(df, "source", "status", "masked", F.col("blocked"), 100).collect()
    assert {(r.section, r.name, r.metric): r.value for r in found} == want and len(found) == len(want)
    assert insights.source_insights(df.limit(0), "source", "status", "masked", F.col("blocked"), 0).count() == 0


def test_coverage_counts_and_examples(spark):
    df = spark.createDataFrame([(3, "x", None), (1, None, "v"), (2, "x", "v"), (2, "x", "v")], "k int, a string, b string")
    assert {r.metric: r.value for r in insights.coverage(df, {"with_a": F.col("a").isNotNull(), "odd": F.when(F.col("k") == 1, True)}).collect()} == {"companies": 4, "with_a": 3, "odd": 1}
    assert {r.metric: r.value for r in insights.coverage(df.limit(0), {"with_a": F.col("a").isNotNull()}).collect()} == {"companies": 0, "with_a": 0}
    assert sorted((r.section, r.name, r.value) for r in insights.value_counts(df, ["a", "b"], "none").collect()) == [("a", "none", 1), ("a", "x", 3), ("b", "none", 1), ("b", "v", 3)]
    found = insights.examples(df, {"all": F.lit(True), "b": F.col("b") == "v", "no": F.lit(None).cast("boolean")}, "k", F.concat_ws("-", F.col("k").cast("string"), "a"), 2)
    assert sorted(tuple(r) for r in found.collect()) == [("all", 1, "1"), ("all", 2, "2-x"), ("b", 1, "1"), ("b", 2, "2-x")]


# ids on pages


def test_mentions_by_brute_force(spark):
    rnd = random.Random(7)
    ids = ["".join(rnd.choice("12") for _ in range(n)) for n in (3, 3, 4, 5) for _ in range(6)] + ["12", "x1", None, " 2112 "]
    pages = [(i, rnd.choice([None, "", "t"]), "".join(rnd.choice("12 a") for _ in range(rnd.randrange(40)))) for i in range(80)]
    known = {x.strip() for x in ids if x and x.strip().isdigit()}
    want = sorted((i, x) for i, a, b in pages for x in known if x in " ".join(t for t in (a, b) if t is not None))
    found = joins.id_mentions(spark.createDataFrame(pages, "p int, a string, b string"), "p", ["a", "b"], spark.createDataFrame([(x,) for x in ids], "i string"), "i")
    assert sorted(map(tuple, found.collect())) == want
    assert "NestedLoop" not in found._jdf.queryExecution().toString() and "Cartesian" not in found._jdf.queryExecution().toString()
    rows = spark.createDataFrame([(i, rnd.choice([*sorted(known), "", None])) for i, *_ in pages], "p int, i string")
    said = set(want)
    assert all(r.matches == (not (r.i or "") or (r.p, r.i) in said) for r in joins.with_page_match(rows, found, "p", "i").collect())
    assert joins.id_mentions(spark.createDataFrame(pages, "p int, a string, b string"), "p", ["a", "b"], spark.createDataFrame([(None,)], "i string"), "i").count() == 0
