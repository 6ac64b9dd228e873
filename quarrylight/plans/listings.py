"""Queries over element trees: of the pages table, and of list pages and cards whose HTML is made from orders and customers, so that the answer is known from these."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import elements as E


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_tree(spark, d):
    """Elements of pages: how many, links in and outside of navigation, and the text of the footer."""
    found = E.page_elements(table(spark, d, "pages"), "html")
    text, nodes = F.col("page_text"), F.col("nodes")
    nav = F.filter(nodes, lambda x: x["tag"] == "nav")
    count = lambda test: F.size(F.filter(nodes, test)).cast("long")
    foot = F.get(F.transform(F.filter(nodes, lambda x: x["tag"] == "footer"), lambda x: E.text_of(text, x)), 0)
    return found.select("page_id", F.size("nodes").cast("long").alias("n_elements"), count(lambda x: x["tag"] == "p").alias("n_paragraphs"), count(lambda x: E.is_link(x) & E.inside(x, nav)).alias("n_nav_links"), count(lambda x: E.is_link(x) & ~E.inside(x, nav)).alias("n_other_links"), F.sha1(foot.cast("binary")).alias("footer"))


PAGE_TREE_SQL = r"""
WITH p AS (SELECT page_id, html, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)(<(script|style)[^>]*>).*?</(script|style)>', '\1', 'g') AS h FROM pages),
n AS (SELECT *, regexp_extract(h, '(?s)<nav>(.*?)</nav>', 1) AS nav, regexp_extract(h, '(?s)<footer>(.*?)</footer>', 1) AS foot FROM p)
SELECT page_id, len(regexp_extract_all(h, '<[a-zA-Z]'))::BIGINT AS n_elements, len(regexp_extract_all(h, '<p>'))::BIGINT AS n_paragraphs, len(regexp_extract_all(nav, '<a href'))::BIGINT AS n_nav_links,
  (len(regexp_extract_all(h, '<a href')) - len(regexp_extract_all(nav, '<a href')))::BIGINT AS n_other_links,
  sha1(trim(regexp_replace(replace(replace(replace(replace(replace(foot, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS footer FROM n
"""


def page_contact_links(spark, d):
    """Links of pages to the same domain that speak of contacts; here the hints are letters of the made-up words."""
    found = E.page_elements(table(spark, d, "pages"), "html")
    links = E.contact_links(F.col("nodes"), F.col("url"), F.col("page_text"), ("the", "le", "er"))
    return found.select("page_id", F.array_join(links, " ").alias("links"))


PAGE_LINKS_SQL = r"""
WITH l AS (SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS o, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>', '', 'g'), '<a href="([^"]*)">([^<]*)</a>', 0)) AS a, generate_subscripts(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>', '', 'g'), '<a href="([^"]*)">([^<]*)</a>', 0), 1) AS k FROM pages),
x AS (SELECT page_id, k, o || regexp_extract(a, 'href="([^"]*)"', 1) AS u, regexp_extract(a, '>([^<]*)<', 1) AS t FROM l),
y AS (SELECT page_id, u, min(k) AS k FROM x WHERE regexp_matches(lower(u), 'the|le|er') OR regexp_matches(lower(t), 'the|le|er') GROUP BY ALL)
SELECT p.page_id, coalesce(string_agg(u, ' ' ORDER BY k), '') AS links FROM pages p LEFT JOIN y USING (page_id) GROUP BY p.page_id
"""


def list_pages(spark, d):
    """A list page for each customer with orders: rows of three kinds, with service links, a repeated link and a footer."""
    key = F.col("o_orderkey")
    text = lambda x: x.cast("string")
    values = {"id": text(key + 10000), "key": text(key), "region": text(key % 7), "price": text(F.floor("o_totalprice")), "day": F.date_format("o_orderdate", "dd.MM.yyyy"), "end": F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 3), "dd.MM.yyyy")}

    def filled(template: str):
        parts = [F.lit(x) if i % 2 == 0 else values[x] for i, x in enumerate(template.split("|"))]
        return F.concat(*parts)

    row = (
        F.when(key % 3 == 0, filled('<tr><td><a href="/tender/|id|/">Подробнее</a> <a href="/tender/|id|">Лот |key|</a></td><td>Регион: Область |region|</td><td>Цена: |price| руб.</td><td>Дата: |day|</td></tr>'))
        .when(key % 3 == 1, filled('<tr><td><a href="/x-tender|id|.html">Order <b>|key|</b></a></td><td>Область |region| / Город</td><td>Электронный аукцион</td><td>|price| руб.</td><td>|day| - |end|</td></tr>'))
        .otherwise(filled('<tr><td><div class="result card"><h3><a href="/tender/|id|/?p=1">Item |key|</a></h3><span>Регион: Край |region|</span> <span>Дата: |day|</span> <span>Сумма: |price| руб.</span><a href="/files/|id|.doc">Документы</a></div></td></tr>'))
    )
    rows = table(spark, d, "orders").select("o_custkey", F.struct("o_orderkey", row.alias("row")).alias("r")).groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["row"]), "\n").alias("rows"))
    return rows.select("o_custkey", F.concat(F.lit('<html><body><div class="menu"><a href="/tender/search?q=1">Расширенный поиск</a><script>var a = "<tr>";</script></div><table>'), F.col("rows"), F.lit('</table><footer><a href="/about">О сайте</a></footer></body></html>')).alias("html"))


def listing_items(spark, d):
    """The items of list pages, as the orders have them."""
    found = E.page_elements(list_pages(spark, d), "html")
    items = found.select("o_custkey", F.explode(E.list_items(F.col("page_text"), F.col("nodes"))).alias("i"))
    return E.item_fields(items.select("o_custkey", "i.*")).select("o_custkey", "item_id", "title", "region", "date_text", "price_text", "procedure_text", "industry", "has_document")


LISTING_SQL = """
SELECT o_custkey, (o_orderkey + 10000)::VARCHAR AS item_id, CASE o_orderkey % 3 WHEN 0 THEN 'Лот ' WHEN 1 THEN 'Order ' ELSE 'Item ' END || o_orderkey AS title,
  CASE o_orderkey % 3 WHEN 0 THEN 'Область ' || o_orderkey % 7 WHEN 1 THEN 'Область ' || o_orderkey % 7 || ' / Город' ELSE 'Край ' || o_orderkey % 7 END AS region,
  strftime(o_orderdate, '%d.%m.%Y') || CASE WHEN o_orderkey % 3 = 1 THEN ' - ' || strftime(o_orderdate::DATE + 3, '%d.%m.%Y') ELSE '' END AS date_text,
  floor(o_totalprice)::BIGINT || ' руб.' AS price_text, CASE WHEN o_orderkey % 3 = 1 THEN 'Электронный аукцион' END AS procedure_text, NULL AS industry, o_orderkey % 3 = 2 AS has_document FROM orders
"""


def listing_signals(spark, d):
    """What the list pages say, with errors, unconfirmed queries and pages without rows among them."""
    found = E.page_elements(list_pages(spark, d), "html").withColumn("items", E.list_items(F.col("page_text"), F.col("nodes")))
    k = F.col("o_custkey")
    items = F.when(k % 5 == 4, F.slice("items", 1, 0)).otherwise(F.col("items"))
    signal = E.list_signal(items, k % 11 == 0, k % 7 != 0, k % 10 == 4, F.when(k % 4 == 3, 0).when(k % 5 == 4, k % 3), F.array(F.lit("лот"), F.lit("item")), F.array(F.lit("край 3")))
    return found.select("o_custkey", signal.alias("s")).select("o_custkey", "s.status", F.col("s.n_visible").cast("long").alias("n_visible"), F.array_join("s.matched_ids", ",").alias("matched"))


SIGNAL_SQL = """
WITH c AS (SELECT o_custkey, count(*) AS n, string_agg((o_orderkey + 10000)::VARCHAR, ',' ORDER BY o_orderkey) FILTER (o_orderkey % 3 = 0 OR o_orderkey % 3 = 2 AND o_orderkey % 7 <> 3) AS ids FROM orders GROUP BY 1),
v AS (SELECT *, CASE WHEN o_custkey % 5 = 4 THEN 0 ELSE n END AS seen, CASE WHEN o_custkey % 4 = 3 THEN 0 WHEN o_custkey % 5 = 4 THEN o_custkey % 3 ELSE 0 END AS stated FROM c),
s AS (SELECT *, CASE WHEN o_custkey % 11 = 0 THEN 'error' WHEN o_custkey % 7 = 0 THEN 'not_applied' WHEN o_custkey % 10 = 4 AND seen = 0 THEN 'registration_limited' WHEN greatest(seen, stated) = 0 THEN 'zero' ELSE 'visible' END AS status FROM v)
SELECT o_custkey, status, seen AS n_visible, CASE WHEN status = 'visible' AND seen > 0 THEN coalesce(ids, '') ELSE '' END AS matched FROM s
"""


def card_pages(spark, d):
    """A card for each customer: contacts in and outside their scope, address parts, a value that is shown, masked or absent."""
    k = F.col("c_custkey")
    text = k.cast("string")
    value = F.when(k % 4 == 0, '<span class="plug-value js-popup-open" data-popup="demo">+7 ***</span>').when(k % 4 == 1, "Сведения отсутствуют").when(k % 4 == 2, "").otherwise(F.concat(F.lit("Director "), text))
    scope = F.when(k % 3 == 0, F.concat(F.lit('<div id="contacts-row"><div class="company-info__contact phone"><a href="tel:+74950000000">+7 495 '), text, F.lit('</a><div class="company-info__contact-notice">main</div></div><a href="http://own'), text, F.lit('.example/">site</a></div>'))).otherwise(F.lit(""))
    # a file of customers is small beside its pages: these are made and read in as many tasks as there are cores, however few pieces the file has
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey").repartition(2 * spark.sparkContext.defaultParallelism, "c_custkey")
    return customers.select(
        "c_custkey",
        F.concat(
            F.lit('<html><body><div id="main_info" data-user="'), F.when(k % 2 == 0, "true").when(k % 3 == 0, "0").otherwise(""), F.lit('"></div>'), scope,
            F.lit('<div itemprop="address"><span itemprop="postalCode">'), F.lpad(text, 6, "1"), F.lit('</span> <i>note</i> <span itemprop="addressRegion">Region '), F.col("c_nationkey").cast("string"), F.lit('</span><span itemprop="streetAddress">Street '), text,
            F.lit('</span></div><a href="http://free'), text, F.lit('.example/a">other</a><p id="value">'), value, F.lit('</p><div class="page-Footer"><p>x<a href="http://footer.example/">f</a></p></div><footer><a href="http://last.example/">l</a></footer></body></html>'),
        ).alias("html"),
    )


def card_scopes(spark, d):
    """Sites, phones, addresses, the state of a value and of the reader, as the cards were made."""
    found = E.page_elements(card_pages(spark, d), "html")
    text, nodes = F.col("page_text"), F.col("nodes")
    value = F.get(F.filter(nodes, lambda x: x["id"] == "value"), 0)
    phones = E.card_contacts(text, nodes, "tel")
    return found.select(
        "c_custkey", F.array_join(E.card_sites(nodes), " ").alias("sites"), F.array_join(F.transform(phones, lambda p: F.concat_ws("/", p["value"], p["note"])), " ").alias("phones"),
        F.array_join(E.structured_addresses(text, nodes), "|").alias("addresses"), E.value_state(text, nodes, value).alias("value_state"), E.access_state(nodes).alias("reader"),
    )


CARD_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'http://own' || c_custkey || '.example/' ELSE 'http://free' || c_custkey || '.example/a' END AS sites,
  CASE WHEN c_custkey % 3 = 0 THEN '+7 495 ' || c_custkey || '/main' ELSE '' END AS phones,
  lpad(c_custkey::VARCHAR, 6, '1') || ' note Region ' || c_nationkey || ' Street ' || c_custkey || '|' || lpad(c_custkey::VARCHAR, 6, '1') || ', Region ' || c_nationkey || ', Street ' || c_custkey AS addresses,
  CASE c_custkey % 4 WHEN 0 THEN 'masked' WHEN 3 THEN 'open' ELSE 'absent' END AS value_state, CASE WHEN c_custkey % 2 = 0 THEN 'authorized' WHEN c_custkey % 3 = 0 THEN 'guest' ELSE 'unknown' END AS reader FROM customer
"""

QUERIES = {f.__name__: f for f in (page_tree, page_contact_links, listing_items, listing_signals, card_scopes)}
ORACLES = {"page_tree": PAGE_TREE_SQL, "page_contact_links": PAGE_LINKS_SQL, "listing_items": LISTING_SQL, "listing_signals": SIGNAL_SQL, "card_scopes": CARD_SQL}
