"""Element trees of HTML pages as columns, and what depends on where an element stands: scopes, rows of lists, cards, masks.

One Arrow-batched pass turns a page into its visible text and an array of its elements in document order. An element knows its number, that of its
last descendant, the numbers of its ancestors and where its text begins and ends in the page's; so "inside" is a comparison of numbers and the text of an element
a substring, and all rules are column expressions. Nothing is shuffled; a page is the unit of work.

Cases: null HTML has no elements and an empty text. Elements that are never closed end with their parent; an end tag without a beginning is ignored. Texts of scripts,
styles and templates, and comments, aren't visible.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import pairwise
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import bound

#: Elements without an end tag, and those whose content isn't text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("script style noscript template".split())
NODE = "struct<n: int, last: int, path: array<int>, tag: string, id: string, classes: array<string>, attrs: map<string, string>, start: int, end: int>"
PAGES_AT_ONCE = 64
#: What stands between < and > in a plain page: an end tag, or a start tag whose attributes stand in double quotes and hold no references; a comment without hyphens or a document type.
#: Elements whose content parsers read as text aren't plain, but for scripts and styles without "<!" or other end tags of them inside, and titles of text only.
HEAD = re.compile(r'(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z_][\w:.-]*="[^"<>&]*")*)[ \t\n]*(/?)', re.ASCII)
ATTR, SILENT = re.compile(r'([a-zA-Z_][\w:.-]*)="([^"]*)"', re.ASCII), re.compile(r"""!--[^-<>]*--|!(?i:doctype)[^<>"'\[\]]*""", re.ASCII)
RAW_END = re.compile(r"!|/\s*(?:script|style)", re.ASCII | re.IGNORECASE)
RAW, TEXTUAL = frozenset({"script", "style"}), frozenset("textarea iframe noembed noframes xmp plaintext".split())
START, END, CLOSED, NOTHING, ODD = range(5)


@lru_cache(4096)
def piece_of(head: str) -> tuple:
    """What a head of a plain page means: kind, tag, id, classes, names and values of attributes."""
    m = HEAD.fullmatch(head)
    if m is None:
        return (NOTHING if SILENT.fullmatch(head) else ODD, "", "", [], [], [])
    ended, tag, attrs, closed = m.groups()
    name = tag.lower()
    if name in TEXTUAL or name in RAW and (tag != name or closed) or ended and len(head) != len(tag) + 1:
        return (ODD, "", "", [], [], [])
    return (END if ended else CLOSED if closed else START, name, *described([(k.lower(), v) for k, v in ATTR.findall(attrs)]))


def described(attrs: list[tuple[str, str | None]]) -> tuple:
    """Id, classes, names and values; of a name that repeats the first counts."""
    given = {k: v or "" for k, v in reversed(attrs)}
    return given.get("id", ""), given.get("class", "").split(), list(given), list(given.values())


class Elements:
    """The elements of pages, column by column: a page after the other, its elements in document order. The text of a page is its stripped parts, one blank between them."""

    def __init__(self):
        self.tags, self.ids, self.last, self.starts, self.ends = [], [], [], [], []
        self.paths, self.path_ends, self.classes, self.class_ends, self.keys, self.values, self.attr_ends = [], [0], [], [0], [], [], [0]
        self.texts, self.page_ends = [], [0]

    def begin(self):
        self.open, self.names, self.marks, self.parts, self.part_starts, self.size, self.unseen = [], [], [], [], [], 0, 0

    def start(self, tag: str, own_id: str, classes: list[str], keys: list[str], values: list[str]):
        n = len(self.tags) - self.page_ends[-1]
        self.tags.append(tag)
        self.ids.append(own_id)
        self.last.append(n)
        self.starts.append(0)
        self.ends.append(0)
        self.paths.extend(self.open)
        self.path_ends.append(len(self.paths))
        if keys:
            self.classes.extend(classes)
            self.keys.extend(keys)
            self.values.extend(values)
        self.class_ends.append(len(self.classes))
        self.attr_ends.append(len(self.keys))
        if tag not in VOID:
            self.open.append(n)
            self.names.append(tag)
            self.marks.append(len(self.parts))
            self.unseen += tag in UNSEEN

    def end_last(self) -> str:
        """Ends the innermost open element; its text goes from the first part since its start to the last."""
        at, first, name = self.page_ends[-1] + self.open.pop(), self.marks.pop(), self.names.pop()
        self.last[at] = len(self.tags) - self.page_ends[-1] - 1
        self.unseen -= name in UNSEEN
        if first < len(self.parts):
            self.starts[at], self.ends[at] = self.part_starts[first], self.size
        return name

    def end(self, tag: str):
        if tag in self.names:
            while self.end_last() != tag:
                pass

    def data(self, data: str):
        found = data.strip()
        if found and not self.unseen:
            start = self.size + bool(self.parts)
            self.parts.append(found)
            self.part_starts.append(start)
            self.size = start + len(found)

    def finish(self):
        while self.open:
            self.end_last()
        self.texts.append(" ".join(self.parts))
        self.page_ends.append(len(self.tags))

    def page(self, html: str | None):
        """Adds a page: a plain one piece by piece, any other by the parser."""
        self.begin()
        if not self.plain(html or ""):
            self.drop()
            self.begin()
            parser = Parser(self)
            parser.feed(html)
            parser.close()
        self.finish()

    def plain(self, html: str) -> bool:
        """Reads a page as long as its pieces are plain; False: one isn't."""
        first, *pieces = html.split("<")
        if first:
            self.data(unescape(first) if "&" in first else first)
        raw, title = "", False
        for piece in pieces:
            head, closed, data = piece.partition(">")
            if raw and (not closed or head != raw):
                if RAW_END.match(piece):
                    return False
                continue
            kind, tag, *described = piece_of(head)
            if kind == ODD or not closed or title and (kind != END or tag != "title"):
                return False
            raw, title = "", False
            if kind == START:
                self.start(tag, *described)
                if tag in RAW:
                    raw = f"/{tag}"
                    continue
                title = tag == "title"
            elif kind == END:
                self.end(tag)
            elif kind == CLOSED:
                self.start(tag, *described)
                if tag not in VOID:
                    self.end(tag)
                if tag == "title":
                    return False
            if data:
                self.data(unescape(data) if "&" in data else data)
        return not raw and not title

    def drop(self):
        """Forgets what was read of the page."""
        n = self.page_ends[-1]
        del self.tags[n:], self.ids[n:], self.last[n:], self.starts[n:], self.ends[n:], self.path_ends[n + 1 :], self.class_ends[n + 1 :], self.attr_ends[n + 1 :]
        del self.paths[self.path_ends[-1] :], self.classes[self.class_ends[-1] :], self.keys[self.attr_ends[-1] :], self.values[self.attr_ends[-1] :]

    def array(self) -> pa.ListArray:
        """The elements of each page."""
        ints = lambda found: pa.array(found, pa.int32())
        words = lambda found: pa.array(found, pa.string())
        columns = {
            "n": ints([n for a, b in pairwise(self.page_ends) for n in range(b - a)]), "last": ints(self.last), "path": pa.ListArray.from_arrays(ints(self.path_ends), ints(self.paths)), "tag": words(self.tags), "id": words(self.ids),
            "classes": pa.ListArray.from_arrays(ints(self.class_ends), words(self.classes)), "attrs": pa.MapArray.from_arrays(ints(self.attr_ends), words(self.keys), words(self.values)), "start": ints(self.starts), "end": ints(self.ends),
        }
        return pa.ListArray.from_arrays(ints(self.page_ends), pa.StructArray.from_arrays(list(columns.values()), names=list(columns)))


class Parser(HTMLParser):
    """Reads what isn't plain: quotes of other kinds, references in attributes, signs that begin no tag, scripts with tags."""

    def __init__(self, elements: Elements):
        super().__init__(convert_charrefs=True)
        self.start, self.handle_endtag, self.handle_data = elements.start, elements.end, elements.data

    def handle_starttag(self, tag, attrs):
        self.start(tag, *described(attrs))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)


def page_elements(pages: DataFrame, html_col: str, keep_html: bool = False) -> DataFrame:
    """pages with page_text and nodes in place of the HTML."""
    names = [c for c in pages.columns if c not in ("page_text", "nodes")]
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    at, back = names.index(html_col), [i for i, c in enumerate(names) if keep_html or c != html_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for offset in range(0, max(1, whole.num_rows), PAGES_AT_ONCE):
                batch = whole.slice(offset, PAGES_AT_ONCE)
                found = Elements()
                for html in batch.column(at).to_pylist():
                    found.page(html)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in back), pa.array(found.texts, pa.string()), found.array()], [*(names[i] for i in back), "page_text", "nodes"])

    schema = ", ".join([*(f"`{names[i]}` {kinds[names[i]]}" for i in back), "page_text string", f"nodes array<{NODE}>"])
    return pages.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(work, schema)



def text_of(text: Column, node: Column) -> Column:
    """The visible text of an element, parts joined by one blank."""
    return T.one_space(F.substring(text, node["start"] + 1, node["end"] - node["start"]))


def attr(node: Column, name: str) -> Column:
    return F.coalesce(F.try_element_at(node["attrs"], F.lit(name)), F.lit(""))


def inside(node: Column, holders: Column) -> Column:
    """Whether an element stands in one of the holders."""
    return F.exists(holders, lambda h: (h["n"] < node["n"]) & (node["n"] <= h["last"]))


def within(nodes: Column, holder: Column, test: Callable[[Column], Column] | None = None) -> Column:
    """The descendants of an element (that pass a test), by their numbers: the other elements of the page aren't read."""
    own = F.transform(F.sequence(holder["n"], holder["last"]), lambda i: F.get(nodes, i))
    return F.filter(own, lambda x: (x["n"] > holder["n"]) if test is None else (x["n"] > holder["n"]) & test(x))


def marked(node: Column, marks: tuple[str, ...]) -> Column:
    """Whether the classes or the id of an element hold one of the marks."""
    named = (F.size(node["classes"]) > 0) | (node["id"] != "")
    return named & bound(F.lower(F.concat_ws(" ", node["classes"], node["id"])), lambda names: any_mark(names, marks))


#: What the class or id of a footer holds; the scopes of a card's contacts by id, class and click mark; labels of addresses; classes of a mask; the phrase of an absent value.
FOOTER_MARKS = ("footer", "breadcrumbs", "breadcrumb", "copy", "copyright")
CONTACT_ID, CONTACT_CLASS, NOTE_CLASS = "contacts-row", "company-info__contact", "company-info__contact-notice"
ADDRESS_LABELS = ("юридический адрес", "фактический адрес", "почтовый адрес", "адрес")
MASK_CLASSES, MASK_POPUP, ABSENT_PHRASE = ("plug-value", "js-popup-open"), "demo", "сведения отсутствуют"
CONTACT_HINTS = ("contact", "kontakt", "контакт", "about", "rekvizit", "реквизит")


def footers(nodes: Column) -> Column:
    return F.filter(nodes, lambda x: (x["tag"] == "footer") | marked(x, FOOTER_MARKS))


def is_link(node: Column, begins: str = "") -> Column:
    any_link = (node["tag"] == "a") & (attr(node, "href") != "")
    return any_link & F.startswith(F.lower(F.trim(attr(node, "href"))), F.lit(begins)) if begins else any_link


def card_sites(nodes: Column) -> Column:
    """The web addresses of a card: links in its contact scopes; where there are none, links outside footers."""
    links = F.filter(nodes, lambda x: is_link(x, "http"))
    row = F.filter(nodes, lambda x: x["id"] == CONTACT_ID)
    own = F.filter(nodes, lambda x: F.array_contains(x["classes"], CONTACT_CLASS) & F.array_contains(x["classes"], "site"))
    tracked = lambda x: F.contains(F.lower(attr(x, "data-track-click")), F.lit("contacts,site"))
    first = lambda found: bound(F.concat(row, own), lambda scopes: F.filter(found, lambda x: inside(x, scopes) | tracked(x)))
    rest = lambda found: bound(footers(nodes), lambda feet: F.filter(found, lambda x: ~inside(x, feet)))
    href = lambda found: F.array_distinct(F.transform(found, lambda x: F.trim(attr(x, "href"))))
    return bound(links, lambda every: bound(first(every), lambda some: href(F.when(F.size(some) > 0, some).otherwise(rest(every)))))


def card_contacts(text: Column, nodes: Column, kind: str) -> Column:
    """Visible contacts of a card as (value, note): kind tel or mailto, in the contact row or marked by a click; the note stands in the same contact element."""
    name = {"tel": "contacts,phone", "mailto": "contacts,email"}[kind]
    row = F.filter(nodes, lambda x: x["id"] == CONTACT_ID)
    links = bound(row, lambda rows: F.filter(nodes, lambda x: is_link(x, f"{kind}:") & (inside(x, rows) | F.contains(F.lower(attr(x, "data-track-click")), F.lit(name)))))
    bare = lambda x: F.trim(F.regexp_replace(attr(x, "href"), f"(?i)^{kind}:", ""))
    seen = lambda x: F.nullif(text_of(text, x), F.lit(""))
    value = (lambda x: F.coalesce(seen(x), bare(x))) if kind == "tel" else (lambda x: F.lower(F.coalesce(F.nullif(bare(x), F.lit("")), seen(x), F.lit(""))))

    def note(x: Column) -> Column:
        holders = F.filter(nodes, lambda h: (h["tag"] == "div") & F.array_contains(h["classes"], CONTACT_CLASS) & (h["n"] < x["n"]) & (x["n"] <= h["last"]))
        noted = lambda nearest: F.get(F.transform(within(nodes, nearest, lambda y: F.array_contains(y["classes"], NOTE_CLASS)), lambda y: text_of(text, y)), 0)
        return F.coalesce(bound(F.element_at(F.concat(F.array(F.lit(None).cast(NODE)), holders), -1), noted), F.lit(""))

    return F.transform(links, lambda x: F.struct(value(x).alias("value"), note(x).alias("note")))


def structured_addresses(text: Column, nodes: Column, pairs: Column | None = None) -> Column:
    """Addresses of a card, in order: labelled values, then of each address element its text and its postal code, region and street joined.

    Of addresses of which one is a part of another only the longer stays.
    """
    own = F.filter(nodes, lambda x: attr(x, "itemprop") == "address")

    def joined(a: Column) -> Column:
        said = lambda y: bound(text_of(text, y), lambda t: F.nullif(F.when(t != "", t).otherwise(attr(y, "content")), F.lit("")))
        part = lambda inner, name: F.get(F.transform(F.filter(inner, lambda y: attr(y, "itemprop") == name), said), 0)
        named = within(nodes, a, lambda y: attr(y, "itemprop") != "")
        parts = bound(named, lambda inner: F.array(*[part(inner, name) for name in ("postalCode", "addressRegion", "streetAddress")]))
        return bound(parts, lambda p: F.when(F.get(p, 2).isNotNull() & (F.get(p, 0).isNotNull() | F.get(p, 1).isNotNull()), F.array_join(p, ", ")))

    found = F.flatten(F.transform(own, lambda a: F.array(F.nullif(text_of(text, a), F.lit("")), joined(a))))
    if pairs is not None:
        hit = lambda k: F.exists(F.array(*map(F.lit, ADDRESS_LABELS)), lambda m: F.contains(F.lower(k), m))
        labelled = F.transform(F.filter(F.coalesce(F.map_entries(pairs), F.array().cast("array<struct<key: string, value: string>>")), lambda e: hit(e["key"])), lambda e: e["value"])
        found = F.concat(labelled, found)
    once = F.array_distinct(F.filter(F.transform(found, lambda a: bound(T.one_space(a), lambda t: F.nullif(t, F.lit("")))), lambda a: a.isNotNull()))
    lowered = F.transform(once, lambda a: F.struct(a.alias("a"), F.lower(a).alias("low")))
    longest = bound(lowered, lambda every: F.filter(every, lambda x: ~F.exists(every, lambda y: (x["a"] != y["a"]) & F.contains(y["low"], x["low"]))))
    return F.transform(longest, lambda x: x["a"])


def value_state(text: Column, nodes: Column, node: Column) -> Column:
    """masked where the value, or something in it, opens a pop-up instead of showing; absent by its phrase or an empty text; else open."""
    has = lambda x, *names: F.array_size(F.array_intersect(x["classes"], F.array(*map(F.lit, names)))) == len(names)
    popup = lambda x: has(x, MASK_CLASSES[1]) & (attr(x, "data-popup") == MASK_POPUP)
    hidden = lambda v: popup(v) | (F.size(within(nodes, v, lambda x: has(x, *MASK_CLASSES) | popup(x))) > 0)
    shown = lambda v: bound(F.lower(text_of(text, v)), lambda t: F.when((t == "") | F.contains(t, F.lit(ABSENT_PHRASE)), "absent").otherwise("open"))
    return bound(node, lambda v: F.when(v.isNull(), None).when(hidden(v), "masked").otherwise(shown(v)))


def access_state(nodes: Column) -> Column:
    """authorized or guest by the card's mark of its reader, else unknown."""
    mark = F.lower(F.trim(F.get(F.transform(F.filter(nodes, lambda x: x["id"] == "main_info"), lambda x: attr(x, "data-user")), 0)))
    return F.when(mark.isin("true", "1"), "authorized").when(mark.isin("false", "0"), "guest").otherwise("unknown")


def contact_links(nodes: Column, url: Column, text: Column, hints: tuple[str, ...] = CONTACT_HINTS) -> Column:
    """Links to the same registered domain whose address or text speaks of contacts, made absolute, in order."""
    origin = F.regexp_extract(F.coalesce(url, F.lit("")), r"^([a-zA-Z]+://[^/?#]+)", 1)
    links = F.filter(nodes, lambda x: is_link(x) & ~F.lower(F.trim(attr(x, "href"))).rlike("^(mailto|tel|javascript|data):"))

    def absolute(x: Column) -> Column:
        href = F.trim(attr(x, "href"))
        scheme = F.regexp_extract(F.coalesce(url, F.lit("")), r"^([a-zA-Z]+:)", 1)
        bare = F.regexp_replace(F.coalesce(url, F.lit("")), "[?#].*$", "")
        folder = F.when(bare == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_replace(bare, "[^/]+$", ""))
        return F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(F.startswith(href, F.lit("//")), F.concat(scheme, href)).when(F.startswith(href, F.lit("/")), F.concat(origin, href)).otherwise(F.concat(folder, href))

    domain = lambda u: T.registered_domain(T.host(u))
    said = lambda x: F.exists(F.array(*map(F.lit, hints)), lambda h: F.contains(F.lower(x["href"]), h) | F.contains(F.lower(x["text"]), h))
    whole = F.transform(links, lambda x: F.struct(F.regexp_replace(absolute(x), "#.*$", "").alias("href"), text_of(text, x).alias("text")))
    return F.array_distinct(F.transform(F.filter(whole, lambda x: (domain(x["href"]) == domain(url)) & (domain(url) != "") & said(x)), lambda x: x["href"]))


def site_contacts(text: Column, nodes: Column, country: tuple[str, str] = ("7", "8")) -> Column:
    """Contacts of a site's page: phones (of a country, by its code and trunk prefix) and e-mails of its text, then of its tel: and mailto: links; the text of its footer, where addresses stand."""
    linked = lambda kind: F.transform(F.filter(nodes, lambda x: is_link(x, f"{kind}:")), lambda x: F.trim(F.regexp_replace(attr(x, "href"), rf"(?i)^{kind}:|\?.*$", "")))
    runs = F.regexp_extract_all(text, F.lit(r"(\+?\d[\d ()-]{8,18}\d)"), F.lit(1))
    phones = F.transform(F.concat(runs, linked("tel")), lambda p: T.phone(p, *country))
    footer = F.get(F.transform(F.filter(nodes, lambda x: x["tag"] == "footer"), lambda x: text_of(text, x)), 0)
    return F.struct(F.array_distinct(F.array_compact(phones)).alias("phones"), F.array_distinct(F.concat(T.emails(text), F.transform(linked("mailto"), F.lower))).alias("emails"), footer.alias("footer"))


#: Fixed values of tender lists: classes of a row, titles of service links, labels of fields, where a value ends, marks of regions and procedures.
ROW_MARKS = ("tender", "result", "lot", "item", "card")
LABELS = {
    "region": ("Регион", "Регион поставки"), "industry": ("Отрасль", "Отрасли", "Категория", "Категории"),
    "date_text": ("Период показа", "Дата начала", "Дата окончания", "Дата публикации", "Срок выполнения", "Окончание", "Дата", "Период", "Начало"),
    "price_text": ("Цена", "Сумма", "Стоимость", "НМЦ"), "procedure_text": ("Процедура", "Тип процедуры", "Тип торгов", "Вид процедуры", "Тип"),
}
LABEL_STEMS = ("регион", "отрасл", "категори", "период", "дата", "срок", "окончание", "начало", "цена", "сумма", "стоимость", "нмц", "процедур", "тип")  # one of them stands in each label
VALUE_ENDS = ("Документы", "Файлы")
REGION_MARKS = (" фо", "область", "край", "республика", "округ", "автоном", "город", " г ")
PROCEDURE_MARKS = ("электронный аукцион", "запрос предложений", "запрос котировок", "аукцион", "конкурс", "торги", "редукцион", "продажа")
SERVICE_TITLES = ("подключить тестовый доступ", "тестовый доступ", "расширенный поиск", "международные тендеры", "см. док", "документы", "файлы", "подробнее", "войти", "зарегистрироваться")
SERVICE_CELLS = ("подключить тестовый доступ", "тестовый доступ", "расширенный поиск", "международные тендеры", "войти", "зарегистрироваться", "подробнее")
DATE = r"\b\d{1,2}\.\d{1,2}\.\d{4}\b"
PRICE = r"(?iu)\b(?:\d{1,3}(?:[\s\u00a0]\d{3})+|\d+)(?:[,.]\d+)?\s*(?:руб\.?|₽)(?=$|\s|[),.;])"
ITEM_HINT = r"(?i)tender/?\d{4}"  # what a link that has such a path holds
ITEM_PATH = r"(?i)(?:-tender(?=\d+\.html$)|/tender/(?=\d+/?$))(\d{4,})(?:\.html|/?)$"


def labelled(text: Column, labels: tuple[str, ...], low: Column) -> Column:
    """The value after the first of the labels that the text (low: in lower case) has, up to the next label of any field; null without one."""
    every = "|".join(rf"\Q{x}\E" for x in sorted({x for v in LABELS.values() for x in v}, key=len, reverse=True))
    ends = "|".join(VALUE_ENDS)
    # most texts lack most labels, which is seen faster without a pattern
    value = lambda x: F.when(F.contains(low, F.lit(x.lower())), F.nullif(T.one_space(F.regexp_extract(text, rf"(?iuU)\Q{x}\E(?<![\p{{L}}0-9]\Q{x}\E)(?![\p{{L}}0-9])\s*(?:[:\-]\s*|\s+)(.+?)(?=\s+(?:{every})(?:\s*[:\-]|\s+)|\s+(?:{ends})\b|$)", 1)), F.lit("")))
    return F.coalesce(*[value(x) for x in labels])


def any_mark(text: Column, marks: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for m in marks:
        found = found | F.contains(text, F.lit(m))
    return found


def list_items(text: Column, nodes: Column) -> Column:
    """The items of a list page: for each link to a detail page its row (the nearest table row, else list item, article or element marked as one up to six levels up) and what stands there.

    An array of item_id, href, title, snippet, cells and has_document; one per id, the first. A title is the link's own text, else that
    of another link to an item in the row whose text isn't a service link's; cells are those of a table row. Of the page only the row's own elements and text are read for an item.
    """
    is_service = lambda t: bound(F.lower(t), lambda low: any_mark(low, SERVICE_TITLES))
    is_bare = lambda t: F.btrim(F.lower(t), F.lit(" .:+-")).isin(*SERVICE_CELLS)
    bare = lambda href: F.regexp_replace(F.regexp_replace(href, "[?#].*$", ""), "^[a-zA-Z]+://[^/]*", "")
    numbered = lambda p: F.regexp_extract(p, ITEM_PATH, 1)
    hinted = lambda x: (x["tag"] == "a") & attr(x, "href").rlike(ITEM_HINT)
    links = F.transform(F.filter(nodes, hinted), lambda x: bound(bare(F.trim(attr(x, "href"))), lambda p: F.struct(x.alias("x"), p.alias("p"), numbered(p).alias("id"))))
    wanted = F.filter(links, lambda y: (y["id"] != "") & ~F.startswith(F.lower(y["p"]), F.lit("/tender/search")))

    def row_of(x: Column, above: Column) -> Column:
        rows = F.filter(above, lambda p: p["tag"] == "tr")
        near = F.filter(F.slice(above, 1, 6), lambda p: p["tag"].isin("li", "article") | bound(F.lower(F.array_join(p["classes"], " ")), lambda low: any_mark(low, ROW_MARKS)))
        return F.coalesce(F.get(rows, 0), F.get(near, 0), F.get(F.slice(above, 6, 1), 0), F.element_at(F.concat(F.array(x), above), -1))

    placed = F.transform(wanted, lambda y: F.struct(y.alias("y"), bound(F.transform(F.reverse(y["x"]["path"]), lambda i: F.get(nodes, i)), lambda above: row_of(y["x"], above)).alias("row")))

    def item(y: Column, row: Column, inner: Column, shown: Column, snippet: Column, low: Column) -> Column:
        cut = lambda z: F.substring(shown, z["start"] - row["start"] + 1, z["end"] - z["start"])
        piece = lambda z: F.when(snippet == shown, cut(z)).otherwise(T.one_space(cut(z)))
        stated = F.when(F.contains(snippet, F.lit("№")), F.regexp_extract(snippet, r"(?iuU)тендер\s*№\s*(\d{4,})", 1))
        others = F.transform(F.filter(inner, lambda z: hinted(z) & (numbered(bare(F.trim(attr(z, "href")))) != "")), piece)
        title = bound(piece(y["x"]), lambda own: F.when((own != "") & ~is_service(own), own).otherwise(F.coalesce(F.get(F.filter(others, lambda t: (t != "") & ~is_service(t)), 0), own)))
        cells = F.transform(F.filter(inner, lambda z: (row["tag"] == "tr") & z["tag"].isin("td", "th") & (F.element_at(z["path"], -1) == row["n"])), piece)
        files = F.exists(inner, lambda z: is_link(z) & bound(F.lower(attr(z, "href")), lambda href: any_mark(href, ("doc", "file", "download", "attachment"))))
        return F.struct(
            F.coalesce(F.nullif(stated, F.lit("")), y["id"]).alias("item_id"), F.trim(attr(y["x"], "href")).alias("href"), title.alias("title"), snippet.alias("snippet"),
            F.filter(cells, lambda t: (t != "") & ~is_bare(t)).alias("cells"), (files | any_mark(low, ("документ", "файл"))).alias("has_document"),
        )

    def made(q: Column) -> Column:
        row, whole = q["row"], F.substring(text, q["row"]["start"] + 1, q["row"]["end"] - q["row"]["start"])
        parts = F.array(F.struct(within(nodes, row).alias("inner"), whole.alias("shown")))
        worded = F.transform(parts, lambda v: F.struct(v["inner"].alias("inner"), v["shown"].alias("shown"), T.one_space(v["shown"]).alias("snippet")))
        return F.get(F.transform(worded, lambda v: item(q["y"], row, v["inner"], v["shown"], v["snippet"], F.lower(v["snippet"]))), 0)

    once = lambda items: bound(F.transform(items, lambda x: x["item_id"]), lambda ids: F.filter(items, lambda x, i: F.array_position(ids, x["item_id"]) == i + 1))
    return bound(F.transform(placed, made), once)


def item_fields(items: DataFrame) -> DataFrame:
    """Rows with snippet and cells, and region, industry, date_text, price_text, procedure_text: by label in the row's text, else by label or look in the first cell that has one."""
    region = lambda c, low: F.when(F.contains(c, F.lit(" / ")) & bound(F.concat(F.lit(" "), low, F.lit(" ")), lambda x: any_mark(x, REGION_MARKS)), c)
    dates = lambda c: F.slice(F.regexp_extract_all(c, F.lit(f"({DATE})"), F.lit(1)), 1, 2)
    dashed = lambda c: F.regexp_extract(c, f"{DATE}(.*?){DATE}", 1).rlike("[-–]")
    joined = lambda c: bound(dates(c), lambda found: F.nullif(F.when((F.size(found) > 1) & dashed(c), F.array_join(found, " - ")).otherwise(F.array_join(found, " ")), F.lit("")))
    # dates, and "см. док", have points; prices have their currency
    date = lambda c, low: F.when(F.contains(c, F.lit(".")), joined(c))
    sum_of = lambda c, low: F.when(any_mark(low, ("руб", "₽")), F.nullif(T.one_space(F.regexp_extract(c, PRICE, 0)), F.lit("")))
    price = lambda c, low: F.coalesce(sum_of(c, low), F.when(F.contains(c, F.lit(".")) & c.rlike(r"(?iu)\bсм\.\s*док"), "См. док."))
    kind = lambda c, low: F.when(any_mark(low, PROCEDURE_MARKS), c)
    industry = lambda c, low: F.when(F.contains(c, F.lit(" / ")) & region(c, low).isNull() & date(c, low).isNull() & price(c, low).isNull() & kind(c, low).isNull(), c)
    looks = {"region": region, "industry": industry, "date_text": date, "price_text": price, "procedure_text": kind}

    def by_cell(name: str) -> Column:
        found = lambda x: F.coalesce(F.when(x["any"], labelled(x["c"], LABELS[name], x["low"])), looks[name](x["c"], x["low"]))
        return F.get(F.filter(F.transform("__cells", found), lambda v: v.isNotNull()), 0)

    lowered = items.withColumns({"__low": F.lower("snippet"), "__cells": F.transform("cells", lambda c: bound(F.lower(c), lambda low: F.struct(c.alias("c"), low.alias("low"), any_mark(low, LABEL_STEMS).alias("any"))))})
    return lowered.withColumns({name: F.coalesce(labelled(F.col("snippet"), LABELS[name], F.col("__low")), by_cell(name)) for name in looks}).drop("__low", "__cells")


def list_signal(items: Column, error: Column, applied: Column, registration: Column, stated: Column, positive: Column, negative: Column) -> Column:
    """What a list page says: status (error, not_applied, registration_limited, zero, visible in that order), how many items it shows, and the ids of those with a positive and no negative term.

    stated is the number of results the page states, null if none; positive and negative are arrays of lower-case terms.
    """
    seen = F.size(items)
    count = F.greatest(seen, F.coalesce(stated, F.lit(0)))
    said = lambda shown, terms: F.exists(terms, lambda t: F.contains(shown, t))
    hit = lambda x: bound(F.lower(F.concat_ws(" ", x["title"], x["snippet"])), lambda shown: said(shown, positive) & ~said(shown, negative))
    hits = F.transform(F.filter(items, hit), lambda x: x["item_id"])
    status = F.when(error, "error").when(~applied, "not_applied").when(registration & (seen == 0), "registration_limited").when(count == 0, "zero").otherwise("visible")
    return F.struct(status.alias("status"), seen.alias("n_visible"), F.when(status == "visible", hits).otherwise(F.array().cast("array<string>")).alias("matched_ids"))
