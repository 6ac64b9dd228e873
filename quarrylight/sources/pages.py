"""HTML pages to records: title, description, text, links, contacts, tables, cards. Parsing is an Arrow-batched pass with the standard parser."""

from __future__ import annotations

import hashlib
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

SKIPPED = {"script", "style", "noscript", "template"}
HEADINGS = {"h1", "h2", "h3", "h4"}
BLOCKS = {"p", "div", "br", "li", "ul", "ol", "table", "tr", "td", "th", "dl", "dt", "dd", "section", "article", "header", "footer", "nav", "title", "address"} | HEADINGS


class Page(HTMLParser):
    """Collects what a record needs in one reading."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.description, self.parts, self.links, self.rows, self.itemprops = [], "", [], [], [], {}
        self.skipping, self.in_title, self.link, self.cell, self.prop = 0, False, None, None, None
        self.sections, self.heading, self.pairs, self.term, self.addresses, self.address = [["", []]], None, {}, None, [], None

    def handle_starttag(self, tag, attrs):
        given = {k: v or "" for k, v in attrs}
        if tag in SKIPPED:
            self.skipping += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "meta" and given.get("name", "").lower() == "description":
            self.description = given.get("content", "")
        elif tag == "a":
            self.link = [given.get("href", ""), []]
        elif tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th", "dt", "dd"):
            self.cell = []
        elif tag in HEADINGS:
            self.heading = []
        elif tag == "address":
            self.address = []
        if given.get("itemprop"):
            if given.get("content"):
                self.itemprops.setdefault(given["itemprop"], []).append(given["content"])
            else:
                self.prop = given["itemprop"]
        if tag in BLOCKS:
            self.parts.append("\n")
            self.sections[-1][1].append("\n")

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skipping = max(0, self.skipping - 1)
        elif tag == "title":
            self.in_title = False
        elif tag == "a" and self.link:
            self.links.append((self.link[0], " ".join("".join(self.link[1]).split())))
            self.link = None
        elif tag in ("td", "th", "dt", "dd") and self.cell is not None:
            value = " ".join("".join(self.cell).split())
            self.cell = None
            if tag == "dt":
                self.term = value
            elif tag == "dd":
                self.pair(self.term, value)
            else:
                if not self.rows:
                    self.rows.append([])
                self.rows[-1].append(value)
        elif tag == "tr" and self.rows and len(self.rows[-1]) == 2:
            self.pair(*self.rows[-1])
        elif tag in HEADINGS and self.heading is not None:
            self.sections.append([" ".join("".join(self.heading).split()), []])
            self.heading = None
        elif tag == "address" and self.address is not None:
            self.addresses.append(" ".join("".join(self.address).split()))
            self.address = None
        if tag in BLOCKS:
            self.parts.append("\n")
            self.sections[-1][1].append("\n")

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
            return
        if self.skipping:
            return
        self.parts.append(data)
        if self.heading is not None:
            self.heading.append(data)
        else:
            self.sections[-1][1].append(data)
        if self.address is not None:
            self.address.append(data)
        if self.link:
            self.link[1].append(data)
        if self.cell is not None:
            self.cell.append(data)
        if self.prop and data.strip():
            self.itemprops.setdefault(self.prop, []).append(" ".join(data.split()))
            self.prop = None

    def pair(self, label: str | None, value: str):
        label = (label or "").rstrip(" :").strip()
        if label and value:
            self.pairs.setdefault(label, value)

    def carded(self) -> list[dict]:
        """The text under each heading; what stands before the first has none."""
        found = [{"heading": h, "text": " ".join("".join(parts).split())} for h, parts in self.sections]
        return [s for s in found if s["heading"] or s["text"]]

    def text(self) -> str:
        lines = (" ".join(x.split()) for x in "".join(self.parts).split("\n"))
        return "\n".join(x for x in lines if x)


def read_page(html: str | None) -> Page:
    page = Page()
    page.feed(html or "")
    page.close()
    return page


RECORD = "title string, description string, text string, n_links int, links array<struct<href:string,anchor:string>>, phones array<string>, emails array<string>, addresses array<string>, rows array<array<string>>, pairs map<string,string>, sections array<struct<heading:string,text:string>>, itemprops map<string,array<string>>, fingerprint string"


def page_records(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """One record per page; the fingerprint is that of its text, else of its URL. Null HTML gives an empty record.

    phones and emails are those of tel: and mailto: links, addresses what address elements hold; pairs are labels with their values, from rows of two cells
    and description lists (the first of a label); sections are the texts under the headings.
    """

    def parse(batches):
        for pdf in batches:
            out = []
            for i, url, html in zip(pdf[id_col], pdf[url_col], pdf[html_col], strict=True):
                p = read_page(html)
                text = p.text()
                linked = lambda mark: list(dict.fromkeys(h[len(mark) :].split("?")[0].strip() for h, _ in p.links if h.lower().startswith(mark)))  # noqa: E731, B023
                links = [{"href": h, "anchor": a} for h, a in p.links]
                out.append((i, url, " ".join("".join(p.title).split()), p.description, text, len(links), links, linked("tel:"), linked("mailto:"), [a for a in p.addresses if a], [r for r in p.rows if r], p.pairs, p.carded(), p.itemprops, hashlib.sha1((text or url or "").encode()).hexdigest()))
            yield pd.DataFrame(out, columns=[id_col, url_col, "title", "description", "text", "n_links", "links", "phones", "emails", "addresses", "rows", "pairs", "sections", "itemprops", "fingerprint"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, url_col, html_col).mapInPandas(parse, f"{id_col} {kind}, {url_col} string, {RECORD}")


def probe(pages: DataFrame, html_col: str) -> DataFrame:
    """pages with native features of a site probe: markers, links, length of the markup without tags."""
    low = F.lower(F.coalesce(F.col(html_col), F.lit("")))
    bare = F.trim(F.regexp_replace(F.regexp_replace(low, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " "), r"(?s)<[^>]*>|\s+", " "))
    spa = low.rlike(r"data-reactroot|__next_data__|id=[\"']__next[\"']|id=[\"'](app|root)[\"']")
    return pages.withColumns({"is_spa": spa, "old_stack": low.rlike(r"bitrix|\.aspx|asp\.net|windows-1251"), "n_links": F.regexp_count(low, F.lit(r"<a[ >]")), "text_length": F.char_length(F.regexp_replace(bare, " +", " "))})


def card_fields(pairs: Column, labels: dict[str, tuple[str, ...]], numbers: tuple[str, ...] = ()) -> Column:
    """Fields of a card: for each field the value of the first label that the page has (letter case aside); of numbers the digits alone."""
    entries = F.coalesce(F.map_entries(pairs), F.map_entries(F.create_map().cast("map<string,string>")))
    named = lambda x: F.get(F.filter(entries, lambda e: F.lower(e["key"]) == x.lower()), F.lit(0))["value"]
    value = lambda f: F.coalesce(*[named(x) for x in labels[f]])
    return F.struct(*[(F.nullif(T.digits(value(f)), F.lit("")) if f in numbers else T.clean(value(f))).alias(f) for f in labels])


def section_of(sections: Column, marks: tuple[str, ...]) -> Column:
    """The text under the first heading that holds one of the marks; null if there is none."""
    found = F.filter(sections, lambda s: F.lower(s["heading"]).rlike("|".join(marks)))
    return F.get(F.transform(found, lambda s: s["text"]), F.lit(0))


def access_boundary(request_status: Column, http_status: Column, html: Column, gated: tuple[str, ...] = ()) -> Column:
    """Why a page shows no card: no_proxy, rate_limited, blocked, or null where nothing stands against it; gated are texts of a closed page."""
    text = F.lower(T.one_space(html))
    closed = F.lit(False)
    for mark in gated:
        closed = closed | F.contains(text, F.lit(mark))
    status = T.one_space(request_status)
    return (
        F.when(status == "blocked_no_proxy", "no_proxy").when((status == "rate_limited") | F.coalesce(http_status == 429, F.lit(False)) | text.contains("429 too many requests"), "rate_limited")
        .when(status.isin("bot_gate", "http_403") | F.coalesce(http_status == 403, F.lit(False)) | closed, "blocked")
    )


def robots_sitemaps(robots: Column) -> Column:
    """The sitemaps that a stored robots.txt names, in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(robots, F.lit("")), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), F.lit(1)))


def sitemap_urls(xml: Column, limit: int | None = None) -> Column:
    """The addresses of a stored sitemap that share its first one's registered domain; the first of them with a limit."""
    found = F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(r"<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))
    domain = lambda u: T.registered_domain(T.host(u))
    own = F.filter(F.array_distinct(found), lambda u: domain(u) == domain(F.get(found, 0)))
    return own if limit is None else F.slice(own, 1, limit)


#: Bytes 80-BF as Latin-1 and as Windows-1252 show them; a sign is a whole UTF-8 character read so, whatever its first byte, never a letter such as Ñ alone.
_TAIL = "[\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]"
_MOJIBAKE = re.compile(f"[Â-ß]{_TAIL}|[à-ï]{_TAIL}{{2}}|[ð-ô]{_TAIL}{{3}}")


def mend(text: str | None, rounds: int = 2) -> str | None:
    """Undoes text that was read as Latin-1 or Windows-1252 but is UTF-8, if that leaves fewer signs of it."""
    for _ in range(rounds):
        best, signs = text, len(_MOJIBAKE.findall(text or ""))
        for charset in ("latin-1", "cp1252"):
            try:
                other = (text or "").encode(charset).decode()
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            if len(_MOJIBAKE.findall(other)) < signs:
                best, signs = other, len(_MOJIBAKE.findall(other))
        if best == text:
            break
        text = best
    return text


def mended(df: DataFrame, text_col: str) -> DataFrame:
    """df with text_col mended where it shows signs; rows without signs don't go to Python's decoder."""

    @F.pandas_udf("string")
    def fix(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: mend(t) if isinstance(t, str) and _MOJIBAKE.search(t) else t)

    return df.withColumn(text_col, fix(F.col(text_col)))
