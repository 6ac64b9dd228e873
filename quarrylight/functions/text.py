"""Text, identifier, contact and URL functions: Column in, Column out, inside code generation.

Absence is null: ``clean`` turns blank text to null at the edge, and every function gives null or an empty array for null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """What use makes of a value that is worked out once, however often use names it."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), 0)


def one_space(x: Column) -> Column:
    """White space runs to one space, ends stripped; null becomes the empty text."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U) \s+|[\s&&[^ ]]\s*", " "))  # a blank alone is left as it is


def clean(x: Column) -> Column:
    """One-spaced, or null if nothing is left."""
    return F.nullif(one_space(x), F.lit(""))


def slug(x: Column) -> Column:
    """Lower case, runs of anything but Latin and Cyrillic letters and digits to a hyphen."""
    return F.regexp_replace(F.regexp_replace(F.lower(one_space(x)), r"[^a-z0-9а-яё]+", "-"), r"^-+|-+$", "")


def compact(x: Column, limit: int) -> Column:
    """One-spaced and cut to limit characters, the last an ellipsis."""
    x = one_space(x)
    return F.when(F.char_length(x) > limit, F.concat(F.rtrim(F.left(x, F.lit(limit - 1))), F.lit("…"))).otherwise(x)


def digits(x: Column) -> Column:
    return F.regexp_replace(F.coalesce(x, F.lit("")), r"[^0-9]", "")


def _check_digit(number: Column, weights: Sequence[int]) -> Column:
    total = F.lit(0)
    for i, w in enumerate(weights):
        total = total + F.substring(number, i + 1, 1).cast("int") * w
    return total % 11 % 10


def valid_inn(x: Column) -> Column:
    """Whether a taxpayer id of 10 or 12 digits has the right check digits."""
    d = digits(x)
    ten = _check_digit(d, V.INN_WEIGHTS_10) == F.substring(d, 10, 1).cast("int")
    twelve = (_check_digit(d, V.INN_WEIGHTS_11) == F.substring(d, 11, 1).cast("int")) & (_check_digit(d, V.INN_WEIGHTS_12) == F.substring(d, 12, 1).cast("int"))
    return F.when(F.char_length(d) == 10, ten).when(F.char_length(d) == 12, twelve).otherwise(F.lit(False))


def phone(x: Column, country: str = "7", trunk: str = "8", length: int = 11) -> Column:
    """A phone number in the form +7 AAA BBB-CC-DD, or null if it isn't one.

    Text after an extension word is cut. National numbers need a sign of a phone among +()- and space. The area may
    not begin with 0, 1 or 2; of those that begin with 8 only 800 is one.
    """
    raw = F.regexp_replace(F.coalesce(x, F.lit("")), r"(?iu)^\s*(tel:|тел\.?)|(доб|ext|внутр).*$", "")
    d = digits(raw)
    full = F.when((F.char_length(d) == length - 1) & raw.rlike(r"[+() -]"), F.concat(F.lit(country), d)).when(
        (F.char_length(d) == length) & F.startswith(d, F.lit(trunk)), F.concat(F.lit(country), F.substring(d, 2, length))
    ).otherwise(d)
    area = F.substring(full, 2, 3)
    good = (F.char_length(full) == length) & F.startswith(full, F.lit(country)) & ~F.substring(area, 1, 1).isin("0", "1", "2") & (~F.startswith(area, F.lit("8")) | (area == "800"))
    shown = F.concat_ws(" ", F.concat(F.lit("+"), F.lit(country)), area, F.concat_ws("-", F.substring(full, 5, 3), F.substring(full, 8, 2), F.substring(full, 10, 2)))
    return F.when(good, shown)


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def emails(x: Column) -> Column:
    """Distinct e-mail addresses in order, lower case, marks stripped from their ends."""
    found = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(f"({EMAIL})"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda e: F.btrim(F.lower(e), F.lit(" .,:;"))))


def urls(x: Column) -> Column:
    """Distinct http(s) addresses in order, closing marks stripped."""
    found = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"(?i)(https?://[^\s<>\"]+)"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda u: F.rtrim(u, F.lit(").,;"))))


def url(x: Column) -> Column:
    """With a scheme, lower-case host, no user, query, fragment or closing slash; null if there is no host."""
    x = clean(x)
    x = F.when(x.rlike(r"(?i)^https?://"), x).otherwise(F.concat(F.lit("https://"), x))
    scheme = F.lower(F.regexp_extract(x, r"(?i)^(https?)://", 1))
    path = F.rtrim(F.regexp_extract(x, r"^[^:]+://[^/?#]*([^?#]*)", 1), F.lit("/"))
    return F.when(host(x) != "", F.concat(scheme, F.lit("://"), host(x), path))


def host(x: Column) -> Column:
    """The lower-case host without user, port and a leading www."""
    bare = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"^[a-z]+://", "")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"^([^/?#]*)", 1), r"^[^@]*@", ""), r":\d+$", "")
    return F.regexp_replace(bare, r"^www\.", "")


def registered_domain(h: Column) -> Column:
    """The last two labels of a host, three under a compound suffix."""
    h = F.btrim(F.lower(F.coalesce(h, F.lit(""))), F.lit("."))
    two = F.substring_index(h, ".", -2)
    return F.when(two.isin(*V.COMPOUND_SUFFIXES), F.substring_index(h, ".", -3)).otherwise(two)


def is_corporate(domain: Column, blocked: Sequence[str] = V.NON_CORPORATE) -> Column:
    """A domain that can be a company's: a dot, a letter, no mask, not on the list nor under an entry of it."""
    listed = domain.isin(*blocked)
    for b in blocked:
        listed = listed | F.endswith(domain, F.lit(f".{b}"))
    return F.coalesce(domain.contains(".") & ~domain.rlike(r"[░*]") & domain.rlike(r"(?U)\p{L}") & ~listed, F.lit(False))


def email_site(email: Column) -> Column:
    """The site that an address suggests; null for mail providers."""
    d = F.lower(F.substring_index(email, "@", -1))
    return F.when(email.contains("@") & ~d.isin(*V.MAIL_PROVIDERS), F.concat(F.lit("https://"), d))


def split_sites(x: Column) -> Column:
    """Sites of a cell that lists them with bars or commas."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), r"[|,]"), one_space), lambda s: s != "")


def name_tokens(x: Column, least: int = 4, stop: Sequence[str] = ()) -> Column:
    """Distinct words of a company name: quotes and legal forms gone, ё to е, at least so long."""
    bare = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"(?iu)\b(ооо|оао|зао|пао|ао|ип|llc|ltd|inc|gmbh)\b", " ")
    words = F.split(F.translate(bare, "ё", "е"), r"(?U)[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: (F.char_length(w) >= least) & ~w.isin(*stop) if stop else F.char_length(w) >= least))


def stem(x: Column) -> Column:
    """The part of a word that stands for its forms: 10 letters of 12 or more, 8 of 9 or more, 6 of 6 or more."""
    n = F.char_length(x)
    return F.when(n >= 12, F.left(x, F.lit(10))).when(n >= 9, F.left(x, F.lit(8))).when(n >= 6, F.left(x, F.lit(6))).otherwise(x)


def keyword_weight(text: Column, weights: Mapping[str, float], first: int | None = None) -> Column:
    """The sum of weights of keywords that text contains; with first, of so many in their order."""
    hits = F.array(*[F.when(F.contains(text, F.lit(k)), F.lit(float(w))) for k, w in weights.items()])
    hits = F.array_compact(hits)
    return F.aggregate(F.slice(hits, 1, first) if first else hits, F.lit(0.0), lambda a, b: a + b)


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """The keywords that text contains, in their order."""
    return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(k)), F.lit(k)) for k in keywords]))


def section(path: Column, hints: Mapping[str, Sequence[str]] = V.SECTION_HINTS, documents: Sequence[str] = V.DOCUMENT_EXTENSIONS) -> Column:
    """The section of a page by its lower-case path: documents are files, then the first hint that it contains, else homepage."""
    low = F.lower(F.coalesce(path, F.lit("")))
    found = F.when(F.regexp_extract(low, r"^([^?#]*)", 1).rlike("(" + "|".join(e.replace(".", r"\.") for e in documents) + ")$"), F.lit("files"))
    for name, marks in hints.items():
        test = F.contains(low, F.lit(marks[0]))
        for m in marks[1:]:
            test = test | F.contains(low, F.lit(m))
        found = found.when(test, F.lit(name))
    return found.otherwise(F.lit("homepage"))


def date_guess(x: Column) -> Column:
    """The first date in the first 2000 characters, as yyyy-mm-dd: dd.mm.yyyy (or with - or /) before an ISO date."""
    head = F.left(F.coalesce(x, F.lit("")), F.lit(2000))
    day, iso = r"\b([0-3]?\d)[./-]([01]?\d)[./-]((?:19|20)\d\d)\b", r"\b((?:19|20)\d\d-[01]\d-[0-3]\d)\b"
    dmy = F.concat_ws("-", F.regexp_extract(head, day, 3), F.lpad(F.regexp_extract(head, day, 2), 2, "0"), F.lpad(F.regexp_extract(head, day, 1), 2, "0"))
    return F.when(head.rlike(day), dmy).when(head.rlike(iso), F.regexp_extract(head, iso, 1))


def tables_text(tables: Column) -> Column:
    """array<array<array<string>>> as text: cells joined by bars, rows and tables by newlines."""
    return F.array_join(F.transform(F.flatten(tables), lambda row: F.array_join(row, " | ")), "\n")


def fingerprint(*columns: Column) -> Column:
    """sha256 of the columns as canonical JSON, in the order given."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def masked(value: Column) -> Column:
    """Whether a contact is shown only in part."""
    return F.coalesce(value.rlike(r"[░*]"), F.lit(False))
