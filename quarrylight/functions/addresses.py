"""Postal addresses: which components a text shows, how good it is, and what of it is an address."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T
from . import vocabulary as V

#: Markers of an address's components; (?iu) folds Cyrillic, (?U) makes word boundaries Unicode ones.
COMPONENTS = {
    "postal": r"(?U)\b\d{6}\b",
    "region": r"(?iuU)\b(обл|область|край|респ|республика)\b",
    "district": r"(?iuU)\b(р-н|район)\b",
    "city": r"(?iuU)(\bг\.\s*\p{L}+|\bгород\b)",
    "settlement": r"(?iuU)\b(дер|деревня|с\.|село|пос|поселок|пгт|хутор|станица)\b",
    "territory": r"(?iuU)\b(тер|территория|промзона|мкр|микрорайон|квартал|площадка)\b",
    "street": r"(?iuU)\b(ул|улица|пр-кт|проспект|пер|переулок|шоссе|проезд|бульвар|набережная|тракт)\b",
    "house": r"(?iuU)\b(д\.?|дом|влд\.?|владение)\s*\d+",
    "building": r"(?iuU)\b(корп\.?|корпус|стр\.?|строение|литера?)\s*[\p{L}\d]+",
    "unit": r"(?iuU)\b(оф\.?|офис|каб\.?|кабинет|пом\.?|помещение|этаж)\s*\d+",
}
#: What a text in lower case must hold for a component, a stop phrase or an abbreviation; most texts lack most of them, which is seen faster without a pattern.
MARKS = {
    "region": ("обл", "край", "респ"), "district": ("р-н", "район"), "city": ("г.", "город"), "settlement": ("дер", "с.", "село", "пос", "пгт", "хутор", "станица"),
    "territory": ("тер", "промзона", "мкр", "микрорайон", "квартал", "площадка"), "street": ("ул", "пр-кт", "проспект", "пер", "шоссе", "проезд", "бульвар", "набережная", "тракт"),
    "house": ("д", "влд"), "building": ("корп", "стр", "лит"), "unit": ("оф", "каб", "пом", "этаж"),
}
STOP_MARKS = ("на карте", "телефон", "тел.", "email", "e-mail", "время работы", "copyright", "заказать звонок", "горячая линия", "инн", "кпп", "огрн", "р/с", "бик")
GARBAGE = r"(?iuU)(https?://|www\.|@|\b(тел|телефон|e-?mail|почта|сайт)\b)"
STOP = r"(?iuU)(на карте|телефон|тел\.|e-?mail|время работы|copyright|заказать звонок|горячая линия|\bинн\b|\bкпп\b|\bогрн\b|р/с|\bбик\b)"


#: Abbreviations before a name, written out, and words of municipal administration that say nothing of the place.
WRITTEN_OUT = (
    (r"(?iuU)\bр\s*[-.]?\s*н\b", " район "), (r"(?iuU)\bг\.\s*(?=[a-zа-я])", " город "), (r"(?iuU)\bгор\.\s*(?=[a-zа-я])", " город "), (r"(?iuU)\bобл\.\b", " область "),
    (r"(?iuU)\bпос\.\s*(?=[a-zа-я])", " поселок "), (r"(?iuU)\bс\.\s*(?=[a-zа-я])", " село "), (r"(?iuU)\bд\.\s*(?=[a-zа-я])", " деревня "), (r"(?iuU)\bдер\.\s*(?=[a-zа-я])", " деревня "),
)
ADMINISTRATION = (r"(?iuU)\bвн\s*[-.]?\s*тер\s*[-.]?\s*г\b", r"(?iuU)\bвнутригородск\w*\s+территор\w*(?:\s+город\w*)?\b", r"(?iuU)\bмуниципальн\w*\s+округ\b")
#: What the text must hold for each of them.
WRITTEN_MARKS, ADMINISTRATION_MARKS = ("р", "г.", "гор.", "обл.", "пос.", "с.", "д.", "дер."), ("вн", "внутригородск", "муниципальн")
#: Short forms by word; those of a settlement count only before a name.
SHORT_FORMS = {"обл": "область", "рн": "район"}
SHORT_BEFORE_NAMES = {"г": "город", "гор": "город", "пос": "поселок", "с": "село", "д": "деревня", "дер": "деревня"}
GENERIC_WORDS = ("город", "область", "район", "поселок", "село", "деревня")


def folded(x: Column) -> Column:
    """A text in lower case, with the letters that (?iu) takes for a lower one although they are none of its case."""
    return F.lower(F.translate(x, "İıſᲀᲁᲂᲃᲄᲅᲆᲇ", "iisвдостттъ"))


def holds(shown: Column, marks: Sequence[str]) -> Column:
    found = F.lit(False)
    for m in marks:
        found = found | F.contains(shown, F.lit(m))
    return found


def lookup_text(x: Column) -> Column:
    """An address or name as look-ups compare it: lower case, short forms written out, words apart by one blank. Null gives the empty text."""
    low = F.translate(F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), "\u00a0", " ")), "ё", "е")
    first = F.struct(low.alias("low"), folded(low).alias("shown"))
    # a replacement ends in a blank and makes no mark of a later one, so all are looked for in the text as it was
    steps = [(pattern, words, (mark,)) for (pattern, words), mark in zip(WRITTEN_OUT, WRITTEN_MARKS, strict=True)] + [(pattern, " ", (mark,)) for pattern, mark in zip(ADMINISTRATION, ADMINISTRATION_MARKS, strict=True)]

    def replaced(v: Column) -> Column:
        out = v["low"]
        for pattern, words, marks in steps:
            out = T.bound(out, lambda t, p=pattern, w=words, m=marks: F.when(holds(v["shown"], m), F.regexp_replace(t, p, w)).otherwise(t))
        return out

    low = T.bound(first, replaced)
    words = F.filter(F.split(low, "[^0-9a-zа-я]+"), lambda w: w != "")

    def written(ws: Column) -> Column:
        short = F.create_map(*[F.lit(v) for kv in SHORT_FORMS.items() for v in kv])
        named = F.create_map(*[F.lit(v) for kv in SHORT_BEFORE_NAMES.items() for v in kv])
        before_name = lambda i: F.coalesce(F.get(ws, i + 1), F.lit("")).rlike("[a-zа-я]")
        return F.transform(ws, lambda w, i: F.coalesce(F.try_element_at(short, w), F.when(before_name(i), F.try_element_at(named, w)), w))

    return F.array_join(F.get(F.transform(F.array(words), written), F.lit(0)), " ")


def components(x: Column, patterns: Mapping[str, str] = COMPONENTS) -> Column:
    """The names of the components that a text shows, in their order."""
    marks = lambda k, p: MARKS.get(k) if COMPONENTS.get(k) == p else None
    shows = lambda v, k, p: v["x"].rlike(p) if marks(k, p) is None else holds(v["shown"], marks(k, p)) & v["x"].rlike(p)
    return T.bound(F.struct(x.alias("x"), folded(x).alias("shown")), lambda v: F.array_compact(F.array(*[F.when(shows(v, k, p), F.lit(k)) for k, p in patterns.items()])))


def specificity(x: Column, patterns: Mapping[str, str] = COMPONENTS, weights: Mapping[str, int] = V.ADDRESS_WEIGHTS) -> Column:
    """The weight of the components, 4 more for street and house, 2 for territory and place, 4 less for a region alone."""
    has = {k: F.coalesce(x.rlike(p), F.lit(False)) for k, p in patterns.items()}
    total = F.lit(0)
    for k, c in has.items():
        total = total + F.when(c, weights[k]).otherwise(0)
    place = has["city"] | has["settlement"]
    only_region = has["region"] & ~place & ~has["street"] & ~has["territory"]
    return total + F.when(has["street"] & has["house"], 4).otherwise(0) + F.when(has["territory"] & place, 2).otherwise(0) - F.when(only_region, 4).otherwise(0)


def sanitize(x: Column, least: int = 20, most: int = 160) -> Column:
    """The address in a text, or null: cut at a second postal code and at the first stop phrase after 20 characters, 160 at most,
    with a marker of an address and without two legal forms or long numbers."""
    cut = lambda t: F.when(F.regexp_count(t, F.lit(r"\d{6}")) >= 2, F.regexp_replace(t, r"^(.*?\b\d{6}\b.*?)\b\d{6}\b.*$", "$1")).otherwise(t)
    stop = lambda t: F.when(holds(folded(t), STOP_MARKS), F.regexp_replace(t, r"^(.{" + str(least) + r"}.*?)" + STOP + r".*$", "$1")).otherwise(t)
    trimmed = lambda t: F.rtrim(F.left(F.rtrim(t, F.lit(" ,;:-")), F.lit(most)), F.lit(" ,;:-"))

    def judged(t: Column) -> Column:
        marked = F.size(F.array_remove(F.array_remove(components(t), "postal"), "unit")) > 0
        forms = F.regexp_count(F.lower(t), F.lit(r"(?U)\b(ооо|ао|пао|ип)\b")) >= 2
        return F.when((F.char_length(t) >= least) & marked & ~forms & ~t.rlike(r"\d{10,}") & ~F.lower(t).rlike(r"(?U)[, ]+(пгт|д|ул\.?|р-н)$"), t)

    # each step is worked out once, however often the next one names it
    return T.bound(T.bound(T.bound(T.one_space(x), cut), stop), lambda t: T.bound(trimmed(t), judged))
