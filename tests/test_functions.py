import math

import pytest
from pyspark.sql import functions as F

from quarrylight.functions import numbers as N
from quarrylight.functions import text as T


def one(spark, make, *values, schema=None):
    row = spark.createDataFrame([values], schema or ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(make(*[F.col(c) for c in row.columns]).alias("x")).first().x


@pytest.mark.parametrize(("given", "want"), [("  a   b\n", "a b"), ("", ""), (None, "")])
def test_one_space(spark, given, want):
    assert one(spark, T.one_space, given) == want


def test_blank_is_null(spark):
    assert one(spark, T.clean, " \t ") is None and one(spark, T.clean, " x ") == "x"


@pytest.mark.parametrize(("given", "want"), [("ООО «Завод №5»", "ооо-завод-5"), ("--A b--", "a-b"), (None, "")])
def test_slug(spark, given, want):
    assert one(spark, T.slug, given) == want


def test_compact(spark):
    assert one(spark, lambda c: T.compact(c, 5), "abcd efgh") == "abcd…" and one(spark, lambda c: T.compact(c, 5), "abcde") == "abcde"


@pytest.mark.parametrize(("given", "want"), [("7707083893", True), ("7707083894", False), ("500100732259", True), ("500100732258", False), ("12", False), (None, False)])
def test_valid_inn(spark, given, want):
    assert one(spark, T.valid_inn, given) is want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("8 (495) 123-45-67", "+7 495 123-45-67"), ("+7 495 1234567", "+7 495 123-45-67"), ("(495) 123-45-67", "+7 495 123-45-67"), ("4951234567", None), ("8 (095) 123-45-67", None),
        ("8 800 100 20 30", "+7 800 100-20-30"), ("8 812 100 20 30", None), ("+7 495 123 45 67 доб. 12", "+7 495 123-45-67"), ("tel:+74951234567", "+7 495 123-45-67"), (None, None),
    ],
)
def test_phone(spark, given, want):
    assert one(spark, T.phone, given) == want


def test_emails(spark):
    assert one(spark, T.emails, "Write to A.b@X.org., a.b@x.org or c@d.co") == ["a.b@x.org", "c@d.co"] and one(spark, T.emails, None) == []


@pytest.mark.parametrize(
    ("given", "want"),
    [("HTTPS://User:p@WWW.Example.org:8080/A/b/?q=1#f", "https://example.org/A/b"), ("example.com", "https://example.com"), ("  ", None), (None, None), ("http://x.y/", "http://x.y")],
)
def test_url(spark, given, want):
    assert one(spark, T.url, given) == want


@pytest.mark.parametrize(("given", "want"), [("a.b.example.com", "example.com"), ("shop.firm.com.ru", "firm.com.ru"), ("firm.spb.ru", "firm.spb.ru"), ("local", "local"), ("", "")])
def test_registered_domain(spark, given, want):
    assert one(spark, T.registered_domain, given) == want


@pytest.mark.parametrize(("given", "want"), [("firm.ru", True), ("vk.com", False), ("m.vk.com", False), ("fi░m.ru", False), ("12.34", False), ("local", False), (None, False)])
def test_is_corporate(spark, given, want):
    assert one(spark, T.is_corporate, given) is want


def test_email_site(spark):
    assert one(spark, T.email_site, "a@firm.ru") == "https://firm.ru" and one(spark, T.email_site, "a@mail.ru") is None


def test_split_sites(spark):
    assert one(spark, T.split_sites, "a.ru | b.ru,, c.ru") == ["a.ru", "b.ru", "c.ru"]


def test_name_tokens(spark):
    assert one(spark, T.name_tokens, "ООО «Ёлочный завод» и завод") == ["елочный", "завод"]


@pytest.mark.parametrize(("given", "want"), [("abcdefghijkl", "abcdefghij"), ("abcdefghi", "abcdefgh"), ("abcdefg", "abcdef"), ("abc", "abc")])
def test_stem(spark, given, want):
    assert one(spark, T.stem, given) == want


def test_keywords(spark):
    words = {"завод": 3, "труба": 2, "лом": 1}
    assert one(spark, lambda c: T.keyword_weight(c, words), "завод и металлолом") == 4.0
    assert one(spark, lambda c: T.keyword_weight(c, words, 1), "завод и металлолом") == 3.0
    assert one(spark, lambda c: T.keyword_hits(c, [*words]), "труба, завод") == ["завод", "труба"]


@pytest.mark.parametrize(("given", "want"), [("/price.PDF?x=1", "files"), ("/kontakty", "contacts"), ("/metallolom/news", "sales"), ("/", "homepage"), (None, "homepage")])
def test_section(spark, given, want):
    assert one(spark, T.section, given) == want


@pytest.mark.parametrize(("given", "want"), [("от 3.2.2024 и 2023-01-05", "2024-02-03"), ("on 2023-01-05", "2023-01-05"), ("none", None), (None, None)])
def test_date_guess(spark, given, want):
    assert one(spark, T.date_guess, given) == want


def test_tables_text(spark):
    assert spark.range(1).select(T.tables_text(F.array(F.array(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("c"))))).alias("x")).first().x == "a | b\nc"


def test_fingerprint_tells_null_from_empty(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string").select(T.fingerprint(F.col("x"), F.col("y")).alias("f")).collect()
    assert rows[0].f == rows[2].f != rows[1].f


def test_haversine(spark):
    km = spark.range(1).select(N.haversine_km(F.lit(55.7558), F.lit(37.6173), F.lit(59.9343), F.lit(30.3351)).alias("x")).first().x
    assert abs(km - 633) < 2


@pytest.mark.parametrize(("lat", "lon", "want"), [(1.0, 1.0, True), (0.0, 1.0, True), (2.0, 2.0, True), (3.0, 1.0, False), (1.0, -0.1, False)])
def test_polygon_holds_its_edge(spark, lat, lon, want):
    assert spark.range(1).select(N.in_polygon(F.lit(lat), F.lit(lon), [(0, 0), (0, 2), (2, 2), (2, 0)]).alias("x")).first().x is want


def test_usage_cost(spark):
    row = spark.createDataFrame([(1_000_000, 200_000, 10), (5, None, 0), (None, 0, 1)], "i bigint, c bigint, o bigint").select(N.usage_cost(F.col("i"), F.col("c"), F.col("o"), ("0.75", "0.075", "4.50")).alias("x")).collect()
    assert math.isclose(row[0].x, 0.615045) and str(row[1].x).startswith("0.00000375") and row[2].x is None


def test_wall_seconds(spark):
    row = spark.sql("select timestamp_ntz'1970-01-02 00:00:01.5' as t").select(N.wall_seconds("t").alias("x")).first()
    assert row.x == 86401.5


def test_marks_hide_no_component_and_no_text_is_cut_twice(spark):
    """Patterns behind marks find what they find alone, in any letter case; the plan has the cuts twice at most, where each check repeated them before."""
    import random

    from quarrylight.functions import addresses as A

    rng = random.Random(8)
    words = "123456 654321 обл. ОБЛ край р-н Р - Н район г. Г.Тверь город гор. пос. с. С.Ивановка д. д.5 Д 7 дом стр.1 литер Б ул. УЛ пер оф.3 каб 4 тер мкр Телефон ТЕЛ. e-mail Email инн БИК вн.тер.г внутригородская территория города муниципального муниципальный округ ᲀн ёлка\u00a0х ооо ᲁом Emaıl ПОᲃ".split(" ")
    rows = [(None,), ("",)] + [(" ".join(rng.choices(words, k=rng.randrange(1, 14))),) for _ in range(400)]
    df = spark.createDataFrame(rows, "a string")
    raw = F.array_compact(F.array(*[F.when(F.col("a").rlike(p), F.lit(k)) for k, p in A.COMPONENTS.items()]))
    cut = F.regexp_replace(F.regexp_replace(A.T.one_space(F.col("a")), r"^(.*?\b\d{6}\b.*?)\b\d{6}\b.*$", "$1"), r"^(.{20}.*?)" + A.STOP + r".*$", "$1")
    low = F.translate(F.lower(F.regexp_replace(F.coalesce("a", F.lit("")), "\u00a0", " ")), "ё", "е")
    for pattern, w in (*A.WRITTEN_OUT, *((p, " ") for p in A.ADMINISTRATION)):
        low = F.regexp_replace(low, pattern, w)
    found = df.select("a", A.components(F.col("a")).alias("c"), raw.alias("raw"), A.sanitize(F.col("a")).alias("s"), cut.alias("cut"), A.lookup_text(F.col("a")).alias("l"), A.lookup_text(low).alias("written")).collect()
    assert all(r.c == r.raw and r.l == r.written and (r.s is None or r.cut.startswith(r.s)) for r in found) and sum(r.s is not None for r in found) > 100
    assert df.select(A.sanitize(F.col("a")))._jdf.queryExecution().analyzed().toString().count("заказать звонок|") <= 2
