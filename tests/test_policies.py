"""Rules of attempts, routes, plans and responses on their edges; accounting of budgets against plain loops."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from quarrylight.operators import policies as P


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_signals_of_nulls_and_mixtures(spark):
    null = F.lit(None)
    s = lambda *a: value(spark, P.signal_tags(*a))
    assert s(null.cast("string"), null.cast("string"), null.cast("int"), null.cast("boolean"), null.cast("double")) == []
    assert s(F.lit(" HTTP_403 "), F.lit("Bot_Gate"), F.lit(429), F.lit(True), F.lit(0.5)) == ["cooldown", "http_429", "http_403", "bot_gate", "challenge"]
    assert s(F.lit("ok"), F.lit(""), F.lit(200), F.lit(False), F.lit(0.0)) == []


def test_hard_negatives_of_odd_pages(spark):
    h = lambda *a: value(spark, P.hard_negatives(*a))
    assert h(F.lit(404), F.lit("https://a.ru"), F.lit("Страница\n не  найдена"), F.lit(True)) == ["http_404", "soft_404", "anti_bot_gate"]
    assert h(F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("boolean")) == []
    assert h(F.lit(200), F.lit("https://a.ru"), F.concat(F.lit("x" * 12_100), F.lit("page not found")), F.lit(False)) == []


@pytest.mark.parametrize(
    ("mode", "family", "section", "want"),
    [
        (None, None, None, ("requests", False, False, "route_family_requests_only")), ("HYBRID", " Search ", None, ("playwright", True, True, "route_family_browser_first")), ("hybrid", "about", None, ("requests", True, False, "route_family_high_value")),
        ("playwright", "static", None, ("playwright", True, False, "requested_playwright")), ("skip", "search", None, ("skip", True, True, "route_family_browser_first")), ("hybrid", "search", "images", ("requests", False, False, "route_family_no_browser")),
        ("requests", "mtr list", "x", ("requests", True, False, "route_family_browser_allowed")),
    ],
)
def test_transport(spark, mode, family, section, want):
    text = lambda x: F.lit(x).cast("string")
    assert tuple(value(spark, P.route_transport(text(mode), text(family), text(section)))) == want


def test_deep_checks(spark):
    rows = [("success", "A", "true", True), ("success", "D", "true", False), ("failed", "A", "true", False), ("success", None, "Yes", True), ("success", "B", None, False), (None, "A", "true", False), ("success", "C", "limited", True), ("success", "C", "maybe", False)]
    df = spark.createDataFrame(rows, "s string, c string, w string, want boolean")
    assert all(r.got == r.want for r in df.select(P.allows_deep_check(F.col("s"), F.col("c"), F.col("w")).alias("got"), "want").collect())


def test_responses_without_parts(spark):
    facts = lambda raw: value(spark, P.response_facts(F.lit(raw).cast("string"), ("1", "0.1", "2")))
    for raw in (None, "", "text", "[1]", "{}", '{"output": null, "usage": null}', '{"output": []}'):
        f = facts(raw)
        assert (f.has_output, f.has_text, f.has_parsed, f.has_refusal, f.content_types, f.cost, f.input_tokens) == (False, False, False, False, [], None, None), raw
    f = facts('{"output": [{"content": null}, {"content": [{"type": " output_text "}, {"type": "refusal", "parsed": null}, {"parsed": {"a": [1]}}]}], "usage": {"input_tokens": 1000000, "output_tokens": 500000, "input_tokens_details": {"cached_tokens": 2000000}}}')
    assert f.has_output and f.has_refusal and f.has_parsed and f.content_types == ["output_text", "refusal"] and float(f.cost) == pytest.approx(1.1)


def test_rows_to_search_on_odd_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c"), (3, "d")], "k int, v string")
    done, pending = spark.createDataFrame([(1,), (1,), (None,)], "k int"), spark.createDataFrame([(3,)], "k int")
    assert sorted(map(str, P.rows_to_search(rows, "k", done, pending).collect())) == sorted(map(str, rows.filter("k = 2 or k is null").collect()))
    assert P.rows_to_search(rows, "k", done.limit(0), pending.limit(0)).count() == 5 and P.rows_to_search(rows.limit(0), "k", done, pending).count() == 0


def test_accounting_adds_up(spark):
    rnd = random.Random(3)
    rows = [(i, f"s{rnd.randrange(3)}", rnd.choice(["news", "item", "other"]), f"h{rnd.randrange(2)}", "/" + "/".join(rnd.choice("abc") for _ in range(rnd.randrange(5))), rnd.random()) for i in range(150)] + [(999, "s9", "news", "h", None, 0.5), (998, "s8", "news", "h", "/a/b/c", 0.5)]
    df = spark.createDataFrame(rows, "i int, site string, family string, host string, path string, score double")
    planned = P.planned_routes(df, "site", "family", "host", "path", "score", {"news": 2}, 3)
    found = planned.collect()
    assert sorted(r.i for r in found) == sorted(r[0] for r in rows)
    for r in found:
        parts = [p for p in (r.path or "").split("/") if p]
        assert r.depth == len(parts) and (r.outcome == "depth_cap") == (len(parts) > (2 if r.family == "news" else 3))
    reasons = ("depth_cap", "family_cap", "host_cap", "path_cap", "total_cap")
    sums = {(r.site, r.family): r for r in P.budget_accounting(planned, "site", "family", "outcome", "depth", 3, reasons).collect()}
    counted = collections.Counter((r.site, r.family, r.outcome) for r in found)
    for (site, family), r in sums.items():
        assert r.n_selected == counted[site, family, "selected"] <= 3 == r.family_cap and r.n_routes == r.n_selected + sum(r[f"n_{x}"] for x in reasons)
        assert all(r[f"n_{x}"] == counted[site, family, x] for x in reasons) and (r.coverage == "covered") == (r.n_selected > 0)
        deep = [x.depth for x in found if (x.site, x.family, x.outcome) == (site, family, "selected")]
        assert r.deepest == (max(deep) if deep else None)
    assert sums["s8", "news"].coverage == "coverage_floor_unmet" and sums["s9", "news"].n_selected == 1
