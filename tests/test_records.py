from pyspark.sql import functions as F

from quarrylight.functions import addresses as A
from quarrylight.operators import records as R


def test_addresses(spark):
    rows = spark.createDataFrame(
        [("117997, г. Москва, ул. Вавилова, д. 19, телефон 8 495", ), ("Московская область, г. Химки, ул. Мира, д. 5 117000 и 117001 еще",), ("ул. Мира",), ("просто длинный текст без примет места",), (None,)], "x string"
    )
    got = [r.a for r in rows.select(A.sanitize(F.col("x")).alias("a")).collect()]
    assert got[0] == "117997, г. Москва, ул. Вавилова, д. 19" and got[1] == "Московская область, г. Химки, ул. Мира, д. 5 117000 и" and got[2:] == [None, None, None]
    parts = rows.select(A.components(F.col("x")).alias("c"), A.specificity(F.col("x")).alias("n")).first()
    assert parts.c == ["postal", "city", "street", "house"] and parts.n == 2 + 4 + 5 + 6 + 4


def test_routes_within_budget(spark):
    rows = [("s", "news", "h", f"/n/{i}", 5.0) for i in range(5)] + [("s", "blog", "h", f"/b{i}/x", 1.0) for i in range(2)]
    found = {r.path: r for r in R.rank_routes(spark.createDataFrame(rows, "site string, family string, host string, path string, score double"), "site", "family", "host", "path", "score", total=3).collect()}
    assert found["/n/0"].place == 1 and found["/b0/x"].place == 2 and found["/n/1"].place == 3
    assert found["/n/2"].outcome == "path_cap" and found["/b1/x"].outcome == "total_cap"


def test_lists_and_maps(spark):
    row = spark.createDataFrame([(["https://www.a.ru/x", "http://a.ru", "b.ru", ""], ["ab", "abc", "x", "AB c ab"], {"k": "", "l": "1"}, {"k": "2", "m": "3"})], "s array<string>, v array<string>, a map<string,string>, b map<string,string>")
    r = row.select(R.distinct_sites(F.col("s")).alias("s"), R.distinct_longest(F.col("v")).alias("v"), R.merge_maps(F.col("a"), F.col("b")).alias("m")).first()
    assert r.s == ["https://www.a.ru/x", "b.ru"] and r.v == ["abc", "x", "AB c ab"] and r.m == {"k": "2", "l": "1", "m": "3"}


def test_terms(spark):
    row = spark.createDataFrame([("Продажа лома и отходов черных металлов",), (None,)], "t string")
    hits = row.select(R.term_hits(F.col("t"), R.parse_terms(F.lit("лом*; [отходов металлов]1, [отходов металлов], металл, лом"))).alias("h")).collect()
    assert hits[0].h == ["лом", "отходов металлов", "металл"] and hits[1].h == []


def test_activity_codes(spark):
    row = spark.createDataFrame([("Основной: 24.10 Производство чугуна; 46.72.1 Торговля рудами",)], "t string").select(R.activity_codes(F.col("t")).alias("c")).first()
    assert [(c.code, c.label) for c in row.c] == [("24.10", "Производство чугуна"), ("46.72.1", "Торговля рудами")]


def test_responses(spark):
    rows = spark.createDataFrame([('{"parsed": {"b": 1, "a": 2}}',), ('{"status": "incomplete"}',), ('text [1, 2] end',), ("nothing",), (None,)], "r string")
    assert [(r.answer, r.reason) for r in R.parse_response(rows, "r").collect()] == [('{"a": 2, "b": 1}', "parsed"), (None, "incomplete"), ("[1, 2]", "found_in_text"), (None, "invalid"), (None, "empty")]


def test_cooldown(spark):
    assert [r.s for r in spark.range(6).select(R.cooldown(F.col("id")).alias("s")).orderBy("s").collect()] == [0.0, 30.0, 60.0, 120.0, 240.0, 240.0]


def naive_routes(rows, total=10, per_family=3, per_host=6, per_path=2):
    rows = sorted(rows, key=lambda r: (-r[4], r[3]))
    turn, used, out, n = {}, {}, {}, 0
    for r in rows:
        turn.setdefault(r[1], []).append(r)
    while any(turn.values()):
        for q in turn.values():
            if not q:
                continue
            r = q.pop(0)
            keys = {"family": r[1], "host": r[2], "path": r[3].split("/")[1]}
            caps = {"family": per_family, "host": per_host, "path": per_path}
            full = next((k for k, v in keys.items() if used.get((k, v), 0) >= caps[k]), None) or ("total" if n >= total else None)
            if full:
                out[r] = (0, f"{full}_cap")
                continue
            n += 1
            out[r] = (n, "selected")
            for kv in keys.items():
                used[kv] = used.get(kv, 0) + 1
    return out


def test_routes_of_a_large_site(spark):
    import random

    rng = random.Random(5)
    rows = [(s, rng.choice(["news", "blog", "item", "other"]), f"h{rng.choice([0, 0, 0, 1, 2])}", f"/{rng.choice('aaaabbcdefgh')}/{i}", float(rng.randint(0, 3))) for s, n in (("big", 1500), ("small", 30), ("one", 1)) for i in range(n)]
    found = R.rank_routes(spark.createDataFrame(rows, "site string, family string, host string, path string, score double").repartition(5), "site", "family", "host", "path", "score")
    want = {}
    for s in ("big", "small", "one"):
        want |= naive_routes([r for r in rows if r[0] == s])
    got = {(r.site, r.family, r.host, r.path, r.score): (r.place, r.outcome) for r in found.collect()}
    assert got == want
    # a site's group holds the routes that can be chosen: at most 39 a family
    assert R.could_be_chosen(found.select(*[F.lit("x").alias(c) for c in ("__s", "__f", "__h", "__p")], F.monotonically_increasing_id().alias("__rank")), 10, 3, 6, 2).count() == 2
    assert "WindowGroupLimit" in found._jdf.queryExecution().optimizedPlan().toString()
