"""Running values over ranges against plain loops, on a hot key and few ranges."""

import random

from pyspark.sql import functions as F

from quarrylight.operators import joins, ranges, timeline


def events(n=400):
    rng = random.Random(1)
    # one key holds most rows, and times have gaps
    return [(rng.choice("aaaab"), i * rng.choice([1, 1, 40]) if i % 7 else i, rng.choice("fffbcs"), rng.random() * 30) for i in range(n)]


def frame(spark):
    rows = [(k, i, at, t, v) for i, (k, at, t, v) in enumerate(events())]
    return rows, spark.createDataFrame(rows, "k string, n int, at int, t string, v double").repartition(5)


def test_counts_since_reset(spark):
    rows, df = frame(spark)
    reset, most = F.col("t") == "s", {"top": F.when(F.col("t") == "f", F.col("v"))}
    found = {r.n: (r.fails, r.bans, r.top) for r in ranges.since_reset(df, ["k"], "n", reset, {"fails": F.col("t") == "f", "bans": F.col("t") == "b"}, most).collect()}
    state = {}
    for k, n, _, t, v in rows:
        fails, bans, top = (0, 0, None) if t == "s" else state.get(k, (0, 0, None))
        state[k] = (fails + (t == "f"), bans + (t == "b"), max(x for x in (top, v if t == "f" else None, -1) if x is not None))
        want = state[k]
        assert found[n] == (want[0], want[1], None if want[2] == -1 else want[2])


def test_unions_depths_and_gaps(spark):
    rows, df = frame(spark)
    spans = df.select("k", F.col("at").cast("double").alias("s"), (F.col("at") + F.round("v")).alias("e"))
    found = {r.k: r for r in timeline.interval_union(spans, ["k"], "s", "e").collect()}
    depth = {r.k: r for r in timeline.queue_depth(spans, ["k"], "s", "e").collect()}
    for k in "ab":
        own = sorted((float(at), float(at + round(v))) for key, _, at, _, v in rows if key == k)
        total, end = 0.0, float("-inf")
        for s, e in own:
            total, end = total + max(0.0, e - max(s, end)), max(end, e)
        assert abs(found[k].union_seconds - total) < 1e-6 and found[k].n_spans == len(own)
        steps = sorted([(s, 1) for s, _ in own] + [(e, -1) for _, e in own])
        level = most = 0
        for _, step in steps:
            level += step
            most = max(most, level)
        assert depth[k].max_depth == most
    seen = {r.n: r.since_previous for r in timeline.since_previous(df, ["k"], "n", F.col("v")).collect()}
    last = {}
    for k, n, _, _, v in rows:
        assert seen[n] == (None if k not in last else v - last[k])
        last[k] = v


def test_equal_orders_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 5, "f"), ("b", 5, "s")], "k string, n int, t string")
    assert {r.k: r.run for r in timeline.consecutive(df, ["k"], "n", F.col("t") == "f", F.col("t") == "s").collect()} == {"a": 1, "b": 0}
    assert timeline.consecutive(df.limit(0), ["k"], "n", F.col("t") == "f", F.col("t") == "s").count() == 0
    assert timeline.interval_union(df.limit(0).select("k", F.lit(0.0).alias("s"), F.lit(1.0).alias("e")), ["k"], "s", "e").count() == 0


def test_a_hot_key_is_many_tasks(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("n"), F.lit("f").alias("t"))
    parts = ranges.with_range(df, "n", 16).groupBy("k", ranges.PART).count().collect()
    assert len(parts) >= 16 and max(r["count"] for r in parts) < 100
    plan = timeline.active_signals(df, ["k"], "n", F.col("t") == "f", F.col("t") == "s")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_frequent_tokens_make_no_pairs(spark):
    # every row has the frequent token; entries with a rarer one are only met by rows that hold it
    rows = spark.range(500).select("id", F.concat(F.lit("common w"), F.col("id").cast("string")).alias("x"))
    table = spark.createDataFrame([(1, "common w7"), (2, "common w8 w9"), (3, "common nowhere")], "e int, x string")
    split = lambda c: F.split(c, " ")
    for least, want in ((2, {(7, 1), (8, 2), (9, 2)}), (None, {(7, 1)})):
        found = joins.token_lookup(rows, "id", split(F.col("x")), table, "e", split(F.col("x")), least)
        assert {(r.id, r.e) for r in found.collect()} == want
    assert joins.token_lookup(rows, "id", split(F.col("x")), table, "e", split(F.col("x")), 1).count() == 1500


def test_breaker(spark):
    rows = [(i, c, r) for i, (c, r) in enumerate([("RATE_LIMIT", None), ("RATE_LIMIT", None), ("HARD_BAN", None), (None, None), ("SUCCESS", None), ("SOFT_BLOCK", "bot_gate"), ("AUTH_REQUIRED", None), ("CHALLENGE_LOOP", None), ("CHALLENGE_LOOP", None)])]
    df = spark.createDataFrame([("h", i, i * 10, c, r) for i, c, r in rows], "k string, n int, at int, c string, r string")
    found = [(r.n, r.mode, r.cooldown_until) for r in timeline.breaker_ledger(df, ["k"], "n", "at", F.col("c"), F.col("r")).orderBy("n").collect()]
    assert found == [(0, "conservative", 30.0), (1, "survival", 70.0), (2, "survival", 200.0), (4, "normal", 0.0), (5, "conservative", 70.0), (6, "survival", 70.0), (7, "survival", 370.0), (8, "paused", 680.0)]


def test_crowded_orders_are_cut_where_they_are_crowded(spark):
    rng = random.Random(3)
    # most of ten years' events fall on one day
    rows = [(i, rng.randrange(86_400) if i % 10 else rng.randrange(315_360_000)) for i in range(4000)] + [(9999, None)]
    df = spark.createDataFrame(rows, "n int, at bigint")
    for n in (1, 8, 50):
        found = ranges.with_range(df, "at", n).groupBy(ranges.PART).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
        some = sorted((r for r in found if r.lo is not None), key=lambda r: r.lo)
        assert len(some) == n and max(r.n for r in some) <= 2.5 * 4000 / n and sum(r.n for r in found) == 4001
        assert [r[ranges.PART] for r in some] == sorted(r[ranges.PART] for r in some) and all(a.hi < b.lo for a, b in zip(some, some[1:], strict=False))


def test_entries_of_frequent_tokens_are_looked_up_by_two(spark):
    rng = random.Random(5)
    words = ["the", "of", "and", "rare", "x", "y"]
    pick = lambda most: sorted({w for w in words if rng.random() < (0.8 if w in words[:3] else 0.2)})[:most]
    rows, table = [(i, pick(6)) for i in range(60)], [(k, pick(3)) for k in range(40)] + [(98, ["nowhere", "the"]), (99, [])]
    want = sorted((i, k, len(b)) for i, a in rows for k, b in table if b and set(b) <= set(a))
    left, right = spark.createDataFrame(rows, "i int, a array<string>"), spark.createDataFrame(table, "k int, b array<string>")
    for hot in (0, 10, 100_000):
        found = joins.token_lookup(left, "i", F.col("a"), right, "k", F.col("b"), None, hot)
        assert sorted(map(tuple, found.collect())) == want


def test_first_references_are_those_of_all(spark):
    from quarrylight.operators import dossiers

    rng = random.Random(9)
    wants = [(f"k{rng.randrange(6)}", i, rng.choice(["l1", "l2", None]), rng.choice(["u1", "u2", None]), rng.choice(["a", "b", "unknown", None])) for i in range(40)]
    pieces = [(i, rng.choice(["l1", "l2", "l3", None]), rng.choice(["u1", "u2", None]), rng.choice(["a", "b"])) for i in range(60)]
    w = spark.createDataFrame(wants, "key string, o int, locator string, url string, kind string")
    e = spark.createDataFrame(pieces, "id int, locator string, url string, kind string")
    every = sorted(map(tuple, dossiers.resolve_refs(w, "key", "o", "locator", "url", "kind", e, "id").collect()))
    for most in (1, 3, 10, 100):
        assert sorted(map(tuple, dossiers.resolve_refs(w, "key", "o", "locator", "url", "kind", e, "id", most).collect())) == [r for r in every if r[2] <= most]


def test_references_by_lists_and_by_pieces_by_brute_force(spark, monkeypatch):
    """Keys of one want meet lists, of which long ones and other keys' are met by piece: the same references and counts."""
    from quarrylight.operators import dossiers

    rng = random.Random(4)
    wants = [(f"k{i}" if i < 30 else f"k{rng.randrange(28, 34)}" if i < 38 else None, i, rng.choice(["l1", "l2", None]), rng.choice(["u1", "u2", "u9", None]), rng.choice(["a", "b", "unknown", None])) for i in range(40)]
    pieces = [(rng.randrange(50), rng.choice(["l1", "l2", "l3", None]), rng.choice(["u1", "u2", None]), rng.choice(["a", "b", None])) for _ in range(70)]
    want = {}
    for key in {x[0] for x in wants}:
        at = {}
        for k, o, locator, url, kind in wants:
            for i, *places, of in pieces if k == key else ():
                for p, (a, b) in enumerate(zip((locator, url), places, strict=True)):
                    if a is not None and a == b and (kind in (None, "unknown") or kind == of):
                        at[i] = min(at.get(i, (9, 0)), (p, o))
        want |= {(key, i): n for n, i in enumerate(sorted(at, key=lambda i: (at[i], i)), 1)}
    w = spark.createDataFrame(wants, "key string, o int, locator string, url string, kind string")
    e = spark.createDataFrame(pieces, "id int, locator string, url string, kind string")
    for listed, crowded in ((100, 5), (0, 0), (12, 100)):
        monkeypatch.setattr(dossiers, "LISTED", listed)
        monkeypatch.setattr(dossiers, "CROWDED", crowded)
        found = dossiers.resolve_refs(w, "key", "o", "locator", "url", "kind", e, "id").collect()
        assert len(found) == len(want) and {(r.key, r.id): r.ref_no for r in found} == want
        counts = {r.key: (r.n_refs, r.first_ref) for r in dossiers.count_refs(w, "key", "o", "locator", "url", "kind", e, "id").collect()}
        assert counts == {k: (sum(x[0] == k for x in want), next(i for (x, i), n in want.items() if x == k and n == 1)) for k in {x[0] for x in want}}


def test_references_of_tiles_by_brute_force(spark, monkeypatch):
    """Tiles of any size, pieces met by locator and URL both, and a piece without an id, which is one and comes last."""
    from quarrylight.operators import dossiers

    rng = random.Random(6)
    wants = [(f"k{i}" if i else None, i, rng.choice(["l1", "l2", "l3", None]), rng.choice(["u1", "u2", None]), rng.choice(["a", "b", "unknown", None])) for i in range(60)]
    pieces = [(rng.choice([*range(30), None]), rng.choice(["l1", "l2", "l4", None]), rng.choice(["u1", "u2", None]), rng.choice(["a", "b", None])) for _ in range(60)]
    want = set()
    for key, _, *asked, kind in wants:
        at = {}
        for i, *places, of in pieces:
            for p, (a, b) in enumerate(zip(asked, places, strict=True)):
                if a is not None and a == b and (kind in (None, "unknown") or kind == of):
                    at[i] = min(at.get(i, p), p)
        want |= {(key, i, n) for n, i in enumerate(sorted(at, key=lambda i: (at[i], i is None, i or 0)), 1)}
    w = spark.createDataFrame(wants, "key string, o int, locator string, url string, kind string")
    e = spark.createDataFrame(pieces, "id int, locator string, url string, kind string")
    assert any(i is None for _, i, _ in want)
    for crowded, keys, near in ((3, 2, (2, 3)), (1, 1, (1, 1)), (512, 256, (4, 8))):
        for name, value in (("CROWDED", crowded), ("KEYS", keys), ("NEAR", near)):
            monkeypatch.setattr(dossiers, name, value)
        for most in (None, 4):
            found = [tuple(r) for r in dossiers.resolve_refs(w, "key", "o", "locator", "url", "kind", e, "id", most).collect()]
            assert len(found) == len(set(found)) and set(found) == {r for r in want if most is None or r[2] <= most}
    counts = {r.key: (r.n_refs, r.first_ref) for r in dossiers.count_refs(w, "key", "o", "locator", "url", "kind", e, "id").collect()}
    assert counts == {k: (max(n for x, _, n in want if x == k), next(i for x, i, n in want if x == k and n == 1)) for k in {x[0] for x in want}}


def test_references_of_a_crowded_place_take_little_disk(spark, tmp_path):
    """1,800 keys by 1,500 pieces of one URL, three of them met by locator too: less than a quarter of a byte a row, as pieces and numbers are runs and keys repeat."""
    from quarrylight.operators import dossiers

    w = spark.range(1800).selectExpr("id AS key", "0 AS o", "'l' || id AS locator", "'u' AS url", "'unknown' AS kind")
    e = spark.range(1500).selectExpr("id * 7 AS id", "'l' || (id + 1797) AS locator", "'u' AS url", "'a' AS kind")
    dossiers.resolve_refs(w, "key", "o", "locator", "url", "kind", e, "id").write.parquet(f"{tmp_path}/refs")
    rows = spark.read.parquet(f"{tmp_path}/refs")
    assert rows.count() == rows.select("key", "id").distinct().count() == 1800 * 1500 and rows.groupBy("key").agg(F.max("ref_no").alias("m")).filter("m <> 1500").isEmpty()
    assert rows.filter("ref_no = 1 AND id <> (CASE WHEN key >= 1797 THEN (key - 1797) * 7 ELSE 0 END)").isEmpty()
    assert sum(f.stat().st_size for f in (tmp_path / "refs").glob("*.parquet")) < 1800 * 1500 / 4


def test_first_sources_of_a_hot_key(spark):
    rows, sources = spark.createDataFrame([(1,), (2,), (3,)], "k int"), spark.createDataFrame([(1, i, f"v{i:03d}") for i in range(200)] + [(2, 5, "x"), (None, 1, "n")], "k int, o int, v string")
    found = {r.k: r.found for r in joins.equi_lookup(rows, sources, "k", "o", "v", 3).collect()}
    assert found == {1: ["v000", "v001", "v002"], 2: ["x"], 3: []} and len(joins.equi_lookup(rows, sources, "k", "o", "v").filter("k = 1").first().found) == 200


def test_lookup_makes_tokens_once_and_joins_texts_of_an_id(spark, monkeypatch):
    made = []
    staged = joins.staged
    monkeypatch.setattr(joins, "staged", lambda df, name: (made.append(name), staged(df, name))[1])
    rows = spark.createDataFrame([(1, ["a", "b", "x"]), (1, ["c", "a"]), (2, ["a", "b"]), (3, []), (4, None), (None, ["a", "b", "c"])], "i bigint, a array<string>")
    entries = spark.createDataFrame([(9, ["a", "b", "c", "c"]), (8, ["z"]), (7, [])], "k bigint, b array<string>")
    for least, want in ((3, [(1, 9, 3)]), (2, [(1, 9, 3), (2, 9, 2)]), (None, [(1, 9, 3)])):
        for hot in (0, 100):
            found = joins.token_lookup(rows, "i", F.col("a"), entries, "k", F.col("b"), least, hot)
            assert sorted(map(tuple, found.collect())) == want
            assert made == ["tokens"] and "Generate explode(a" not in found._jdf.queryExecution().toString()
            made.clear()
