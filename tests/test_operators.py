import pytest
from pyspark.sql import functions as F

from quarrylight.operators import consensus, entities, geo, joins, rollups, scoring, selection, timeline


def test_interval_union_of_overlapping_spans(spark):
    spans = spark.createDataFrame([("a", 0.0, 7.5), ("a", 3.0, 8.0), ("b", 0.0, 1.0), ("b", 1.0, 2.0), ("b", 5.0, 4.0)], "k string, s double, e double")
    found = {r.k: r for r in timeline.interval_union(spans, ["k"], "s", "e").collect()}
    assert (found["a"].sum_seconds, found["a"].union_seconds, found["a"].overlap_seconds) == (12.5, 8.0, 4.5)
    assert found["b"].union_seconds == 2.0 and found["b"].n_spans == 2


def test_signals_after_the_last_success(spark):
    ev = spark.createDataFrame([("h", 1, "x"), ("h", 2, "ok"), ("h", 3, "x"), ("g", 1, "x")], "k string, n int, t string")
    found = timeline.active_signals(ev, ["k"], "n", F.col("t") == "x", F.col("t") == "ok").collect()
    assert sorted((r.k, r.n) for r in found) == [("g", 1), ("h", 3)]


def test_runs_start_over(spark):
    ev = spark.createDataFrame([(i, t) for i, t in enumerate("eesee")], "n int, t string").withColumn("k", F.lit(1))
    found = timeline.consecutive(ev, ["k"], "n", F.col("t") == "e", F.col("t") == "s").orderBy("n").collect()
    assert [r.run for r in found] == [1, 2, 0, 1, 2]


def test_circuit_modes_rise_and_reset(spark):
    ev = spark.createDataFrame([(i, t) for i, t in enumerate("bbbsbcc")], "n int, t string").withColumn("k", F.lit(1))
    found = timeline.circuit_modes(ev, ["k"], "n", F.col("t") == "b", F.col("t") == "c", F.col("t") == "s").orderBy("n").collect()
    assert [r.mode for r in found] == ["conservative", "survival", "paused", "normal", "conservative", "survival", "paused"]


def test_last_write_wins_first_position(spark):
    ev = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "k string, n int, v string")
    assert sorted(tuple(r) for r in timeline.latest_per_key(ev, ["k"], "n").select("k", "v", "first_position").collect()) == [("a", "z", 1), ("b", "y", 2)]


def test_consensus_ignores_masked_but_addresses(spark):
    rows = [("e", "phone", "1", "s1", "v1", 1, False), ("e", "phone", "1", "s2", "v2", 2, True), ("e", "address", "a", "s1", "v1", 1, True), ("e", "address", "a", "s2", "v2", 2, False), ("e", "phone", "", "s3", "v", 3, False)]
    found = consensus.consensus(spark.createDataFrame(rows, "e string, kind string, key string, source string, value string, ord int, masked boolean"), "e", "kind", "key", "source", "value", "ord", "masked")
    assert sorted((r.kind, r.n_sources, r["sample"]) for r in found.collect()) == [("address", 2, "v1"), ("phone", 1, "v1")]
    assert [r.key for r in consensus.trusted(found, "e", "kind", "key").collect()] == ["a"]


def test_domains_are_ranked(spark):
    rows = [("e", "a.ru", "input", "row", "https://a.ru", 1), ("e", "b.ru", "site", "s1", "https://b.ru", 0), ("e", "c.ru", "email", "s1", "https://c.ru", 0)]
    found = consensus.resolve_domains(spark.createDataFrame(rows, "e string, d string, origin string, source string, url string, n_tokens int"), "e", "d").orderBy("rank").collect()
    assert [(r.d, r.status, r.confidence) for r in found] == [("a.ru", "verified", 0.91), ("b.ru", "candidate", 0.32), ("c.ru", "rejected", 0.24)]


def test_tiers_stop_at_the_first_that_matches(spark):
    refs = spark.createDataFrame([(1, "f1", "u1"), (2, None, "u2"), (3, "f9", "u1"), (4, "f2", "u1"), (5, None, None)], "r int, file string, url string")
    targets = spark.createDataFrame([(10, "f1", "u1"), (11, "f2", "u2"), (12, "f2", "u3")], "t int, file string, url string")
    found = {r.r: (r.target, r.tier) for r in joins.tiered_match(refs, targets, "r", "t", ["file", "url"]).collect()}
    assert found == {1: (10, "file"), 2: (11, "url"), 3: (10, "url"), 4: (None, None), 5: (None, None)}


def test_ledgers_merge_field_by_field(spark):
    left = spark.createDataFrame([("k", "", ["a"]), ("l", "x", None)], "k string, v string, tags array<string>")
    right = spark.createDataFrame([("k", "y", ["a", "b"]), ("m", "z", ["c"])], "k string, v string, tags array<string>")
    found = {r.k: (r.v, r.tags) for r in joins.merge_ledgers(left, right, ["k"], ["v"], ["tags"]).collect()}
    assert found == {"k": ("y", ["a", "b"]), "l": ("x", []), "m": ("z", ["c"])}


def test_fallback_join(spark):
    rows = spark.createDataFrame([(1, "f", "s", "p"), (2, None, "s", "p"), (3, None, "s", "q")], "i int, fp string, site string, pattern string")
    table = spark.createDataFrame([("f", "s", "p", "one", 1), ("g", "s", "p", "two", 2)], "fp string, site string, pattern string, v string, ord int")
    found = {r.i: (r.v, r.matched_by) for r in joins.fallback_join(rows, table, "fp", ["site", "pattern"], "v", "ord").collect()}
    assert found == {1: ("one", "first"), 2: ("one", "second"), 3: (None, None)}


def test_poisoned_sums(spark):
    found = {(r.grouping, r.value): r.total for r in rollups.poisoned_sums(spark.createDataFrame([("a", "m", 1.0), ("a", "n", None), ("b", "n", 2.0)], "stage string, model string, cost double"), ["stage", "model"], "cost").collect()}
    assert found == {("stage", "a"): None, ("stage", "b"): 2.0, ("model", "m"): 1.0, ("model", "n"): None}


def test_percentile_is_linear(spark):
    r = rollups.delay_buckets(spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double"), F.lit(1), "v", F.col("v") > 1).first()
    assert (r.median, r.p95, r.n_ok) == (2.0, 3.8, 2)


def test_delay_is_recommended(spark):
    make = lambda rows: rollups.recommend_delay(spark.createDataFrame(rows, "delay int, ok int, hard int"), "delay", "ok", "hard").first().delay
    assert make([(1, 5, 1), (2, 5, 0), (3, 5, 0)]) == 2 and make([(1, 5, 0), (2, 5, 0), (3, 5, 0)]) == 2 and make([(1, 0, 0), (3, 0, 0)]) == 3


def test_relevance_caps_corporate_sections(spark):
    row = spark.createDataFrame([("procurement", "тендер на закупку лома завод 01.02.2024"), ("about", "завод производит"), ("news", None)], "section string, body string")
    score, label = scoring.relevance(F.lit(""), F.lit(""), F.col("section"), F.col("body"), strong=["тендер"])
    found = row.select("section", score.alias("s"), label.alias("l")).collect()
    assert found[0].l == "likely_relevant" and found[1].s <= 0.25 and found[2].l == "not_relevant"


def test_greedy_batches(spark):
    row = spark.createDataFrame([(["aa", "bb", "cccc", "d"],), ([],)], "t array<string>").select(scoring.greedy_batches(F.col("t"), 5).alias("b")).collect()
    assert row[0].b == ["aa bb", "cccc", "d"] and row[1].b == []


def test_ordinals_follow_the_request(spark):
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(1, 6)], "n bigint, v string")
    assert [r.v for r in selection.row_ordinals(rows, "n", [4, 2, 4]).orderBy("request_order").collect()] == ["v4", "v2"]
    with pytest.raises(Exception, match="no row has ordinal 9"):
        selection.row_ordinals(rows, "n", [9]).collect()
    with pytest.raises(ValueError):
        selection.row_window(rows, ["n"], 0)
    assert selection.row_window(rows, ["n"], 9).count() == 0


def test_resume_needs_every_source(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    done = spark.createDataFrame([(1, "a", "ok"), (1, "b", "ok"), (2, "a", "ok"), (2, "b", "")], "k int, s string, st string")
    assert sorted(r.k for r in selection.resumable(rows, done, "k", "s", "st", ["a", "b"]).collect()) == [2, 3]


def test_admission_caps(spark):
    rows = [("q", "a", "t", 1, 5), ("q", "a", "t", 2, 5), ("q", "b", "t", 3, 500), ("q", "c", "t", 4, 5), ("q", "d", "t", 5, 5), ("q", "e", "u", 6, 5), ("q", "f", "u", 7, 5)]
    found = selection.admit(spark.createDataFrame(rows, "q string, k string, t string, n int, size int"), "q", "k", "t", "n", "size", 3, 2, 100).orderBy("n").collect()
    assert [r.status for r in found] == ["admitted", "duplicate", "too_large", "admitted", "kind_cap", "admitted", "total_cap"]


def test_ties_in_terms_go_to_the_first(spark):
    rows = spark.createDataFrame([(1, "beta alpha beta alpha gamma")], "n int, t string")
    assert [(r.term, r.n) for r in selection.frequent_terms(rows, "t", "n", 3).collect()] == [("beta", 2), ("alpha", 2), ("gamma", 1)]


def test_entities(spark):
    text = "ИНН 7707083893, КПП: 123456789, mail A@b.org; ip 10.0.0.1"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "a@b.org")], "i bigint, t string")
    found = entities.entity_values(docs, "i", "t")
    assert {(r.i, r.kind, r.value) for r in found.collect()} >= {(1, "inn", "7707083893"), (1, "kpp", "123456789"), (1, "email", "a@b.org"), (3, "email", "a@b.org"), (1, "ip", "10.0.0.1")}
    merged = {r.value: r for r in entities.merge_entities(found, "kind", "value", "i", ["i", "pos"]).collect()}
    assert merged["a@b.org"].n_holders == 2 and merged["a@b.org"].first_i == 1
    offsets = [r for r in entities.entity_snippets(docs, "i", "t").collect() if r.kind == "inn"]
    assert offsets[0].start == text.index("ИНН") and "КПП" in offsets[0].snippet


def test_clusters_and_ambiguity(spark):
    places = spark.createDataFrame([("k", "A", "core", 1.0), ("k", "Ab", "core", 3.0), ("l", "B", "core", 1.0), ("l", "B", "outside", 9.0)], "k string, n string, b string, x double")
    found = {r.k: r for r in geo.clusters(places, ["k"], "n", "b", "x").collect()}
    assert found["k"].n == "Ab" and found["k"].spread == 2.0 and found["k"].b == "core" and found["l"].ambiguous and found["l"].b is None


def test_address_lookup(spark):
    rows = spark.createDataFrame([(1, "г. Москва, ул. Мира"), (2, "Омск"), (3, "nowhere")], "i int, a string")
    aliases = spark.createDataFrame([(7, "москва", 1), (8, "омск", 1), (9, "омск", 1)], "p int, alias string, pr int")
    found = {r.i: (r.p, r.match) for r in geo.address_lookup(rows, "i", "a", aliases, "p", "alias", "pr").collect()}
    assert found == {1: (7, "matched"), 2: (None, "ambiguous"), 3: (None, "none")}


def test_groups_are_not_collected(spark):
    from pyspark.sql import functions as F

    from quarrylight.operators import scoring
    from quarrylight.plans import catalog

    rows = spark.range(400).select((F.col("id") % 3).alias("k"), F.expr("CASE WHEN id % 50 = 7 THEN NULL ELSE repeat('x', int(id * 7 % 31)) END").alias("t"), "id")
    lists = rows.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "t"))), lambda x: x["t"]).alias("ts")).select("k", scoring.greedy_batches(F.col("ts"), 25).alias("b"))
    want = {r.k: (r.n, r.m) for r in lists.select("k", F.size("b").alias("n"), F.array_max(F.transform("b", F.char_length)).alias("m")).collect()}
    assert {r.k: (r.n_batches, r.longest) for r in scoring.greedy_batch_counts(rows, "k", "t", "id", 25).collect()} == want
    for name in ("distinct_sites", "greedy_batch", "field_availability"):
        assert "collect_list" not in catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_tiers_make_no_pairs(spark):
    refs = spark.range(40).selectExpr("id AS r", "0 AS k")
    targets = spark.range(50).selectExpr("id % 2 AS t", "0 AS k")
    found = joins.tiered_match(refs, targets, "r", "t", ["k"])
    assert {(r.target, r.tier) for r in found.collect()} == {(None, None)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # targets are one row per key below the join
    assert "Aggregate" in plan.split("Join Inner")[1].split("Range (0, 50")[0].split("Range (0, 40")[-1]
