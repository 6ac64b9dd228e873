import json
import random
import re

import pytest
from pyspark.sql import functions as F

from quarrylight.operators import profiles as P


def test_back_fill(spark):
    df = spark.createDataFrame([("", "x", [], ["a"]), ("y", "x", ["b"], None)], "n string, o string, m array<string>, p array<string>")
    assert [(r.n, r.m) for r in P.back_fill(df, {"n": "o", "m": "p"}).collect()] == [("x", ["a"]), ("y", ["b"])]


def test_activity_terms_by_brute_force(spark, monkeypatch):
    rnd, plans = random.Random(3), []
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([*range(40), 7, 7]), rnd.choice([None, "", " ".join(rnd.choice(["alpha", "Beta1beta", "gamma", "delta", "omega", "their", "no"]) for _ in range(rnd.randrange(9)))])) for _ in range(60)]
    staged = P.staged
    monkeypatch.setattr(P, "staged", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), staged(df, name))[1])
    found = P.activity_terms(spark.createDataFrame(rows, "k string, o bigint, t string"), "k", "t", "o", ["their"], most=3, least=4)
    seen = {}
    for k, o, t in rows:
        for place, word in enumerate(re.split(r"[^a-z]+", (t or "").lower())):
            if len(word) >= 4 and word != "their":
                seen.setdefault((k, word), []).append((o, place))
    want = []
    for k in {k for k, _ in seen}:
        best = sorted((-len(v), min(v), w) for (key, w), v in seen.items() if key == k)[:3]
        want += [(k, w, -n, i + 1) for i, (n, _, w) in enumerate(best)]
    assert sorted(map(str, want)) == sorted(str((r.k, r.term, r.n, r["rank"])) for r in found.collect())
    assert len(plans) == 1 and "SortAggregate" not in plans[0] and "HashAggregate" in plans[0]


def test_explanation(spark):
    df = spark.createDataFrame([(0.2, 0.5, 0.0), (0.0, 0.0, 0.0)], "a double, b double, c double")
    assert [r.x for r in df.select(P.explanation({k: F.col(k) for k in "abc"}).alias("x")).collect()] == ["b 0.500, a 0.200", ""]


def test_versioned_asset(spark, tmp_path):
    versions = {1: "name:string", 2: "name:string,bucket:string"}
    path = tmp_path / "a.json"
    path.write_text(json.dumps({"version": 1, "records": [{"name": "x"}]}))
    row = P.load_asset(spark, str(path), versions, "name").first()
    assert row.name == "x" and row.bucket is None
    path.write_text(json.dumps({"version": 2, "records": [{"bucket": "x"}]}))
    with pytest.raises(Exception, match="lacks name"):
        P.load_asset(spark, str(path), versions, "name").collect()
    path.write_text(json.dumps({"version": 9, "records": []}))
    with pytest.raises(ValueError):
        P.load_asset(spark, str(path), versions, "name")


def test_manifest_refuses_paths_outside(spark):
    with pytest.raises(Exception, match="outside the archive"):
        P.manifest(spark.createDataFrame([("../x", "c")], "p string, c string"), "p", "c").collect()


def test_site_hints_collects_few_reasons(spark):
    rows = spark.range(3000).select(F.lit("k").alias("k"), F.lit("https://a.ru/x").alias("u"), F.concat(F.lit("r"), (F.col("id") % 1000).cast("string")).alias("r"), "id")
    found = P.site_hints(rows, "k", "u", "r", "id")
    row = found.first()
    assert (row.domain, row.rank, row.reasons) == ("a.ru", 1, ["r0", "r1", "r2", "r3"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "<= 4" in plan.split("collect_list")[1]
