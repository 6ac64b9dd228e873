"""Queries over events, orders and the other tables: run telemetry, ledgers, consensus, selection, joins, geo."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as T
from ..operators import consensus, geo, joins, rollups, scoring, selection, timeline


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark, sf_dir):
    """Events as host attempts: user as host, ts in seconds."""
    return table(spark, sf_dir, "events").withColumn("at", N.wall_seconds("ts"))


AT = "epoch_us(ts) / 1e6"


def host_stats_rollup(spark, d):
    return rollups.host_stats(events(spark, d), "user_id", "event_type", F.col("at"), "value", "event_id")


HOST_STATS_SQL = """
SELECT user_id, min(event_id) AS first_seen, max(event_id) AS last_seen, count(*) AS n_events, count(DISTINCT event_type) AS n_kinds, count(*) FILTER (value > 0) AS n_timed,
  round(sum(value) FILTER (value > 0), 4) AS sum_elapsed, min(value) FILTER (value > 0) AS min_elapsed, max(value) FILTER (value > 0) AS max_elapsed, round(avg(value) FILTER (value > 0), 4) AS avg_elapsed FROM events GROUP BY user_id
"""


def host_bucket_merge(spark, d):
    """Partial statistics by host and kind, merged per host: the same as from the events."""
    parts = rollups.host_stats(events(spark, d).withColumn("part", F.concat_ws("/", "user_id", "event_type")), "part", "event_type", F.col("at"), "value", "event_id")
    return rollups.merge_stats(parts.withColumn("user_id", F.substring_index("part", "/", 1).cast("bigint")), "user_id")


def cost_poison_rollup(spark, d):
    rows = table(spark, d, "events").select(F.col("event_type").alias("stage"), (F.col("user_id") % 5).alias("model"), F.when(F.col("event_id") % 997 != 0, F.round("value", 4)).alias("cost"))
    return rollups.poisoned_sums(rows, ["stage", "model"], "cost", 4)


POISON_SQL = """
WITH e AS (SELECT event_type AS stage, user_id % 5 AS model, CASE WHEN event_id % 997 <> 0 THEN round(value, 4) END AS cost FROM events)
SELECT 'stage' AS grouping, stage AS value, count(*) AS n, CASE WHEN bool_or(cost IS NULL) THEN NULL ELSE round(sum(cost), 4) END AS total FROM e GROUP BY stage
UNION ALL SELECT 'model', model::VARCHAR, count(*), CASE WHEN bool_or(cost IS NULL) THEN NULL ELSE round(sum(cost), 4) END FROM e GROUP BY model
"""
STATUSES = ("click", "view", "purchase", "error", "signup")


def availability_pivot(spark, d):
    return rollups.pivot_counts(table(spark, d, "events").withColumn("bucket", F.col("user_id") % 10), ["bucket"], "event_type", STATUSES)


def interval_union(spans_of, d):
    spans = events(spans_of, d).select("user_id", F.round("at", 3).alias("s"), F.round(F.round("at", 3) + F.col("value") * 100, 3).alias("e"))
    found = timeline.interval_union(spans, ["user_id"], "s", "e")
    return found.select("user_id", "n_spans", *[F.round(c, 2).alias(c) for c in ("sum_seconds", "max_seconds", "union_seconds", "overlap_seconds")])


UNION_SQL = f"""
WITH s AS (SELECT user_id, round({AT}, 3) AS s, round(round({AT}, 3) + value * 100, 3) AS e FROM events), f AS (SELECT * FROM s WHERE e >= s),
o AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM s),
i AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM o WHERE e >= s),
g AS (SELECT user_id, k, min(s) AS s, max(e) AS e, sum(e - s) AS t, max(e - s) AS l, count(*) AS n FROM i GROUP BY user_id, k)
SELECT user_id, sum(n)::BIGINT AS n_spans, round(sum(t), 2) AS sum_seconds, round(max(l), 2) AS max_seconds, round(sum(e - s), 2) AS union_seconds, round(greatest(0, sum(t) - sum(e - s)), 2) AS overlap_seconds FROM g GROUP BY user_id
"""


def last_n_ledger(spark, d):
    return timeline.last_n(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", 25)


def active_after_success(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return timeline.active_signals(ev, ["user_id"], "event_id", F.col("event_type") == "error", F.col("event_type") == "purchase")


def consecutive_errors(spark, d):
    ev = timeline.consecutive(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", F.col("event_type") == "error", F.col("event_type") == "purchase")
    return ev.groupBy("user_id").agg(F.max("run").alias("longest_run"), F.max_by("run", "event_id").alias("current_run")).withColumn("cooldown_seconds", F.col("current_run") * 30)


RUN_SQL = """
WITH m AS (SELECT *, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
r AS (SELECT *, sum((event_type = 'error')::INT) OVER (PARTITION BY user_id, k ORDER BY event_id) AS run FROM m)
SELECT user_id, max(run)::BIGINT AS longest_run, arg_max(run, event_id)::BIGINT AS current_run, (arg_max(run, event_id) * 30)::BIGINT AS cooldown_seconds FROM r GROUP BY user_id
"""


def circuit_breaker_modes(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_id", "event_type")
    modes = timeline.circuit_modes(ev, ["user_id"], "event_id", F.col("event_type") == "error", F.col("event_type") == "signup", F.col("event_type") == "purchase")
    return modes.groupBy("mode").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("n_users"))


CIRCUIT_SQL = """
WITH m AS (SELECT *, sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
r AS (SELECT *, sum((event_type = 'error')::INT) OVER w AS b, sum((event_type = 'signup')::INT) OVER w AS c FROM m WINDOW w AS (PARTITION BY user_id, k ORDER BY event_id))
SELECT CASE WHEN b >= 3 OR c >= 2 THEN 'paused' WHEN b >= 2 OR c >= 1 THEN 'survival' WHEN b >= 1 THEN 'conservative' ELSE 'normal' END AS mode, count(*) AS n, count(DISTINCT user_id) AS n_users FROM r GROUP BY 1
"""


def gap_over_threshold(spark, d):
    gaps = timeline.clock_gaps(events(spark, d), ["user_id"], "event_id", F.col("at"), 3600.0)
    return gaps.select("user_id", "n_gaps", *[F.round(c, 2).alias(c) for c in ("wall_seconds", "paused_seconds", "active_seconds")])


GAP_SQL = f"""
WITH e AS (SELECT user_id, {AT} AS moment, {AT} - lag({AT}) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events),
s AS (SELECT user_id, count(*) FILTER (g > 3600) AS n_gaps, max(moment) - min(moment) AS w, sum(CASE WHEN g > 3600 THEN g ELSE 0.0 END) AS p FROM e GROUP BY user_id)
SELECT user_id, n_gaps, round(w, 2) AS wall_seconds, round(p, 2) AS paused_seconds, round(w - p, 2) AS active_seconds FROM s
"""


def wait_pressure(spark, d):
    spans = events(spark, d).select((F.col("user_id") % 20).alias("lane"), F.floor("at").alias("s"), (F.floor("at") + F.floor(F.col("value") * 50)).alias("e"))
    return timeline.queue_depth(spans, ["lane"], "s", "e")


WAIT_SQL = f"""
WITH s AS (SELECT user_id % 20 AS lane, floor({AT})::BIGINT AS s, floor({AT})::BIGINT + floor(value * 50)::BIGINT AS e FROM events),
p AS (SELECT lane, s AS moment, 1 AS step FROM s UNION ALL SELECT lane, e, -1 FROM s), g AS (SELECT lane, moment, step, sum(step) AS c FROM p GROUP BY lane, moment, step),
d AS (SELECT lane, sum(c) OVER (PARTITION BY lane ORDER BY moment, step ROWS UNBOUNDED PRECEDING) AS depth FROM g)
SELECT lane, max(depth)::BIGINT AS max_depth, (SELECT sum(e - s) FROM s WHERE s.lane = d.lane)::BIGINT AS total_wait, (SELECT max(e - s) FROM s WHERE s.lane = d.lane) AS max_wait FROM d GROUP BY lane
"""


def delay_bucket_percentile(spark, d):
    return rollups.delay_buckets(table(spark, d, "events"), F.col("user_id") % 7, "value", F.col("event_type") == "purchase")


def case_summary(spark, d):
    return rollups.case_summary(events(spark, d).withColumn("case", F.col("user_id") % 50), ["case"], "event_id", F.col("at"), F.col("event_type") == "purchase", F.col("event_type") == "error")


def replay_summary(spark, d):
    rows = table(spark, d, "events").select("event_type", (F.col("user_id") % 3).alias("stage"), F.round("value", 3).alias("value"))
    return rollups.replay_summary(rows, ["stage"], F.col("event_type") == "purchase", "value").withColumns({"cost": F.round("cost", 3), "cost_per_success": F.round("cost_per_success", 5)})


def delay_recommendation(spark, d):
    rows = table(spark, d, "events").groupBy((F.col("user_id") % 9).alias("delay")).agg(F.count_if(F.col("event_type") == "purchase").alias("ok"), F.count_if((F.col("event_type") == "error") & (F.col("value") > 95) & (F.col("user_id") % 9 < 4)).alias("hard"))
    return rollups.recommend_delay(rows, "delay", "ok", "hard")


DELAY_SQL = """
WITH b AS (SELECT user_id % 9 AS delay, count(*) FILTER (event_type = 'purchase') AS ok, count(*) FILTER (event_type = 'error' AND value > 95 AND user_id % 9 < 4) AS hard FROM events GROUP BY 1),
w AS (SELECT max(delay) FILTER (hard > 0) AS worst, min(delay) FILTER (hard = 0 AND ok > 0) AS fastest, max(delay) AS slowest FROM b),
n AS (SELECT min(delay) FILTER (hard = 0 AND ok > 0 AND delay > worst) AS safe, min(delay) FILTER (hard = 0 AND ok > 0 AND delay > fastest) AS next FROM b, w)
SELECT CASE WHEN worst IS NOT NULL THEN coalesce(safe, slowest) ELSE coalesce(next, slowest) END AS delay FROM w, n
"""


def budget_pressure(spark, d):
    ev = timeline.since_previous(events(spark, d), ["user_id"], "event_id", F.col("at")).withColumn("cold", F.when(F.col("event_type") == "error", F.col("value") * 10).otherwise(0.0))
    found = rollups.pressure(ev, ["user_id"], "value", "cold", "since_previous")
    return found.select("user_id", F.round("elapsed", 2).alias("elapsed"), F.round("cooldown", 2).alias("cooldown"), "pressure")


PRESSURE_SQL = f"""
WITH e AS (SELECT user_id, value, CASE WHEN event_type = 'error' THEN value * 10 ELSE 0 END AS cold, {AT} - lag({AT}) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events),
s AS (SELECT user_id, round(sum(value), 3) AS a, round(sum(cold), 3) AS b, max(g) AS c FROM e GROUP BY user_id)
SELECT user_id, round(a, 2) AS elapsed, round(b, 2) AS cooldown, CASE WHEN a > 600 AND b > 3600 THEN 'elapsed_and_cooldown' WHEN b > 3600 THEN 'cooldown' WHEN a > 600 THEN 'elapsed' WHEN c > 300 THEN 'idle' ELSE 'none' END AS pressure FROM s
"""


def handoff_fold_latest(spark, d):
    """The batch twin of the stream fold: the last event of a user and kind, and where the first stood."""
    return timeline.latest_per_key(table(spark, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


def fingerprint_emit_once(spark, d):
    ev = table(spark, d, "events").select("user_id", T.fingerprint(F.col("event_type"), F.col("props")).alias("fingerprint"), "event_id")
    return timeline.emit_once(ev, ["user_id", "fingerprint"], "event_id").select("user_id", "event_id")


def json_props_rollup(spark, d):
    k = F.from_json("props", "k int")["k"]
    return table(spark, d, "events").groupBy("event_type").agg(F.count(k).alias("n"), F.sum(k.cast("bigint")).alias("total"), F.max(k).alias("most"))


def phase_waits(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first"), F.percentile_approx(N.wall_seconds("l_shipdate").cast("bigint"), 0.5).alias("mid"), F.max("l_shipdate").alias("last"))
    rows = rows.select("l_orderkey", N.wall_seconds("first").cast("bigint").alias("first"), "mid", N.wall_seconds("last").cast("bigint").alias("last"))
    return timeline.phase_waits(rows, ["l_orderkey"], ["first", "mid", "last"])


PHASE_SQL = """
WITH r AS (SELECT l_orderkey, epoch(min(l_shipdate))::BIGINT AS f, (list_sort(list(epoch(l_shipdate)::BIGINT)))[greatest(1, ceil(count(*) / 2.0)::BIGINT)] AS m, epoch(max(l_shipdate))::BIGINT AS l FROM lineitem GROUP BY l_orderkey),
w AS (SELECT l_orderkey, greatest(0, m - f)::DOUBLE AS first_to_mid, greatest(0, l - m)::DOUBLE AS mid_to_last FROM r)
SELECT *, CASE WHEN first_to_mid >= mid_to_last THEN 'first_to_mid' ELSE 'mid_to_last' END AS longest_phase FROM w
"""


def consensus_ge2(spark, d):
    """Nations as values that sources (customer, supplier, nation) agree on, by key digit as entity."""
    c = table(spark, d, "customer").select((F.col("c_custkey") % 10).alias("entity"), F.lit("nation").alias("kind"), F.col("c_nationkey").cast("string").alias("key"), F.lit("customer").alias("source"), F.col("c_name").alias("value"), F.col("c_custkey").alias("ord"))
    s = table(spark, d, "supplier").select((F.col("s_suppkey") % 10).alias("entity"), F.lit("nation").alias("kind"), F.col("s_nationkey").cast("string").alias("key"), F.lit("supplier").alias("source"), F.col("s_name").alias("value"), (F.col("s_suppkey") + 1_000_000_000).alias("ord"))
    agreed = consensus.consensus(c.unionByName(s), "entity", "kind", "key", "source", "value", "ord")
    return consensus.trusted(agreed, "entity", "kind", "key")


CONSENSUS_SQL = """
WITH u AS (SELECT c_custkey % 10 AS entity, c_nationkey::VARCHAR AS key, 'customer' AS source, c_name AS value, c_custkey AS ord FROM customer
 UNION ALL SELECT s_suppkey % 10, s_nationkey::VARCHAR, 'supplier', s_name, s_suppkey + 1000000000 FROM supplier)
SELECT entity, 'nation' AS kind, key, arg_min(value, ord) AS value, 1 AS priority FROM u GROUP BY entity, key HAVING count(DISTINCT source) >= 2
"""


def first_sample_by_order(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status"))


def best_pick_lexicographic(spark, d):
    return consensus.best(table(spark, d, "part").select("p_brand", "p_partkey", "p_name", "p_size", "p_retailprice"), ["p_brand"], [F.desc("p_size"), F.desc(F.char_length("p_name")), "p_retailprice", "p_partkey"], 3)


def ordered_union_dedupe(spark, d):
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), (F.col("c_acctbal") > 0).alias("positive"), F.col("c_name").alias("name"), F.col("c_custkey").alias("ord"))
    s = table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation"), (F.col("s_acctbal") > 0).alias("positive"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("ord"))
    return consensus.merge_ordered([s, c], ["nation", "positive"], "ord").select("nation", "positive", "name")


def semi_anti_resume(spark, d):
    """Orders without all of their return flags done yet."""
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("status"))
    return selection.resumable(table(spark, d, "orders").select("o_orderkey", "o_custkey"), done, "o_orderkey", "source", "status", ["A", "N", "R"])


def retry_plan(spark, d):
    """Customers with an open order, semi-joined, and what they still need, anti-joined."""
    orders, customers = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    open_ = orders.filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))
    urgent = orders.filter(F.startswith("o_orderpriority", F.lit("1"))).select(F.col("o_custkey").alias("c_custkey"))
    return selection.without_keys(selection.only_keys(customers, open_, "c_custkey"), urgent, "c_custkey")


def row_window(spark, d):
    return selection.row_window(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_custkey"], 101, 50)


def row_ordinals(spark, d):
    return selection.row_ordinals(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", [7, 3, 7, 100, 12])


def top_slow_items(spark, d):
    return selection.top(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], 20)


def top_per_group(spark, d):
    return selection.top_per_group(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 2)


def queue_admission(spark, d):
    """Documents of a source as a queue: repeats by text, a cap by language, a cap in all, a cap on size."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", F.sha1(F.col("text").cast("binary")).alias("key"), "n_chars")
    return selection.admit(docs, "source", "key", "lang", "doc_id", "n_chars", 30, 15, 8000).select("doc_id", "status")


ADMIT_SQL = """
WITH a AS (SELECT doc_id, source, lang, CASE WHEN row_number() OVER (PARTITION BY source, sha1(text) ORDER BY doc_id) > 1 THEN 'duplicate' WHEN n_chars > 8000 THEN 'too_large' END AS o FROM documents),
b AS (SELECT *, sum((o IS NULL)::INT) OVER (PARTITION BY source, lang ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS k FROM a), c AS (SELECT *, coalesce(o, CASE WHEN k > 15 THEN 'kind_cap' END) AS p FROM b),
e AS (SELECT *, sum((p IS NULL)::INT) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS n FROM c)
SELECT doc_id, coalesce(p, CASE WHEN n > 30 THEN 'total_cap' ELSE 'admitted' END) AS status FROM e
"""


def tiered_reference_match(spark, d):
    """Orders as references to customers, by key, then name, then segment; several in one tier are none."""
    refs = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")).alias("k1"), F.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))).alias("k2"), F.when(F.col("o_orderkey") % 3 == 2, F.col("o_custkey") % 700).alias("k3"))
    targets = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("k1"), F.col("c_name").alias("k2"), (F.col("c_custkey") % 1000).alias("k3"))
    return joins.tiered_match(refs, targets, "o_orderkey", "c_custkey", ["k1", "k2", "k3"]).select("o_orderkey", "target", "tier")


TIER_SQL = """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS k1, CASE WHEN o_orderkey % 3 = 1 THEN 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') END AS k2, CASE WHEN o_orderkey % 3 = 2 THEN o_custkey % 700 END AS k3 FROM orders),
p AS (SELECT o_orderkey, c_custkey, 0 AS t FROM r JOIN customer ON k1 = c_custkey UNION ALL SELECT o_orderkey, c_custkey, 1 FROM r JOIN customer ON k2 = c_name UNION ALL SELECT o_orderkey, c_custkey, 2 FROM r JOIN customer ON k3 = c_custkey % 1000),
n AS (SELECT o_orderkey, t, count(DISTINCT c_custkey) AS n, min(c_custkey) AS c FROM p GROUP BY 1, 2), f AS (SELECT o_orderkey, arg_min(n, t) AS n, arg_min(c, t) AS c, min(t) AS t FROM n GROUP BY 1)
SELECT r.o_orderkey, CASE WHEN n = 1 THEN c END AS target, CASE WHEN n = 1 THEN 'k' || (t + 1) END AS tier FROM r LEFT JOIN f USING (o_orderkey)
"""


def full_merge_ledger(spark, d):
    """Customers and their orders as two ledgers of one key, merged field by field."""
    left = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("label"), F.array("c_mktsegment").alias("tags"))
    right = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.min("o_orderpriority").alias("label"), F.array_sort(F.collect_set("o_orderstatus")).alias("tags"))
    return joins.merge_ledgers(left, right, ["key"], ["label"], ["tags"]).select("key", "label", F.array_join("tags", ",").alias("tags"))


LEDGER_SQL = """
WITH l AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS label, c_mktsegment AS tags FROM customer WHERE c_acctbal > 0),
r AS (SELECT o_custkey AS key, min(o_orderpriority) AS label, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS tags FROM orders GROUP BY 1)
SELECT coalesce(l.key, r.key) AS key, coalesce(l.label, r.label) AS label, concat_ws(',', l.tags, r.tags) AS tags FROM l FULL JOIN r ON l.key = r.key
"""


def fallback_route_join(spark, d):
    """Orders' customers by key, else by nation and segment as a composite."""
    rows = table(spark, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey")).otherwise(-1).alias("fp"), F.col("s_nationkey").alias("nation"), F.lit("BUILDING").alias("segment"))
    target = table(spark, d, "customer").select(F.col("c_custkey").alias("fp"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.col("c_custkey").alias("ord"))
    return joins.fallback_join(rows, target, "fp", ["nation", "segment"], "name", "ord").select("s_suppkey", "name", "matched_by")


FALLBACK_SQL = """
WITH c AS (SELECT c_nationkey AS n, arg_min(c_name, c_custkey) AS name FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1)
SELECT s_suppkey, coalesce(a.c_name, c.name) AS name, CASE WHEN a.c_name IS NOT NULL THEN 'first' WHEN c.name IS NOT NULL THEN 'second' END AS matched_by
FROM supplier s LEFT JOIN customer a ON s.s_suppkey % 2 = 0 AND a.c_custkey = s.s_suppkey LEFT JOIN c ON c.n = s.s_nationkey
"""


def source_lookup(spark, d):
    """Each customer with the statuses of its orders in order."""
    return joins.equi_lookup(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus"), "c_custkey", "o_orderkey", "o_orderstatus").select("c_custkey", F.array_join("found", "").alias("found"))


def refresh_cadence(spark, d):
    site_class = F.when(F.col("o_orderkey") % 4 == 0, "A").when(F.col("o_orderkey") % 4 == 1, "D").otherwise("F")
    worth = F.when(F.col("o_orderkey") % 3 == 0, "true").when(F.col("o_orderkey") % 3 == 1, "limited").otherwise("false")
    return table(spark, d, "orders").select("o_orderkey", N.refresh_due(F.col("o_orderdate"), site_class, worth).cast("string").alias("due"))


REFRESH_SQL = """
SELECT o_orderkey, strftime(o_orderdate + to_days(CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 3 = 0 THEN 1 WHEN o_orderkey % 4 = 1 OR o_orderkey % 3 = 1 THEN 7 ELSE 30 END), '%Y-%m-%d %H:%M:%S') AS due FROM orders
"""
OUTER, INNER = [(45.0, 25.0), (45.0, 70.0), (80.0, 70.0), (80.0, 25.0)], [(52.0, 35.0), (52.0, 55.0), (65.0, 45.0)]


def haversine_polygon(spark, d):
    k = F.col("c_custkey")
    pts = table(spark, d, "customer").select("c_custkey", (k * 7 % 50 + 40.5).cast("double").alias("lat"), (k * 11 % 60 + 20.25).cast("double").alias("lon"))
    zone = N.zone(F.col("lat"), F.col("lon"), OUTER, INNER)
    return pts.select("c_custkey", F.round(N.haversine_km(F.col("lat"), F.col("lon"), F.lit(55.75), F.lit(37.62)), 4).alias("km"), zone.alias("zone"), N.zone_weight(zone).alias("weight"))


POLYGON_SQL = """
WITH p AS (SELECT c_custkey, (c_custkey * 7 % 50 + 40.5)::DOUBLE AS lat, (c_custkey * 11 % 60 + 20.25)::DOUBLE AS lon FROM customer),
z AS (SELECT *, CASE WHEN lat BETWEEN 52 AND 65 AND lon BETWEEN 35 AND 55 AND (lon - 35) * 13 >= (lat - 52) * 10 AND (55 - lon) * 13 >= (lat - 52) * 10 THEN 'core'
  WHEN lat BETWEEN 45 AND 80 AND lon BETWEEN 25 AND 70 THEN 'outer_band' ELSE 'outside' END AS zone FROM p)
SELECT c_custkey, round(2 * 6371.0088 * asin(sqrt(pow(sin(radians(55.75 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(55.75)) * pow(sin(radians(37.62 - lon) / 2), 2))), 4) AS km, zone, CASE zone WHEN 'core' THEN 5 WHEN 'outer_band' THEN 1 ELSE 0 END AS weight FROM z
"""


def geo_clusters(spark, d):
    places = table(spark, d, "supplier").select("s_nationkey", (F.col("s_suppkey") % 3).alias("kind"), F.when(F.col("s_suppkey") % 2 == 0, "north").otherwise("south").alias("name"), F.when(F.col("s_acctbal") > 9000, "core").otherwise("outside").alias("bucket"), F.col("s_acctbal").alias("distance"))
    return geo.clusters(places, ["s_nationkey", "kind"], "name", "bucket", "distance")


CLUSTER_SQL = """
WITH p AS (SELECT s_nationkey, s_suppkey % 3 AS kind, CASE WHEN s_suppkey % 2 = 0 THEN 'north' ELSE 'south' END AS name, CASE WHEN s_acctbal > 9000 THEN 'core' ELSE 'outside' END AS bucket, s_acctbal AS x FROM supplier),
n AS (SELECT s_nationkey, kind, name, count(*) AS n FROM p GROUP BY 1, 2, 3), m AS (SELECT s_nationkey, kind, (max((n, length(name), name)))[3] AS name FROM n GROUP BY 1, 2)
SELECT s_nationkey, kind, m.name, count(*) AS n_variants, round(median(x), 3) AS distance, round(max(x) - min(x), 3) AS spread, CASE WHEN count(DISTINCT bucket) = 1 THEN min(bucket) END AS bucket, count(DISTINCT bucket) > 1 AS ambiguous FROM p JOIN m USING (s_nationkey, kind) GROUP BY 1, 2, 3
"""


def address_lookup(spark, d):
    """Nations as places, looked up in texts that name one, two or none."""
    nations = table(spark, d, "nation").select("n_nationkey", F.lower("n_name").alias("alias"), (F.col("n_regionkey") % 2).alias("priority"))
    names = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = table(spark, d, "customer").join(F.broadcast(names), "c_nationkey").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("12 street, "), "n_name", F.lit(" west"))).when(F.col("c_custkey") % 3 == 1, F.concat("n_name", F.lit(" or KENYA"))).otherwise("nowhere at all").alias("address"))
    return geo.address_lookup(rows, "c_custkey", "address", nations, "n_nationkey", "alias", "priority")


ADDRESS_SQL = r"""
WITH r AS (SELECT c_custkey, ' ' || trim(regexp_replace(lower(CASE WHEN c_custkey % 3 = 0 THEN '12 street, ' || n_name || ' west' WHEN c_custkey % 3 = 1 THEN n_name || ' or KENYA' ELSE 'nowhere at all' END), '[^a-z0-9]+', ' ', 'g')) || ' ' AS a FROM customer JOIN nation ON c_nationkey = n_nationkey),
n AS (SELECT n_nationkey, lower(n_name) AS alias, n_regionkey % 2 AS pr, array_to_string(list_filter(string_split_regex(lower(n_name), '[^a-z0-9]+'), lambda t: length(t) > 1), ' ') AS ph FROM nation),
m AS (SELECT c_custkey, n_nationkey, alias, rank() OVER (PARTITION BY c_custkey ORDER BY pr DESC, len(string_split(ph, ' ')) DESC, length(alias) DESC) AS k FROM r JOIN n ON contains(a, ' ' || ph || ' ')),
f AS (SELECT c_custkey, count(DISTINCT n_nationkey) AS n, min(n_nationkey) AS p, min(alias) AS al FROM m WHERE k = 1 GROUP BY 1)
SELECT customer.c_custkey, CASE WHEN n = 1 THEN p END AS n_nationkey, CASE WHEN n = 1 THEN al END AS alias, CASE WHEN n IS NULL THEN 'none' WHEN n = 1 THEN 'matched' ELSE 'ambiguous' END AS match FROM customer LEFT JOIN f USING (c_custkey)
"""


def mask_signals(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("masked"), F.count(F.lit(1)).alias("total"))
    return g.select("user_id", "masked", rollups.mask_signal(F.col("masked"), F.col("total")).alias("signal"))


def field_availability(spark, d):
    """Open, masked, absent, blocked or unknown fields of a user's items."""
    seen = lambda kind: F.coalesce(F.bool_or(F.col("event_type") == kind), F.lit(False))
    users = table(spark, d, "events").groupBy("user_id").agg(seen("signup").alias("open"), seen("error").alias("masked"))
    status = F.when(F.col("user_id") % 5 == 0, "blocked").otherwise("ok")
    return users.select("user_id", consensus.availability_of(status, F.col("open"), F.col("masked"), F.col("user_id") % 2 == 0).alias("availability"))


AVAIL_SQL = """
WITH g AS (SELECT user_id, bool_or(event_type = 'signup') AS o, bool_or(event_type = 'error') AS m FROM events GROUP BY 1)
SELECT user_id, CASE WHEN o THEN 'open' WHEN m THEN 'masked' WHEN user_id % 5 = 0 THEN 'blocked' WHEN user_id % 2 = 0 THEN 'absent' ELSE 'unknown' END AS availability FROM g
"""


def best_contact_status(spark, d):
    """The best contact of a customer by precedence of where it comes from."""
    k = F.col("c_custkey")
    value, status = consensus.pick_status(F.when(k % 7 == 0, F.col("c_name")), F.when(k % 5 == 0, F.col("c_mktsegment")), F.when(k % 3 == 0, F.lit("domain")), F.when(k % 2 == 0, F.lit("merged")))
    return table(spark, d, "customer").select("c_custkey", value.alias("value"), status.alias("status"))


def decision_ladder(spark, d):
    """A decision table over status and flag, as data."""
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus")
    rules = [("A", "F", "stop"), ("N", "O", "defer"), ("R", "F", "retry")]
    return scoring.decision_table(rows, rules, "l_returnflag string, l_linestatus string, outcome string", ["l_returnflag", "l_linestatus"]).groupBy("l_returnflag", "l_linestatus", F.coalesce("outcome", F.lit("go")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def ready_idle(spark, d):
    """The oldest ready row of each lane and how long it has waited."""
    ev = events(spark, d).withColumn("lane", F.col("user_id") % 10)
    ready = F.col("event_type") == "view"
    idle = F.max("at") - F.min(F.when(ready, F.col("at")))
    return ev.groupBy("lane").agg(F.round(idle, 2).alias("oldest_idle"), F.count_if(ready).alias("n_ready")).filter("n_ready > 0")


QUERIES = {f.__name__: f for f in (
    host_stats_rollup, host_bucket_merge, cost_poison_rollup, availability_pivot, interval_union, last_n_ledger, active_after_success, consecutive_errors, circuit_breaker_modes, gap_over_threshold, wait_pressure, delay_bucket_percentile,
    case_summary, replay_summary, delay_recommendation, budget_pressure, handoff_fold_latest, fingerprint_emit_once, json_props_rollup, phase_waits, consensus_ge2, first_sample_by_order, best_pick_lexicographic, ordered_union_dedupe,
    semi_anti_resume, retry_plan, row_window, row_ordinals, top_slow_items, top_per_group, queue_admission, tiered_reference_match, full_merge_ledger, fallback_route_join, source_lookup, refresh_cadence, haversine_polygon, geo_clusters,
    address_lookup, mask_signals, field_availability, best_contact_status, decision_ladder, ready_idle,
)}
ORACLES = {
    "host_stats_rollup": HOST_STATS_SQL,
    "host_bucket_merge": "WITH p AS (SELECT user_id, event_type, min(event_id) AS a, max(event_id) AS b, count(*) AS n, count(*) FILTER (value > 0) AS t, round(sum(value) FILTER (value > 0), 4) AS s, min(value) FILTER (value > 0) AS lo, max(value) FILTER (value > 0) AS hi FROM events GROUP BY 1, 2) SELECT user_id, min(a) AS first_seen, max(b) AS last_seen, sum(n)::BIGINT AS n_events, sum(t)::BIGINT AS n_timed, round(sum(s), 4) AS sum_elapsed, min(lo) AS min_elapsed, max(hi) AS max_elapsed FROM p GROUP BY user_id",
    "cost_poison_rollup": POISON_SQL,
    "availability_pivot": "SELECT user_id % 10 AS bucket, " + ", ".join(f"count(*) FILTER (event_type = '{s}') AS n_{s}" for s in STATUSES) + " FROM events GROUP BY 1",
    "interval_union": UNION_SQL,
    "last_n_ledger": "SELECT * FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS from_end FROM events) WHERE from_end <= 25",
    "active_after_success": "SELECT user_id, event_id, event_type FROM (SELECT *, max(CASE WHEN event_type = 'purchase' THEN event_id END) OVER (PARTITION BY user_id) AS l FROM events) WHERE event_type = 'error' AND (l IS NULL OR event_id > l)",
    "consecutive_errors": RUN_SQL, "circuit_breaker_modes": CIRCUIT_SQL, "gap_over_threshold": GAP_SQL, "wait_pressure": WAIT_SQL,
    "delay_bucket_percentile": "SELECT user_id % 7 AS bucket, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS n_ok, round(quantile_cont(value, 0.5), 3) AS median, round(quantile_cont(value, 0.95), 3) AS p95 FROM events GROUP BY 1",
    "case_summary": f"SELECT user_id % 50 AS \"case\", count(*) AS n, round(count(*)::DOUBLE / ((max({AT}) - min({AT})) / 60), 4) AS rows_per_minute, round(count(*) FILTER (event_type = 'purchase') / count(*), 6) AS success_rate, min(CASE WHEN event_type = 'error' THEN event_id END) AS first_block FROM events GROUP BY 1",
    "replay_summary": "WITH s AS (SELECT user_id % 3 AS stage, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS n_ok, sum(round(value, 3)) AS c FROM events GROUP BY 1) SELECT stage, n, n_ok, round(c, 3) AS cost, round(n_ok / n, 6) AS success_rate, round(c / nullif(n_ok, 0), 5) AS cost_per_success FROM s",
    "delay_recommendation": DELAY_SQL, "budget_pressure": PRESSURE_SQL,
    "handoff_fold_latest": "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value, min(event_id) AS first_position FROM events GROUP BY 1, 2",
    "fingerprint_emit_once": "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id, event_type, props",
    "json_props_rollup": "SELECT event_type, count((props->>'$.k')::INT) AS n, sum((props->>'$.k')::INT)::BIGINT AS total, max((props->>'$.k')::INT) AS most FROM events GROUP BY 1",
    "phase_waits": PHASE_SQL, "consensus_ge2": CONSENSUS_SQL,
    "first_sample_by_order": "SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status FROM orders GROUP BY 1",
    "best_pick_lexicographic": "SELECT * FROM (SELECT p_brand, p_partkey, p_name, p_size, p_retailprice, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, length(p_name) DESC, p_retailprice, p_partkey) AS rank FROM part) WHERE rank <= 3",
    "ordered_union_dedupe": "WITH u AS (SELECT s_nationkey AS nation, s_acctbal > 0 AS positive, s_name AS name, 0 AS f, s_suppkey AS o FROM supplier UNION ALL SELECT c_nationkey, c_acctbal > 0, c_name, 1, c_custkey FROM customer) SELECT nation, positive, arg_min(name, (f, o)) AS name FROM u GROUP BY 1, 2",
    "semi_anti_resume": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') AND coalesce(l_linestatus, '') <> '' GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 3)",
    "retry_plan": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1%')",
    "row_window": "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 50 OFFSET 100",
    "row_ordinals": "SELECT c_custkey, c_name, CASE c_custkey WHEN 7 THEN 0 WHEN 3 THEN 1 WHEN 100 THEN 2 ELSE 3 END AS request_order FROM customer WHERE c_custkey IN (7, 3, 100, 12)",
    "top_slow_items": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20",
    "top_per_group": "SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 2",
    "queue_admission": ADMIT_SQL, "tiered_reference_match": TIER_SQL, "full_merge_ledger": LEDGER_SQL, "fallback_route_join": FALLBACK_SQL,
    "source_lookup": "SELECT c_custkey, coalesce(string_agg(o_orderstatus, '' ORDER BY o_orderkey), '') AS found FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1",
    "refresh_cadence": REFRESH_SQL, "haversine_polygon": POLYGON_SQL, "geo_clusters": CLUSTER_SQL, "address_lookup": ADDRESS_SQL,
    "mask_signals": "SELECT user_id, masked, CASE WHEN masked >= greatest(10, floor(total * 0.15)) THEN 'high' WHEN masked > 0 THEN 'medium' ELSE 'low' END AS signal FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS masked, count(*) AS total FROM events GROUP BY 1)",
    "field_availability": AVAIL_SQL,
    "best_contact_status": "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN c_name WHEN c_custkey % 5 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 0 THEN 'domain' WHEN c_custkey % 2 = 0 THEN 'merged' END AS value, CASE WHEN c_custkey % 7 = 0 THEN 'validated' WHEN c_custkey % 5 = 0 THEN 'trusted' WHEN c_custkey % 3 = 0 THEN 'domain_resolution' WHEN c_custkey % 2 = 0 THEN 'merged_only' ELSE 'none' END AS status FROM customer",
    "decision_ladder": "SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'stop' WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'defer' WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'retry' ELSE 'go' END AS outcome, count(*) AS n FROM lineitem GROUP BY 1, 2, 3",
    "ready_idle": f"WITH e AS (SELECT user_id % 10 AS lane, event_type, {AT} AS moment, max({AT}) OVER (PARTITION BY user_id % 10) AS now FROM events) SELECT lane, round(max(now - moment), 2) AS oldest_idle, count(*) AS n_ready FROM e WHERE event_type = 'view' GROUP BY 1",
}
