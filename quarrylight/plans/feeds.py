"""Queries over outboxes of messages and over event feeds that are folded batch by batch: each feed is written from the events table first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..sources import outbox
from ..sources.workspace import shared_folder
from ..streaming import events as S
from ..streaming import handoff as H
from ..streaming import stores, telemetry


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_messages(spark, d):
    """Events as messages between stages: the user is the company, the kind of event the kind of message."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    end = F.when(F.col("event_id") % 2 == 0, "deep_parse_done").otherwise("company_completed")
    named = F.when(kind == "view", "source_result_ready").when(kind == "click", "candidate_site_found").when(kind == "signup", "site_gate_decision").when(kind == "error", "host_event").otherwise(end)
    payload = F.struct(F.concat(F.lit("s"), (k % 4).cast("string")).alias("source"), F.concat(F.lit("https://s"), (k % 6).cast("string"), F.lit(".example")).alias("site_url"), F.col("event_id").alias("v"))
    return table(spark, d, "events").select(
        F.lit("run").alias("run_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), named.alias("message_type"), F.concat(F.lit("stage-"), kind).alias("stage"), F.col("user_id").cast("string").alias("inn"),
        (F.col("event_id") + 1).alias("row_index"), F.to_json(payload).alias("payload"), "event_id",
    )


MESSAGES_SQL = """
SELECT event_id, user_id::VARCHAR AS inn, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, 'stage-' || event_type AS stage, event_id + 1 AS row_index, (props->>'$.k')::INT AS k,
  CASE event_type WHEN 'view' THEN 'source_result_ready' WHEN 'click' THEN 'candidate_site_found' WHEN 'signup' THEN 'site_gate_decision' WHEN 'error' THEN 'host_event'
    ELSE CASE WHEN event_id % 2 = 0 THEN 'deep_parse_done' ELSE 'company_completed' END END AS message_type FROM events
"""


def written_outbox(spark, d, files=3):
    """The messages in an outbox in the shared folder; a company's messages stand in one file, in order."""
    path = shared_folder(spark, "outbox")
    outbox.append_messages(stage_messages(spark, d).repartition(files, "inn").sortWithinPartitions("event_id"), f"{path}/lines")
    return path


def outbox_messages(spark, d):
    """Every message read back from its bytes, the second half by a cursor in the middle of the files."""
    path = f"{written_outbox(spark, d)}/lines"
    half = {file: outbox.last_line_end(path, file, 0, size // 2, size) for file, size in outbox.sizes(path).items()}
    rest, _ = outbox.read_unread(spark, path, half)
    first = spark.read.format("outbox").option("path", path).option("end", outbox.json.dumps(half)).load()
    found = outbox.messages(first.unionByName(rest))
    return found.select("inn", "ts", "message_type", "stage", "row_index", F.get_json_object("payload", "$.v").cast("bigint").alias("event_id"), F.get_json_object("payload", "$.source").alias("source"))


def shown(rows):
    """Lists and payloads of a handoff as text."""
    v = lambda x: F.get_json_object(x["payload"], "$.v")
    lists = [F.array_join(F.transform(name, lambda x: F.concat_ws("=", x["item_key"], v(x))), "|").alias(name) for name, _ in H.LISTS.values()]
    return rows.select("inn", "row_index", "last_message_type", "last_message_ts", *lists, *[F.concat_ws(" ", F.col(f"{n}.stage"), v(F.col(n))).alias(n) for n in H.SINGLES.values()])


def handoff_fold(spark, d):
    return shown(H.handoff_fold(stage_messages(spark, d), "event_id"))


def stream_handoff_fold(spark, d):
    """The same rows from the outbox, in several batches of bytes, with state between them."""
    path = written_outbox(spark, d)
    most = max(4096, max(outbox.sizes(f"{path}/lines").values()) // 3)
    lines = outbox.stream_lines(spark, f"{path}/lines", most, f"{path}/cursor")
    with stores.rocksdb_state(spark):
        found = stores.last_rows(H.handoff_stream(outbox.messages(lines), "file", "byte_offset"), path, ["inn"])
    return shown(found)


HANDOFF_SQL = f"""
WITH m AS ({MESSAGES_SQL}), c AS (SELECT *, CASE message_type WHEN 'source_result_ready' THEN 's' || k % 4 ELSE 'https://s' || k % 6 || '.example' END AS item FROM m WHERE message_type <> 'host_event'),
i AS (SELECT inn, message_type, item, min(event_id) AS a, max(event_id) AS v FROM c GROUP BY ALL),
l AS (SELECT inn, message_type, string_agg(item || '=' || v, '|' ORDER BY a) AS t FROM i GROUP BY ALL),
s AS (SELECT inn, message_type, arg_max(stage || ' ' || event_id, event_id) AS t FROM c GROUP BY ALL),
h AS (SELECT inn, max(row_index) AS row_index, arg_max(message_type, event_id) AS last_message_type, arg_max(ts, event_id) AS last_message_ts FROM c GROUP BY inn)
SELECT h.*, {", ".join(f"coalesce((SELECT t FROM l WHERE l.inn = h.inn AND message_type = '{kind}'), '') AS {name}" for kind, (name, _) in H.LISTS.items())},
  {", ".join(f"coalesce((SELECT t FROM s WHERE s.inn = h.inn AND message_type = '{kind}'), '') AS {name}" for kind, name in H.SINGLES.items())} FROM h
"""


def run_events(events):
    """Events as telemetry: hosts are users, stages kinds of events; each is a span of a user and a drain of its stage."""
    at, second = F.round(N.wall_seconds("ts"), 3), F.floor(N.wall_seconds("ts"))
    return events.select(
        "event_id", F.col("user_id").cast("string").alias("host"), F.col("event_type").alias("kind"), F.col("value").alias("seconds"), F.col("event_type").alias("stage"), (F.col("user_id") % 5).cast("string").alias("model"),
        F.when(F.col("event_id") % 997 != 0, F.round("value", 4)).alias("cost"), F.col("user_id").cast("string").alias("owner"), at.alias("started"), F.round(at + F.col("value") * 100, 3).alias("finished"),
        second.alias("queued"), (second + F.floor("value")).alias("began"), (second + F.floor(F.col("value") * 3)).alias("ended"),
    )


def stream_telemetry(spark, d):
    """Four ledgers folded from a feed in several batches, the last of which is sent twice. A batch is a third of the events, in as many files as keep all cores busy."""
    path, files = shared_folder(spark, "telemetry"), max(16, int(spark.conf.get("spark.sql.shuffle.partitions")) // 3)
    table(spark, d, "events").repartitionByRange(3 * files, "event_id").write.parquet(f"{path}/feed")
    ledger, seen = stores.Ledger(spark, f"{path}/ledger"), []

    def each(batch, i):
        telemetry.apply_batch(ledger, run_events(batch), i)
        seen.append(i)

    stores.run_through(S.read_events(spark, f"{path}/feed", max_files=files), each, f"{path}/state")
    if seen and telemetry.apply_batch(ledger, run_events(table(spark, d, "events")), seen[-1]):
        raise ValueError("a batch counted twice")
    t = telemetry.summaries(ledger)
    two = lambda c, n=2: F.round(c, n)
    row = lambda name, key, *v: [F.lit(name).alias("ledger"), F.col(key).cast("string").alias("key"), *[x.cast("double").alias(n) for n, x in zip("abcde", v, strict=True)]]
    c, none = F.col, F.lit(None)
    parts = [
        t["hosts"].select(*row("host", "host", c("n_events"), c("n_kinds"), c("last_seen") - c("first_seen"), two(c("sum_elapsed")), c("max_elapsed"))),
        t["costs"].withColumn("k", F.concat_ws("/", "grouping", "value")).select(*row("cost", "k", c("n"), two(c("total"), 4), none, none, none)),
        t["spans"].select(*row("span", "owner", c("n_spans"), two(c("sum_seconds")), two(c("max_seconds")), two(c("union_seconds")), two(c("overlap_seconds")))),
        t["drains"].select(*row("drain", "stage", c("n"), c("waited"), c("longest_wait"), c("worked"), F.get("slowest", F.lit(0)))),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


TELEMETRY_SQL = """
WITH e AS (SELECT *, CASE WHEN event_id % 997 <> 0 THEN round(value, 4) END AS cost, round(epoch_us(ts) / 1e6, 3) AS s FROM events), sp AS (SELECT user_id, s, round(s + value * 100, 3) AS f FROM e),
o AS (SELECT *, max(f) OVER (PARTITION BY user_id ORDER BY s, f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM sp WHERE f >= s),
i AS (SELECT *, sum(CASE WHEN b IS NULL OR s > b THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, f ROWS UNBOUNDED PRECEDING) AS k FROM o),
g AS (SELECT user_id, k, min(s) AS s, max(f) AS f, sum(f - s) AS t, max(f - s) AS l, count(*) AS n FROM i GROUP BY user_id, k),
dr AS (SELECT event_type, event_id, floor(value)::BIGINT AS w, floor(value * 3)::BIGINT AS t FROM events)
SELECT 'host' AS ledger, user_id::VARCHAR AS key, count(*)::DOUBLE AS a, count(DISTINCT event_type)::DOUBLE AS b, (max(event_id) - min(event_id))::DOUBLE AS c, round(sum(value) FILTER (value > 0), 2) AS d, max(value) FILTER (value > 0) AS e FROM e GROUP BY user_id
UNION ALL SELECT 'cost', 'stage/' || event_type, count(*), CASE WHEN bool_or(cost IS NULL) THEN NULL ELSE round(sum(cost), 4) END, NULL, NULL, NULL FROM e GROUP BY event_type
UNION ALL SELECT 'cost', 'model/' || user_id % 5, count(*), CASE WHEN bool_or(cost IS NULL) THEN NULL ELSE round(sum(cost), 4) END, NULL, NULL, NULL FROM e GROUP BY user_id % 5
UNION ALL SELECT 'span', user_id::VARCHAR, sum(n)::DOUBLE, round(sum(t), 2), round(max(l), 2), round(sum(f - s), 2), round(greatest(0, sum(t) - sum(f - s)), 2) FROM g GROUP BY user_id
UNION ALL SELECT 'drain', event_type, count(*), sum(w), max(w), sum(t - w), arg_min(event_id, (-t, event_id)) FROM dr GROUP BY event_type
"""


def stream_emit_within(spark, d):
    """First emissions with bounded state: repeats of a user and kind within an hour of event time count once; the feed comes in order of time, so none is late."""
    path = shared_folder(spark, "emit-within")
    table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", "user_id", "event_type", "props").repartitionByRange(4, "ts", "event_id").sortWithinPartitions("ts", "event_id").write.parquet(f"{path}/feed")
    stream = S.emit_once_within(S.read_events(spark, f"{path}/feed", max_files=1), ["user_id", "event_type", "props"], "ts", "365 days")
    stores.run_through(stream, lambda batch, i: batch.write.mode("overwrite").parquet(f"{path}/rows/batch={i}"), f"{path}/state")
    return spark.read.schema(stream.schema).parquet(f"{path}/rows").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_distinct"))


QUERIES = {f.__name__: f for f in (outbox_messages, handoff_fold, stream_handoff_fold, stream_telemetry, stream_emit_within)}
ORACLES = {
    "outbox_messages": f"SELECT inn, ts, message_type, stage, row_index, event_id, 's' || k % 4 AS source FROM ({MESSAGES_SQL})",
    "handoff_fold": HANDOFF_SQL, "stream_handoff_fold": HANDOFF_SQL, "stream_telemetry": TELEMETRY_SQL,
    "stream_emit_within": "SELECT user_id, count(DISTINCT event_type || props) AS n_distinct FROM events GROUP BY 1",
}
