"""Outboxes with a cursor, the stateful handoff, telemetry ledgers and emission with bounded state."""

import json
import os
import random
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from quarrylight.sources import outbox
from quarrylight.streaming import events as S
from quarrylight.streaming import handoff, stores, telemetry

KINDS = outbox.MESSAGE_TYPES


@pytest.fixture
def folder():
    path = tempfile.mkdtemp(prefix="feeds-")
    yield path
    shutil.rmtree(path, ignore_errors=True)


def message(i, **other):
    return {"run_id": "r", "ts": f"t{i:04d}", "message_type": KINDS[i % len(KINDS)], "stage": f"s{i % 3}", "inn": f"c{i % 4}", "row_index": i + 1, "payload": {"source": f"a{i % 5}", "site_url": f"u{i % 7}", "v": i}} | other


def append(path, rows, end="\n"):
    with open(path, "ab") as f:
        for r in rows:
            f.write((r if isinstance(r, bytes) else json.dumps(r, ensure_ascii=False).encode()) + end.encode())


# reading bytes


def test_batches_from_a_cursor(spark, folder, monkeypatch):
    monkeypatch.setattr(outbox, "SPLIT_BYTES", 700)  # several ranges of a file, cut inside lines
    rows = [message(i, stage="é😀" * (i % 5)) for i in range(60)]
    append(f"{folder}/a.jsonl", rows[:30])
    append(f"{folder}/b.jsonl", [b"", b"   ", *rows[30:]])
    append(f"{folder}/_hidden.jsonl", [b"not a line"])
    found, cursor = outbox.read_unread(spark, folder)
    assert sorted(r.line for r in found.collect()) == sorted(json.dumps(r, ensure_ascii=False) for r in rows)
    assert cursor == {f"{folder}/{n}": os.path.getsize(f"{folder}/{n}") for n in ("a.jsonl", "b.jsonl")}
    append(f"{folder}/a.jsonl", [message(99)])
    append(f"{folder}/b.jsonl", [b'{"half": '], end="")
    more, after = outbox.read_unread(spark, folder, cursor)
    found = more.collect()
    assert [json.loads(r.line)["row_index"] for r in found] == [100] and found[0].byte_offset == cursor[f"{folder}/a.jsonl"]
    assert after[f"{folder}/b.jsonl"] == cursor[f"{folder}/b.jsonl"]  # the line that isn't whole waits
    assert outbox.read_unread(spark, folder, after)[0].count() == 0
    assert outbox.read_unread(spark, f"{folder}/none")[0].count() == 0


def test_a_cut_file_stops_the_reader(spark, folder):
    append(f"{folder}/a.jsonl", [message(i) for i in range(5)])
    _, cursor = outbox.read_unread(spark, folder)
    with open(f"{folder}/a.jsonl", "r+b") as f:
        f.truncate(100)
    with pytest.raises(ValueError, match="cut before the cursor"):
        outbox.read_unread(spark, folder, cursor)
    os.remove(f"{folder}/a.jsonl")
    with pytest.raises(ValueError, match="gone"):
        outbox.read_unread(spark, folder, cursor)


@pytest.mark.parametrize("line", [b"\xff\xfe", b"{broken", b"[1]", b"3", json.dumps(message(0, message_type="other")).encode(), json.dumps(message(0, inn=" ")).encode(), json.dumps(message(0, row_index=0)).encode(), json.dumps(message(0, payload=None)).encode()])
def test_a_bad_line_stops_the_reader(spark, folder, line):
    append(f"{folder}/a.jsonl", [message(1), line])
    with pytest.raises(Exception):  # noqa: B017
        outbox.messages(outbox.read_unread(spark, folder)[0]).collect()


def test_messages_survive_the_outbox(spark, folder):
    rows = [message(i) for i in range(12)]
    df = spark.createDataFrame([{**r, "payload": json.dumps(r["payload"])} for r in rows], "run_id string, ts string, message_type string, stage string, inn string, row_index bigint, payload string")
    outbox.append_messages(df, f"{folder}/lines")
    found = outbox.messages(outbox.read_unread(spark, f"{folder}/lines")[0]).orderBy("row_index").collect()
    assert [(r.ts, r.message_type, r.stage, r.inn, r.row_index, json.loads(r.payload)) for r in found] == [(r["ts"], r["message_type"], r["stage"], r["inn"], r["row_index"], r["payload"]) for r in rows]


def test_a_stream_resumes_in_the_middle_of_a_file(spark, folder):
    """Three restarts, each with a few bytes a batch: every line comes once, in batches that begin inside the file."""
    seen = []

    def run(times):
        stream = outbox.stream_lines(spark, f"{folder}/box", 400, f"{folder}/cursor.json")
        query = stream.writeStream.foreachBatch(lambda b, i: seen.append((i, [(r.byte_offset, json.loads(r.line)["row_index"]) for r in b.collect()]))).option("checkpointLocation", f"{folder}/state").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    os.mkdir(f"{folder}/box")
    for k in range(4):
        append(f"{folder}/box/a.jsonl", [message(i) for i in range(10 * k, 10 * k + 10)])
        run(k)
    assert sorted(n for _, rows in seen for _, n in rows) == list(range(1, 41))
    assert len(seen) > 8 and [i for i, _ in seen] == sorted({i for i, _ in seen})  # batches of a few lines, none twice
    with open(f"{folder}/box/a.jsonl", "r+b") as f:
        f.truncate(50)
    with pytest.raises(Exception, match="cut before the cursor"):
        run(4)


# handoff


def naive_fold(messages):
    """One message after another."""
    out = {}
    for m in messages:
        kind, inn = (m["message_type"] or "").strip(), (m["inn"] or "").strip()
        if kind == "host_event" or not inn:
            continue
        c = out.setdefault(inn, {"row": 0, "source_results": {}, "candidate_sites": {}, "site_gate_decisions": {}, "deep_parse_done": None, "company_completed": None})
        if m["row_index"] and m["row_index"] > 0:
            c["row"] = m["row_index"]
        c["last"] = (kind, m["ts"] or "")
        value = (m["stage"] or "", m["ts"] or "", m["payload"])
        if kind in handoff.LISTS:
            name, field = handoff.LISTS[kind]
            key = str((json.loads(m["payload"]) if m["payload"] else {}).get(field) or "").strip()
            if key:
                c[name][key] = value
        elif kind in handoff.SINGLES:
            c[kind] = value
    return sorted((inn, c["row"], *c["last"], *[[(k, *v) for k, v in c[n].items()] for n, _ in handoff.LISTS.values()], c["deep_parse_done"], c["company_completed"]) for inn, c in out.items())


def plain(rows):
    some = lambda x: None if x is None else tuple(x)
    return sorted((r.inn, r.row_index, r.last_message_type, r.last_message_ts, *[[tuple(x) for x in r[n]] for n, _ in handoff.LISTS.values()], some(r.deep_parse_done), some(r.company_completed)) for r in rows)


def random_messages(n, seed):
    rnd = random.Random(seed)
    payload = lambda i: json.dumps({k: v for k, v in {"source": rnd.choice(["a", " b ", "", None]), "site_url": rnd.choice(["x", "y", "z", ""]), "v": i}.items() if v is not None})
    return [{"n": i, "inn": rnd.choice(["c1", " c1", "c2", "c3", "", None] if i % 5 else ["hot"]), "row_index": rnd.choice([i + 1, 0, None]), "message_type": rnd.choice([*KINDS, "unknown"]), "stage": rnd.choice(["s", None]), "ts": f"t{i}", "payload": rnd.choice([payload(i), payload(i), None])} for i in range(n)]


SCHEMA = "n bigint, inn string, row_index bigint, message_type string, stage string, ts string, payload string"


def test_fold_of_messages_by_brute_force(spark):
    for seed in range(4):
        rows = random_messages(120, seed)
        shuffled = random.Random(seed).sample(rows, len(rows))
        assert plain(handoff.handoff_fold(spark.createDataFrame(shuffled, SCHEMA).repartition(5), "n").collect()) == naive_fold(rows)
    assert handoff.handoff_fold(spark.createDataFrame([], SCHEMA), "n").count() == 0


def test_a_company_costs_one_read_and_one_write_of_state_a_batch():
    """However many items it has: by a call for each item a batch of many companies took minutes."""
    import pandas as pd

    class State:
        calls, exists, value = [], False, None

        @property
        def get(self):
            self.calls.append("get")
            return self.value

        def update(self, value):
            self.calls.append("update")
            self.value, self.exists = value, True

    def rows(numbers, kind="candidate_site_found"):
        found = [(kind, f"u{i % 40}", float(i + 1), f"t{i}", "s", str(i), "f", i, "f", i, "f", i) for i in numbers]
        return [pd.DataFrame(found, columns=handoff.FOLDED)]

    state = State()
    list(handoff.folded(("c",), rows(range(39, -1, -1)), state))
    out = next(handoff.folded(("c",), rows(range(45, 50)), state)).iloc[0]
    assert state.calls == ["update", "get", "update"] and out["row_index"] == 50 and out["last_message_ts"] == "t49"
    sites = json.loads(out["candidate_sites"])
    assert [x["item_key"] for x in sites] == [f"u{i}" for i in range(40)] and [x["payload"] for x in sites[4:11]] == ["4", "45", "46", "47", "48", "49", "10"] and out["source_results"] == "[]"


def test_stateful_fold_equals_the_batch_over_several_batches(spark, folder):
    rows = random_messages(200, 9)
    rows += rows[-20:]  # repeats
    rows = [{**r, "n": i} for i, r in enumerate(rows)]
    for k in range(4):
        spark.createDataFrame(rows[55 * k : 55 * k + 55], SCHEMA).repartition(3).write.mode("append").parquet(f"{folder}/in/{k}")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 3).parquet(f"{folder}/in/*")
    with stores.rocksdb_state(spark):
        found = stores.last_rows(handoff.handoff_stream(stream.withColumn("zero", F.lit(0)), "n", "zero"), f"{folder}/run", ["inn"])
    assert sum(x.startswith("batch=") for x in os.listdir(f"{folder}/run/rows")) == 4
    assert plain(found.collect()) == naive_fold(rows)


# telemetry


def run_rows(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        at = rnd.randrange(1000)
        out.append((i, rnd.choice(["h1", "h2", None]), rnd.choice(["ok", "bad"]), rnd.choice([1.5, 0.0, None, 2.25]), rnd.choice(["s1", "s2", None]), rnd.choice(["m1", "m2"]), rnd.choice([0.5, 0.25, 0.125]) if i % 50 else None, rnd.choice(["o1", "o2"]), float(at), float(at + rnd.choice([0, 3, 40, -1])), at, at + rnd.randrange(5), at + 5 + rnd.randrange(9)))
    return out


EVENTS = "event_id bigint, host string, kind string, seconds double, stage string, model string, cost double, owner string, started double, finished double, queued bigint, began bigint, ended bigint"


def state(ledger):
    return {name: sorted(map(str, (tuple(r) for r in df.collect()))) for name, df in telemetry.summaries(ledger).items()}


def test_batches_fold_to_what_all_events_give(spark, folder):
    rows = run_rows(300)
    whole, parts = stores.Ledger(spark, f"{folder}/whole"), stores.Ledger(spark, f"{folder}/parts")
    assert whole.batch() == -1 and telemetry.apply_batch(whole, spark.createDataFrame(rows, EVENTS), 0)
    for i in range(4):
        assert telemetry.apply_batch(parts, spark.createDataFrame(rows[75 * i : 75 * i + 75], EVENTS), i)
    before = state(parts)
    assert before == state(whole) and parts.batch() == 3
    # a batch that counted changes nothing, nor does what a failed attempt left
    assert not telemetry.apply_batch(parts, spark.createDataFrame(rows[:75], EVENTS), 3) and state(parts) == before
    spark.range(3).write.parquet(f"{folder}/parts/v=4/hosts")
    assert telemetry.apply_batch(parts, spark.createDataFrame([], EVENTS), 4) and state(parts) == before
    assert sorted(x for x in os.listdir(f"{folder}/parts") if x.startswith("v=")) == ["v=3", "v=4"]


def test_stretches_of_spans_by_brute_force(spark, folder):
    rows = run_rows(200, 3)
    covered = {}
    for r in rows:
        if r[9] >= r[8]:
            covered.setdefault(r[7], []).append((r[8], r[9]))
    want = {}
    for owner, spans in covered.items():
        total, end = 0.0, float("-inf")
        for a, b in sorted(spans):
            total += max(0.0, b - max(a, end))
            end = max(end, b)
        want[owner] = (len(spans), sum(b - a for a, b in spans), total)
    ledger = stores.Ledger(spark, f"{folder}/l")
    for i in range(3):
        telemetry.apply_batch(ledger, spark.createDataFrame(rows[70 * i : 70 * i + 70], EVENTS), i)
    assert {r.owner: (r.n_spans, r.sum_seconds, r.union_seconds) for r in telemetry.summaries(ledger)["spans"].collect()} == want


def test_spans_are_merged_by_one_sort_unless_their_owner_is_hot(spark, monkeypatch):
    rnd = random.Random(7)
    # one owner has most spans, many of them at one start; null is an owner too
    starts = [(rnd.choice(["hot", "hot", "hot", "b", "c", None]), float(rnd.choice([50, rnd.randrange(400)]))) for _ in range(400)]
    rows = [(o, a, a + rnd.choice([0.0, 1.0, 2.0, 9.0])) for o, a in starts]
    made = spark.createDataFrame(rows, "owner string, started double, finished double").repartition(3).select("*", F.lit(1).cast("bigint").alias("n"), (F.col("finished") - F.col("started")).alias("seconds"), (F.col("finished") - F.col("started")).alias("longest"))
    want = {}
    for o, a, b in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        own = want.setdefault(o, [])
        if not own or a > own[-1][1]:
            own.append([a, b, 0, 0.0, 0.0])
        last = own[-1]
        last[1:] = [max(last[1], b), last[2] + 1, last[3] + b - a, max(last[4], b - a)]
    want = sorted((str(o), *x) for o, own in want.items() for x in own)
    shown = lambda df: sorted((str(r.owner), r.started, r.finished, r.n, r.seconds, r.longest) for r in df.collect())
    plain = telemetry.merged_spans(made)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert shown(plain) == want and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    ranged, hot_spans = [], telemetry.hot_spans
    monkeypatch.setattr(telemetry, "hot_spans", lambda rows: (ranged.append({r.owner for r in rows.select("owner").distinct().collect()}), hot_spans(rows))[1])
    assert shown(telemetry.merged_spans(made, 1)) == want and ranged == [{"hot"}]
    lone = made.filter("owner is null")
    assert shown(telemetry.merged_spans(lone, 1)) == [x for x in want if x[0] == "None"] and ranged[1:] == [{None}]
    assert telemetry.merged_spans(made.limit(0), 1).collect() == []


def test_a_batch_of_telemetry_is_read_by_many_tasks(spark, monkeypatch):
    from quarrylight.plans import feeds

    seen, fold = [], telemetry.apply_batch

    def counted(ledger, events, batch):
        seen.append((batch, events.count(), events.select(F.input_file_name()).distinct().count()))
        return fold(ledger, events, batch)

    monkeypatch.setattr(telemetry, "apply_batch", counted)
    feeds.stream_telemetry(spark, "/root/testdata/sf0.01")
    first = seen[:-1]  # the last one is sent again
    assert [b for b, *_ in first] == [0, 1, 2] and sum(n for _, n, _ in first) == 10_000
    assert all(n > 2_000 and files >= 16 for _, n, files in first)


# emission


def test_state_of_emission_falls_as_time_goes_on(spark, folder):
    day = 24 * 3600
    for k in range(4):
        rows = [(k * 10 * day + i, f"key{k}-{i % 20}") for i in range(40)]
        if k == 3:
            rows += [(5, "key0-5"), (5, "late")]  # behind the watermark
        spark.createDataFrame(rows, "s bigint, key string").select(F.timestamp_seconds("s").alias("at"), "key").coalesce(1).write.parquet(f"{folder}/in/{k}")
    stream = spark.readStream.schema("at timestamp, key string").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{folder}/in/*")
    emitted = []
    progress = stores.run_through(S.emit_once_within(stream, ["key"], "at", "2 days"), lambda b, i: emitted.extend(r.key for r in b.collect()), f"{folder}/state")
    assert sorted(k for k in emitted if k != "late") == sorted(f"key{k}-{i}" for k in range(4) for i in range(20))
    batches = S.late_rows(progress)
    assert max(n for _, n, _ in batches) <= 41 and batches[-1][1] < 40  # not the 80 keys of all batches
    assert sum(late for *_, late in batches) >= 1
