"""The handoff between stages: what each company's stages have found so far, folded from their messages.

A company has three lists (results by source, candidate sites and gate decisions by URL) whose items are replaced in place and stand in the order of
first sight, two payloads that are replaced (deep parse, completion), and the row, type and time of its last message. Events of hosts are
ignored. ``handoff_fold`` is the batch form, ``handoff_stream`` the stateful one; both give the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: The list that a kind of message goes to with the field that names its item, and the payloads that are replaced.
LISTS = {"source_result_ready": ("source_results", "source"), "candidate_site_found": ("candidate_sites", "site_url"), "site_gate_decision": ("site_gate_decisions", "site_url")}
SINGLES = {"deep_parse_done": "deep_parse_done", "company_completed": "company_completed"}
ITEM = "struct<item_key: string, stage: string, ts: string, payload: string>"
ONE = "struct<stage: string, ts: string, payload: string>"
ROW = "inn string, row_index bigint, last_message_type string, last_message_ts string, " + ", ".join([*(f"{n} array<{ITEM}>" for n, _ in LISTS.values()), *(f"{n} {ONE}" for n in SINGLES.values())])


def with_items(messages: DataFrame) -> DataFrame:
    """The messages that count, with item_key: what names the list item (null: none, the message changes no list)."""
    key: Column = F.lit(None).cast("string")
    for kind, (_, field) in LISTS.items():
        key = F.when(F.col("message_type") == kind, F.trim(F.get_json_object("payload", f"$.{field}"))).otherwise(key)
    inn = F.trim("inn")
    rows = messages.filter((inn != "") & F.coalesce(F.trim("message_type") != "host_event", F.lit(True)))
    return rows.withColumns({"inn": inn, "message_type": F.coalesce(F.trim("message_type"), F.lit(""))}).withColumn("item_key", F.nullif(key, F.lit("")))


def handoff_fold(messages: DataFrame, *order: str) -> DataFrame:
    """One row per company of messages (inn, row_index, message_type, stage, ts, payload), in order.

    Messages are combined by (company, kind, item) before they meet at their company, so what meets there is as long as the result.
    """
    at = F.struct(*order)
    one = F.struct(F.coalesce("stage", F.lit("")).alias("stage"), F.coalesce("ts", F.lit("")).alias("ts"), "payload")
    items = with_items(messages).groupBy("inn", "message_type", "item_key").agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.max_by(one, at).alias("v"), F.max_by("row_index", F.when(F.col("row_index") > 0, at)).alias("row"), F.max(F.when(F.col("row_index") > 0, at)).alias("row_at"),
    )

    def listed(kind: str) -> Column:
        kept = F.collect_list(F.when((F.col("message_type") == kind) & F.col("item_key").isNotNull(), F.struct("first", F.struct("item_key", "v.stage", "v.ts", "v.payload").alias("x"))))
        return F.transform(F.array_sort(kept), lambda x: x["x"])

    lists = {name: listed(kind) for kind, (name, _) in LISTS.items()}
    singles = {name: F.max_by("v", F.when(F.col("message_type") == kind, F.col("last"))) for kind, name in SINGLES.items()}
    return items.groupBy("inn").agg(
        F.coalesce(F.max_by("row", "row_at"), F.lit(0)).cast("bigint").alias("row_index"), F.max_by("message_type", "last").alias("last_message_type"), F.max_by("v.ts", "last").alias("last_message_ts"),
        *[v.alias(k) for k, v in (lists | singles).items()],
    )


def last_of_each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each company, kind and item of a record batch the last message, with the place of the first: what a batch sends of a hot company is as long as its items."""
    by = ["inn", "message_type", "item_key"]
    for pdf in batches:
        pdf = pdf.sort_values(["o1", "o2"], kind="stable")
        groups = pdf.groupby(by, dropna=False, sort=False)
        pdf["f1"], pdf["f2"] = groups["o1"].transform("first"), groups["o2"].transform("first")
        known = pdf["row_index"].where(pdf["row_index"] > 0)
        pdf["row_index"] = known.groupby([pdf[c] for c in by], dropna=False, sort=False).ffill()
        # the place of the row that names row_index, as a later message without one doesn't hide it
        pdf["r1"], pdf["r2"] = (pdf[c].where(known.notna()).groupby([pdf[b] for b in by], dropna=False, sort=False).ffill() for c in ("o1", "o2"))
        yield pdf.drop_duplicates(by, keep="last")


#: The state of a company: its head, and each list and payload as the JSON of what ROW has for it.
STATE = "row_index bigint, last_message_type string, last_message_ts string, " + ", ".join(f"{n} string" for n in [*(n for n, _ in LISTS.values()), *SINGLES.values()])
FOLDED = ("message_type", "item_key", "row_index", "ts", "stage", "payload", "o1", "o2", "f1", "f2", "r1", "r2")


def folded(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A company's row after a batch. Only the lists that the batch touches are parsed; all of a company's rows are plain values, as a frame per company costs more than its fold."""
    row_index, kind, ts, *kept = state.get if state.exists else (0, "", "", *["[]"] * len(LISTS), *[None] * len(SINGLES))
    kept = dict(zip([*LISTS, *SINGLES], kept, strict=True))
    rows = [dict(zip(FOLDED, x, strict=True)) for pdf in batches for x in zip(*(pdf[c].tolist() for c in FOLDED), strict=True)]
    rows.sort(key=lambda r: (r["o1"], r["o2"]))
    named = [r for r in rows if r["row_index"] == r["row_index"] and r["row_index"] is not None]
    if named:
        row_index = int(max(named, key=lambda r: (r["r1"], r["r2"]))["row_index"])
    kind, ts = rows[-1]["message_type"], rows[-1]["ts"]
    last, first = {}, {}
    for r in rows:
        last[r["message_type"], r["item_key"]] = r
        at = r["f1"], r["f2"]
        first[r["message_type"], r["item_key"]] = min(at, first.get((r["message_type"], r["item_key"]), at))
    for of in LISTS:
        touched = sorted((x for x in last if x[0] == of and x[1] is not None), key=first.get)
        if touched:
            held = {x["item_key"]: x for x in json.loads(kept[of])}
            held |= {x[1]: {"item_key": x[1]} | {c: last[x][c] for c in ("stage", "ts", "payload")} for x in touched}
            kept[of] = json.dumps([*held.values()], ensure_ascii=False)
    for of in SINGLES:
        if found := [r for r in rows if r["message_type"] == of]:
            kept[of] = json.dumps({c: found[-1][c] for c in ("stage", "ts", "payload")}, ensure_ascii=False)
    state.update((row_index, kind, ts, *kept.values()))
    yield pd.DataFrame([(key[0], row_index, kind, ts, *kept.values())], columns=["inn", *(f.split()[0] for f in STATE.split(", "))])


def handoff_stream(messages: DataFrame, first: str, second: str) -> DataFrame:
    """The rows of handoff_fold for the companies that a batch touches, after it (update mode). first and second are the order of messages; batches come in order.

    What a task holds is a batch's items of one company and that company's row, which is also its state; the state comes and goes with the batches of Arrow, not by a call for each item.
    """
    text = ("ts", "stage")
    rows = with_items(messages).select(
        "inn", "message_type", "item_key", F.col("row_index").cast("double").alias("row_index"), *[F.coalesce(c, F.lit("")).alias(c) for c in text], "payload", F.col(first).alias("o1"), F.col(second).alias("o2"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    fields = [*rows.schema.fieldNames(), "f1", "f2", "r1", "r2"]
    schema = ", ".join(f"{c} {kinds.get(c) or kinds[{'f': 'o', 'r': 'o'}[c[0]] + c[1]]}" for c in fields)
    combined = rows.mapInPandas(lambda batches: (pdf[fields] for pdf in last_of_each(batches)), schema)
    found = combined.groupBy("inn").applyInPandasWithState(folded, f"inn string, {STATE}", STATE, "update", GroupStateTimeout.NoTimeout)
    whole = {n: f"array<{ITEM}>" for n, _ in LISTS.values()} | dict.fromkeys(SINGLES.values(), ONE)
    return found.withColumns({n: F.from_json(n, kind) for n, kind in whole.items()})
