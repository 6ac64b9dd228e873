"""Token counts of fields or sections, from one encoding of the whole document.

A document is encoded once; the byte lengths of its tokens give their character spans, and these are joined to the
sections' spans by two binary searches per token over the sorted section starts. A token belongs to the section that
holds all its characters. One that crosses a boundary goes, by the stated rule, to the section with most of
its characters (``majority``; of equals, the earlier), to the first it touches (``first``) or to the last (``last``).
Encoding sections alone would count other tokens than the model sees; this doesn't. A token's characters are those that
its bytes touch; part of a character counts as the character.

Cases: a null or empty text has no tokens, and each of its sections counts 0. Sections are half-open spans of code points,
sorted, without overlap; null means none. Tokens outside all sections are counted as ``unassigned``. Empty sections
count 0. Strings of special tokens in a text are ordinary text. Repeated rows get equal results. An empty table
gives an empty one. Other columns pass through.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

RULES = ("majority", "first", "last")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Counter:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.sizes[i] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the tokens in code points."""
        sizes = self.sizes[self.encoding.encode_ordinary(text)]
        ends = np.cumsum(sizes)
        raw = np.frombuffer(text.encode(), np.uint8)
        if len(raw) == len(text):
            return ends - sizes, ends
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        return char[ends - sizes], char[ends - 1] + 1

    def count(self, text: str | None, starts: np.ndarray, stops: np.ndarray, rule: str) -> tuple[np.ndarray, int, int, int]:
        """(tokens of each section, all tokens, those that cross a boundary, those outside every section)."""
        counts = np.zeros(len(starts), np.int64)
        if not text:
            return counts, 0, 0, 0
        a, b = self.spans(text)
        # an empty section holds no character, so no token can be its own
        some = np.nonzero(starts < stops)[0]
        starts, stops = starts[some], stops[some]
        # the sections that a token touches are first to last: the first that ends after its start, the last that starts before its end
        first, last = np.searchsorted(stops, a, "right"), np.searchsorted(starts, b, "left") - 1
        touches = first <= last
        whole = touches & (first == last)
        inside = np.zeros(len(a), bool)
        inside[whole] = (starts[first[whole]] <= a[whole]) & (b[whole] <= stops[first[whole]])
        owner = np.where(touches, last if rule == "last" else first, -1)
        if rule == "majority":
            for t in np.nonzero(touches & (first < last))[0]:
                k = np.arange(first[t], last[t] + 1)
                owner[t] = k[np.argmax(np.minimum(b[t], stops[k]) - np.maximum(a[t], starts[k]))]
        np.add.at(counts, some[owner[owner >= 0]], 1)
        return counts, len(a), int((touches & ~inside).sum()), int((~touches).sum())


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, ranks_file: str, pattern: str, text_col: str = "text", sections_col: str | None = None, rule: str = "majority", keep_text: bool = True) -> DataFrame:
    """docs with section_tokens array<bigint>, n_tokens, n_crossing and n_unassigned.

    sections_col is array<struct<start int, stop int>>; without it each line with its newline is a section. Without
    keep_text the text doesn't come back from the Python workers.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    made = ("section_tokens", "n_tokens", "n_crossing", "n_unassigned")
    fields = [f for f in docs.schema.fields if f.name not in made]
    df = docs.select(*[F.col(f"`{f.name}`") for f in fields])
    at, cut = df.columns.index(text_col), df.columns.index(sections_col) if sections_col else None
    ranks = read_ranks(ranks_file)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))  # the vocabulary: a size that no corpus changes

    back = [i for i, f in enumerate(fields) if keep_text or i != at]

    def work(batches):
        if key not in _counters:
            _counters.clear()
            _counters[key] = Counter(*shared.value)
        counter = _counters[key]
        for whole in batches:
            for i in range(0, max(1, whole.num_rows), 512):
                batch = whole.slice(i, 512)
                rows = []
                for k, value in enumerate(batch.column(at)):
                    text = value.as_py() or ""
                    if cut is None:
                        stops = np.cumsum([len(x) + 1 for x in text.split("\n")])
                        stops[-1] -= 1
                        starts = np.concatenate([[0], stops[:-1]])
                    else:
                        given = batch.column(cut)[k].as_py() or []
                        starts, stops = np.array([x["start"] for x in given], np.int64), np.array([x["stop"] for x in given], np.int64)
                    rows.append(counter.count(text, starts, stops, rule))
                columns = [pa.array([r[0] for r in rows], pa.list_(pa.int64())), *(pa.array([r[n] for r in rows], pa.int64()) for n in (1, 2, 3))]
                yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in back), *columns], [*(fields[j].name for j in back), *made])

    kinds = ["array<bigint>", "bigint", "bigint", "bigint"]
    return df.mapInArrow(work, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in (fields[j] for j in back)), *(f"{m} {k}" for m, k in zip(made, kinds, strict=True))]))


def count_field_tokens(docs: DataFrame, ranks_file: str, pattern: str, fields: list[str], separator: str = "\n", rule: str = "majority") -> DataFrame:
    """The same for the fields of a row, encoded as one text with a separator; a separator is outside every section."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields]
    spans, start = [], F.lit(0)
    for t in texts:
        stop = start + F.char_length(t)
        spans.append(F.struct(start.alias("start"), stop.alias("stop")))
        start = stop + len(separator)
    joined = docs.withColumns({"__joined": F.concat_ws(separator, *texts), "__spans": F.array(*spans)})
    return count_tokens(joined, ranks_file, pattern, "__joined", "__spans", rule).drop("__joined", "__spans")


def op3_token_counts(spark, sf_dir):
    import public_tokenizers

    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_text=False)
    return counted.select("doc_id", "n_tokens", F.size("section_tokens").cast("long").alias("n_sections"), "n_crossing", "n_unassigned", "section_tokens")


QUERIES = {"op3_token_counts": op3_token_counts}
ORACLES = {}
