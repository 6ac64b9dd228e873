"""Periodic runs of words by Crochemore's partition refinement.

The positions of a text are classed by the factor (word sequence) of length l that starts there; l grows by one a step. Two
positions of a class stay together where the positions after them do, so the classes of length l + 1 follow from those of
length l alone. Where two neighbours in a class of length l are l apart, a square with a primitive root of l words stands at
the first; squares of one period at consecutive places are one run, and all runs with two periods or more are found so.

The first ``AT_ONCE`` lengths are refined for the documents of a slice together, by sorting the positions that still share a
class. What is left after that (long repeats and long periods) is refined document by document with the smaller-half strategy:
of the parts of a class that splits, only those apart from the largest split the classes before them in the next step, so a
position is moved at most log n times. Neighbours are kept in linked lists, and their distances in buckets that are looked
through when the length reaches them. The work is O(n log n) in a document of n words, whatever it repeats. Refinement ends at the longest period
that a run of the wanted exponent can have.

Spark deals the documents; a slice of a record batch holds a bounded number of bytes or one document, so memory is bounded by
the longest document. Nothing is shuffled.

Cases: a null or empty text, or one of blanks, has no words and no run. A null id plants nothing. Repeated rows give equal
results. Ties for the longest run go to the least start, then the least period. An empty table gives an empty one. Other
columns pass through, apart from those with the names of the results.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

AT_ONCE = 8  # lengths that are refined for a whole slice by sorting
SLICE_BYTES = 4 << 20  # text in a slice; a longer document is a slice of its own
LEAST_WORDS, LEAST_EXPONENT = 6, 4


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Where groups of equal neighbours begin."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


class Refinement:
    """Squares of the texts of a slice: start (in the slice) and period of each square with a primitive root of up to limits[d] words."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, limits: np.ndarray):
        self.sizes, self.limits = sizes, limits
        # a place of its own after each text ends the factors that would reach beyond it
        self.begin = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.doc = np.repeat(np.arange(len(sizes)), sizes + 1)
        self.word = np.full(int(self.begin[-1]), -1, np.int64)
        inside = np.ones(len(self.word), bool)
        inside[self.begin[1:] - 1] = False
        self.word[inside] = ids
        self.starts: list[np.ndarray] = []
        self.periods: list[np.ndarray] = []

    def note(self, starts: np.ndarray, period: int) -> None:
        if len(starts):
            self.starts.append(starts)
            self.periods.append(np.full(len(starts), period, np.int64))

    def squares(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.word >= 0)
        order = at[np.argsort(self.doc[at] * (int(self.word.max(initial=0)) + 1) + self.word[at], kind="stable")]
        self.classes = np.arange(len(self.word), dtype=np.int64)
        self.named, length = len(self.word), 1
        keys = self.doc[order] * (int(self.word.max(initial=0)) + 1) + self.word[order]
        order, _, _ = self.split(order, keys)
        while len(order):
            self.note(order[:-1][(np.diff(order) == length) & (np.diff(self.classes[order]) == 0)], length)
            order = order[self.limits[self.doc[order]] > length]
            if not len(order):
                break
            before = self.classes[order]
            keys = before * self.named + self.classes[order + 1]
            sort = np.argsort(keys, kind="stable")
            order, parents, parts = self.split(order[sort], keys[sort], before[sort])
            length += 1
            if length == AT_ONCE:
                self.by_document(order, parents, parts, length)
                break
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *self.starts]), np.concatenate([none, *self.periods])

    def split(self, order: np.ndarray, keys: np.ndarray, parents: np.ndarray | None = None):
        """Name the groups of equal keys; gives the places that share a class still, and parents and starts of all groups."""
        first = group_starts(keys)
        counts = np.diff(np.append(first, len(order)))
        self.classes[order] = self.named + np.repeat(np.arange(len(first)), counts)
        self.named += len(first)
        return order[np.repeat(counts > 1, counts)], None if parents is None else parents[first], (order, first, counts)

    def by_document(self, shared: np.ndarray, parents: np.ndarray, parts, length: int) -> None:
        """Go on document by document. The parts of the last step, apart from the largest of each class, split the classes next."""
        if not len(shared):
            return
        order, first, counts = parts
        small = np.ones(len(first), bool)
        rank = np.lexsort((-counts, parents))
        small[rank[group_starts(parents[rank])]] = False
        left = np.flatnonzero(small)
        splits: dict[int, list[int]] = defaultdict(list)
        for d, k in zip(self.doc[order[first[left]]].tolist(), left.tolist(), strict=True):
            splits[d].append(k)
        sort = np.argsort(self.doc[shared], kind="stable")  # keeps classes and places in order
        shared = shared[sort]
        docs, ends = np.unique(self.doc[shared], return_index=True)
        for d, places in zip(docs.tolist(), np.split(shared, ends[1:]), strict=True):
            base = int(self.begin[d])
            lists = [(order[first[k] : first[k] + counts[k]] - base).tolist() for k in splits.get(d, ())]
            for period, starts in refine_by_halves(places - base, self.classes[places], lists, length, int(self.sizes[d]), int(self.limits[d])).items():
                self.note(np.array(starts, np.int64) + base, period)


def refine_by_halves(places: np.ndarray, classes: np.ndarray, small: list[list[int]], length: int, size: int, limit: int) -> dict[int, list[int]]:
    """Starts of squares by period, for periods from length to limit.

    places: those that share a class, ordered by class and place; small: the classes that split others next.
    """
    one, same = places.tolist(), np.diff(classes) == 0
    nums = np.cumsum(np.concatenate([[True], ~same])) - 1
    of, after, before = [-1] * (size + 1), [-1] * (size + 1), [-1] * (size + 1)
    for i, c in zip(one, nums.tolist(), strict=True):
        of[i] = c
    near = np.flatnonzero(same)
    gaps: dict[int, list[int]] = defaultdict(list)
    for i, j in zip(places[near].tolist(), places[near + 1].tolist(), strict=True):
        after[i], before[j] = j, i
        if length <= j - i <= limit:
            gaps[j - i].append(i)
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    head, count = places[starts].tolist(), np.diff(np.append(starts, len(places))).tolist()
    found: dict[int, list[int]] = {}
    while True:
        # a distance in a bucket may have grown since
        hits = sorted({i for i in gaps.pop(length, ()) if after[i] - i == length})
        if hits:
            found[length] = hits
        if length >= limit or not small:
            # without a class to split by, nothing changes any more
            for period in sorted(g for g in gaps if length < g <= limit):
                hits = sorted({i for i in gaps[period] if after[i] - i == period})
                if hits:
                    found[period] = hits
            return found
        parts: dict[int, list[tuple[int, list[int]]]] = {}
        for members in small:
            made: dict[int, list[int]] = {}
            for i in members:
                j = i - 1
                c = of[j] if j >= 0 else -1
                if c < 0:
                    continue
                p, q = before[j], after[j]
                if p >= 0:
                    after[p] = q
                else:
                    head[c] = q
                if q >= 0:
                    before[q] = p
                    if p >= 0 and length < q - p <= limit:
                        gaps[q - p].append(p)
                count[c] -= 1
                after[j] = -1
                if c in made:
                    last = made[c][-1]
                    after[last], before[j] = j, last
                    if length < j - last <= limit:
                        gaps[j - last].append(last)
                    made[c].append(j)
                else:
                    before[j] = -1
                    made[c] = [j]
            for c, moved in made.items():
                new = len(head)
                head.append(moved[0])
                count.append(len(moved))
                parts.setdefault(c, []).append((new, moved))
                name = new if len(moved) > 1 else -1
                for j in moved:
                    of[j] = name
        small = []
        for c, new in parts.items():
            rest = count[c]
            largest = max(rest, max(count[d] for d, _ in new))
            keep_rest = rest == largest
            kept = keep_rest
            for d, moved in new:
                if not kept and count[d] == largest:
                    kept = True
                else:
                    small.append(moved)
            if rest == 1:
                of[head[c]] = -1
            if rest and not keep_rest:
                moved, j = [], head[c]
                while j >= 0:
                    moved.append(j)
                    j = after[j]
                small.append(moved)
        length += 1


def merged_runs(starts: np.ndarray, periods: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs: squares of one period at consecutive places are one."""
    order = np.lexsort((starts, periods))
    starts, periods = starts[order], periods[order]
    if not len(starts):
        return starts, starts, periods
    first = np.flatnonzero(np.concatenate([[True], (np.diff(periods) != 0) | (np.diff(starts) != 1)]))
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], starts[last] - starts[first] + 2 * periods[first], periods[first]


def planted(ids: np.ndarray, doc_id: int | None) -> np.ndarray:
    """For one id in ten the words from a place on repeat a part of the text; the rule of the query."""
    h, n = zlib.crc32(str(doc_id).encode()), len(ids)
    if doc_id is None or h % 10 or not n:
        return ids
    g = h // 10
    a = g % n
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return ids[at]


def runs_of_texts(texts: list[str | None], plant: list | None = None, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT):
    """For each text its words (of what plant makes of them, by id), and start, length and period of its runs by start and period."""
    split = [(t or "").encode().split() for t in texts]
    flat = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode()
    names, ids = flat.dictionary.to_pylist(), flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.array([len(w) for w in split], np.int64)
    each = np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else []
    if plant is not None:
        each = [planted(x, d) for x, d in zip(each, plant, strict=True)]
        ids = np.concatenate(each) if each else ids
    refined = Refinement(ids, sizes, sizes // least_exponent)
    start, length, period = merged_runs(*refined.squares())
    long = length >= np.maximum(least_words, least_exponent * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    cuts = np.searchsorted(start, refined.begin)
    for d, own in enumerate(each):
        a, b = cuts[d], cuts[d + 1]
        yield own, names, start[a:b] - refined.begin[d], length[a:b], period[a:b]


def collapsed(own: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The words that stay: none that a run holds after its first period."""
    if not len(start):
        return own
    change = np.zeros(len(own) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return own[np.cumsum(change[:-1]) == 0]


def slices(column: pa.Array, most: int = SLICE_BYTES):
    """(offset, rows) of slices of a text column with about that many bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > most:
            yield begin, i - begin
            begin, total = i, 0
        total += size
    yield begin, len(sizes) - begin


MADE = {"n_words": "bigint", "runs": "array<struct<start: bigint, length: bigint, period: bigint>>", "collapsed_text": "string"}


def periodic_runs(docs: DataFrame, text_col: str = "text", plant_col: str | None = None, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT, keep_text: bool = True) -> DataFrame:
    """docs with n_words, runs (by start, then period) and collapsed_text (the words outside repeats, joined by one blank).

    A run has at least least_words words and least_exponent (2 or more) periods. plant_col names an integer id by which ``planted``
    changes the words first. Without keep_text the text doesn't come back from the Python workers.
    """
    if least_exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    fields = [f for f in docs.schema.fields if f.name not in MADE]
    docs = docs.select(*[F.col(f"`{f.name}`") for f in fields])
    names = [f.name for f in fields]
    back = [i for i, f in enumerate(fields) if keep_text or f.name != text_col]
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches):
        for whole in batches:
            text_at, plant_at = names.index(text_col), None if plant_col is None else names.index(plant_col)
            for offset, rows in slices(whole.column(text_at)):
                batch = whole.slice(offset, rows)
                plant = None if plant_at is None else batch.column(plant_at).to_pylist()
                sizes, ends, texts, parts = [], [0], [], []
                for own, vocabulary, start, length, period in runs_of_texts(batch.column(text_at).to_pylist(), plant, least_words, least_exponent):
                    sizes.append(len(own))
                    ends.append(ends[-1] + len(start))
                    parts.append((start, length, period))
                    texts.append(b" ".join(map(vocabulary.__getitem__, collapsed(own, start, length, period).tolist())).decode())
                columns = [pa.array(np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64), pa.int64()) for k in range(3)]
                runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=[*kinds.value_type]))
                yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in back), pa.array(sizes, pa.int64()), runs, pa.array(texts, pa.string())], [*(names[j] for j in back), *MADE])

    return docs.mapInArrow(work, ", ".join([*(f"`{fields[j].name}` {fields[j].dataType.simpleString()}" for j in back), *(f"{k} {v}" for k, v in MADE.items())]))


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(documents(spark, sf_dir).select("doc_id", "text"), plant_col="doc_id", keep_text=False)
    best = F.aggregate("runs", F.expr("cast(null as struct<start: bigint, length: bigint, period: bigint>)"), lambda a, r: F.when(a.isNull() | (r["length"] > a["length"]), r).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("__best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "__best.start", "__best.length", "__best.period",
        F.expr("(1000 * __best.length) div __best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
ORACLES = {}
