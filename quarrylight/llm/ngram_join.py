"""N-gram Jaccard self-join: MinHash banding proposes, full n-gram sets decide.

Words are runs of letters and digits of the lower-cased text; a document's set holds the 64-bit hashes of its
five-word shingles (a text of one to four words has one shingle). ``choose_bands`` picks the rows of a band and the
number of bands for a target recall at the threshold. Then:

1. One pass over the texts gives each row the hash of its whole set, its band hashes and a sketch (a byte of each
   min-hash). Rows with equal sets are one node, so copies are never compared.
2. Nodes are shuffled on band hashes. Inside a bucket the sketches of its pairs are compared; a pair agrees if its
   sketches do in so many places that a pair at the threshold falls short once in 30,000. A bucket returns a star for
   each group that agreeing pairs connect, never its pairs; one of over ``BUCKET`` nodes is dealt to pairs of parts.
   The components of the stars are the groups to verify: texts that only share a band by chance don't tie groups together.
3. Only nodes in such groups get their full sets. Nodes stand in blocks of bounded count and size, ordered by group
   and band hash; a pair of blocks is compared where some bucket reaches into both, as a task of its own, which counts
   intersections on bitsets. It returns each node's number of links and a star for each group of linked nodes.
4. The components of these verified links are the classes.

Cases: a null text counts as empty; a text without a word has no links and is a class of its own. Each row has the class
of its own text, also where rows share an id; ``n_links`` and ``class_size`` count rows. Rows without an id come back
with null class and no links. Ties: the class is named by its least id; ``first`` marks the rows of that id
and, where texts of one id are in one class, of the text with the least hash. An empty table gives an empty one. Other
columns pass through.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, materialize
from .graph import connected_components

WORD = re.compile(r"[^\W_]+")
N_WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
BLOCK_NODES, BLOCK_SHINGLES, BUCKET = 512, 500_000, 1024
WORDS_KEPT = 100_000  # word hashes that a task remembers; beyond that it starts anew


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): the longest band with which so many hashes still reach the recall at the threshold."""
    best = (max_hashes, 1)
    for rows in range(1, 33):
        p = threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log(1 - p)) if p < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


class _Words(dict):
    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, n: int = N_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of a text; empty if it has no word."""
    found = WORD.findall((text or "").lower())
    w = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    if not len(w):
        return w
    k = min(n, len(w))
    h = np.zeros(len(w) - k + 1, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - k + 1 + i]
    return np.unique(_mix(h + np.uint64(k)))


def _min_hashes(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    short, least = (sets >> np.uint64(32)).astype(np.uint32), np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(short), 4096):  # a very long text goes through in slices
        np.minimum(least, (short[i : i + 4096, None] * a + b).min(axis=0), out=least)
    return least


def agreement(m: int, threshold: float) -> int:
    """How many of m min-hashes a pair has in common at least: four deviations under what the threshold lets expect."""
    return max(1, math.floor(m * threshold - 4 * math.sqrt(m * threshold * (1 - threshold))))


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int) -> DataFrame:
    """__id, __h (hash of the text), __n (shingles), __set (hash of the set), __bands, __sketch; the last three are null if there is no word."""
    rng = np.random.default_rng(10)
    a = rng.integers(1, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    kind = docs.schema[id_col].dataType

    def sign(batches):
        for batch in batches:
            if len(_words) > WORDS_KEPT:
                _words.clear()
            ns, keys, found, sketches = [], [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py(), n)
                ns.append(len(s))
                if len(s):
                    keys.append(xxhash.xxh3_128_digest(s))
                    m = _mix(_min_hashes(s, a, b).astype(np.uint64)).reshape(bands, rows)
                    h = np.arange(bands, dtype=np.uint64)  # the band is part of its hash
                    for i in range(rows):
                        h = _mix(h * np.uint64(31) + m[:, i])
                    found.append(h.view(np.int64))
                    sketches.append(m.astype(np.uint8).tobytes())
                else:
                    keys.append(None)
                    found.append(None)
                    sketches.append(None)
            made = [pa.array(ns, pa.int32()), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["__id", "__h", "__n", "__set", "__bands", "__sketch"])
        _words.clear()

    texts = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__h"), F.col(text_col).alias("__text"))
    return texts.mapInArrow(sign, f"__id {kind.simpleString()}, __h bigint, __n int, __set binary, __bands array<bigint>, __sketch binary")


def with_sets(docs: DataFrame, n: int) -> DataFrame:
    """docs(__text, __set, rest) with __set_bytes, the sorted shingle hashes as bytes, in place of both; only rows whose text has that set."""
    rest = [f for f in docs.schema.fields if f.name not in ("__text", "__set")]
    at, key = docs.columns.index("__text"), docs.columns.index("__set")

    def fill(batches):
        for batch in batches:
            if len(_words) > WORDS_KEPT:
                _words.clear()
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                sets = [shingles(t.as_py(), n) for t in part.column(at)]
                same = pa.array([xxhash.xxh3_128_digest(s) == k.as_py() for s, k in zip(sets, part.column(key), strict=True)])
                made = pa.RecordBatch.from_arrays([*(part.column(f.name) for f in rest), pa.array([s.tobytes() for s in sets], pa.binary())], [*(f.name for f in rest), "__set_bytes"])
                yield made.filter(same)
        _words.clear()

    return docs.mapInArrow(fill, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest) + ", __set_bytes binary")


def stars(sketches: np.ndarray, least: int) -> np.ndarray:
    """For each row the first row that agreeing pairs connect it to."""
    root = np.arange(len(sketches))
    left = root.copy()
    while len(left) > 1:
        top, wave = left[0], [left[0]]
        left = left[1:]
        while wave and len(left):
            hit = (sketches[left] == sketches[wave.pop()]).sum(axis=1) >= least
            root[left[hit]] = top
            wave += left[hit].tolist()
            left = left[~hit]
    return root


def least_nodes(nodes: np.ndarray, root: np.ndarray) -> np.ndarray:
    """For each of the nodes the least node of those that have the same root."""
    top = nodes.copy()
    np.minimum.at(top, root, nodes)
    return top[root]


def contracted(edges: DataFrame, node: str, root: str) -> DataFrame:
    """Edges a, b with the components of the edges from nodes to the roots of their stars: a node and all its roots go to the least of them.

    A node has a root per bucket or pair of blocks that it is in; the nodes of a large group share theirs, so that few edges are left.
    """
    each = edges.filter(F.col(node) != F.col(root)).groupBy(node).agg(F.collect_set(root).alias("__roots"))
    ends = each.select(F.explode(F.array_append("__roots", F.col(node))).alias("a"), F.least(F.array_min("__roots"), F.col(node)).alias("b"))
    return ends.filter("a <> b").distinct()


def bucket_ties(members: DataFrame, least: int) -> DataFrame:
    """Edges a, b of the stars of members(__value, __i, __j, __node, __sketch), whose rows are dealt and sorted by the first three."""

    def runs(values: np.ndarray, nodes: np.ndarray, sketches: np.ndarray):
        starts = np.concatenate([[0], np.nonzero((values[1:] != values[:-1]).any(axis=1))[0] + 1])
        sizes = np.diff(np.append(starts, len(values)))
        two = starts[sizes == 2]
        two = two[(sketches[two] == sketches[two + 1]).sum(axis=1) >= least]
        a, b = [np.minimum(nodes[two], nodes[two + 1])], [np.maximum(nodes[two], nodes[two + 1])]
        for s, k in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            own = nodes[s : s + k]
            top = least_nodes(own, stars(sketches[s : s + k], least))
            some = top != own
            a.append(top[some])
            b.append(own[some])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (a, b)], ["a", "b"])

    def tie(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            now = (values, batch.column(3).to_numpy(), np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            now = now if held is None else tuple(map(np.concatenate, zip(held, now, strict=True)))
            # the last run may go on in the next batch
            cut = int(np.nonzero((now[0] != now[0][-1]).any(axis=1))[0][-1] + 1) if (now[0] != now[0][-1]).any() else 0
            held = tuple(x[cut:] for x in now)
            if cut:
                yield runs(*(x[:cut] for x in now))
        if held is not None:
            yield runs(*held)

    return members.mapInArrow(tie, "a bigint, b bigint")


def in_blocks(members: DataFrame) -> DataFrame:
    """members, which are ordered within their partitions, with __block: a number shared by at most BLOCK_NODES of them in a row."""
    at, names = members.columns.index("__n"), [*members.columns, "__block"]

    def number(batches):
        block, count, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            found = np.empty(batch.num_rows, np.int64)
            for k, n in enumerate(batch.column(at).to_numpy().tolist()):
                if count and (count == BLOCK_NODES or size + n > BLOCK_SHINGLES):
                    block, count, size = block + 1, 0, 0
                count, size, found[k] = count + 1, size + n, block
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names)

    return members.mapInArrow(number, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema.fields) + ", __block bigint")


def intersections(sets: list[np.ndarray]):
    """Yields (i, sizes of the intersections of set i with sets i+1...): bitsets over the shared shingles."""
    n = len(sets)
    if n == 2:
        yield 0, np.array([len(np.intersect1d(sets[0], sets[1], assume_unique=True))])
        return
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    code = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[at]
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    owner, code = owner[code >= 0], code[code >= 0]
    order = np.argsort(code, kind="stable")
    owner, code, step = owner[order], code[order], 1 << 13
    total = np.zeros((n, n), np.int32)
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, step):
        x, y = np.searchsorted(code, [lo, lo + step])
        flags = np.zeros((n, step), bool)
        flags[owner[x:y], code[x:y] - lo] = True
        bits = np.packbits(flags, axis=1).view(np.uint64)
        bits = bits[:, bits.any(axis=0)]
        for i in range(n - 1):
            total[i, i + 1 :] += np.bitwise_count(bits[i + 1 :] & bits[i]).sum(axis=1, dtype=np.int32)
    for i in range(n - 1):
        yield i, total[i, i + 1 :]


def linked(sets: list[np.ndarray], side: np.ndarray | None, threshold: float):
    """(i, j) index arrays of the pairs whose Jaccard reaches the threshold; with sides, only across them."""
    size = np.array([len(s) for s in sets], np.int64)
    a, b = [], []
    for i, inter in intersections(sets):
        # the ratio is compared as integers over a common base, as a division could round
        ok = inter * 10_000 >= round(threshold * 10_000) * (size[i] + size[i + 1 :] - inter)
        ok &= inter > 0
        if side is not None:
            ok &= side[i + 1 :] != side[i]
        j = np.nonzero(ok)[0] + i + 1
        a.append(np.full(len(j), i))
        b.append(j)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the first that the pairs connect it to."""
    top = list(range(n))

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            top[max(p, q)] = min(p, q)
    return np.array([find(x) for x in range(n)], int)


def block_pairs(members: DataFrame, banded: DataFrame) -> DataFrame:
    """__block, __pairs: the pairs (i, j) of blocks that a block is compared in, where a bucket of a group reaches into another block too."""
    wide = members.groupBy("component").agg(F.min("__block").alias("x"), F.max("__block").alias("y")).filter("x < y").select("component")
    spread = members.join(wide, "component").select("__node", "component", "__block")
    # a bucket gives as many rows as it has blocks, whatever their number of nodes
    touched = banded.join(spread, "__node").groupBy("component", "__value").agg(F.sort_array(F.collect_set("__block")).alias("__blocks")).filter(F.size("__blocks") > 1).select("__blocks").distinct()
    both = touched.select(F.explode("__blocks").alias("i"), "__blocks").select("i", F.explode("__blocks").alias("j")).filter("i < j").distinct()
    each = both.select(F.explode(F.array("i", "j")).alias("__block"), F.struct("i", "j").alias("__pair"))
    return each.groupBy("__block").agg(F.collect_list("__pair").alias("__pairs"))


def verified_links(full: DataFrame, threshold: float) -> DataFrame:
    """node, other, links: how many rows a node is linked to in a pair of blocks, and stars of the linked nodes (other not null)."""

    def verify(table: pa.Table) -> pa.Table:
        nodes, groups, copies, own = (table.column(c).to_numpy() for c in ("__node", "component", "__copies", "__block"))
        # repeated rows of a text hold its set more than once
        keep = np.unique(nodes, return_index=True)[1]
        keep = keep[np.argsort(groups[keep], kind="stable")]
        nodes, groups, copies, own = nodes[keep], groups[keep], copies[keep], own[keep]
        sets, across = table.column("__set_bytes"), table.column("i")[0].as_py() != table.column("j")[0].as_py()
        node, other, links = [], [], []
        for part in np.split(np.arange(len(nodes)), np.nonzero(groups[1:] != groups[:-1])[0] + 1):
            side = own[part]
            if len(part) < 2 or (across and (side == side[0]).all()):
                continue
            a, b = linked([np.frombuffer(sets[int(keep[k])].as_buffer(), np.uint64) for k in part], side if across else None, threshold)
            count, root = np.zeros(len(part), np.int64), roots(len(part), a, b)
            np.add.at(count, a, copies[part][b])
            np.add.at(count, b, copies[part][a])
            some = np.nonzero(count)[0]
            node.append(nodes[part[some]])
            other.append(least_nodes(nodes[part], root)[some])
            links.append(count[some])
        node, other, links = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (node, other, links))
        return pa.table({"node": pa.array(node, pa.int64()), "other": pa.array(other, pa.int64()), "links": pa.array(links, pa.int64())})

    return full.groupBy("i", "j").applyInArrow(verify, "node bigint, other bigint, links bigint")


def _classified(docs: DataFrame, id_col: str, text_col: str, n: int, threshold: float, recall: float) -> DataFrame:
    """docs with __k, __h (id and text hash, by which the rows are dealt), __class, __links, __size, __first; null where there is no class to find."""
    bands, rows = choose_bands(threshold, recall)
    signed = materialize(signatures(docs, id_col, text_col, n, bands, rows), "signatures")
    worded = signed.filter("__set is not null")
    # rows with equal sets are one node; its holder is a row that has the text
    nodes = worded.groupBy("__set").agg(F.min(F.struct("__id", "__h")).alias("__holder"), F.count(F.lit(1)).alias("__copies"), F.first("__n").alias("__n"), F.first("__bands").alias("__bands"), F.first("__sketch").alias("__sketch"))
    nodes = materialize(nodes.withColumn("__node", F.monotonically_increasing_id()), "nodes")
    banded = nodes.select("__node", F.explode("__bands").alias("__value"))
    buckets = banded.groupBy("__value").agg(F.count(F.lit(1)).alias("__in")).filter("__in > 1")
    shared = materialize(banded.join(buckets, "__value"), "shared-bands")
    parts = F.ceil(F.col("__in") / BUCKET).cast("int")
    dealt = shared.join(nodes.select("__node", "__sketch"), "__node").withColumn("__own", F.pmod(F.xxhash64("__node"), parts).cast("int")).withColumn("__other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select("__value", F.least("__own", "__other").cast("long").alias("__i"), F.greatest("__own", "__other").cast("long").alias("__j"), "__node", "__sketch")
    ties = bucket_ties(dealt.repartition("__value", "__i", "__j").sortWithinPartitions("__value", "__i", "__j"), agreement(bands * rows, threshold))
    groups = connected_components(contracted(ties, "b", "a"))
    members = groups.withColumnRenamed("node", "__node").join(nodes.select("__node", "__set", "__holder", "__copies", "__n", F.get("__bands", F.lit(0)).alias("__near")), "__node")
    members = materialize(in_blocks(members.repartitionByRange("component", "__near", "__node").sortWithinPartitions("component", "__near", "__node")), "members")
    texts = docs.select(F.col(id_col).alias("__k"), F.xxhash64(text_col).alias("__h"), F.col(text_col).alias("__text"))
    placed = members.join(block_pairs(members, shared.select("__node", "__value")), "__block", "left")
    held = texts.join(placed, (F.col("__k") == F.col("__holder.__id")) & (F.col("__h") == F.col("__holder.__h")))
    full = with_sets(held.select("__node", "component", "__copies", "__block", "__pairs", "__set", "__text"), n)
    own = F.array(F.struct(F.col("__block").alias("i"), F.col("__block").alias("j")))
    pairs = full.withColumn("__pair", F.explode(F.coalesce(F.concat(own, "__pairs"), own))).select("__node", "component", "__copies", "__block", "__pair.i", "__pair.j", "__set_bytes")
    found = materialize(verified_links(pairs, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("__links"))
    classes = connected_components(contracted(found, "node", "other"))
    named = nodes.select("__set", "__holder", F.col("__node").alias("node"), "__copies").join(links, "node", "left").join(classes, "node", "left").withColumn("__top", F.coalesce("component", "node"))
    tops = named.groupBy("__top").agg(F.min("__holder").alias("__least"), F.sum("__copies").alias("__size"))
    named = named.join(tops, "__top").select(F.col("__set").alias("__key"), "__least", (F.coalesce("__links", F.lit(0)) + F.col("__copies") - 1).alias("__links"), "__size")
    each = worded.select("__id", F.col("__h").alias("__t"), "__set").distinct().join(named, F.col("__set") == F.col("__key"))
    each = each.select("__id", "__t", F.col("__least.__id").alias("__class"), "__links", "__size", ((F.col("__id") == F.col("__least.__id")) & (F.col("__t") == F.col("__least.__h"))).alias("__first"))
    keyed = docs.withColumns({"__k": F.col(id_col), "__h": F.xxhash64(text_col)})
    return keyed.join(each, (F.col("__k") == F.col("__id")) & (F.col("__h") == F.col("__t")), "left")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """docs with class_id (least id of its near-duplicate class), n_links, class_size (in rows) and first (stands for its class)."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("class_id", "n_links", "class_size", "first")]
    return _classified(docs, id_col, text_col, n, threshold, recall).select(
        *rest, F.coalesce("__class", "__k").alias("class_id"), F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("class_size"), F.coalesce("__first", F.lit(True)).alias("first"),
    )


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N_WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The row that stands for each class, of rows repeated with id and text the least by the other columns. Rows without an id stay."""
    kept = _classified(docs.filter(F.col(id_col).isNotNull()), id_col, text_col, n, threshold, recall).filter(F.coalesce("__first", F.lit(True)))
    # dealt and sorted by the join already; a row repeated without end is one row after each task's own aggregation
    row = kept.groupBy("__k", "__h").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("__row"))
    return row.select("__row.*").unionByName(docs.filter(F.col(id_col).isNull()))


def op10_ngram_jaccard_join(spark, sf_dir):
    return jaccard_classes(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "class_id", "n_links", "class_size")


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END)) AS g FROM w WHERE len(ws) > 0),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
      FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE c * 10 >= 8 * (na + nb - c)),
r AS (SELECT a AS node, a AS other FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.other = l.a),
c AS (SELECT node, min(other) AS class_id, count(DISTINCT other) AS class_size FROM r GROUP BY node),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(k.n, 0) AS n_links, coalesce(c.class_size, 1) AS class_size
FROM documents d LEFT JOIN c ON c.node = d.doc_id LEFT JOIN k ON k.a = d.doc_id
"""
QUERIES = {"op10_ngram_jaccard_join": op10_ngram_jaccard_join}
ORACLES = {"op10_ngram_jaccard_join": OP10_SQL}
