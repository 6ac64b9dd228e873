"""Merkle manifest of a dataset: a hash tree per group, a tree over the groups' roots, and a proof for every row.

Each row becomes a leaf, a hash of its columns; only ids and hashes are shuffled, never texts. Leaves get their places in
their group from ranges of (group, order): rows are range-partitioned and written once, counted per group and range, and numbered by a window
inside a range on top of the counts before it. So a group that holds a third of all rows is many ranges, not one task.

The levels are built by windows: a window partitioned by group and parent place, ordered by place, collects over its full
frame the hashes of at most ``FAN`` nodes. That list is the parent's preimage and holds the siblings of each node; the first node of each
window keeps it as the one row of the parent. Parents are written to the shared folder, an eighth of the rows a level, so the
number of levels is the logarithm of the number of rows and a lost executor costs one level. A tree ends where one node is left in its
group. The roots of the groups, in the order of their names, make a tree in the same way.

Proofs go down again: a parent's row hands its children the list and the path above it, so each level is one join
of an eighth of the rows below it. Under the root of a group the path goes on with the group's place in the upper tree. Folding a leaf with its
path is an aggregate over an array of one entry a level.

Cases: null columns are hashed as ``-``. A null group is a group and comes first, and null orders come first. Rows of one order go by their leaves; equal
rows are leaves of their own, told apart by nothing but their place. A group of one row has no level of its own, and a table of one row has its leaf as root. An
empty table gives an empty one. Only the id, the group and the results come back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, fold, materialize

FAN = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = "struct<before: string, after: string>"


def framed(value: Column) -> Column:
    """A value with its length in bytes in front; - if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def joined_hash(hashes: Column) -> Column:
    return F.sha2(F.array_join(hashes, ""), 256)


def with_places(nodes: DataFrame, group: str, order: list[str]) -> DataFrame:
    """nodes with __place (from 0, in its group by order) and __n (rows of the group), written once."""
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # equal rows go to several ranges by a number that a second reading of the same splits gives again
    dealt = nodes.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(n, group, *[F.asc_nulls_first(c) for c in order], "__row")
    ranged = materialize(dealt.withColumn("__range", F.spark_partition_id()), "manifest-ranges")
    counts = ranged.groupBy(group, "__range").agg(F.count(F.lit(1)).alias("__in"))
    # one row per group and range
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    starts = counts.withColumns({"__start": F.coalesce(F.sum("__in").over(before), F.lit(0)), "__n": F.sum("__in").over(whole)}).drop("__in")
    own = Window.partitionBy(group, "__range").orderBy(*[F.asc_nulls_first(c) for c in order], "__row")
    numbered = ranged.withColumn("__at", F.row_number().over(own) - 1)
    return numbered.join(starts, [group, "__range"]).withColumn("__place", F.col("__start") + F.col("__at")).drop("__range", "__row", "__start", "__at")


def parents_of(nodes: DataFrame, group: str) -> DataFrame:
    """The parents of the nodes of all groups that have more than one: group, __place, __n, __hash and the list __kids they hash."""
    run = Window.partitionBy(group, F.expr(f"__place div {FAN}")).orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = nodes.filter("__n > 1").select(group, "__place", "__n", F.collect_list("__hash").over(run).alias("__kids")).filter(f"__place % {FAN} = 0")
    return heads.select(group, F.expr(f"__place div {FAN}").alias("__place"), F.expr(f"(__n + {FAN - 1}) div {FAN}").alias("__n"), joined_hash(F.col("__kids")).alias("__hash"), "__kids")


def levels_above(nodes: DataFrame, group: str) -> list[DataFrame]:
    """The levels above the nodes (group, __place, __n, __hash), each written once."""
    most, levels = nodes.agg(F.max("__n")).first()[0] or 0, []
    while most > 1:
        levels.append(materialize(parents_of(levels[-1] if levels else nodes, group), "manifest-level"))
        most = -(-most // FAN)
    return levels


def roots_of(nodes: DataFrame, levels: list[DataFrame], group: str) -> DataFrame:
    """group and __hash of the one node that is left of each group."""
    found = None
    for level in [nodes, *levels]:
        top = level.filter("__n = 1").select(group, "__hash")
        found = top if found is None else found.unionByName(top)
    return found


def with_paths(nodes: DataFrame, levels: list[DataFrame], group: str, above: DataFrame | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """nodes with __path, the hashes before and after a node and each of its ancestors.

    above has a row per group: __path from the root of the group on, and the columns carried, which the nodes get too.
    Without it paths end at the roots of the groups.
    """
    empty = F.array().cast(f"array<{STEP}>")
    # the place above the root of a group is -1
    tops = None if above is None else above.select(group, F.lit(-1).cast("long").alias("__up"), F.lit(None).cast("array<string>").alias("__list"), F.col("__path").alias("__rest"), *carried)
    upper = None
    for level in [*reversed(levels), nodes]:
        known = [x for x in (tops, upper) if x is not None]
        if not known:
            found = level.withColumn("__path", empty)
        else:
            up = known[0] if len(known) == 1 else known[0].unionByName(known[1])
            found = level.withColumn("__up", F.when(F.col("__n") == 1, F.lit(-1)).otherwise(F.expr(f"__place div {FAN}"))).join(up, [group, "__up"], "left")
            at = F.expr(f"cast(__place % {FAN} as int)")
            step = F.struct(F.array_join(F.slice("__list", F.lit(1), at), "").alias("before"), F.array_join(F.slice("__list", at + 2, F.lit(FAN)), "").alias("after"))
            rest = F.coalesce("__rest", empty)
            found = found.withColumn("__path", F.when(F.col("__list").isNull(), rest).otherwise(F.concat(F.array(step), rest))).drop("__up", "__list", "__rest")
        if level is not nodes:
            upper = found.select(group, F.col("__place").alias("__up"), F.col("__kids").alias("__list"), F.col("__path").alias("__rest"), *carried)
    return found


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_hash(path: Column) -> Column:
    """The hash of all siblings of a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def merkle_manifest(rows: DataFrame, id_col: str, group_col: str, leaf: Column, claimed: Column | None = None) -> DataFrame:
    """id, group, leaf, claimed, subroot, root, path (array of before and after), proof_sha256 and folded_root of each row.

    Leaves are ordered by id in their group. claimed is the leaf that is put to the proof in place of the true one (null: the true
    one); the row is verified where folded_root equals root.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-"))  # orders as the group does, null first
    other = F.lit(None).cast("string") if claimed is None else claimed
    # the one pass over the rows themselves; ranges are sampled from this
    hashed = materialize(rows.select(group.alias("__group"), F.col(id_col).alias("__id"), leaf.alias("__hash"), other.alias("__claimed")), "manifest-rows")
    nodes = materialize(with_places(hashed, "__group", ["__id", "__hash"]), "manifest-leaves")
    levels = levels_above(nodes, "__group")
    groups = materialize(with_places(roots_of(nodes, levels, "__group").withColumn("__tree", F.lit(0)), "__tree", ["__group"]), "manifest-groups")
    upper = levels_above(groups, "__tree")
    root = roots_of(groups, upper, "__tree").first()  # one row; none if there are no rows
    above = with_paths(groups, upper, "__tree").select("__group", "__path", F.col("__hash").alias("subroot"), F.lit(root and root["__hash"]).cast("string").alias("root"))
    proved = with_paths(nodes, levels, "__group", materialize(above, "manifest-above"), ("subroot", "root"))
    put = F.coalesce("__claimed", "__hash")
    return proved.select(
        F.col("__id").alias(id_col), F.when(F.col("__group") != "-", F.substr("__group", F.lit(2))).alias(group_col), F.col("__hash").alias("leaf"), put.alias("claimed"),
        "subroot", "root", F.col("__path").alias("path"), proof_hash(F.col("__path")).alias("proof_sha256"), folded(put, F.col("__path")).alias("folded_root"),
    )


def op13_merkle_manifest(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "n_chars", "text")
    first = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.when(fold("doc_id", 3) == 0, row_hash(*first, F.translate("text", UPPER, LOWER)))
    found = merkle_manifest(docs, "doc_id", "lang", row_hash(*first, F.col("text")), lowered)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


OP13_SQL = r"""
WITH RECURSIVE
bits AS (SELECT b, 0 AS k, b::BIGINT AS v FROM range(256) t(b)
  UNION ALL SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
crc AS (SELECT doc_id, 1 AS i, 4294967295 AS c FROM documents
  UNION ALL SELECT doc_id, i + 1, xor(c // 256, v) FROM crc JOIN bits ON k = 8 AND b = xor(c % 256, ascii(substr(doc_id::VARCHAR, i, 1))) WHERE i <= length(doc_id::VARCHAR)),
h AS (SELECT doc_id, xor(max_by(c, i), 4294967295) AS h FROM crc GROUP BY doc_id),
d AS (SELECT doc_id, lang, h % 3 = 0 AS hit,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
        text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents JOIN h USING (doc_id)),
l AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN hit THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS other FROM d),
t AS (SELECT 0 AS level, g, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY g) AS n, leaf AS h, doc_id FROM l
  UNION ALL SELECT level + 1, g, place // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY place)), NULL FROM t WHERE n > 1 GROUP BY level, g, place // 8),
s AS (SELECT g, level AS top, h FROM t WHERE n = 1),
u AS (SELECT 0 AS level, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n, h, g FROM s
  UNION ALL SELECT level + 1, place // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY place)), NULL FROM u WHERE n > 1 GROUP BY level, place // 8),
root AS (SELECT h AS root FROM u WHERE n = 1),
steps AS (
  SELECT a.doc_id, b.level, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place < a.place // pow(8, b.level)::BIGINT), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place > a.place // pow(8, b.level)::BIGINT), '') AS after
  FROM t a JOIN t b ON a.level = 0 AND a.g = b.g AND b.n > 1 AND b.place // 8 = a.place // pow(8, b.level + 1)::BIGINT GROUP BY a.doc_id, b.level
  UNION ALL
  SELECT l.doc_id, 1000 + b.level, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place < a.place // pow(8, b.level)::BIGINT), ''),
         coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (WHERE b.place > a.place // pow(8, b.level)::BIGINT), '')
  FROM l JOIN u a ON a.level = 0 AND a.g = l.g JOIN u b ON b.n > 1 AND b.place // 8 = a.place // pow(8, b.level + 1)::BIGINT GROUP BY l.doc_id, b.level),
ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS k FROM steps),
proofs AS (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM ordered GROUP BY doc_id),
f AS (SELECT doc_id, 0 AS k, coalesce(other, leaf) AS h FROM l
  UNION ALL SELECT doc_id, o.k, sha256(o.before || f.h || o.after) FROM f JOIN ordered o USING (doc_id) WHERE o.k = f.k + 1),
final AS (SELECT doc_id, max_by(h, k) AS folded FROM f GROUP BY doc_id)
SELECT l.doc_id, l.leaf, s.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM l JOIN s USING (g) JOIN final USING (doc_id) LEFT JOIN proofs USING (doc_id), root
"""
QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLES = {"op13_merkle_manifest": OP13_SQL}
