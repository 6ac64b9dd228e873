"""Line dedup: shared lines stay only in the last document that holds them. DataFrame functions only.

Every line of at least ``min_chars`` gets a 128-bit hash of its key (the line stripped of blanks, A-Z lower-cased).
The hashes, without text, are range-partitioned by (hash, salt) and sorted by document and position within that;
a window streams over each run, marks the first occurrence of each document and so counts documents. The salt
cuts a line that a third of the corpus holds into as many parts as a shuffle has partitions, whose sums are merged per hash. Lines that
lose become bits of sparse 64-line words, collected to one keep bitmap per document; only the last step, which
applies the bitmaps, moves text, once.

Cases: a null text counts as the empty text, which has one empty line. Repeated rows of a document are one
document: they share its bitmap, and all lose or keep the same lines. Rows that share an id but not the text keep
bitmaps of their own. Rows without an id count as no document: their lines don't count and aren't dropped. An
empty table gives an empty one. Other columns pass through; working columns have a ``__`` prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, documents, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20) -> DataFrame:
    """One row per line whose key is long enough: __h, __g (its hash), __id, __t (the text's hash), __pos."""
    exploded = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__t"), F.posexplode(split_lines(F.col(text_col))).alias("__pos", "__line")
    )
    key = F.btrim(F.col("__line"), F.lit(BLANKS))
    keyed = exploded.filter(F.char_length("__line") >= min_chars).filter(F.char_length(key) >= min_chars).withColumn("__key", F.translate(key, UPPER, LOWER))
    return keyed.select(F.xxhash64("__key").alias("__h"), F.xxhash64(F.lit("second"), F.col("__key")).alias("__g"), "__id", "__t", "__pos")


def shared_keys(lines: DataFrame, min_docs: int = 3) -> DataFrame:
    """The hashes that at least min_docs documents hold, with the largest of their ids as __last."""
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("__id"), F.lit(n)).cast("int").alias("__salt")
    run = Window.partitionBy("__h", "__g", "__salt").orderBy(F.desc("__id"), "__pos")
    first = F.lag("__id").over(run).isNull() | (F.lag("__id").over(run) != F.col("__id"))
    parts = (
        lines.select("__h", "__g", salt, "__id", "__pos")
        .repartitionByRange(n, "__h", "__g", "__salt")
        .withColumn("__first", first.cast("long"))
        .groupBy("__h", "__g", "__salt")
        .agg(F.sum("__first").alias("__n"), F.max("__id").alias("__last"))
    )
    return parts.groupBy("__h", "__g").agg(F.sum("__n").alias("__n"), F.max("__last").alias("__last")).filter(F.col("__n") >= min_docs).select("__h", "__g", "__last")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """__id, __t, keep_bitmap map<bigint, bigint> of each document that loses a line.

    Bit i % 64 of word i / 64 says whether line i stays; a word that the map lacks is all ones.
    """
    lines = materialize(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    # both sides of the join come from tables, so that adaptive execution can split the hash of a hot line
    shared = materialize(shared_keys(lines, min_docs), "shared-lines")
    lost = lines.join(shared, ["__h", "__g"]).filter(F.col("__id") != F.col("__last"))
    pos = F.col("__pos").cast("long")
    words = lost.groupBy("__id", "__t", F.floor(pos / 64).alias("__word")).agg(F.expr("~bit_or(shiftleft(1L, cast(__pos % 64 as int)))").alias("__bits"))
    return words.groupBy("__id", "__t").agg(F.map_from_entries(F.collect_list(F.struct("__word", "__bits"))).alias("keep_bitmap"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with its own columns and n_lines, n_dropped, keep_bitmap (null: every line stays), kept_text."""
    maps = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    joined = docs.withColumns({"__k": F.col(id_col), "__x": F.xxhash64(F.col(text_col))}).join(maps, (F.col("__k") == F.col("__id")) & (F.col("__x") == F.col("__t")), "left")
    lines = split_lines(F.col(text_col))
    # a dense array of the words makes the test of each line one look-up
    dense = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 64).cast("int")), lambda k: F.coalesce(F.element_at("keep_bitmap", k.cast("long")), F.lit(-1).cast("long")))
    joined = joined.withColumn("__dense", F.when(F.col("keep_bitmap").isNotNull(), dense))
    stays = F.expr("filter(split(coalesce(`{0}`, ''), '\\n', -1), (x, i) -> shiftrightunsigned(__dense[cast(i div 64 as int)], cast(i % 64 as int)) & 1L = 1L)".format(text_col.replace("`", "``")))
    lost = F.aggregate(F.map_values("keep_bitmap"), F.lit(0), lambda a, b: a + F.bit_count(F.bitwise_not(b)))
    out = joined.withColumns(
        {
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.coalesce(lost, F.lit(0)).cast("long"),
            "kept_text": F.when(F.col("keep_bitmap").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.concat_ws("\n", stays)),
        }
    )
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped", "keep_bitmap", "kept_text")], "n_lines", "n_dropped", "keep_bitmap", "kept_text")


def op7_line_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
e AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last AS lost FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
QUERIES = {"op7_line_dedup": op7_line_dedup}
ORACLES = {"op7_line_dedup": OP7_SQL}
