"""Document fingerprints by SpotSigs: chains of content words after common-word anchors. DataFrame functions only.

The lower-cased text is cut into words (runs of letters and digits). Common words are anchors; so that tables and texts
of other languages have some too, the start of the text and words of four, eight, twelve... characters are as well, in any
text. The next ``CHAIN`` words that aren't common (at the end of the text: as many as are left), hashed, are an anchor's
signature, and a document's fingerprint is the set of its signatures. A text of common words only has one signature,
of all its words. An edit touches only the signatures of the anchors just before it.

``similar_pairs`` finds the pairs of the corpus whose sets reach a Jaccard: sets are partitioned by length, as bin k holds
lengths within a factor of the threshold, so that only the same and adjacent bins can match; within them candidates
share one of their rarest signatures, and the Jaccard is computed only where the ratio of lengths, which bounds it,
reaches the threshold. ``compare_edits`` compares given pairs: each document with an edit of itself and with its neighbour.

The neighbour by descending id comes from ranges of ids, cut at ids that exist: ranges of a thousand rows, of the root of the
number of rows where that is more, so that their number grows as the root. Each range is one window partition, which is
sorted and read in order, and the first row of a range goes to the range before it as well, so that no window spans the table
and each text is shuffled once.

Cases: a null text counts as empty. Equal texts have equal fingerprints, and two texts without any word too. Rows of
equal id are ordered by the hash of their text; rows without an id follow the smallest id. A table of one row is its
own neighbour. An empty table gives an empty one. Other columns pass through.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import STOP_WORDS, documents, materialize

CHAIN, EVERY, THRESHOLD = 2, 4, 0.8
RANGE_DOCS = 1000
HOT = 512  # sets that hold a signature, beyond which it takes two signatures to make a candidate


def anchor_pattern(words: list[str]) -> str:
    """An alternation that is entered by first letter, so that most words fail on one character."""
    by = defaultdict(list)
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        by[w[0]].append(w[1:])
    return "(?:" + "|".join(f"{k}(?:{'|'.join(v)})" for k, v in sorted(by.items())) + ")"


ANCHORS = anchor_pattern([w for line in STOP_WORDS for w in line.split()])
#: The common words of a run have the same chain, so a run is one anchor; that also keeps the look-ahead short.
RUN_PATTERN = "(?:# )++"
CHAIN_PATTERN = f"(?:#|(?<= )(?:[^# ]{{{EVERY}}})+)(?= ((?:# )?[^# ]+" + "(?: (?:# )?[^# ]+)?" * (CHAIN - 1) + "))"


def words_of(text: Column) -> Column:
    """The lower-cased words of a text, with a blank before and after each."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))


def with_signatures(df: DataFrame, text: Column, out: str) -> DataFrame:
    """df with out: the sorted distinct signatures (array<int>) of a text column."""
    df = df.withColumn("__words", words_of(text))
    marked = F.concat(F.lit("#"), F.regexp_replace("__words", f"(?<= ){ANCHORS}(?= )", "#"))
    marked = F.regexp_replace(marked, RUN_PATTERN, "# ")
    spots = F.transform(F.regexp_extract_all(marked, F.lit(CHAIN_PATTERN), F.lit(1)), lambda x: F.hash(F.replace(x, F.lit("# "), F.lit(""))))
    df = df.withColumn("__spots", F.array_sort(F.array_distinct(spots)))
    return df.withColumn(out, F.when(F.size("__spots") > 0, F.col("__spots")).otherwise(F.array(F.hash(F.trim("__words"))))).drop("__words", "__spots")


def fingerprint(signatures: Column) -> Column:
    """Eight hex digits for each signature, in order."""
    return F.array_join(F.transform(signatures, lambda x: F.right(F.concat(F.lit("0000000"), F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), F.lit(8))), "")


def length_bin(signatures: Column, threshold: float = THRESHOLD) -> Column:
    """Sets whose Jaccard reaches the threshold are in the same or in adjacent bins; a bin is wider by a hair, for rounding."""
    return F.floor(F.log(F.greatest(F.size(signatures), F.lit(1)).cast("double")) / F.lit(1e-9 - math.log(threshold))).cast("int")


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """The Jaccard of two sets; 0 where their lengths alone keep it under the threshold."""
    bound = F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return F.when(bound < threshold, F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def id_bounds(docs: DataFrame, id_col: str, n: int) -> list:
    """The largest ids of n ranges of ids, of about equal count, in order."""
    ranged = docs.select(id_col).filter(F.col(id_col).isNotNull()).repartitionByRange(n, id_col)
    return sorted(r["m"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.max(id_col).alias("m")).collect())


def with_next(docs: DataFrame, id_col: str, columns: dict[str, str], tie: Column, n: int | None = None) -> DataFrame:
    """docs with columns[c], the value of c in the next row by descending id (after the last: the first); n: how many ranges."""
    if n is None:
        rows = docs.count()
        n = max(1, round(rows / max(RANGE_DOCS, math.isqrt(rows))))
    bounds = id_bounds(docs, id_col, n)
    step = max(1, math.isqrt(len(bounds)))
    key, kind = F.col(id_col), docs.schema[id_col].dataType.simpleString()
    if bounds:
        listed = lambda found: F.from_json(F.lit(json.dumps([str(x) for x in found])), "array<string>").cast(f"array<{kind}>")
        every, tops = listed(bounds), listed(bounds[::step])
        # how many bounds are below the id, in two steps
        coarse = F.size(F.filter(tops, lambda b: b < key))
        fine = F.size(F.filter(F.slice(every, (F.col("__coarse") - 1) * step + 1, step), lambda b: b < key))
        ranged = docs.withColumn("__coarse", F.coalesce(F.when(key.isNotNull(), coarse), F.lit(0)))
        ranged = ranged.withColumn("__range", F.when(F.col("__coarse") == 0, 0).otherwise((F.col("__coarse") - 1) * step + fine)).drop("__coarse")
        first = F.coalesce(key == F.element_at(every, F.col("__range") + 1), F.lit(False))
    else:
        ranged, first = docs.withColumn("__range", F.lit(0)), F.lit(False)
    own = F.struct(F.col("__range").alias("r"), F.lit(False).alias("halo"))
    copy = F.struct(((F.col("__range") + 1) % F.lit(max(1, len(bounds)))).alias("r"), F.lit(True).alias("halo"))
    dealt = ranged.withColumn("__at", F.explode(F.when(first, F.array(own, copy)).otherwise(F.array(own))))
    dealt = dealt.withColumns({"__range": F.col("__at.r"), "__halo": F.col("__at.halo")}).drop("__at")
    run = Window.partitionBy("__range").orderBy("__halo", F.desc_nulls_last(id_col), tie)
    return dealt.withColumns({new: F.lead(c).over(run) for c, new in columns.items()}).filter(~F.col("__halo")).drop("__range", "__halo")


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with signatures, fingerprint, fingerprint_key (its digest) and length_bin; the operator on its own."""
    found = with_signatures(docs, F.col(text_col), "signatures").withColumn("fingerprint", fingerprint(F.col("signatures")))
    return found.withColumns({"fingerprint_key": F.md5(F.col("fingerprint").cast("binary")), "length_bin": length_bin(F.col("signatures"))})


def similar_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of different fingerprints whose sets reach the threshold: key_a, key_b, a, b (least ids that hold them), likeness.

    Documents of one fingerprint (``fingerprint_documents`` gives each document's key) stand behind one row. In order of
    rarity, two sets that reach the threshold share one of the first n - ceil(threshold n) + 1 signatures of
    either, and two of the first n - ceil(threshold n) + 2; so a signature that more than HOT sets hold only makes
    a candidate together with another one. Both rules are exact for thresholds above one half.
    """
    if not 0.5 < threshold <= 1:
        raise ValueError("threshold must be above 0.5 and at most 1")
    found = fingerprint_documents(docs.select(id_col, text_col), id_col, text_col).filter(F.col(id_col).isNotNull())
    nodes = found.groupBy("fingerprint_key").agg(F.min(id_col).alias("least"), F.first("signatures").alias("signatures"))
    nodes = materialize(nodes.withColumns({"n": F.size("signatures"), "bin": length_bin(F.col("signatures"), threshold)}), "fingerprints")
    each = nodes.select("fingerprint_key", "n", "bin", F.explode("signatures").alias("s"))
    held = each.groupBy("s").agg(F.count(F.lit(1)).alias("held"))
    # as long as a document's own set
    ordered = each.join(held, "s").groupBy("fingerprint_key", "n", "bin").agg(F.array_sort(F.collect_list(F.struct("held", "s"))).alias("rare"))
    first = F.col("n") - F.ceil(F.round(F.col("n") * threshold, 6)).cast("int") + 1
    cold = F.transform(F.filter(F.slice("rare", F.lit(1), first), lambda x: x["held"] <= HOT), lambda x: F.struct(x["s"].alias("s"), x["s"].alias("t")))
    more = F.slice("rare", F.lit(1), first + 1)
    hot = F.transform(F.filter(F.slice("rare", F.lit(1), first), lambda x: x["held"] > HOT), lambda x: F.transform(F.filter(more, lambda y: y["s"] != x["s"]), lambda y: F.struct(x["s"].alias("s"), y["s"].alias("t"))))
    keyed = ordered.select("fingerprint_key", "n", "bin", F.explode(F.concat(cold, F.flatten(hot))).alias("k")).select("fingerprint_key", "n", "bin", "k.s", "k.t")
    left = keyed.select(F.col("fingerprint_key").alias("x"), F.col("n").alias("nx"), F.col("bin").alias("own"), F.explode(F.array(F.col("bin"), F.col("bin") + 1)).alias("bin"), "s", "t")
    right = keyed.select(F.col("fingerprint_key").alias("y"), F.col("n").alias("ny"), "bin", "s", "t")
    pairs = left.join(right, ["s", "t", "bin"]).filter((F.col("own") < F.col("bin")) | (F.col("x") < F.col("y")))
    pairs = pairs.filter(F.least("nx", "ny") >= threshold * F.greatest("nx", "ny") - 1e-9).select("x", "y").distinct()
    side = lambda k: nodes.select(F.col("fingerprint_key").alias(k), F.col("least").alias(f"id_{k}"), F.col("signatures").alias(f"s_{k}"))
    near = likeness(F.col("s_x"), F.col("s_y"), threshold - 1e-9)
    both = pairs.join(side("x"), "x").join(side("y"), "y").withColumn("likeness", near).filter(F.col("likeness") >= threshold - 1e-9)
    swap = F.struct("id_y", "y") < F.struct("id_x", "x")
    pick = lambda p, q, name: F.when(swap, F.col(q)).otherwise(F.col(p)).alias(name)
    return both.select(pick("x", "y", "key_a"), pick("y", "x", "key_b"), pick("id_x", "id_y", "a"), pick("id_y", "id_x", "b"), "likeness")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text (the second half replaced from the next document) and the next document.

    Columns of docs pass through, apart from the text and those with the names of the results.
    """
    made = ("n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "length_bin")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col, *made)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    signed = with_signatures(docs.select(F.col(id_col), *rest, text.alias("__text")), F.col("__text"), "__own")
    near = with_next(signed, id_col, {"__text": "__next_text", "__own": "__next"}, F.xxhash64("__text"))
    n_chars = F.char_length("__text").cast("long")
    half = F.floor(F.col("__n_chars") / 2).cast("int")
    edited = F.concat(F.left(F.col("__text"), F.col("__n_chars").cast("int") - half), F.left(F.coalesce(F.col("__next_text"), F.col("__text")), half))
    near = near.withColumn("__n_chars", n_chars).withColumn("__edit", edited)
    near = with_signatures(near, F.col("__edit"), "__edited")
    own, next_ = F.col("__own"), F.coalesce("__next", "__own")
    return near.select(
        id_col, *rest, F.col("__n_chars").alias("n_chars"), F.col("__edit").alias("edited"), fingerprint(own).alias("fingerprint"), fingerprint(F.col("__edited")).alias("edited_fingerprint"),
        likeness(own, F.col("__edited")).alias("near_edited"), likeness(own, next_).alias("near_next"), length_bin(own).alias("length_bin"),
    )


def op6_spotsigs(spark, sf_dir):
    found = compare_edits(documents(spark, sf_dir).select("doc_id", "text"))
    return found.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


QUERIES = {"op6_spotsigs": op6_spotsigs}
ORACLES = {}
