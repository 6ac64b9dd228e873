"""A training corpus from documents: reject toxic ones, drop shared lines, keep one of each near-duplicate class, mix sources, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.llm.common import documents, fold, materialize, small_batches
from quarrylight.llm.line_dedup import dedup_lines
from quarrylight.llm.mixing import mix_documents
from quarrylight.llm.ngram_join import one_of_each_class
from quarrylight.llm.pieces import model_path, piece_digests
from quarrylight.llm.toxicity import fit_toxicity, score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is graded above 0 with even odds go."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 5) != 0)
    return score_toxicity(docs, fit_toxicity(documents(spark, sf_dir), labels)).filter(~F.col("toxic")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents share stay in the last of them."""
    kept = dedup_lines(docs).withColumn("text", F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the one that names it. Different texts under one id are told apart; rows without an id stay."""
    small_batches(spark)
    return one_of_each_class(docs).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, twice at most, until the mix is as flat as that allows; no document goes."""
    return mix_documents(docs).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each text and their decoded text, as digests."""
    small_batches(spark)
    return piece_digests(docs.select("doc_id", "source", "text"), model_path())


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("ngram_jaccard_join", near_duplicates), ("mixing", mixing), ("sentencepiece", encoding)]
#: Toxicity is learned and pieces come from a vocabulary file: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
