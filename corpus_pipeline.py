"""A corpus pipeline: each stage works on all that its predecessor kept, written as Parquet and read again.

Stages but the last return the columns of their input, whatever other columns those hold and however they are named.
An empty table stays empty in each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hypso.llm import dedup_exact, langid, minhash, packing, quality
from hypso.llm.queries import WORD_BPE
from hypso.llm.shared import file_bytes, remove, scratch, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go; the others pass whole, without a shuffle.

    Texts that are null or empty or have no letters go. Rows that repeat each other, and those with a null id, are
    judged by their texts like any others.
    """
    return docs.where(langid.told(langid.sample(docs, "doc_id", "text", "lang"), F.col("text"), docs)["lang"] != langid.UNKNOWN_LANG)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be of label 0 go; again without a shuffle.

    Texts that are null or have no words get the sample's share of label 1 as their score, and stay if that is a half
    or more. Rows that repeat each other, and those with a null id, are judged by their texts like any others.
    """
    return docs.where(quality.voted(quality.learn(docs, table(spark, sf_dir, "labels")), F.col("text"), docs) >= 0.5)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A to Z lower-cased) the document with the largest id stays.

    Null texts count as empty; a null id loses against any other; of rows that repeat both id and text one stays.
    """
    return dedup_exact.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the smallest id stays.

    Texts that are null or have no words are nobody's duplicates. Rows that repeat an id are one document and stay or
    go together. Rows with a null id can't be named by a decision and stay, whatever their texts; the stage before
    leaves one of them a text. Whole rows move once, by id.
    """
    told = minhash.near_duplicates(docs).where(F.col("kept") | F.col("doc_id").isNull()).select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(told, docs["doc_id"].eqNullSafe(told["kept_id"]), "left_semi")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences. Null and empty texts are a piece of the end token alone;
    null ids and repeated rows are packed like others."""
    return packing.pack_documents(docs, file_bytes(WORD_BPE))


STAGES = [("language", language), ("quality", good), ("exact", exact), ("near", near), ("packing", packed)]
#: Learned models and byte-pair encoding are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's table is removed once its successor's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
