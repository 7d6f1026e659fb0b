"""From raw documents to token ids: five stages, each on all that the one before kept.

1. language: documents without a language (null texts, no letter) go.
2. exact_dedup: of equal texts the document with the smallest id stays.
3. near_dedup: of documents linked by word shingles (five words, 0.8) one stays.
4. decontaminate: documents that hold a benchmark passage go.
5. encode: each document's token ids, and digests of them and of the text decoded from them.

All stages but the last return the columns of documents. Each result is
written as Parquet and reread, so that a lost executor costs part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripengine.llm import bpe, decontaminate, exact, jaccard, langid
from tripengine.llm.common import begin, materialise, query, scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, as told by trees fitted on labelled ones."""
    begin(spark, sf_dir, "documents")
    return langid.known_language(docs, langid.fit(langid.training_rows(docs)))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id stays."""
    begin(spark, sf_dir, "documents")
    return exact.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked documents one stays: the smallest id, null ids last.

    Rows of one id with several texts are told apart by their texts; of rows
    that repeat both, one stays too. A document without words is a component
    of its own.
    """
    begin(spark, sf_dir, "documents")
    found = materialise(jaccard.near_duplicates(docs, 5, 80).where("sid IS NOT NULL").select(
        "root", "row_id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id").alias("place")), "found")
    first = found.groupBy("root").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    stays = first.where("n > 1").select("root", F.col("first.row_id").alias("stays"))
    linked = found.join(stays, "root").groupBy("row_id").agg(
        F.bool_or(F.col("row_id") == F.col("stays")).alias("stays"), F.count("*").alias("rows"))
    linked = materialise(linked.where("NOT stays OR rows > 1"), "linked")
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("row_id"))
    alone = named.join(linked, "row_id", "left_anti")
    again = named.join(linked.where("stays").select("row_id"), "row_id").dropDuplicates(["row_id"])
    return alone.unionByName(again).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    begin(spark, sf_dir, "documents")
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the decoded text's digest of every document."""
    begin(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path(bpe.WORD_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None  # languages, links and tokens have no SQL form; see tests/llm

query("pipeline", ORACLE_SQL)(run)
