"""Corpus preparation: toxic texts go, repeated lines go, near copies go, contaminated texts go, the rest is packed."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontam, lines, neardup, packing, store, toxicity


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects (0.5 or more) go.

    Null and empty texts score as texts without hits; repeated rows are judged each; the score's column takes a name that docs lack.
    """
    score = decontam.free_name(docs, "tox_score")
    scored = toxicity.with_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), score)
    return scored.filter(F.col(score) < 0.5).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one, or nearly so, go; all documents stay, those of null or empty text too."""
    column = decontam.free_name(docs, "lines")
    found = lines.dedup_lines(docs, column=column).withColumn("text", F.col(f"{column}.text")).drop(column)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return found


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity 0.8), that with the smallest id."""
    return neardup.kept_rows(docs, size=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words 5 % or more lie in benchmark windows go; null and empty texts have no words and stay."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of at most 1024 tokens; null and empty texts and repeated rows give pieces of their own."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxic), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("packing", pack)]
ORACLE_SQL = None  # learned scores and packing have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each one's result is written to the shared folder, read by the next and then removed.

    The last one, which run()'s rows still read, goes when the driver ends.
    """
    folder, before = f"{store.shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            store.remove(spark, before)
        before = path
    store.remove_later(spark, folder)
    return STAGES[-1][1](spark, docs, sf_dir)
