"""A training corpus from documents: five stages, each over all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read back as the next stage's documents. Columns beyond those of documents are dropped by the first
stage; null texts count as empty; repeated rows are near duplicates of each other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bagminhash, bpe, decontaminate, quality, queries, recompression
from tidemark.llm.shipping import ship
from tidemark.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant, fitted to the labelled ones, scores at the threshold or above."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    labels = queries.table(spark, sf_dir, "labels").filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    labelled = docs.select("doc_id", "text").join(labels.select("doc_id", "quality"), "doc_id")
    model = quality.fit(quality.with_statistics(labelled).drop("text"), "quality")
    scored = quality.with_scores(quality.with_statistics(docs), model)
    return scored.filter(F.col("score") >= queries.QUALITY_THRESHOLD).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest doc_id."""
    ship(spark)
    return bagminhash.first_of_each(docs).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words of passages that stand in more than one place."""
    ship(spark)
    kept = recompression.deduplicate(docs, ["doc_id", "lang", "source"])
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    ship(spark)
    found = decontaminate.with_leaks(docs, queries.table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    ship(spark)
    path = public_tokenizers.path(queries.RANKS)
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN), path)
    exact = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_bpe),
]
ORACLE_SQL = None  # models, similarity classes and tokens are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = f"{Scratch(spark).root}/{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
