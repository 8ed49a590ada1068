"""The corpus pipeline: stages over ``documents``, each calling one operator of ``keelson.llm``.

Edge cases, in every stage: only the columns of ``documents`` are read, so
extra ones with any names don't matter and don't go on. A null text is empty.
Quality rules reject texts without words; the classifier gives them the score 0.
Rows of equal doc_id stay separate rows; a null doc_id links, removes and packs like
any other, comes last among equals, and counts as larger than all ids. Repeated
rows are near duplicates of each other, so the first of them stays. An empty
table gives an empty table. Texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from keelson.llm import hilbert_pack, line_quality, ordinal, signature_tree, suffix_repeats
from keelson.llm.packed import scoped
from keelson.session import ship_package, store

#: Columns of ``documents``; every stage but the last returns them.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line-first cleaning: failing lines go from the text, rejected documents go as a whole."""
    kept = line_quality.with_line_quality(docs.select(*COLUMNS)).filter("kept")
    return kept.withColumn("text", F.col("clean_text")).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are unlikely to be good by the ordinal regression go."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        "doc_id", ordinal.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    docs = docs.select(*COLUMNS)
    return ordinal.with_grades(docs, ordinal.fit(docs, labels)).filter("kept").select(*COLUMNS)


@scoped
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays."""
    ship_package(spark)
    return signature_tree.one_of_each(docs.select(*COLUMNS))


@scoped
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 50 or more that a document with a smaller id has too go from the text."""
    ship_package(spark)
    docs = docs.select(*COLUMNS)
    return suffix_repeats.without_repeats(docs, suffix_repeats.kept_texts, docs.schema)


@scoped
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens along the Hilbert curve."""
    ship_package(spark)
    return hilbert_pack.packed_pieces(docs.select(*COLUMNS), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row over ``documents``; each result is written as Parquet and read again.

    A stage's result is deleted once the next one's is written; what a stage
    stores on its way is deleted as soon as it has its result.
    """
    ship_package(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        after = stage(spark, docs, sf_dir)
        after = getattr(after, "stored_table", None) or store(after, name.replace(" ", "_"))
        if before is not None:
            before.drop()
        docs, before = after.df, after
    return docs


#: SQL can't express the classifier and the packing; tests/llm compare the stages with brute force.
ORACLE_SQL = None
