"""A corpus pipeline over ``documents``: five stages, each one operator of ``adfacts.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All stages but the last return the columns of
``documents``; the last one returns the plan of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfacts.llm import language_id
from adfacts.llm.common import fold_share, table, written
from adfacts.llm.decontamination import without_contaminated
from adfacts.llm.line_dedup import without_recurring_lines
from adfacts.llm.near_groups import one_of_each_near
from adfacts.llm.packing import pack

# A language is taken as rejected below this mean probability of the best label.
MIN_LANGUAGE_SCORE = 0.35
# Near-duplicates share this part of their shingles of this many words.
SIMILARITY = 0.8
SHINGLE_WORDS = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; ``lang`` itself stays as it was."""
    network = language_id.fit(docs.where(fold_share("doc_id", 4) != 2))
    found = language_id.language_columns(F.col("text"), network)
    recognised = (F.col("_found.lang_pred") != language_id.UNKNOWN) & (
        F.col("_found.score") >= MIN_LANGUAGE_SCORE
    )
    rows = docs.select(F.struct("*").alias("_row"), found.alias("_found"))
    return rows.where(recognised).select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that recur elsewhere; ``n_chars`` follows the text."""
    cleaned = without_recurring_lines(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.char_length("text").cast(kind))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Fingerprints of five-word shingles within 4 bits are found by covering tables, documents that
    share 0.8 of their shingles by rare shingles and exact sets. Groups close over both.
    """
    return one_of_each_near(docs, SIMILARITY, SHINGLE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's bucket, batch and place."""
    return pack(docs)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("packing", packing),
]

# Trained weights, fingerprints and dynamic programming are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
