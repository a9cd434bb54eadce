"""The registered queries of this package, and their SQL where SQL can express them.

Each query applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adfacts.llm import language_id, toxicity
from adfacts.llm.alignment import aligned
from adfacts.llm.common import WORD, fold_share, table, whole_text
from adfacts.llm.decontamination import contamination
from adfacts.llm.exact_dedup import exact_duplicates
from adfacts.llm.html_text import main_text_column
from adfacts.llm.line_dedup import without_recurring_lines
from adfacts.llm.lm_scoring import language_model_scores
from adfacts.llm.packing import pack
from adfacts.llm.periodic_runs import periodic_runs
from adfacts.llm.pii import pseudonymised
from adfacts.llm.simhash import near_duplicates
from adfacts.llm.token_files import read_token_files, write_token_files
from adfacts.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its cleaned text and the numbers of the lines it lost."""
    cleaned = without_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
        F.size("dropped_lines").alias("n_dropped"),
        F.array_join(F.col("dropped_lines").cast("array<string>"), ",").alias("dropped_lines"),
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_share("doc_id", 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.fit(docs, labels)
    return docs.select(
        "doc_id",
        held_out.alias("held_out"),
        toxicity.toxicity_columns(F.col("text"), model).alias("found"),
    ).select(
        "doc_id",
        "held_out",
        "found.score",
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
        "found.worst_sentence",
        # numbers of all offending sentences; empty for a clean document
        F.array_join(F.col("found.offending.sentence").cast("array<string>"), ",").alias("offending"),
    )


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model_scores(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold_share("doc_id", 4) == 2
    network = language_id.fit(docs.where(~held_out))
    return docs.select(
        "doc_id",
        held_out.alias("held_out"),
        language_id.language_columns(F.col("text"), network).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op9_format_preserving_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its pseudonymised text and what was replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pseudonymised(docs, key=QUERY_KEY)
    return found.select(
        "doc_id",
        "text",
        F.size("found").alias("n_found"),
        F.array_join("found.kind", ",").alias("kinds"),
        F.array_join("found.pseudonym", ",").alias("pseudonyms"),
    )


def op10_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = pages.select("page_id", "url", main_text_column(F.col("html")).alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its runs, after the circles that the contract asks for are written into it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    found = _with_circles(docs).select("doc_id", periodic_runs(F.col("text")).alias("found"))
    runs = F.arrays_zip(
        F.col("found.starts").alias("start"),
        F.col("found.lengths").alias("length"),
        F.col("found.periods").alias("period"),
    )
    listed = found.select("doc_id", runs.alias("runs"), "found.collapsed")
    # The runs come by start, then period, so that the first of equals stays.
    best = F.reduce(
        "runs",
        F.get("runs", F.lit(0)),
        lambda top, run: F.when(run.length * top.period > top.length * run.period, run).otherwise(top),
    )
    lines = F.transform(
        "runs", lambda run: F.concat(F.concat_ws(",", run.start, run.length, run.period), F.lit("\n"))
    )
    return listed.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _with_circles(docs: DataFrame) -> DataFrame:
    """In every document whose crc32(doc_id) ends with 0, a circle of words up to the end.

    With n words and g = floor(crc32 / 10), word i >= a = g % n becomes word a + (i - a) % p, where
    p = 1 + floor((n - a) / (3 + g % 8)). A null id has no decimal text: its row stays.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (hashed % 10 == 0) & (F.col("n") > 0)
    rows = docs.withColumn(
        "words", F.when(hashed % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    )
    rows = rows.withColumn("n", F.size(F.coalesce("words", F.array())))
    g = F.floor(hashed / 10)
    rows = rows.withColumn("a", F.when(chosen, (g % F.col("n")).cast("int")))
    rows = rows.withColumn(
        "p", F.when(chosen, (F.lit(1) + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    )
    rest = F.col("n") - F.col("a")
    times = F.ceil(rest / F.col("p")).cast("int")
    circle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    turned = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(circle, F.lit(1), rest))
    text = F.when(chosen, F.array_join(turned, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(
        table(spark, sf_dir, "documents"),
        vocabulary_path("byte_bpe_50k.json"),
        vocabulary_path("piece_bpe_32k.model"),
    )


def op13_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what the written files hold of it, in the order of the files."""
    folder = f"{shared_folder(spark).rstrip('/')}/token-planes-{uuid.uuid4().hex}"
    manifest = write_token_files(
        table(spark, sf_dir, "documents"), folder, vocabulary_path("word_bpe_49k.json"), END_OF_DOCUMENT
    )
    return read_token_files(manifest, digest=True)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


# The id that the contract puts behind every document.
END_OF_DOCUMENT = 1

# The key of the registered query alone; users pass their own secret.
QUERY_KEY = "registered query"

QUERIES: dict[str, Query] = {
    "op1_length_buckets": op1_length_buckets,
    "op2_line_templates": op2_line_templates,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_benchmark_windows": op4_benchmark_windows,
    "op5_toxicity": op5_toxicity,
    "op6_deleted_interpolation": op6_deleted_interpolation,
    "op7_language_id": op7_language_id,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_format_preserving_pii": op9_format_preserving_pii,
    "op10_text_density": op10_text_density,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_token_planes": op13_token_planes,
}

ORACLE: dict[str, str] = {
    "op8_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same_text AS keep_id,
               count(*) OVER same_text AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same_text AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same_text AS (PARTITION BY coalesce(text, ''))
    """,
}
