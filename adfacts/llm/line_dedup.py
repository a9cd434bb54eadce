"""Recurring lines found with a log-template tree, with DataFrame functions only.

Every trimmed line is masked (each token holding a digit becomes ``<*>``) and walks down a
tree of fixed depth: its number of tokens, then its first ``depth`` masked tokens. The leaf
generalises what varies there:

- masked lines that are equal have one template;
- other lines of the leaf are cut down to their constant tokens, the rest becomes ``<*>``. If at
  least ``min_constant`` of the tokens are constant, the result is a template of the line. How
  often a token must stand at its place of the leaf to be constant is not one number, as the
  values of a field become frequent too: a line is cut at each of ``min_docs``, 2, 4, 8, ...
  times ``min_docs`` occurrences. For a template with n lines, one of these lies between n / 2 and
  n, so its words are constant there and the values of its fields are not, unless a value
  stands in half of the lines and so makes a template itself.

A template recurs if at least ``min_docs`` documents (distinct in id and text) have it and not
all of them have the same text: copies of one document are no recurrence. Its lines are dropped
from every document but the one with the smallest id, so that nothing is lost from the corpus.
Lines of fewer than ``min_tokens`` tokens say too little and stay.

Scale: lines are counted by a 128-bit key, equal ones combined before the shuffle. A leaf is
never gathered; its tokens are counted as rows. Only lines of a leaf with several templates are
read with their text. Texts are shuffled once, to take out the lines to drop. Documents are
counted by a bit each of 64 in the same aggregation; only where too few bits are set for the
number of lines are they counted one by one.

Defined results: null text stays null and has no lines, empty text stays empty. A text whose
lines are all dropped becomes empty; the document stays. A null id never counts as the first
document, so its recurring lines are dropped. Rows equal in id and text get the same result.
Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfacts.llm.common import Scratch, free_name, whole_text, written

ANY = "<*>"


def _masked(line: Column) -> Column:
    # starts at tokens only and never gives back: linear in tokens of any length
    changed = F.regexp_replace(line, r"(?<!\S)[^\s\d]*+\d\S*+", ANY)
    return F.when(line.rlike(r"\d"), changed).otherwise(line)


def _trimmed_lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), F.trim)


def _tokens(line: Column) -> Column:
    """Number of tokens: a line is trimmed, and its tokens are parted by single blanks."""
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _leaf(line: Column, depth: int) -> Column:
    return F.xxhash64(_tokens(line), F.substring_index(line, " ", depth))


def _key(line: Column) -> list[Column]:
    """128 bits that stand for a masked line."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(1), line).alias("k2")]


def _document_bit() -> Column:
    place = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def recurring_lines(
    docs: DataFrame,
    scratch: Scratch,
    min_docs: int = 3,
    min_tokens: int = 3,
    depth: int = 3,
    min_constant: float = 0.7,
) -> DataFrame:
    """k1, k2, first_doc: keys of the masked lines that recur. ``docs``: doc_id, text."""
    lines = (
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            F.explode(F.array_distinct(_trimmed_lines(_masked(F.col("text"))))).alias("line"),
        )
        .where(_tokens(F.col("line")) >= min_tokens)
        .withColumn("leaf", _leaf(F.col("line"), depth))
    )
    seen = [
        F.count("*").alias("n"),
        F.bit_or(_document_bit()).alias("bits"),
        F.min("doc_id").alias("first_doc"),
        F.min("text_hash").alias("low"),
        F.max("text_hash").alias("high"),
    ]
    counted = scratch.table(
        lines.select("doc_id", "text_hash", "leaf", *_key(F.col("line")))
        .groupBy("leaf", "k1", "k2")
        .agg(*seen),
        "line-templates",
    )
    # As many bits as that are set by as many documents at least; n counts repeated rows too.
    enough, unclear = F.bit_count("bits") >= min_docs, F.bit_count("bits") < min_docs
    differ = F.col("low") != F.col("high")
    exact = counted.where(enough & differ).select("k1", "k2", "first_doc")

    # Leaves in which several lines may be one template, or a line's documents are to be counted.
    # They are few: written first, so that Spark knows their size when it chooses how to join the
    # texts of their lines.
    leaves = scratch.table(
        counted.groupBy("leaf")
        .agg(
            F.count("*").alias("lines"),
            F.sum("n").alias("n"),
            F.max((F.col("n") >= min_docs) & unclear & differ).alias("unclear"),
        )
        .where(((F.col("lines") > 1) & (F.col("n") >= min_docs)) | F.col("unclear"))
        .select("leaf"),
        "line-leaves",
    )
    occurrences = scratch.table(
        lines.join(leaves, "leaf", "left_semi").distinct(), "line-occurrences"
    )
    several = scratch.table(
        occurrences.groupBy("leaf", "line")
        .agg(*seen)
        .withColumn("tokens", _tokens(F.col("line"))),
        "line-candidates",
    )
    counted_apart = several.where((F.col("n") >= min_docs) & unclear & differ)
    tokens = several.select(
        *_key(F.col("line")), "leaf", "tokens", "n", "bits", "first_doc", "low", "high",
        F.posexplode(F.split("line", " ")).alias("at", "token"),
    ).withColumn("token", F.xxhash64("token"))
    frequent = (
        tokens.groupBy("leaf", "at", "token")
        .agg(F.sum("n").alias("times"))
        .where(F.col("times") >= min_docs)
        .select(
            "leaf", "at", "token",
            (F.length(F.bin(F.floor(F.col("times") / min_docs))) - 1).alias("level"),
        )
    )
    kept = ["k1", "k2", "leaf", "tokens", "n", "bits", "first_doc", "low", "high"]
    needed = F.col("tokens") * min_constant
    levels = F.array_distinct(F.transform("words", lambda word: word["level"]))
    constants = F.transform(
        levels,
        lambda level: F.transform(
            F.filter("words", lambda word: word["level"] >= level),
            lambda word: F.struct(word["at"], word["token"]),
        ),
    )
    shaped = (
        tokens.join(frequent, ["leaf", "at", "token"])
        .groupBy(*kept)
        .agg(F.sort_array(F.collect_list(F.struct("at", "token", "level"))).alias("words"))
        .where(F.size("words") >= needed)
        .select(*kept, F.explode(constants).alias("constants"))
        .where(F.size("constants") >= needed)
        .select(
            "k1", "k2", "n", "bits", "first_doc", "low", "high",
            F.xxhash64("leaf", "constants").alias("t1"),
            F.xxhash64(F.lit(1), "leaf", "constants").alias("t2"),
        )
    )
    shaped = scratch.table(shaped, "line-shapes")
    grouped = scratch.table(
        shaped.groupBy("t1", "t2")
        .agg(
            F.count("*").alias("lines"),
            F.sum("n").alias("n"),
            F.bit_or("bits").alias("bits"),
            F.min("first_doc").alias("first_doc"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .where((F.col("lines") > 1) & (F.col("n") >= min_docs) & differ),
        "line-groups",
    )
    # Lines of the templates whose documents have to be counted: they have few documents each.
    apart = scratch.table(
        shaped.join(grouped.where(unclear).select("t1", "t2"), ["t1", "t2"], "left_semi").select(
            "k1", "k2", "t1", "t2"
        ),
        "line-unclear",
    )
    documents = occurrences.select("doc_id", "text_hash", *_key(F.col("line")))
    many = (
        documents.join(apart, ["k1", "k2"])
        .select("t1", "t2", "doc_id", "text_hash")
        .distinct()
        .groupBy("t1", "t2")
        .agg(F.count("*").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .select("t1", "t2")
    )
    templates = (
        grouped.where(enough)
        .unionByName(grouped.join(many, ["t1", "t2"], "left_semi"))
        .select("t1", "t2", "first_doc")
    )
    general = shaped.drop("first_doc").join(templates, ["t1", "t2"])
    return (
        exact.union(counted_apart.select(*_key(F.col("line")), "first_doc"))
        .union(general.select("k1", "k2", "first_doc"))
        .groupBy("k1", "k2")
        .agg(F.min("first_doc").alias("first_doc"))
    )


def dropped_lines(docs: DataFrame, recurring: DataFrame) -> DataFrame:
    """doc_id, text_hash, at (line number from 0): the lines that a document loses."""
    lines = (
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            F.posexplode(_trimmed_lines(_masked(F.col("text")))).alias("at", "line"),
        )
        .where(F.col("line") != "")
        .select("doc_id", "text_hash", "at", *_key(F.col("line")))
    )
    later = F.coalesce(F.col("doc_id") > F.col("first_doc"), F.col("doc_id").isNull())
    return lines.join(recurring, ["k1", "k2"]).where(later).select("doc_id", "text_hash", "at")


def without_recurring_lines(docs: DataFrame, **settings: float) -> DataFrame:
    """``docs`` (doc_id, text and any others) with ``text`` cleaned, and a further column
    ``dropped_lines``, the sorted numbers of the lines dropped; underscores follow its name where
    ``docs`` has a column called so. See ``recurring_lines``."""
    plain = docs.select("doc_id", whole_text().alias("text"))
    with Scratch(docs.sparkSession) as scratch:
        recurring = written(recurring_lines(plain, scratch, **settings), "line-recurring")
    losses = (
        dropped_lines(plain, recurring)
        .groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .agg(F.sort_array(F.collect_list("at")).alias("_dropped"))
    )
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(whole_text()).alias("_text_hash"))
    joined = rows.join(
        losses,
        F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")),
        "left",
    )
    text = F.col("row.text")
    left = F.filter(F.split(text, "\n"), lambda line, at: ~F.array_contains(F.col("_dropped"), at))
    cleaned = F.when(F.col("_dropped").isNull(), text).otherwise(F.array_join(left, "\n"))
    no_lines = F.array().cast("array<int>")
    return joined.select(
        *[cleaned.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns],
        F.coalesce("_dropped", no_lines).alias(free_name(docs, "dropped_lines")),
    )
