"""Exact duplicates by skew-safe combining, with DataFrame functions only.

1. *Locally*: rows are grouped by (digest, salt, text). The salt is a hash of the id, so
   a group of copies that holds a third of all rows is spread over many tasks, and each
   map task first merges its own copies before anything is shuffled.
2. *Salt winners*: at most one row per text and salt is left. They meet by digest and are
   compared by their full text again; each gets the winner and the size of its text.
3. *Back to the rows*: a row finds its text's winner by (digest, salt). Should two texts
   ever share a digest, the rows of that digest are joined by text as well.

Text is shuffled twice, without its copies the second time. Everything else is narrow.

Defined results: null text counts as empty. A null id never wins over another id; if all
ids of a text are null, ``keep_id`` is null and all its rows are kept. Rows that repeat
the winning id with the same text are one document and are all marked kept. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adfacts.llm.common import shuffle_partitions, whole_text, written


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salts: int | None = None
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``.

    ``salts`` defaults to the number of shuffle partitions: a group of copies then spreads
    over as many tasks as there are.
    """
    salts = salts or shuffle_partitions(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.sha2(whole_text(text), 256).alias("text_sha256"),
        F.pmod(F.xxhash64(F.col(doc_id)), F.lit(salts)).cast("int").alias("salt"),
        whole_text(text).alias("text"),
    )
    salted = rows.groupBy("text_sha256", "salt", "text").agg(
        F.max("doc_id").alias("winner"), F.count("*").alias("n")
    )
    # Partitioned by digest, rows of one text are together: no further exchange follows.
    same_digest = W.partitionBy("text_sha256")
    same_text = W.partitionBy("text_sha256", "text")
    winners = written(
        salted.repartition("text_sha256")
        .withColumn("keep_id", F.max("winner").over(same_text))
        .withColumn("group_size", F.sum("n").over(same_text))
        .withColumn("low", F.min("text").over(same_digest))
        .withColumn("high", F.max("text").over(same_digest))
        .select(
            "text_sha256",
            "salt",
            "keep_id",
            "group_size",
            F.when(F.col("low") != F.col("high"), F.col("text")).alias("clashing_text"),
        ),
        "exact-dedup",
    )
    clashing = winners.where(F.col("clashing_text").isNotNull())
    plain = winners.where(F.col("clashing_text").isNull()).drop("clashing_text")
    ids = rows.drop("text")
    found = ids.join(plain, ["text_sha256", "salt"])
    if not clashing.isEmpty():  # two texts with one digest: compare the texts themselves
        by_text = clashing.withColumnRenamed("clashing_text", "text")
        found = found.unionByName(rows.join(by_text, ["text_sha256", "salt", "text"]).drop("text"))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
