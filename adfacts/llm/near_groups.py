"""One document of each group of near-duplicates, by two kinds of links at once.

Documents are linked if their fingerprints (``simhash``) are within the radius or their sets of shingles
(``similar_sets``) reach the similarity. Both are taken over all documents, and groups are the
components of both together, so a link counts also where only a document that goes has it. Of
equal texts one takes part in the comparison of sets; the others are in its group by their fingerprint.

Defined results: a document is all rows of one id, and the smallest id of a group stays. Null counts as
empty; all texts without words are in one group. Rows without an id are linked by fingerprints only and
go if one of them is in a group with an id, unless another is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfacts.llm.common import Scratch, whole_text, written
from adfacts.llm.graph import connected_components
from adfacts.llm.simhash import component_ids, fingerprint_column
from adfacts.llm.similar_sets import similar_links


def dropped_ids(
    docs: DataFrame,
    scratch: Scratch,
    similarity: float = 0.8,
    shingle_words: int = 5,
    radius: int = 4,
    hubs: int = 32,
) -> DataFrame:
    """doc_id of each document whose group holds a smaller one; null stands for rows without an id."""
    printed = scratch.table(
        docs.select(
            "doc_id",
            fingerprint_column(whole_text(), shingle_words).alias("fp"),
            F.xxhash64(whole_text()).alias("text_hash"),
        ),
        "near-prints",
    )
    classes = component_ids(printed.select("doc_id", "fp"), scratch, radius)
    placed = scratch.table(printed.select("doc_id", "fp").join(classes, "fp"), "near-placed")
    known = scratch.table(
        placed.where("doc_id != component_id")
        .select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
        .distinct(),
        "near-known",
    )
    firsts = printed.groupBy("fp", "text_hash").agg(F.min("doc_id").alias("doc_id"))
    copies = scratch.table(
        printed.where("doc_id is not null")
        .select(F.col("doc_id").alias("id"))
        .subtract(firsts.select("doc_id")),
        "near-copies",
    )
    links = similar_links(docs, scratch, similarity, shingle_words, hubs, known, copies)
    groups = connected_components(known.union(links), scratch)
    without_id = placed.where("doc_id is null").agg(F.bool_and(F.col("component_id").isNotNull()).alias("go"))
    return (
        groups.where(F.col("node") != F.col("component"))
        .select(F.col("node").alias("doc_id"))
        .union(without_id.where("go").select(F.lit(None).cast(groups.schema["node"].dataType)))
    )


def one_of_each_near(
    docs: DataFrame, similarity: float = 0.8, shingle_words: int = 5, radius: int = 4, hubs: int = 32
) -> DataFrame:
    """The rows of ``docs`` with the smallest ``doc_id`` of their group, all columns kept.

    Texts are joined with the ids that go, a table of known size: Spark broadcasts it just if it is small.
    """
    with Scratch(docs.sparkSession) as scratch:
        dropped = dropped_ids(docs, scratch, similarity, shingle_words, radius, hubs)
        dropped = written(dropped.select(F.col("doc_id").alias("_dropped")), "near-dropped")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"))
    same = F.col("_id").eqNullSafe(F.col("_dropped"))
    return rows.join(dropped, same, "left_anti").select("row.*")
