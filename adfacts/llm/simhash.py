"""SimHash near-duplicates found by covering locality-sensitive hashing.

Fingerprints: 64 bits by majority over the 64-bit hashes of a text's word shingles.

Covering: bit i gets the vector m(i) of radius+1 bits, m(i) = i mod (2^(radius+1)-1) + 1.
For every vector v but zero there is a table whose mask keeps the bits with an odd
<m(i), v>. The vectors of ``radius`` differing bits span at most ``radius`` dimensions, so
some v is orthogonal to all of them: that table's mask hides every difference, and the pair
meets there. This holds for every pair within the radius, without exception. Each of the
2^(radius+1)-1 masks keeps about half of the bits, so unrelated fingerprints rarely meet.

Documents are first reduced to distinct fingerprints. Buckets of up to ``bucket_limit``
fingerprints are compared in pairs. Fingerprints of larger buckets are linked exactly by
another way, linear in their number: two are within an even distance r just if some 64-bit value is
within r/2 of both. Every such fingerprint is listed
under all values around it, and those under one value are linked in two stars, one within
each of several salts and one over the salts. No group is ever compared with itself, and no
link is lost.

Links are then closed to components (``graph.connected_components``), and documents take
the component of their fingerprint.

Defined results: null text counts as empty. Texts without words have fingerprint zero and
are linked like any other. The component id is the smallest id reachable; null ids count
only where there is no other. Repeated rows get equal results. Other columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adfacts.llm.common import Scratch, shuffle_partitions, whole_text, written
from adfacts.llm.graph import connected_components

BITS = 64
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included.

    A-Z are lower-cased; a text of fewer words is one shingle; without words it is 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[min(shingle_words, len(words)) - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, len(ends)
    hashes = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts, ends)), dtype=np.uint64, count=total
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, total, CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, shingle_words: int = 4) -> Column:
    """Fingerprints as a bigint column, computed in Arrow batches."""

    @F.pandas_udf("bigint")
    def batch(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            values = [fingerprint(t, shingle_words) for t in texts]
            yield pd.Series(np.array(values, dtype=np.uint64).view(np.int64))

    return batch(text)


def covering_masks(radius: int) -> list[int]:
    """One mask, as a signed 64-bit number, per table."""
    tables = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, tables + 1):
        bits = [i for i in range(BITS) if ((i % tables + 1) & v).bit_count() % 2]
        masks.append(_signed(sum(1 << i for i in bits)))
    return masks


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(
    fingerprints: DataFrame, scratch: Scratch, radius: int = 4, bucket_limit: int = 64
) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, closing to the same components as all
    pairs within ``radius``. ``fingerprints`` has one bigint column ``fp``, no repeats."""
    masks = F.array(*[F.lit(m) for m in covering_masks(radius)])
    keyed = fingerprints.select("fp", F.posexplode(masks).alias("table", "mask")).select(
        "fp", F.xxhash64("table", F.col("fp").bitwiseAND(F.col("mask"))).alias("key")
    )
    shared = scratch.table(
        keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets"
    )
    small = keyed.join(shared.where(F.col("n") <= bucket_limit), "key")
    members = small.groupBy("key").agg(F.collect_list("fp").alias("fps"))
    near = members.select(F.explode("fps").alias("a"), "fps").select(
        "a",
        F.explode(
            F.filter(
                "fps", lambda x: (x > F.col("a")) & (F.bit_count(x.bitwiseXOR(F.col("a"))) <= radius)
            )
        ).alias("b"),
    )
    crowded = shared.where(F.col("n") > bucket_limit)
    if crowded.isEmpty():
        return near.distinct()
    dense = keyed.join(crowded.select("key"), "key", "left_semi").select("fp").distinct()
    return near.distinct().union(_links_by_midpoint(dense, radius))


def _links_by_midpoint(dense: DataFrame, radius: int) -> DataFrame:
    """Stars over the fingerprints that lie around one value: all pairs within an even radius."""
    if radius % 2:
        raise ValueError("crowded buckets need an even radius")
    flips = [
        _signed(sum(1 << i for i in bits))
        for size in range(radius // 2 + 1)
        for bits in combinations(range(BITS), size)
    ]
    near = F.array(*[F.lit(f) for f in flips])
    salts = shuffle_partitions(dense.sparkSession)
    around = dense.select("fp", F.explode(near).alias("flip")).select(
        "fp",
        F.col("fp").bitwiseXOR(F.col("flip")).alias("value"),
        F.pmod(F.xxhash64("fp"), F.lit(salts)).alias("salt"),
    )
    hubs = around.withColumn("hub", F.min("fp").over(W.partitionBy("value", "salt")))
    star = hubs.where(F.col("fp") != F.col("hub")).select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    roots = (
        around.groupBy("value", "salt")
        .agg(F.min("fp").alias("a"))
        .withColumn("b", F.min("a").over(W.partitionBy("value")))
        .where(F.col("a") != F.col("b"))
        .select("a", "b")
    )
    return star.union(roots).distinct()


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = 4,
    shingle_words: int = 4,
    bucket_limit: int = 64,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``."""
    printed = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            fingerprint_column(whole_text(text), shingle_words).alias("fp"),
        ),
        "simhash",
    )
    with Scratch(docs.sparkSession) as scratch:
        classes = written(
            component_ids(printed, scratch, radius, bucket_limit), "simhash-classes"
        )
    return printed.join(classes, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def component_ids(
    printed: DataFrame, scratch: Scratch, radius: int = 4, bucket_limit: int = 64
) -> DataFrame:
    """fp, component_id of each distinct fingerprint; ``printed`` has doc_id and fp."""
    first = scratch.table(
        printed.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-first"
    )
    edges = links(first.select("fp"), scratch, radius, bucket_limit)
    grouped = connected_components(edges, scratch).withColumnRenamed("node", "fp")
    marked = first.join(grouped, "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    least = marked.groupBy("component").agg(F.min("first").alias("component_id"))
    return marked.join(least, "component").select("fp", "component_id")


def one_of_each_group(docs: DataFrame, radius: int = 4, shingle_words: int = 4) -> DataFrame:
    """The rows of ``docs`` with the smallest ``doc_id`` of their component, all columns kept.

    Rows that repeat that id stay together, as they are one document. Texts are joined with the ids
    that go, a table of known size: Spark broadcasts it just if it is small.
    """
    with Scratch(docs.sparkSession) as scratch:
        printed = scratch.table(
            docs.select("doc_id", fingerprint_column(whole_text(), shingle_words).alias("fp")), "simhash"
        )
        classes = component_ids(printed, scratch, radius)
        sorted_out = scratch.table(
            printed.join(classes, "fp").select(
                F.col("doc_id").alias("_dropped"),
                F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
            ),
            "simhash-sorted",
        )
        dropped = written(
            sorted_out.where("not kept").select("_dropped").subtract(
                sorted_out.where("kept").select("_dropped")
            ),
            "simhash-dropped",
        )
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"))
    same = F.col("_id").eqNullSafe(F.col("_dropped"))
    return rows.join(dropped, same, "left_anti").select("row.*")
