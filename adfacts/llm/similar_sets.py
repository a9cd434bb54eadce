"""Documents whose sets of word shingles have a Jaccard similarity of at least a bound.

Of fingerprints of 64 bits, two at a similarity of 0.8 differ in ten bits on average, and tables that
cover ten bits or more keep too few of them to tell documents apart. Such pairs are found
by their shingles instead.

Prefixes: order all shingles in one way throughout the corpus. Two sets of similarity s or more share one
of the first floor((1-s) n) + 1 of either set, n being its size: each set misses at most that
many of the other, less one. Any order will do; here rarer shingles come first, so that passages of
many documents are no prefix of any. Frequencies are counts of all shingles in a table of ``CELLS``
cells, a fixed size that is sent to the tasks. Shingles that share a cell only weaken the order.
Behind the first shingle that two sets share, at the places i and j of them, both hold at most
min(n_a - i, n_b - j) in common; pairs are dropped where this cannot reach the similarity.

Prefix rows are the bulk of the work. They are shuffled once, as arrays of one bucket of shingles and one batch
of documents each, which take a third of the bytes of single rows, and rows whose shingle no other
document has are left out behind that shuffle.

Most pairs found that way share a passage and are far below the similarity. They are sorted out by sketches: one
bit for each cell of a table that grows with the set, telling whether an odd number of its shingles is in that cell.
Each shingle that only one of two sets has changes one bit, so sketches never differ in more bits than sets in
shingles, and no similar pair is lost. A sketch has a thirty-second to a sixteenth of the bytes of its set.

Full sets are as large as the texts and hardly compress, so they are never stored for all documents: they are
made from the texts once for the frequencies, once for the prefixes, once for the sketches of documents that have
a pair, and for the documents of pairs that sketches leave. Those are picked out by a bitmap of ``ID_BITS`` bits over
their ids, a fixed size too, so that texts are not shuffled; what else the bitmap lets through finds no pair.
``docs`` should therefore be a table.

Documents that share a prefix shingle are compared exactly, in full sets. Up to ``hubs`` of
them are all compared with each other. Of more, all are compared that are not yet in one group, so that the groups
are those of all pairs, whatever the size: the members outside of the largest group are compared with all of
the other groups. Where that is much work, a few rounds before it compare one member of
each such shingle with the others, which makes one group of a crowd of near copies in linear time. Only crowds of
documents that stay unlike take a square of their number, in tasks that Spark splits.

Defined results: null counts as empty; a text without words is in no link; fewer words than a
shingle has are one shingle. Rows without an id are in no link. Rows of one id are one document,
which is as similar as its most similar text. Other columns are kept out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adfacts.llm.common import Scratch, whole_text, written
from adfacts.llm.graph import connected_components

CELLS = 1 << 18
BUCKETS = 1 << 13
ID_BITS = 1 << 25
# Rounds that only save work, before the groups of a crowd are compared with each other.
STARS = 3
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text: str | None, shingle_words: int = 5) -> np.ndarray:
    """Distinct XXH64 of all word shingles, A-Z lower-cased, as sorted signed numbers."""
    words = WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return np.zeros(0, dtype=np.int64)
    starts = range(max(len(words) - shingle_words, 0) + 1)
    digests = (xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle_words])) for i in starts)
    return np.unique(np.fromiter(digests, dtype=np.uint64, count=len(starts)).view(np.int64))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Words of 64 bits: parities of a set over a power of two of cells, at least two cells per shingle."""
    cells = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    used, counts = np.unique(shingles & (cells - 1), return_counts=True)
    odd = np.zeros(cells, dtype=np.uint8)
    odd[used] = counts & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    """id, text of every row that has an id."""
    return docs.where("doc_id is not null").select(F.col("doc_id").alias("id"), whole_text().alias("text"))


def _id_bit(ids: str) -> Column:
    return F.pmod(F.xxhash64(ids), F.lit(ID_BITS))


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """The bits of all ``id`` of ``ids``, in ``ID_BITS`` / 64 words."""
    bits = ids.select(_id_bit("id").alias("bit")).select(
        F.shiftright("bit", 6).alias("word"),
        F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask"),
    )
    table = np.zeros(ID_BITS // 64, dtype=np.int64)
    words = bits.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()  # one job, 16 bytes a word
    table[words["word"].to_numpy()] = words["mask"].to_numpy()
    return table


def _made_of_sets(
    docs: DataFrame, ids: DataFrame, shingle_words: int, columns: str, made: Callable[[np.ndarray], tuple]
) -> DataFrame:
    """id and ``columns`` of every row that has a word and an id of ``ids``; few others come with them.

    ``made`` returns the values of ``columns`` for the set of a row.
    """
    bitmap = docs.sparkSession.sparkContext.broadcast(id_bitmap(ids))
    names = [column.split()[0] for column in columns.split(", ")]

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bit = frame.pop("bit").to_numpy()
            frame = frame[(bitmap.value[bit >> 6] >> (bit & 63)) & 1 == 1]
            found = []
            for key, text in zip(frame["id"], frame["text"]):
                if len(shingles := shingle_set(text, shingle_words)):
                    found.append((key, *made(shingles)))
            yield pd.DataFrame(found, columns=["id", *names])

    rows = _texts(docs).withColumn("bit", _id_bit("id"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(batches, f"id {kind}, {columns}")


def shingle_sets(docs: DataFrame, ids: DataFrame, shingle_words: int = 5) -> DataFrame:
    """id, shingles of every row that has a word and an id of ``ids``; few others come with them."""
    return _made_of_sets(docs, ids, shingle_words, "shingles array<bigint>", lambda shingles: (shingles,))


def sketches(docs: DataFrame, ids: DataFrame, shingle_words: int = 5) -> DataFrame:
    """id, size, sketch of the same rows."""
    return _made_of_sets(
        docs, ids, shingle_words, "size int, sketch array<bigint>", lambda shingles: (len(shingles), sketch(shingles))
    )


def cell_counts(docs: DataFrame, shingle_words: int = 5) -> np.ndarray:
    """Number of shingles of all sets in each of the ``CELLS`` cells."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(CELLS, dtype=np.int64)
        for frame in frames:
            for text in frame["text"]:
                np.add.at(counts, shingle_set(text, shingle_words) % CELLS, 1)
        cells = np.flatnonzero(counts)
        yield pd.DataFrame({"cell": cells.astype(np.int32), "n": counts[cells]})

    counted = _texts(docs).select("text").mapInPandas(batches, "cell int, n bigint")
    table = np.zeros(CELLS, dtype=np.int64)
    cells = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most CELLS rows
    table[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return table


def prefixes(docs: DataFrame, similarity: float, shingle_words: int = 5) -> DataFrame:
    """bucket, shingle, id, size, place: the rarest floor((1-similarity) size) + 1 shingles of each set.

    Rows of a bucket, and so of a shingle, are in one partition.
    """
    frequency = docs.sparkSession.sparkContext.broadcast(cell_counts(docs, shingle_words))

    def rarest(shingles: np.ndarray) -> np.ndarray:
        length = int(len(shingles) * (1 - similarity) + 1e-9) + 1
        return shingles[np.lexsort((shingles, frequency.value[shingles % CELLS]))[:length]]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sets = [shingle_set(text.as_py(), shingle_words) for text in part.column("text")]
            sizes = np.array([len(s) for s in sets], dtype=np.int32)
            first = [rarest(s) if len(s) else s for s in sets]
            lengths = np.array([len(f) for f in first], dtype=np.int64)
            if not lengths.sum():
                continue
            shingles = np.concatenate(first)
            row = np.repeat(np.arange(len(first)), lengths)
            place = (np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            # neither the bits of the cells nor those that the order prefers
            bucket = ((shingles >> 20) % BUCKETS).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            offsets = pa.array(np.append(starts, len(order)), pa.int32())
            columns = {
                "shingle": pa.array(shingles[order]),
                "id": part.column("id").take(pa.array(row[order])),
                "size": pa.array(sizes[row[order]]),
                "place": pa.array(place[order]),
            }
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(bucket[order][starts])}
                | {name: pa.ListArray.from_arrays(offsets, column) for name, column in columns.items()}
            )

    rows = _texts(docs)
    kind = rows.schema["id"].dataType.simpleString()
    lists = f"shingle array<bigint>, id array<{kind}>, size array<int>, place array<int>"
    found = rows.mapInArrow(batches, f"bucket int, {lists}").repartition("bucket")
    return found.select("bucket", F.inline(F.arrays_zip("shingle", "id", "size", "place")))


def shared_prefixes(docs: DataFrame, similarity: float, shingle_words: int = 5) -> DataFrame:
    """shingle, id, size, place, n: the rows of ``prefixes`` whose shingle n > 1 rows have."""
    alike = W.partitionBy("bucket", "shingle")  # no shuffle, as buckets are together
    counted = prefixes(docs, similarity, shingle_words).withColumn("n", F.count("*").over(alike))
    return counted.where("n > 1").drop("bucket")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id"))


def _of_both(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """``pairs`` with the columns of ``table`` for the ids a and b, named a_ and b_."""
    for side in ("a", "b"):
        names = [F.col(c).alias(side if c == "id" else f"{side}_{c}") for c in table.columns]
        pairs = pairs.join(table.select(*names), side)
    return pairs


def differing_bits(a: str, b: str) -> Column:
    """Bits in which two sketches differ, the longer one folded to the length of the other."""
    length = F.least(F.size(a), F.size(b))

    def folded(name: str, word: Column) -> Column:
        places = F.sequence(word, F.size(name) - 1, length)
        return F.aggregate(places, F.lit(0).cast("bigint"), lambda bits, i: bits.bitwiseXOR(F.get(F.col(name), i)))

    words = F.transform(
        F.sequence(F.lit(0), length - 1), lambda w: F.bit_count(folded(a, w).bitwiseXOR(folded(b, w)))
    )
    return F.aggregate(words, F.lit(0), lambda total, n: total + n)


def possible(
    pairs: DataFrame, docs: DataFrame, scratch: Scratch, similarity: float, shingle_words: int
) -> DataFrame:
    """The pairs (a, b) of ids that their sketches allow to reach the similarity."""
    drawn = scratch.table(sketches(docs, _ids(pairs), shingle_words), "shingle-sketches")
    allowed = (F.col("a_size") + F.col("b_size")) * F.lit(1 - similarity) + F.lit(1e-6)
    near = differing_bits("a_sketch", "b_sketch") * F.lit(1 + similarity) <= allowed
    return _of_both(pairs, drawn).where(near).select("a", "b").distinct()


def similar(
    pairs: DataFrame, docs: DataFrame, scratch: Scratch, similarity: float, shingle_words: int
) -> DataFrame:
    """The pairs (a, b) of ids whose sets reach the similarity.

    ``pairs`` is a table, as are the sketches of its documents and the sets of those left: all have a known
    size, so Spark broadcasts them just if they are small, and never makes or shuffles other sets.
    """
    pairs = scratch.table(possible(pairs, docs, scratch, similarity, shingle_words), "shingle-possible")
    wanted = scratch.table(shingle_sets(docs, _ids(pairs), shingle_words), "shingle-wanted")
    both = _of_both(pairs, wanted)
    shared = F.size(F.array_intersect("a_shingles", "b_shingles"))
    every = F.size("a_shingles") + F.size("b_shingles") - shared
    return both.where(shared >= similarity * every - F.lit(1e-9)).select("a", "b").distinct()


def candidates(left: DataFrame, right: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of ids of different groups that share a shingle and may be similar."""
    names = ("id", "size", "place", "component")
    other = right.select("shingle", *[F.col(c).alias(f"other_{c}") for c in names])
    needed = (F.col("size") + F.col("other_size")) * F.lit(similarity / (1 + similarity)) - F.lit(1e-6)
    most = F.least(F.col("size") - F.col("place"), F.col("other_size") - F.col("other_place"))
    met = left.join(other, "shingle").where((F.col("component") != F.col("other_component")) & (most >= needed))
    return met.select(F.least("id", "other_id").alias("a"), F.greatest("id", "other_id").alias("b")).distinct()


def _grouped(members: DataFrame, groups: DataFrame | None) -> DataFrame:
    """``members`` with the component of each id; ids outside of ``groups`` are alone."""
    if groups is None:
        return members.withColumn("component", F.col("id"))
    placed = members.join(groups.withColumnRenamed("node", "id"), "id", "left")
    return placed.withColumn("component", F.coalesce("component", "id"))


def _outside_largest(placed: DataFrame) -> DataFrame:
    """The rows of ``placed`` that are not in the largest component of their shingle."""
    counts = placed.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    largest = counts.groupBy("shingle").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    return placed.join(largest, "shingle").where(F.col("component") != F.col("largest")).drop("largest")


def similar_links(
    docs: DataFrame,
    scratch: Scratch,
    similarity: float = 0.8,
    shingle_words: int = 5,
    hubs: int = 32,
    known: DataFrame | None = None,
    copies: DataFrame | None = None,
) -> DataFrame:
    """Links (a, b) between ids of similar documents, which close to the groups of all such pairs.

    Where no more than ``hubs`` documents share a shingle, all their links are found. ``known`` holds
    links (a, b) from elsewhere: what they join need not be compared. Each ``id`` of ``copies`` must
    be joined by them to an equal text that stays; it is compared with nothing.
    """
    members = shared_prefixes(docs, similarity, shingle_words)
    if copies is not None:
        members = scratch.table(members, "shingle-copies").join(copies, "id", "left_anti")
    members = scratch.table(members, "shingle-members")
    found = []

    def groups() -> DataFrame | None:
        links = [df for df in (known, *found) if df is not None]
        if not links:
            return None
        edges = links[0]
        for df in links[1:]:
            edges = edges.union(df)
        return connected_components(edges, scratch)

    def compare(left: DataFrame, right: DataFrame) -> None:
        pairs = scratch.table(candidates(left, right, similarity), "shingle-pairs")
        if not pairs.isEmpty():
            found.append(scratch.table(similar(pairs, docs, scratch, similarity, shingle_words), "shingle-links"))

    few = _grouped(members.where(F.col("n") <= hubs), groups())
    few = scratch.table(few, "shingle-few")
    compare(few, few)
    crowded = members.where(F.col("n") > hubs)
    size = crowded.count()
    for star in range(STARS + 1 if size else 0):
        placed = scratch.table(_grouped(crowded, groups()), "shingle-crowds")
        apart = scratch.table(_outside_largest(placed), "shingle-apart")
        work = apart.agg(F.sum("n")).first()[0]
        if work is None:
            break
        if star == STARS or work <= hubs * size:
            compare(apart, placed)
            break
        any_one = F.min_by(F.struct("id", "size", "place", "component"), F.xxhash64("id", F.lit(star)))
        compare(apart.groupBy("shingle").agg(any_one.alias("one")).select("shingle", "one.*"), placed)
    links = members.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    for part in found:
        links = links.union(part)
    return links.distinct()


def one_of_each_similar(docs: DataFrame, similarity: float = 0.8, shingle_words: int = 5) -> DataFrame:
    """The rows of ``docs`` but those whose group of linked documents holds a smaller ``doc_id``.

    All columns are kept, and so are rows without an id or a word.
    """
    with Scratch(docs.sparkSession) as scratch:
        links = similar_links(docs, scratch, similarity, shingle_words)
        groups = connected_components(links, scratch)
        dropped = written(
            groups.where(F.col("node") != F.col("component")).select(F.col("node").alias("_dropped")),
            "similar-dropped",
        )
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"))
    return rows.join(dropped, F.col("_id") == F.col("_dropped"), "left_anti").select("row.*")
