"""Benchmark passages found in documents, with DataFrame functions only.

Words are runs of letters and digits, lower-cased; a shingle is ``shingle_words`` of them.

1. *Windows of an item's size.* A window of a document as long as an item can only reach the
   wanted similarity with it if it shares most of its shingles. So it shares one of any
   floor(0.2 n) + 1 of the item's n shingles (for similarity 0.8), and those that fewest items have are
   taken as its anchors. A shingle of the document that is an anchor places the item's window
   there; as words may have been put in or left out before the anchor, the window is also
   placed up to floor(0.2 n) - 4 words off, which is as far as the similarity allows.
   Windows are cut at the ends of the document. Every shingle of every document is looked up.
2. *SimHash with multi-index Hamming blocks.* Windows and items get 64-bit fingerprints. Both
   are cut into radius + 1 blocks: fingerprints within the radius are equal in one of them at
   least, so a join on (item size, block, its bits) yields every pair within the radius.
3. *Exact check.* Pairs within the radius are kept if the weighted Jaccard similarity of their
   shingles (weight: how often it occurs) is at least ``similarity``.

The radius is 24 of 64 bits: a pair at similarity 0.8 differs in 10 bits on average.

Anchors are broadcast after a check of their number. Above ``broadcast_rows`` their hashes alone
are, packed into buckets and in parts of ``lookup_rows``, one scan each, so that memory does not
grow with the benchmark; the places they are found at are joined with the anchors by a shuffle. Words stay on
their task: what leaves it are the hashes of the shingles around an anchor. Items that differ in
their id alone are looked for once, and get their ids when their windows are known.

Defined results: null text or id counts as empty text or is carried through; items with null
text or fewer words than a shingle match nothing. Items equal in
id and text count once, other equal items are each reported. Documents of
fewer words than a shingle are clean. Rows equal in id and text are reported once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adfacts.llm.common import shuffle_partitions, whole_text, written

BITS = 64
HASHES_OF_BUCKET = 32


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _followed(tokens: Column, size: int) -> Column:
    """Each word with the ``size`` - 1 after it, as fields w0, w1, ...; null beyond the end."""
    length = F.greatest(F.size(tokens), F.lit(1))
    return F.arrays_zip(
        *[(F.slice(tokens, k + 1, length) if k else tokens).alias(f"w{k}") for k in range(size)]
    )


def shingles(tokens: Column, size: int) -> Column:
    """All runs of ``size`` words as hashes, in order; none if there are fewer words."""
    full = F.slice(_followed(tokens, size), 1, F.greatest(F.size(tokens) - (size - 1), F.lit(0)))
    return F.transform(full, lambda run: F.xxhash64(*[run[f"w{k}"] for k in range(size)]))


def simhash(hashes: Column) -> Column:
    """A bit is 1 if it is set in more than half of the hashes."""
    one = F.lit(1).cast("bigint")

    def majority(place: Column) -> Column:
        ones = F.filter(hashes, lambda h: _shifted("shiftright", h, place).bitwiseAND(one) == 1)
        return (2 * F.size(ones) > F.size(hashes)).cast("bigint")

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        F.lit(0).cast("bigint"),
        lambda bits, place: bits.bitwiseOR(_shifted("shiftleft", majority(place), place)),
    )


def _shifted(function: str, value: Column, places: Column) -> Column:
    return F.call_function(function, value, places)


def _blocks(fingerprint: Column, radius: int) -> Column:
    """The bits of the radius + 1 blocks, in order."""
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    blocks = [
        F.struct(F.lit(low).alias("low"), F.lit((1 << (high - low)) - 1).cast("bigint").alias("mask"))
        for low, high in zip(edges, edges[1:])
    ]
    return F.transform(
        F.array(*blocks),
        lambda x: _shifted("shiftrightunsigned", fingerprint, x["low"]).bitwiseAND(x["mask"]),
    )


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Shared occurrences over all occurrences; 0 if there are none."""

    def times(xs: Column, x: Column) -> Column:
        return F.size(F.filter(xs, lambda y: y == x))

    shared = F.aggregate(
        F.array_intersect(a, b),
        F.lit(0),
        lambda total, x: total + F.least(times(a, x), times(b, x)),
    )
    every = F.size(a) + F.size(b) - shared
    return (
        F.when((a == b) & (F.size(a) > 0), F.lit(1.0))
        .when(every > 0, shared / every)
        .otherwise(F.lit(0.0))
    )


def benchmark_items(benchmark: DataFrame, shingle_words: int) -> DataFrame:
    """item_id, n_words, hashes, item1, item2 of the items that have a shingle.

    An id may be null or repeated: what an item holds is known by all of its shingles, 128 bits
    of which are item1 and item2.
    """
    # a benchmark is often one small file, whose shingles one task would make
    spread = benchmark.select("item_id", "text").repartition(shuffle_partitions(benchmark.sparkSession))
    return (
        spread.select("item_id", words(whole_text()).alias("tokens"))
        .select(
            "item_id",
            F.size("tokens").alias("n_words"),
            shingles(F.col("tokens"), shingle_words).alias("hashes"),
        )
        .distinct()
        .where(F.col("n_words") >= shingle_words)
        .withColumns(
            {"item1": F.xxhash64("hashes"), "item2": F.xxhash64(F.lit(1), "hashes")}
        )
    )


def distinct_texts(items: DataFrame) -> DataFrame:
    """item1, item2, n_words, hashes, copies, fingerprint: items that differ in their id alone are one."""
    # grouping also keeps Spark from repeating the shingles for each bit
    return (
        items.groupBy("item1", "item2", "n_words", "hashes")
        .agg(F.count("*").alias("copies"))
        .withColumn("fingerprint", simhash(F.col("hashes")))
    )


def anchors(texts: DataFrame, similarity: float, shingle_words: int) -> DataFrame:
    """hash, item1, item2, n_words, at, slack: where in an item of n_words words an anchor stands."""
    lost = F.floor(F.size("hashes") * (1 - similarity) + 1e-9)
    placed = texts.select(
        "item1",
        "item2",
        "n_words",
        "copies",
        lost.alias("lost"),
        F.greatest(lost - (shingle_words - 1), F.lit(0)).cast("int").alias("slack"),
        F.posexplode("hashes").alias("at", "hash"),
    )
    # Repeats within the item count apart: any lost + 1 of its shingles will do.
    common = placed.groupBy("hash").agg(F.sum("copies").alias("items"))
    rank = F.row_number().over(W.partitionBy("item1", "item2", "n_words").orderBy("items", "at"))
    return (
        placed.join(common, "hash")
        .withColumn("rank", rank)
        .where(F.col("rank") <= F.col("lost") + 1)
        .select("hash", "item1", "item2", "n_words", "at", "slack")
        .distinct()
    )


def _reach() -> tuple[Column, Column]:
    """How many words before an anchor, and from it on, the windows that it places can take."""
    return F.col("at") + F.col("slack"), F.col("n_words") - F.col("at") + F.col("slack")


def _with_surroundings(rows: DataFrame, before: Column, after: Column, shingle_words: int, *kept: str) -> DataFrame:
    """``rows`` of a word each, with the shingles of the words around it in place of all tokens.

    n_tokens is the number of words of the document, near_from the first word of ``near``.
    """
    start = F.greatest(F.col("place") - before, F.lit(0))
    end = F.least(F.col("place") + after, F.size("tokens"))
    columns = ["doc_id", "text_hash", "place", "n_tokens", "near_from", *kept]
    return (
        rows.withColumns({"n_tokens": F.size("tokens"), "near_from": start, "near_end": end})
        .select(*columns, F.slice("tokens", F.col("near_from") + 1, F.col("near_end") - F.col("near_from")).alias("near"))
        .select(*columns, shingles(F.col("near"), shingle_words).alias("near"))
    )


def anchored(
    docs: DataFrame, marks: DataFrame, shingle_words: int, broadcast_rows: int, lookup_rows: int
) -> DataFrame:
    """doc_id, text_hash, place, n_tokens, near_from, near, and the anchor's columns: each place
    of a document where an anchor stands. No row holds more of a text than its windows need."""
    rows = (
        docs.select("doc_id", whole_text().alias("text"))
        .select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("tokens"))
        .select("doc_id", "text_hash", "tokens", F.posexplode(_followed(F.col("tokens"), shingle_words)).alias("place", "w"))
        .where(F.col(f"w.w{shingle_words - 1}").isNotNull())
        .withColumn("hash", F.xxhash64(*[F.col(f"w.w{k}") for k in range(shingle_words)]))
    )
    if marks.count() <= broadcast_rows:
        met = rows.join(F.broadcast(marks), "hash")
        return _with_surroundings(met, *_reach(), shingle_words, "item1", "item2", "n_words", "at", "slack")
    before, after = _reach()
    hashes = marks.groupBy("hash").agg(F.max(before).alias("before"), F.max(after).alias("after"))
    hashes = written(hashes, "decontamination-hashes")
    n = hashes.count()
    bucket = F.pmod("hash", F.lit(max(1, n // HASHES_OF_BUCKET)).cast("bigint"))
    # A row of three arrays per bucket, not one per anchor: what is broadcast stays small.
    buckets = written(
        hashes.groupBy(bucket.alias("bucket"))
        .agg(F.collect_list(F.struct("hash", "before", "after")).alias("e"))
        .select(
            "bucket",
            F.col("e.hash").alias("hashes"),
            F.col("e.before").alias("befores"),
            F.col("e.after").alias("afters"),
        ),
        "decontamination-lookup",
    )
    parts = -(-n // lookup_rows)
    met = []
    for part in range(parts):
        of_part = buckets.where(F.pmod("bucket", F.lit(parts).cast("bigint")) == part)
        hit = (
            rows.withColumn("bucket", bucket)
            .join(F.broadcast(of_part), "bucket")
            .withColumn("nth", F.array_position("hashes", F.col("hash")).cast("int"))
            .where(F.col("nth") > 0)
        )
        reach = [F.get(F.col(c), F.col("nth") - 1) for c in ("befores", "afters")]
        met.append(_with_surroundings(hit, *reach, shingle_words, "hash"))
    return reduce(DataFrame.unionAll, met).join(marks.hint("merge"), "hash").drop("hash")


def contaminated_texts(
    docs: DataFrame,
    texts: DataFrame,
    similarity: float = 0.8,
    shingle_words: int = 5,
    radius: int = 24,
    broadcast_rows: int = 500_000,
    lookup_rows: int = 4_000_000,
) -> DataFrame:
    """doc_id, text_hash, item1, item2, start (word number from 0), n_words, similarity: every
    window of ``docs`` that reaches ``similarity`` with one of ``texts`` of its size."""
    marks = written(anchors(texts, similarity, shingle_words), "decontamination-anchors")
    # Spark takes the size of a file for that of its rows, which blocks and hashes exceed by far.
    n_values = texts.agg(F.sum(F.size("hashes") + radius + 1)).first()[0] or 0
    way = "broadcast" if n_values <= broadcast_rows else "merge"
    # A window keeps the item whose anchor placed it, and meets no other item.
    found = anchored(docs, marks, shingle_words, broadcast_rows, lookup_rows).select(
        "doc_id",
        "text_hash",
        "item1",
        "item2",
        "n_words",
        "n_tokens",
        "near_from",
        "near",
        F.explode(F.sequence(-F.col("slack"), F.col("slack"))).alias("off"),
        (F.col("place") - F.col("at")).alias("place"),
    )
    start, end = F.col("place") + F.col("off"), F.col("place") + F.col("off") + F.col("n_words")
    from_word = F.greatest(start, F.lit(0))
    n_hashes = F.least(end, F.col("n_tokens")) - from_word - (shingle_words - 1)
    # Several anchors may place the same window. Its shingles are those around the anchor, cut
    # at its ends, and are taken before that is settled: Spark would otherwise
    # take them anew for every bit of the fingerprint.
    windows = (
        found.where((end > 0) & (start < F.col("n_tokens")))
        .select(
            "doc_id",
            "text_hash",
            "item1",
            "item2",
            "n_words",
            from_word.alias("start"),
            F.slice("near", from_word - F.col("near_from") + 1, F.greatest(n_hashes, F.lit(0))).alias("hashes"),
        )
        .distinct()
        .where(F.size("hashes") > 0)
    )
    windows = written(
        windows.withColumn("fingerprint", simhash(F.col("hashes"))), "decontamination-windows"
    )

    # Rows of blocks are many: they hold fingerprints alone, and hashes are joined to the pairs that are left.
    by_window = windows.select(
        "doc_id", "text_hash", "item1", "item2", "start", F.col("fingerprint").alias("print"),
        F.posexplode(_blocks(F.col("fingerprint"), radius)).alias("block", "bits"),
    )
    by_item = texts.select(
        "item1", "item2", F.col("fingerprint").alias("item_print"),
        F.posexplode(_blocks(F.col("fingerprint"), radius)).alias("block", "bits"),
    )
    differs = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    # A pair may meet in several blocks: it is kept at its first equal block alone.
    blocks = F.zip_with(
        _blocks(F.col("print"), radius), _blocks(F.col("item_print"), radius), lambda x, y: x == y
    )
    first_block = F.array_position(blocks, True)
    pairs = (
        by_window.join(by_item.hint(way), ["item1", "item2", "block", "bits"])
        .where(differs <= radius)
        .where(first_block == F.col("block") + 1)
        .select(
            F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("item1").alias("_item1"),
            F.col("item2").alias("_item2"), F.col("start").alias("_start"),
        )
    )
    paired = (
        F.col("doc_id").eqNullSafe(F.col("_id"))
        & (F.col("text_hash") == F.col("_hash"))
        & (F.col("item1") == F.col("_item1"))
        & (F.col("item2") == F.col("_item2"))
        & (F.col("start") == F.col("_start"))
    )
    item_hashes = texts.select("item1", "item2", F.col("hashes").alias("item_hashes"))
    equal = weighted_jaccard(F.col("hashes"), F.col("item_hashes"))
    return (
        windows.join(pairs, paired, "left_semi")
        .join(item_hashes.hint(way), ["item1", "item2"])
        .withColumn("similarity", equal)
        .where(F.col("similarity") >= similarity)
        .select("doc_id", "text_hash", "item1", "item2", "start", "n_words", "similarity")
    )


def _items_and_texts(benchmark: DataFrame, shingle_words: int) -> tuple[DataFrame, DataFrame]:
    items = written(benchmark_items(benchmark, shingle_words), "decontamination-items")
    return items, written(distinct_texts(items), "decontamination-texts")


def contaminated_windows(
    docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, **settings: float
) -> DataFrame:
    """doc_id, text_hash, item_id, start (word number from 0), n_words, similarity: every
    window of ``docs`` that reaches ``similarity`` with an item of its size."""
    items, texts = _items_and_texts(benchmark, shingle_words)
    found = contaminated_texts(docs, texts, shingle_words=shingle_words, **settings)
    return found.join(items.select("item1", "item2", "item_id"), ["item1", "item2"]).select(
        "doc_id", "text_hash", "item_id", "start", "n_words", "similarity"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, **settings: float
) -> DataFrame:
    """doc_id, item_id, start, n_words, similarity: the best window of each document and item."""

    def best(of: str = "") -> Column:
        row = F.struct(*[F.col(f"{of}{c}").alias(c) for c in ("start", "n_words", "similarity")])
        return F.max_by(row, F.struct(F.col(f"{of}similarity"), -F.col(f"{of}start"))).alias("best")

    items, texts = _items_and_texts(benchmark, shingle_words)
    # The best of a text first: items equal in it share that window. Then ids, which several texts may share.
    found = contaminated_texts(docs, texts, shingle_words=shingle_words, **settings)
    of_text = found.groupBy("doc_id", "text_hash", "item1", "item2").agg(best())
    return (
        of_text.join(items.select("item1", "item2", "item_id"), ["item1", "item2"])
        .groupBy("doc_id", "text_hash", "item_id")
        .agg(best("best."))
        .select("doc_id", "item_id", "best.*")
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, **settings: float
) -> DataFrame:
    """The documents in which no benchmark item was found, with all their columns."""
    _, texts = _items_and_texts(benchmark, shingle_words)
    hits = written(
        contaminated_texts(docs, texts, shingle_words=shingle_words, **settings)
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct(),
        "decontamination-hits",
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.xxhash64(whole_text()).alias("_text_hash")
    )
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    return rows.join(hits, same, "left_anti").select("row.*")
