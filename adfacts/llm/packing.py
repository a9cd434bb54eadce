"""Packing into length buckets whose bounds minimise padding.

1. A global histogram of lengths, combined before the shuffle. Lengths are grouped into
   cells no wider than 1/512 of the length (every length below 1,024 is a cell of its own), so the
   histogram is bounded: at most some 14,000 cells up to a length of 2^32. Each cell knows its
   exact number of rows, sum and maximum of lengths.
2. Dynamic programming over the cells finds at most ``buckets`` bounds, each the exact maximum
   of a cell, with the least total padding. It is exact for these cells. The optimum's split
   points never move back, so each layer is solved by halving: O(buckets * cells * log cells).
3. A row goes to the first bucket whose bound is not below its length. A batch of a bucket
   holds ``token_budget // bound`` rows, one at least: a row longer than the budget is alone.
   Rows are numbered within slices of a bucket (a hash of the id), and a slice starts where
   the one before it ends. A bucket that holds a third of all rows is thus numbered by many
   tasks, and only the last batch of each bucket may be short.

Length is the number of words of the whole text; a caller with token counts names its column.

Defined results: a null or empty text has length 0, counts as padding up to its bound, and is
packed like any other. A null id is allowed. Repeated rows are packed once each, and ties
change only which of the equal rows comes first. An empty table gives an empty result.
Nothing is cut or dropped. Other columns are not returned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adfacts.llm.common import WORD, shuffle_partitions, whole_text, written

CELL_BITS = 9


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def _cell(length: Column) -> Column:
    """The length with all but its first CELL_BITS + 1 binary digits cleared."""
    digits = F.length(F.bin(length))
    drop = F.greatest(digits - F.lit(CELL_BITS + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", length, drop), drop)


def optimal_bounds(
    maxima: list[int], rows: list[int], sums: list[int], buckets: int
) -> tuple[list[int], int]:
    """Bounds (rising, the last is the largest length) and the total padding.

    ``maxima`` are the cells' largest lengths, rising. Among equal sums of padding the
    leftmost split is taken, and no more buckets are used than lower it.
    """
    cells = len(maxima)
    if cells == 0:
        return [], 0
    top = np.array(maxima, dtype=np.int64)
    count = np.concatenate([[0], np.cumsum(np.array(rows, dtype=np.int64))])
    total = np.concatenate([[0], np.cumsum(np.array(sums, dtype=np.int64))])

    def padding(start: np.ndarray, end: int) -> np.ndarray:
        """Of one bucket over the cells start..end-1."""
        return top[end - 1] * (count[end] - count[start]) - (total[end] - total[start])

    best = np.array([padding(np.array([0]), end)[0] if end else 0 for end in range(cells + 1)])
    splits = [np.zeros(cells + 1, dtype=np.int64)]
    for used in range(2, min(buckets, cells) + 1):
        layer, split = best.copy(), np.zeros(cells + 1, dtype=np.int64)
        todo = [(used, cells, used - 1, cells - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            end = (low + high) // 2
            starts = np.arange(first, min(last, end - 1) + 1)
            costs = best[starts] + padding(starts, end)
            at = int(starts[np.argmin(costs)])
            layer[end], split[end] = costs.min(), at
            todo += [(low, end - 1, first, at), (end + 1, high, at, last)]
        if layer[cells] >= best[cells]:
            break
        best = layer
        splits.append(split)
    bounds, end = [], cells
    for split in reversed(splits):
        bounds.append(maxima[end - 1])
        end = int(split[end])
    return bounds[::-1], int(best[cells])


def length_histogram(lengths: DataFrame) -> DataFrame:
    """cell, longest, n, total; ``lengths`` has a bigint column ``length``."""
    return lengths.groupBy(_cell(F.col("length")).alias("cell")).agg(
        F.max("length").alias("longest"), F.count("*").alias("n"), F.sum("length").alias("total")
    )


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: str | None = None,
    buckets: int = 16,
    token_budget: int = 16_384,
) -> DataFrame:
    """doc_id, n_tokens, bucket (from 0), padded_length, batch (from 0, within the bucket),
    position (from 0, within the batch): one row per row of ``docs``."""
    spark = docs.sparkSession
    known = F.coalesce(F.col(length), F.lit(0)) if length else word_count(whole_text(text))
    slices = shuffle_partitions(spark)
    # The text's hash only tells rows with one id apart, so that numbering is reproducible.
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            known.cast("bigint").alias("length"),
            F.xxhash64(whole_text(text)).alias("tie") if text in docs.columns else F.lit(0).alias("tie"),
        ),
        "packing-lengths",
    )
    cells = length_histogram(rows).orderBy("cell").collect()  # bounded, see above
    bounds, _ = optimal_bounds(
        [c["longest"] for c in cells], [c["n"] for c in cells], [c["total"] for c in cells], buckets
    )
    bucket, padded = F.lit(None).cast("int"), F.lit(None).cast("bigint")
    for i, bound in reversed(list(enumerate(bounds))):
        here = F.col("length") <= bound
        bucket = F.when(here, F.lit(i)).otherwise(bucket)
        padded = F.when(here, F.lit(bound).cast("bigint")).otherwise(padded)
    placed = rows.select(
        "doc_id", "length", "tie",
        bucket.alias("bucket"),
        padded.alias("padded_length"),
        F.pmod(F.xxhash64("doc_id", "tie"), F.lit(slices)).cast("int").alias("slice"),
    )
    # At most buckets * slices rows, whatever the data: small enough to send everywhere.
    offsets = placed.groupBy("bucket", "slice").agg(F.count("*").alias("n"))
    before = W.partitionBy("bucket").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = offsets.select(
        "bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = W.partitionBy("bucket", "slice").orderBy("doc_id", "tie", "length")
    number = F.col("offset") + F.row_number().over(within) - 1
    capacity = F.greatest(
        F.floor(F.lit(token_budget) / F.greatest("padded_length", F.lit(1))), F.lit(1)
    )
    return (
        placed.join(F.broadcast(offsets), ["bucket", "slice"])
        .withColumn("number", number)
        .select(
            "doc_id",
            F.col("length").alias("n_tokens"),
            "bucket",
            "padded_length",
            F.floor(F.col("number") / capacity).alias("batch"),
            (F.col("number") % capacity).alias("position"),
        )
    )
