"""Exact median without gathering the values in one place."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


# A rank read from Spark's quantile sketch is off by at most one part in ``ACCURACY`` of the rows.
ACCURACY = 10_000


def exact_median(
    df: DataFrame, column: str, bins: int = 4096, final_rows: int = 100_000
) -> float | None:
    """Median of the non-NULL values, exact for any number of rows; see ``median_and``."""
    return median_and(df, column, [], bins, final_rows)[0]


def median_and(
    df: DataFrame,
    column: str,
    others: Sequence[Column],
    bins: int = 4096,
    final_rows: int = 100_000,
) -> tuple[float | None, Row]:
    """The exact median of the non-NULL values, and a row of ``others``, aggregates of ``df``.

    Spark's own exact median keeps every distinct value of a group in one task. Here the
    pass that takes the other aggregates also keeps a mergeable quantile sketch. Its
    error bound brackets the middle ranks, and a second pass counts the rows below the bracket
    and the distinct values within it, a few ten-thousandths of the rows at most. Only if
    these may be more than ``final_rows`` does it go on with counts per equal-width bin, which
    narrow the bracket pass by pass. Each pass reads ``df`` again.
    """
    v = F.col(column).cast("double")
    # NaN sorts above infinity, as everywhere in Spark; only finite values are bracketed.
    is_nan = F.isnan(v)
    finite = F.when(~is_nan & (F.abs(v) < math.inf), v)
    step = 2 / ACCURACY  # the sketch's error, twice
    ends = [F.lit(share) for share in (0.0, 0.5 - step, 0.5 + step, 1.0)]
    row = df.agg(
        *others,
        F.count_if(v == -math.inf).alias("_lowest"),
        F.count_if(is_nan).alias("_nans"),
        F.count(finite).alias("_finite"),
        F.count(v).alias("_total"),
        F.percentile_approx(finite, F.array(*ends), F.lit(ACCURACY)).alias("_ends"),
        F.min(finite).alias("_min"),
        F.max(finite).alias("_max"),
    ).first()
    lowest, nans, count, total, ends, low, high = row[-7:]
    rest = Row(*row.__fields__[:-7])(*row[:-7])
    if total == 0:
        return None, rest
    values = df.select(v.alias("v")).where(finite.isNotNull())
    below, above = (total - 1) // 2, total // 2
    wanted = {rank: _outside(rank, lowest, count, total, nans) for rank in (below, above)}
    inside = sorted({rank - lowest for rank, value in wanted.items() if value is None})
    # the bracket is that of the middle of the finite values: infinite ones move the middle
    middle = lowest == 0 and count == total
    bracket = (ends[1], ends[2]) if middle and count > ACCURACY else (low, high)
    within = 3 * step * count + 2 if middle and count > ACCURACY else count
    found: dict[int, float] = {}
    if bracket[0] == bracket[1]:
        found = dict.fromkeys(inside, bracket[0])
    elif inside and within <= final_rows:
        found = _in_bracket(values, *bracket, inside)
    elif inside:
        found = _narrowed(values, *bracket, inside, bins, final_rows)
    first, second = (
        wanted[rank] if wanted[rank] is not None else found[rank - lowest] for rank in (below, above)
    )
    if below == above:
        return first, rest
    return first / 2 + second / 2 if math.isinf(first + second) else (first + second) / 2, rest


def _outside(rank: int, lowest: int, count: int, total: int, nans: int) -> float | None:
    """The value at a rank that holds no finite one."""
    if rank < lowest:
        return -math.inf
    if rank >= lowest + count:
        return math.nan if rank >= total - nans else math.inf
    return None


def _in_bracket(values: DataFrame, low: float, high: float, ranks: Sequence[int]) -> dict[int, float]:
    """The values at some ranks, all of which lie between two values."""
    kept = F.when(F.col("v") < low, F.lit(-math.inf)).otherwise(F.col("v")).alias("v")
    counted = values.where(F.col("v") <= high).groupBy(kept).agg(F.count("*").alias("n"))
    found, before = {}, 0
    for value, n in sorted(map(tuple, counted.collect())):
        found |= {rank: value for rank in ranks if before <= rank < before + n}
        before += n
    return found


def _narrowed(
    values: DataFrame, low: float, high: float, ranks: Sequence[int], bins: int, final_rows: int
) -> dict[int, float]:
    """The same for brackets with too many distinct values to be fetched."""
    v = F.col("v")
    before, n = values.agg(F.count_if(v < low), F.count_if(v.between(low, high))).first()
    between, found = values.where(v.between(low, high)), {}
    for rank in ranks:
        if rank - 1 in found:
            found[rank] = _next_value(between, found[rank - 1], rank - before)
        else:
            found[rank] = _value_at(between, rank - before, n, low, high, bins, final_rows)
    return found


def _next_value(values: DataFrame, value: float, rank: int) -> float:
    """The value at ``rank``, given that ``value`` sits just before it."""
    up_to, following = values.agg(
        F.count_if(F.col("v") <= value), F.min(F.when(F.col("v") > value, F.col("v")))
    ).first()
    return value if up_to > rank else following


def _value_at(
    values: DataFrame, rank: int, count: int, low: float, high: float, bins: int, final_rows: int
) -> float:
    while low < high and count > final_rows:
        counted = (
            values.where(F.col("v").between(low, high))
            .groupBy(_bin(low, high, bins).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .orderBy("bin")
            .collect()
        )
        before = count
        for row in counted:
            if rank < row["n"]:
                count, low, high = row["n"], row["low"], row["high"]
                break
            rank -= row["n"]
        if count >= before:
            raise ArithmeticError("the bins do not tell the values apart")
    if low == high:
        return low
    inside = values.where(F.col("v").between(low, high))
    return inside.agg(F.array_sort(F.collect_list("v")).getItem(rank)).first()[0]


def _bin(low: float, high: float, bins: int) -> Column:
    """Bin number, rising with the value; the smallest and the largest never share one."""
    width = (high - low) / bins
    if width == 0.0:  # too narrow to divide: each value is its own bin
        return F.col("v")
    if math.isinf(width):  # too wide to subtract
        return (F.col("v") >= 0).cast("bigint")
    return F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
