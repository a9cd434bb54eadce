"""Row-based windows over campaign histories of any length.

A window over (platform, campaign) puts one campaign into one task. Daily facts of a
campaign are few, but nothing in the data enforces that: one campaign may hold a third of
all rows, or all of them. ``with_history`` therefore cuts the ordered rows of all campaigns
into pieces of about equal size, wherever the cuts fall, and gives the campaign that crosses
a cut its last few rows from before it (its look-back). The result is the same, row for row,
as one window per campaign. There is no other way for small data, and no limit on lengths.

1. The rows are written once, so that the input is computed once, and their place in the
   written files tells equal rows apart. A task that is run again sees the same places.
2. They are range-partitioned by campaign, time and place, sorted, numbered, and written.
3. One aggregation finds where each campaign starts and ends in each piece. From these few
   numbers follows which rows before a cut are needed after it.
4. One window per campaign and piece gives the columns; look-back rows are left out again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adfacts.schema import CANONICAL_COLUMNS, SERIES_KEYS
from adfacts.session import delete_folder, folder_bytes, write_shared

PIECE = "_piece"
AT = "_at"
PLACE = "_place"
IS_LOOK_BACK = "_is_look_back"

# The campaign comes first: a sort compares the first bytes of its first key, and the
# few platform names would leave them equal.
WINDOW_KEYS = list(reversed(SERIES_KEYS))

WindowColumns = Callable[[WindowSpec], dict[str, Column]]


@dataclass(frozen=True)
class SkewPolicy:
    """Into how many pieces the rows are cut.

    ``pieces=None`` means one for every ``piece_bytes`` of the rows as written, and
    ``spark.sql.shuffle.partitions`` at least, small pieces merged by adaptive execution: a
    task's share does not grow with the table. ``unique_grain`` states that each campaign has at
    most one row per day. Its history is then no longer than the calendar, and nothing has to be cut.
    """

    pieces: int | None = None
    unique_grain: bool = False
    piece_bytes: int = 64 << 20

    def pieces_of(self, written_bytes: int, least: int) -> int | None:
        """Number of pieces to cut into; None leaves it to Spark."""
        needed = -(-written_bytes // self.piece_bytes)
        return self.pieces or (needed if needed > least else None)


def time_order(df: DataFrame) -> list[Column]:
    """By date, then by every other canonical column: ties are broken by content alone."""
    ties = [c for c in CANONICAL_COLUMNS if c in df.columns and c not in [*SERIES_KEYS, "date"]]
    return [F.col(c) for c in ["date", *ties]]


def with_history(
    df: DataFrame, build: WindowColumns, look_back: int, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Add the columns of ``build(window)``, which look at most ``look_back`` rows back.

    Unless ``policy.unique_grain`` is stated, this writes the cut rows to the shared folder
    before it returns; they have to last until the result is used.
    """
    if policy.unique_grain:
        return _windowed(df, build, W.partitionBy(*WINDOW_KEYS).orderBy(*time_order(df)))
    cut = _cut(df, policy)
    rows = cut.withColumn(IS_LOOK_BACK, F.lit(False)).unionByName(
        _look_back_rows(cut, look_back).withColumn(IS_LOOK_BACK, F.lit(True))
    )
    wide = _windowed(rows, build, W.partitionBy(*WINDOW_KEYS, PIECE).orderBy(AT))
    return wide.where(~F.col(IS_LOOK_BACK)).drop(PIECE, AT, IS_LOOK_BACK)


def _windowed(df: DataFrame, build: WindowColumns, window: WindowSpec) -> DataFrame:
    return df.select("*", *[c.alias(name) for name, c in build(window).items()])


def _cut(df: DataFrame, policy: SkewPolicy) -> DataFrame:
    """``df`` with ``PIECE`` and ``AT``: ``AT`` rises in campaign and time order, and by one
    from row to row of a piece. Written, as range bounds are sampled anew by every run."""
    spark = df.sparkSession
    path = write_shared(df, "history-rows")
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    placed = spark.read.schema(df.schema).parquet(path).select("*", place.alias(PLACE))
    order = [*[F.col(k) for k in WINDOW_KEYS], *time_order(df), F.col(PLACE)]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = policy.pieces_of(folder_bytes(spark, path), least)
    ranged = placed.repartitionByRange(*([pieces] if pieces else []), *order)
    cut = (
        ranged.sortWithinPartitions(*order)
        .drop(PLACE)
        .withColumns({PIECE: F.spark_partition_id(), AT: F.monotonically_increasing_id()})
    )
    cut_path = write_shared(cut, "history-pieces")
    delete_folder(spark, path)
    return spark.read.schema(cut.schema).parquet(cut_path)


def _look_back_rows(cut: DataFrame, look_back: int) -> DataFrame:
    """The rows that the first campaign of a piece needs from earlier ones, under its piece.

    A piece of a campaign has at least one row, so ``look_back`` earlier pieces are enough.
    """
    runs = cut.groupBy(*WINDOW_KEYS, PIECE).agg(
        F.min(AT).alias("start"), F.max(AT).alias("end"), F.count("*").alias("n")
    )
    # one row per campaign and piece: the longest campaign has as many as there are pieces
    history = W.partitionBy(*WINDOW_KEYS).orderBy(PIECE)
    donors = F.collect_list(F.struct(PIECE, "start", "end", "n", "before")).over(
        history.rowsBetween(-look_back, -1)
    )
    needed = (
        runs.withColumn("before", F.sum("n").over(history) - F.col("n"))
        .select(F.col(PIECE).alias("_owner"), F.col("before").alias("_rows"), donors.alias("d"))
        .select("_owner", "_rows", F.inline("d"))
        .select(
            "_owner",
            PIECE,
            (F.col("start") + F.greatest(F.lit(0), F.col("_rows") - look_back - F.col("before")))
            .alias("_low"),
            F.col("end").alias("_high"),
        )
        .where(F.col("_low") <= F.col("_high"))
    )
    # about one row per piece: written first, so that Spark knows the size when it joins
    spark = cut.sparkSession
    ranges = spark.read.schema(needed.schema).parquet(write_shared(needed, "history-borders"))
    return (
        cut.join(ranges, PIECE)
        .where(F.col(AT).between(F.col("_low"), F.col("_high")))
        .withColumn(PIECE, F.col("_owner"))
        .select(*cut.columns)
    )
