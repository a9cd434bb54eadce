"""Totals over a prediction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfacts.operators.median import median_and

STATS_SCHEMA = """row_count bigint, total_revenue double, mean_prediction double,
    median_prediction double, std_prediction double, min_prediction double,
    max_prediction double"""


def prediction_stats(df: DataFrame, approximate_median: bool = False) -> DataFrame:
    """One row: count, sum, mean, median, sample deviation, minimum, maximum.

    Computed at once, in two passes over a persisted copy of the single column.
    ``approximate_median`` needs one lazy pass and is off by at most a ten-thousandth of the ranks.
    """
    value = F.col("prediction")
    statistics = [
        F.count(value).alias("row_count"),
        F.sum(value).alias("total_revenue"),
        F.avg(value).alias("mean_prediction"),
        F.stddev_samp(value).alias("std_prediction"),
        F.min(value).alias("min_prediction"),
        F.max(value).alias("max_prediction"),
    ]
    if approximate_median:
        median = F.percentile_approx(value, F.lit(0.5), F.lit(10_000))
        statistics.insert(3, median.alias("median_prediction"))
        return df.agg(*statistics)
    column = df.select("prediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        median, row = median_and(column, "prediction", statistics)
    finally:
        column.unpersist()
    row = (*row[:3], median, *row[3:])
    return df.sparkSession.createDataFrame([row], STATS_SCHEMA)


def date_range_label(low: Column, high: Column) -> Column:
    def day(date: Column) -> Column:
        return F.date_format(date, "yyyy-MM-dd")

    return F.coalesce(F.concat(day(low), F.lit(" to "), day(high)), F.lit("N/A"))


def date_range(df: DataFrame) -> DataFrame:
    """One row with the covered days as text, or ``N/A`` without any."""
    return df.agg(date_range_label(F.min("date"), F.max("date")).alias("date_range"))


def with_share(per_platform: DataFrame) -> DataFrame:
    """Add each platform's share of the total in percent; 0 if the total is not positive."""
    total = per_platform.agg(F.sum("total_revenue")).scalar()
    share = F.when(total > 0, F.col("total_revenue") / total * 100).otherwise(F.lit(0.0))
    return per_platform.withColumn("share_pct", share)


def platform_summary(df: DataFrame) -> DataFrame:
    """Predicted revenue per platform and its share of the total, largest first."""
    per_platform = df.groupBy("platform").agg(
        F.sum("prediction").alias("total_revenue"), F.avg("prediction").alias("mean_revenue")
    )
    return with_share(per_platform).orderBy(F.desc("total_revenue"), "platform")


def campaign_totals(df: DataFrame, by: Sequence[str] = ("campaign_name",)) -> DataFrame:
    """Predicted revenue per campaign.

    By name alone, equal names on two platforms count as one campaign; pass
    ``("platform", "campaign_id")`` to keep them apart.
    """
    return df.groupBy(*by).agg(F.sum("prediction").alias("total_revenue"))


def top_campaigns(
    df: DataFrame, n: int = 5, by: Sequence[str] = ("campaign_name",)
) -> DataFrame:
    """The ``n`` campaigns with the most predicted revenue; ties go by name."""
    return campaign_totals(df, by).orderBy(F.desc("total_revenue"), *by).limit(n)
