"""Rules every canonical row must meet, and counts of what broke them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from adfacts.functions.cleaning import clamp_negative
from adfacts.schema import (
    CANONICAL_COLUMNS,
    NON_NEGATIVE_COLUMNS,
    REQUIRED_COLUMNS,
    require_columns,
)


def validate(df: DataFrame) -> DataFrame:
    """Drop rows lacking a required value; raise negative amounts to 0.

    Takes no count and triggers no job. Applying it twice changes nothing.
    """
    require_columns(df.columns, CANONICAL_COLUMNS, "canonical table")
    kept = df.na.drop("any", subset=REQUIRED_COLUMNS)
    return kept.select(
        [
            clamp_negative(F.col(c)).cast(kept.schema[c].dataType).alias(c)
            if c in NON_NEGATIVE_COLUMNS
            else F.col(c)
            for c in kept.columns
        ]
    )


def quality_audit(
    df: DataFrame, as_of: Column | None = None, by: tuple[str, ...] = ("platform",)
) -> DataFrame:
    """Every audit count in a single aggregation over rows not yet validated.

    ``dropped_<c>`` counts rows dropped because of column ``c``, each row under the
    first required column it lacks. All other counts are over the rows kept.
    ``as_of`` is the day after which a date lies in the future.
    """
    require_columns(df.columns, CANONICAL_COLUMNS, "canonical table")
    as_of = F.current_date() if as_of is None else as_of
    return _with_first_missing(df).groupBy(*by).agg(*_audit_counts(df.columns, as_of))


def observed(df: DataFrame, observation: Observation, as_of: Column) -> DataFrame:
    """``df`` with the counts of ``quality_audit`` taken on the way, over all of its rows.

    ``observation`` holds them once a job has computed the result; no further pass is made.
    """
    require_columns(df.columns, CANONICAL_COLUMNS, "canonical table")
    counts = _audit_counts(df.columns, as_of)
    return _with_first_missing(df).observe(observation, *counts).drop("first_missing")


def _with_first_missing(df: DataFrame) -> DataFrame:
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED_COLUMNS]
    return df.withColumn("first_missing", F.coalesce(*missing))


def _audit_counts(columns: list[str], as_of: Column) -> list[Column]:
    kept = F.col("first_missing").isNull()
    kept_date = F.when(kept, F.col("date"))
    flags = [c for c in ("negative_revenue", "grain_mismatch") if c in columns]
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(kept).alias("kept_rows"),
        *[F.count_if(F.col("first_missing") == c).alias(f"dropped_{c}") for c in REQUIRED_COLUMNS],
        *[F.count_if(kept & (F.col(c) < 0)).alias(f"negative_{c}") for c in NON_NEGATIVE_COLUMNS],
        *[F.count_if(F.col(c)).alias(f"{c}_rows") for c in flags],
        F.count_if(kept & F.col("revenue").isNull()).alias("revenue_nulls"),
        F.count_if(kept_date > as_of.cast("timestamp_ntz")).alias("future_rows"),
        F.min(kept_date).alias("min_date"),
        F.max(kept_date).alias("max_date"),
        (F.datediff(F.max(kept_date), F.min(kept_date)) + 1).cast("bigint").alias("calendar_days"),
    ]


def revenue_null_audit(df: DataFrame) -> DataFrame:
    """Rows without revenue per platform, and in total (platform ``all``)."""
    # total over the few per-platform rows: a rollup of the input would double it
    per_platform = df.groupBy("platform").agg(
        F.count("*").alias("n"), F.count_if(F.col("revenue").isNull()).alias("nulls")
    )
    totals = per_platform.rollup("platform").agg(
        F.grouping("platform").alias("is_total"),
        F.sum("n").alias("row_count"),
        F.sum("nulls").alias("revenue_nulls"),
    )
    return totals.select(
        F.when(F.col("is_total") == 1, F.lit("all")).otherwise(F.col("platform")).alias("platform"),
        "row_count",
        "revenue_nulls",
        (100.0 * F.col("revenue_nulls") / F.nullif(F.col("row_count"), F.lit(0))).alias(
            "revenue_null_pct"
        ),
    )


def revenue_null_map(df: DataFrame) -> DataFrame:
    """Platform to null count as one map. Its size is the number of platforms."""
    lacking = df.where(F.col("revenue").isNull()).groupBy("platform").agg(F.count("*").alias("n"))
    return lacking.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("platform", "n")))).alias(
            "revenue_nulls"
        )
    )
