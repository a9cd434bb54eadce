"""The tables behind the evaluation charts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfacts.operators.metrics import checked_metrics, regression_metrics
from adfacts.schema import PREDICTION_KEYS, require_columns


def _pairs(df: DataFrame, actual: str, prediction: str) -> DataFrame:
    require_columns(df.columns, [actual, prediction], "evaluation")
    keys = [c for c in PREDICTION_KEYS if c in df.columns]
    return df.select(
        *keys,
        F.col(actual).cast("double").alias("actual"),
        F.col(prediction).cast("double").alias("predicted"),
    )


def actual_vs_predicted(
    df: DataFrame, actual: str = "revenue", prediction: str = "prediction"
) -> DataFrame:
    """Both values summed per date: the two lines of the chart."""
    return (
        _pairs(df, actual, prediction)
        .groupBy("date")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"))
    )


def residuals(df: DataFrame, actual: str = "revenue", prediction: str = "prediction") -> DataFrame:
    """Actual minus predicted for every row, next to its keys."""
    pairs = _pairs(df, actual, prediction)
    return pairs.withColumn("residual", F.col("actual") - F.col("predicted"))


def _bucket(value: str, low: Column, high: Column, buckets: int) -> Column:
    """Equal-width bucket number 0 to ``buckets`` - 1; a single value is bucket 0."""
    width = F.nullif((high - low) / F.lit(float(buckets)), F.lit(0.0))
    number = F.floor((F.col(value) - low) / width)
    return F.least(F.coalesce(number, F.lit(0)), F.lit(buckets - 1)).cast("bigint")


def residual_buckets(
    df: DataFrame, actual: str = "revenue", prediction: str = "prediction", buckets: int = 20
) -> DataFrame:
    """Residuals per bucket of the predicted value: the scatter plot at any size."""
    rows = residuals(df, actual, prediction)
    bounds = rows.agg(
        F.struct(F.min("predicted").alias("low"), F.max("predicted").alias("high")).alias("b")
    ).scalar()
    return (
        rows.select(
            "predicted",
            "residual",
            _bucket("predicted", bounds["low"], bounds["high"], buckets).alias("bucket"),
        )
        .groupBy("bucket")
        .agg(
            F.count("*").alias("row_count"),
            F.min("predicted").alias("min_predicted"),
            F.max("predicted").alias("max_predicted"),
            F.avg("residual").alias("mean_residual"),
            F.min("residual").alias("min_residual"),
            F.max("residual").alias("max_residual"),
        )
    )


def prediction_error(
    df: DataFrame, actual: str = "revenue", prediction: str = "prediction", buckets: int = 20
) -> DataFrame:
    """Row counts per (actual, predicted) bucket over the range of the identity line.

    ``line_low`` and ``line_high`` are the ends of that line: the smallest and the
    largest value of either kind.
    """
    pairs = _pairs(df, actual, prediction)
    bounds = pairs.agg(
        F.struct(
            F.least(F.min("actual"), F.min("predicted")).alias("low"),
            F.greatest(F.max("actual"), F.max("predicted")).alias("high"),
        ).alias("b")
    ).scalar()
    low, high = bounds["low"], bounds["high"]
    return (
        pairs.select(
            _bucket("actual", low, high, buckets).alias("actual_bucket"),
            _bucket("predicted", low, high, buckets).alias("predicted_bucket"),
            low.alias("line_low"),
            high.alias("line_high"),
        )
        .groupBy("actual_bucket", "predicted_bucket")
        .agg(
            F.count("*").alias("row_count"),
            F.first("line_low").alias("line_low"),
            F.first("line_high").alias("line_high"),
        )
    )


def importance_table(importance: DataFrame) -> DataFrame:
    """Features by falling importance; an empty or misshapen table is an error."""
    require_columns(importance.columns, ["feature", "importance"], "feature importance")
    if importance.isEmpty():
        raise ValueError("the feature importance table is empty")
    return importance.select("feature", "importance").orderBy(F.desc("importance"), "feature")


@dataclass(frozen=True)
class EvaluationReport:
    """Metrics and chart tables of one set of predictions; all but the checks is lazy."""

    metrics: DataFrame
    actual_vs_predicted: DataFrame
    residuals: DataFrame
    residual_buckets: DataFrame
    prediction_error: DataFrame
    feature_importance: DataFrame | None


def evaluate(
    df: DataFrame,
    importance: DataFrame | None = None,
    actual: str = "revenue",
    prediction: str = "prediction",
    by: tuple[str, ...] = (),
) -> EvaluationReport:
    """Bundle of all evaluation tables. Empty input or missing values are errors."""
    overall = checked_metrics(df, actual, prediction)
    if by:
        metrics = regression_metrics(df, actual, prediction, by)
    else:  # the row that was checked
        schema = regression_metrics(df, actual, prediction).schema
        metrics = df.sparkSession.createDataFrame([tuple(overall.values())], schema)
    return EvaluationReport(
        metrics=metrics,
        actual_vs_predicted=actual_vs_predicted(df, actual, prediction),
        residuals=residuals(df, actual, prediction),
        residual_buckets=residual_buckets(df, actual, prediction),
        prediction_error=prediction_error(df, actual, prediction),
        feature_importance=None if importance is None else importance_table(importance),
    )
