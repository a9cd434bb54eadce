"""Every registered query: a name, and a function of (session, table folder)."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfacts.functions import cleaning
from adfacts.operators import evaluation, features, metrics, rollups
from adfacts.operators.series import SkewPolicy, with_history
from adfacts.operators.validation import (
    quality_audit,
    revenue_null_audit,
    revenue_null_map,
    validate,
)
from adfacts.plans import forecast, jobs, report
from adfacts.plans.config import JobConfig
from adfacts.sources import SOURCES, ingest, load_source, normalise, read_export
from adfacts.sources.exports import in_canonical_order, ingest_summary, unified_summary
from workloads import facts

Query = Callable[[SparkSession, str], DataFrame]

# The daily adapters group by campaign and day, so no campaign outgrows the calendar.
DAILY = SkewPolicy(unique_grain=True)
# More pieces than the test tables need, so that campaigns cross their borders.
PIECES = SkewPolicy(pieces=16)

ROLLING = {
    f"{metric}_rolling_{kind}_{rows}": 6 if kind == "mean" else 4
    for metric in features.HISTORY_METRICS
    for kind in ("mean", "std")
    for rows in features.ROLLING_ROWS
}


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Sums of doubles depend on their order in the last bits: round before comparing."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items() if c in df.columns})


def sources(spark: SparkSession, sf_dir: str, audit: bool = False) -> list[DataFrame]:
    paths = facts.export_paths(spark, sf_dir)
    return [
        normalise(read_export(spark, paths[p], spec.required), spec, audit=audit)
        for p, spec in SOURCES.items()
    ]


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def one_source(platform: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = facts.export_paths(spark, sf_dir)[platform]
        return load_source(spark, path, SOURCES[platform])

    return query


def scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_export(spark, facts.export_paths(spark, sf_dir)["google_ads"])


def ingest_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, facts.export_paths(spark, sf_dir))


def clean_thousands(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_export(spark, facts.export_paths(spark, sf_dir)["microsoft_ads"])
    return raw.select(
        *[
            cleaning.strip_commas(F.col(c)).alias(c.lower())
            for c in ("Impressions", "Spend", "Revenue")
        ]
    )


def campaign_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = union(sources(spark, sf_dir))
    return rows.groupBy("platform", "campaign_name", "campaign_id").agg(
        F.count("*").alias("row_count")
    )


def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union(sources(spark, sf_dir)).select("platform", "spend", "conversions")


def coerce_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union(sources(spark, sf_dir)).select("platform", "clicks", "impressions")


def revenue_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = union(sources(spark, sf_dir, audit=True))
    return rows.groupBy("platform", "revenue", "negative_revenue").agg(
        F.count("*").alias("row_count")
    )


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = union(
        [
            read_export(spark, path).select(F.col(SOURCES[p].columns["date"]).alias("date_text"))
            for p, path in facts.export_paths(spark, sf_dir).items()
        ]
    )
    # each distinct text is read once
    counted = texts.groupBy("date_text").agg(F.count("*").alias("row_count"))
    return counted.select(
        "date_text", cleaning.to_date_time(F.col("date_text")).alias("date"), "row_count"
    )


def parse_date_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = facts.date_texts(spark, sf_dir).withColumn("date", cleaning.to_date_time(F.col("date_text")))
    return read.groupBy("date_text", "date").agg(F.count("*").alias("row_count"))


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_audit(
        union(sources(spark, sf_dir, audit=True)), F.lit(datetime.date(2001, 6, 1))
    )


def on_facts(make: Callable, change: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: change(make(spark, sf_dir))


def on_shipments(change: Callable[[DataFrame], DataFrame]) -> Query:
    return on_facts(facts.shipment_facts, change)


def feature_rows(policy: SkewPolicy) -> Callable[[DataFrame], DataFrame]:
    return lambda df: rounded(features.feature_table(df, policy), ROLLING)


def matrix(config: JobConfig) -> Callable[[DataFrame], DataFrame]:
    return lambda df: rounded(
        forecast.model_matrix(features.feature_table(df, DAILY), config), ROLLING
    )


def naive_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's revenue as the forecast, where both days have one."""
    rows = with_history(
        facts.shipment_facts(spark, sf_dir),
        lambda window: {"prediction": F.lag("revenue", 1).over(window)},
        look_back=1,
        policy=DAILY,
    )
    return rows.where(F.col("revenue").isNotNull() & F.col("prediction").isNotNull())


def on_naive(change: Callable[[DataFrame], DataFrame], **digits: int) -> Query:
    return lambda spark, sf_dir: rounded(change(naive_predictions(spark, sf_dir)), digits)


METRIC_DIGITS = dict(rmse=6, mae=6, r2=6, mape=6, mape_nonzero=6)


def evaluation_report(df: DataFrame) -> DataFrame:
    """All six tables: their row counts, and two sums over the content of each."""
    importance = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                    for c in features.HISTORY_METRICS
                ]
            )
        )
    )
    importance = importance.groupBy("feature").agg(F.max("value").alias("importance"))
    bundle = evaluation.evaluate(df, importance, by=("platform",))
    position = F.col("actual_bucket") * 20 + F.col("predicted_bucket")
    sums = {
        "metrics": (F.col("rmse"), F.col("mae")),
        "actual_vs_predicted": (F.col("actual"), F.abs(F.col("actual") - F.col("predicted"))),
        "residuals": (F.abs(F.col("residual")), F.col("predicted")),
        "residual_buckets": (F.col("bucket") * F.col("row_count"), F.col("max_residual")),
        "prediction_error": (position * F.col("row_count"), F.col("line_high") - F.col("line_low")),
        "feature_importance": (F.col("importance"), F.length("feature")),
    }
    return union(
        [
            getattr(bundle, part).agg(
                F.count("*").alias("row_count"),
                *[
                    F.round(F.sum(value.cast("double")), 2).alias(f"sum_{i}")
                    for i, value in enumerate(values, 1)
                ],
            ).select(F.lit(part).alias("part"), "row_count", "sum_1", "sum_2")
            for part, values in sums.items()
        ]
    )


# A small forecast: few rounds, so that a query takes seconds.
SMALL = JobConfig(boosting_rounds=5, boosting_params={"maxDepth": 4, "maxBins": 32})

_models: dict[tuple[str, str], forecast.TrainingResult] = {}


def trained(spark: SparkSession, sf_dir: str) -> forecast.TrainingResult:
    """The boosted forecast, fitted once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        table = features.feature_table(facts.shipment_facts(spark, sf_dir), DAILY)
        training = forecast.model_matrix(table, SMALL).persist()
        try:
            _models[key] = forecast.train(training, forecast.boosting_from(SMALL))
        finally:
            training.unpersist()
    return _models[key]


def result_row(spark: SparkSession, result: forecast.TrainingResult) -> DataFrame:
    names = ["model_name", "rmse", "mae", "r2", "train_rows", "validation_rows"]
    schema = T.StructType(
        [
            T.StructField("model_name", T.StringType()),
            *[T.StructField(c, T.DoubleType()) for c in ("rmse", "mae", "r2")],
            *[T.StructField(c, T.LongType()) for c in ("train_rows", "validation_rows")],
        ]
    )
    return spark.createDataFrame([tuple(getattr(result, n) for n in names)], schema)


def train_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_row(spark, trained(spark, sf_dir))


def score_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = trained(spark, sf_dir).model
    table = features.feature_table(facts.shipment_facts(spark, sf_dir), DAILY)
    return forecast.score(model, table)


def train_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a boosted forecast must meet, its exact numbers aside."""
    result = trained(spark, sf_dir)
    return result_row(spark, result).select(
        "train_rows",
        "validation_rows",
        ((F.col("rmse") > 0) & (F.col("mae") <= F.col("rmse"))).alias("errors_are_plausible"),
        (F.col("r2") <= 1).alias("r2_is_plausible"),
    )


def score_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No row is lost or left without a number, missing features or not."""
    finite = F.abs(F.col("prediction")) < float("inf")
    return score_predictions(spark, sf_dir).groupBy("platform").agg(
        F.count("*").alias("row_count"),
        F.count_if(finite).alias("finite_predictions"),
        F.count_distinct("campaign_id").alias("campaign_count"),
    )


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.feature_importance(spark, trained(spark, sf_dir).model)


def linear(spark: SparkSession, sf_dir: str) -> forecast.TrainingResult:
    """A least-squares line of revenue over conversions: any regressor can be trained."""
    training = (
        facts.shipment_facts(spark, sf_dir)
        .where(F.col("revenue").isNotNull())
        .select("date", "platform", "campaign_id", "conversions", F.col("revenue").alias("label"))
    )
    return forecast.train(training, LinearRegression(solver="normal", standardization=False))


def train_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = result_row(spark, linear(spark, sf_dir)).drop("model_name")
    return rounded(row, dict(rmse=4, mae=4, r2=4))


def score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = linear(spark, sf_dir).model
    return rounded(forecast.score(model, facts.shipment_facts(spark, sf_dir)), {"prediction": 4})


def train_validation_split(df: DataFrame) -> DataFrame:
    known = df.where(F.col("revenue").isNotNull())
    return forecast.split_counts(forecast.hash_split(known))


SUMMARY_SCHEMA = """timestamp string, date_range string, total_predicted_revenue double,
    mean_prediction double,
    platform_summary map<string, struct<total_revenue double, mean_revenue double>>,
    top_5_campaigns map<string, double>, execution_time_seconds double"""


def summary_json(df: DataFrame) -> DataFrame:
    """The JSON document read back: one row per map entry, with the document's totals."""
    document = report.summary_json(df, timestamp="2024-01-01T00:00:00Z", elapsed_seconds=0.0)
    read = document.select(F.from_json("value", SUMMARY_SCHEMA).alias("d")).select("d.*")
    fixed = ["timestamp", "date_range", "total_predicted_revenue", "mean_prediction"]
    platforms = read.select(*fixed, F.explode("platform_summary").alias("name", "v")).select(
        *fixed, "name", "v.total_revenue", "v.mean_revenue"
    )
    campaigns = read.select(
        *fixed, F.explode("top_5_campaigns").alias("name", "total_revenue")
    ).withColumn("mean_revenue", F.lit(None).cast("double"))
    return platforms.unionByName(campaigns)


def end_to_end_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports to evaluation in one call: metrics per part of the split."""
    result = jobs.run_training(spark, facts.export_paths(spark, sf_dir), SMALL)
    return result.metrics_by_split


QUERIES: dict[str, Query] = {
    "scan_csv_strings": scan_csv_strings,
    "ingest_google": one_source("google_ads"),
    "ingest_meta": one_source("meta_ads"),
    "ingest_bing": one_source("microsoft_ads"),
    "ingest_unified": ingest_unified,
    "ingest_ordered": lambda spark, d: in_canonical_order(ingest_unified(spark, d)),
    "ingest_summary": lambda spark, d: ingest_summary(ingest_unified(spark, d)),
    "unified_summary": lambda spark, d: unified_summary(ingest_unified(spark, d)),
    "clean_thousands": clean_thousands,
    "campaign_identity": campaign_identity,
    "coerce_numeric": coerce_numeric,
    "coerce_counts": coerce_counts,
    "revenue_sanitise": revenue_sanitise,
    "parse_dates": parse_dates,
    "parse_date_shapes": parse_date_shapes,
    "validate_canonical": on_facts(facts.dirty_facts, validate),
    "quality_audit": audit,
    "revenue_null_audit": on_facts(
        facts.dirty_facts, lambda df: revenue_null_audit(validate(df))
    ),
    "revenue_null_map": on_facts(
        facts.dirty_facts,
        lambda df: revenue_null_map(validate(df)).select(
            F.explode("revenue_nulls").alias("platform", "revenue_nulls")
        ),
    ),
    "time_features": on_shipments(features.time_features),
    "marketing_kpis": on_shipments(features.marketing_features),
    "lag_features": on_shipments(lambda df: features.lag_features(df, DAILY)),
    "rolling_features": on_shipments(
        lambda df: rounded(features.rolling_features(df, DAILY), ROLLING)
    ),
    "feature_table": on_shipments(feature_rows(DAILY)),
    "feature_table_events": on_facts(facts.event_facts, feature_rows(DAILY)),
    "feature_table_default": on_shipments(feature_rows(SkewPolicy())),
    "feature_table_skewed": on_facts(facts.skewed_shipment_facts, feature_rows(PIECES)),
    "feature_table_one_campaign": on_facts(facts.one_campaign_facts, feature_rows(PIECES)),
    "model_matrix": on_shipments(matrix(JobConfig())),
    "model_matrix_all_features": on_shipments(matrix(JobConfig(drop_leaky_features=False))),
    "train_validation_split": on_shipments(train_validation_split),
    "train_model": train_model,
    "score_predictions": score_predictions,
    "train_contract": train_contract,
    "score_coverage": score_coverage,
    "feature_importance": feature_importance,
    "train_linear": train_linear,
    "score_linear": score_linear,
    "regression_metrics": on_naive(metrics.regression_metrics, **METRIC_DIGITS),
    "regression_metrics_by_platform": on_naive(
        lambda df: metrics.regression_metrics(df, by=["platform"]), **METRIC_DIGITS
    ),
    "eval_actual_vs_predicted": on_naive(
        evaluation.actual_vs_predicted, actual=4, predicted=4
    ),
    "eval_residuals": on_naive(evaluation.residuals),
    "eval_residual_buckets": on_naive(evaluation.residual_buckets, mean_residual=4),
    "eval_prediction_error": on_naive(evaluation.prediction_error),
    "evaluation_report": on_naive(evaluation_report),
    "prediction_stats": on_naive(
        rollups.prediction_stats,
        total_revenue=2, mean_prediction=4, median_prediction=6, std_prediction=4,
    ),
    "date_range": on_naive(rollups.date_range),
    "platform_summary": on_naive(
        rollups.platform_summary, total_revenue=2, mean_revenue=4, share_pct=6
    ),
    "top_campaigns": on_naive(rollups.top_campaigns, total_revenue=2),
    "top_campaigns_by_platform": on_naive(
        lambda df: rollups.top_campaigns(df, by=("platform", "campaign_id")), total_revenue=2
    ),
    "summary_json": on_naive(
        summary_json,
        total_predicted_revenue=2, mean_prediction=4, total_revenue=2, mean_revenue=4,
    ),
    "insights_report": on_naive(report.insights_report),
    "end_to_end_run": end_to_end_run,
}
