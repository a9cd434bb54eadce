"""The two batch jobs.

    spark-submit adfacts/plans/jobs.py train --data-dir URI --models-dir URI
    spark-submit adfacts/plans/jobs.py score --data-dir URI --output URI --model URI
"""

from __future__ import annotations

import argparse
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adfacts.operators.evaluation import EvaluationReport, evaluate
from adfacts.operators.features import feature_table
from adfacts.operators.metrics import regression_metrics
from adfacts.operators.rollups import prediction_stats
from adfacts.operators.series import SkewPolicy
from adfacts.plans import forecast, report
from adfacts.plans.config import JobConfig
from adfacts.plans.publish import Publication
from adfacts.session import Scratch, build_session, compiled_methods, written
from adfacts.sources import SOURCES, ingest
from adfacts.sources.exports import Paths


@dataclass(frozen=True)
class RunResult:
    """Everything a training run produced.

    ``evaluation`` covers all rows with a known target, ``metrics_by_split`` the
    training and the validation rows apart.
    """

    unified: DataFrame
    audit: DataFrame
    features: DataFrame
    training: forecast.TrainingResult
    evaluation: EvaluationReport
    metrics_by_split: DataFrame
    importance: DataFrame | None


def _ingested(
    spark: SparkSession, paths: Mapping[str, Paths | None], multi_line: bool | None
) -> tuple[DataFrame, DataFrame]:
    """The written fact table, and one row of audit counts per platform, taken while writing."""
    audits = {p: Observation(f"audit-{p}-{uuid.uuid4().hex}") for p, path in paths.items() if path}
    unified = written(ingest(spark, paths, multi_line=multi_line, audits=audits), "unified")
    counts = [{"platform": p, **audits[p].get} for p in sorted(audits)]
    kinds = {"platform": "string", "min_date": "timestamp_ntz", "max_date": "timestamp_ntz"}
    schema = ", ".join(f"{name} {kinds.get(name, 'bigint')}" for name in counts[0])
    return unified, spark.createDataFrame([tuple(c.values()) for c in counts], schema)


def run_training(
    spark: SparkSession,
    paths: Mapping[str, Paths | None],
    config: JobConfig = JobConfig(),
    estimator: Estimator | None = None,
    save: bool = False,
    policy: SkewPolicy = SkewPolicy(),
    multi_line: bool | None = None,
) -> RunResult:
    """Ingest, derive features, train, and evaluate over all rows with a known target.

    The tables of the result lie in the shared folder. Run it within ``with Scratch(spark):`` to
    have them deleted at the end of that block.
    """
    with compiled_methods(spark):
        unified, audit = _ingested(spark, paths, multi_line)
        features = written(feature_table(unified, policy), "features")
        matrix = forecast.model_matrix(features, config)
        matrix = forecast.hash_split(matrix, config.test_size, config.random_state)
        training = forecast.train(
            matrix,
            estimator or forecast.boosting_from(config),
            config.test_size,
            config.random_state,
            model_path=config.model_path if save else None,
            patience=config.early_stopping_rounds,
            keep_scores=True,
        )
    scored = training.scored
    importance = None
    if hasattr(training.model.stages[-1], "featureImportances"):
        importance = forecast.feature_importance(spark, training.model)
    evaluation = evaluate(scored, importance, forecast.LABEL)
    by_split = regression_metrics(scored, forecast.LABEL, by=[forecast.IS_VALIDATION])
    return RunResult(unified, audit, features, training, evaluation, by_split, importance)


def write_predictions(predictions: DataFrame, output: str, file_format: str = "parquet") -> None:
    """A folder of part files. CSV gets a header and plain days where there is no time."""
    writer = predictions.write.mode("overwrite").format(file_format)
    if file_format == "csv":
        if "date" in predictions.columns:
            date = F.col("date").cast("timestamp_ntz")
            midnight = date == date.cast("date").cast("timestamp_ntz")
            text = F.when(midnight, F.date_format(date, "yyyy-MM-dd")).otherwise(
                F.date_format(date, "yyyy-MM-dd HH:mm:ss")
            )
            writer = predictions.withColumn("date", text).write.mode("overwrite").format("csv")
        writer = writer.option("header", True).option("escape", '"')
    writer.save(output)


def read_predictions(
    spark: SparkSession, output: str, schema: T.StructType, file_format: str = "parquet"
) -> DataFrame:
    reader = spark.read.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.options(
            header=True, escape='"', timestampNTZFormat="yyyy-MM-dd[ HH:mm:ss]"
        )
    return reader.load(output)


def run_scoring(
    spark: SparkSession,
    paths: Mapping[str, Paths | None],
    model: PipelineModel | str,
    output: str,
    file_format: str = "parquet",
    policy: SkewPolicy = SkewPolicy(),
    multi_line: bool | None = None,
) -> DataFrame:
    """Score the exports; write predictions to ``output``, reports and a manifest next to it.

    They are named after it: ``<output>_insights``, ``<output>_summary``,
    ``<output>_statistics`` (of the predictions), ``<output>_audit`` (rows dropped and
    mended per platform) and ``<output>_manifest`` (rows read, dropped and scored). The first three
    read the written predictions, so the model runs once per row. All are written to a staging
    folder beside ``output`` and replace earlier ones only when every one is complete; if there
    is no row to score, or anything fails, earlier outputs stay as they were.
    """
    started = time.monotonic()
    if isinstance(model, str):
        model = forecast.load_model(spark, model)
    with Scratch(spark), Publication(spark, output) as out:
        unified, audit = _ingested(spark, paths, multi_line)
        rows_read, kept = audit.agg(F.sum("row_count"), F.sum("kept_rows")).first()
        if not kept:
            raise ValueError("nothing to score: no valid row in the exports")
        scored = forecast.score(model, feature_table(unified, policy))
        staged = out.stage()
        write_predictions(scored, staged, file_format)
        predictions = read_predictions(spark, staged, scored.schema, file_format)
        audit.write.json(out.stage("_audit"))
        statistics = prediction_stats(predictions)
        n_scored = statistics.first()["row_count"]
        if n_scored != kept:
            raise RuntimeError(f"{n_scored} predictions were written for {kept} valid rows")
        statistics.write.json(out.stage("_statistics"))
        elapsed = time.monotonic() - started
        rollup = report.campaign_rollup(predictions)
        insights = report.insights_report(predictions, elapsed, rollup)
        report.write_lines(insights, out.stage("_insights"))
        summary = report.summary_json(predictions, elapsed_seconds=elapsed, rollup=rollup)
        report.write_document(summary, out.stage("_summary"))
        counts = [(rows_read, rows_read - kept, n_scored)]
        manifest = spark.createDataFrame(counts, "rows_read bigint, rows_dropped bigint, rows_scored bigint")
        manifest.coalesce(1).write.json(out.stage("_manifest"))
    return read_predictions(spark, output, scored.schema, file_format)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="adfacts.plans.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    train = jobs.add_parser("train", help="train and save the revenue forecast")
    train.add_argument("--data-dir", default=JobConfig.data_dir)
    train.add_argument("--models-dir", default=JobConfig.models_dir)
    train.add_argument("--rounds", type=int, default=JobConfig.boosting_rounds)
    score = jobs.add_parser("score", help="score exports with a saved model")
    score.add_argument("--data-dir", required=True)
    score.add_argument("--output", required=True)
    score.add_argument("--model", default=JobConfig().model_path)
    score.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    train.add_argument("--seed", type=int, default=JobConfig.random_state)
    train.add_argument("--test-size", type=float, default=JobConfig.test_size)
    for job in (train, score):
        job.add_argument("--without", action="append", default=[], choices=sorted(SOURCES),
                         help="a platform that has no export; may be repeated")
        job.add_argument("--single-line", action="store_true",
                         help="no line breaks inside quotes: saves the scan for files that hold some")
    given = parser.parse_args(arguments)

    def exports(config: JobConfig) -> dict[str, str]:
        return {p: path for p, path in config.export_paths.items() if p not in given.without}

    several_lines = False if given.single_line else None
    spark = build_session(f"adfacts-{given.job}")
    if given.job == "train":
        config = JobConfig(
            data_dir=given.data_dir,
            models_dir=given.models_dir,
            boosting_rounds=given.rounds,
            random_state=given.seed,
            test_size=given.test_size,
        )
        with Scratch(spark):
            result = run_training(
                spark, exports(config), config, save=True, multi_line=several_lines
            )
            for row in result.audit.collect():  # one per platform
                print(f"{row['platform']}: {row['kept_rows']} of {row['row_count']} rows kept")
        scores = result.training
        print(f"rmse={scores.rmse:.4f} mae={scores.mae:.4f} r2={scores.r2:.4f}")
        if scores.best_round:
            print(f"best round={scores.best_round} of {len(scores.validation_curve)} looked at")
        print(f"train rows={scores.train_rows} validation rows={scores.validation_rows}")
    else:
        config = JobConfig(data_dir=given.data_dir)
        run_scoring(
            spark, exports(config), given.model, given.output, given.format,
            multi_line=several_lines,
        )


if __name__ == "__main__":
    main()
