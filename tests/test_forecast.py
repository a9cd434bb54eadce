from __future__ import annotations

import dataclasses
import datetime
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from adfacts.operators.features import feature_table
from adfacts.operators.series import SkewPolicy
from adfacts.plans import forecast
from adfacts.plans.config import JobConfig
from tests.conftest import generated, sorted_rows

SMALL = dict(maxIter=4, maxDepth=3, maxBins=16)


@pytest.fixture(scope="module")
def matrix(spark):
    """200 rows; the label follows the first features, some of which are missing."""
    rng = random.Random(7)
    rows = []
    for n in range(200):
        x = [rng.gauss(0, 1) for _ in range(4)]
        label = 500 + 100 * x[0] + 20 * x[1] + rng.gauss(0, 5)
        date = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
        rows.append((date, "google_ads", "c", "C", x[0], None if n % 9 == 0 else x[1], *x[2:], label))
    return spark.createDataFrame(
        rows,
        "date timestamp_ntz, platform string, campaign_id string, campaign_name string, "
        "f0 double, f1 double, f2 double, f3 double, label double",
    ).persist()


@pytest.fixture(scope="module")
def result(matrix):
    return forecast.train(matrix, forecast.boosting(SMALL))


def test_model_matrix(spark):
    features = feature_table(generated(spark, days=20), SkewPolicy(unique_grain=True))
    features = features.withColumn(
        "revenue", F.when(F.col("date") > "2024-01-02", F.col("revenue"))
    )
    default = forecast.model_matrix(features)
    names = forecast.matrix_features(default)
    assert len(names) == 55 and not set(names) & set(forecast.LEAKY_FEATURES)
    assert not {"revenue", "day_name", "month_name", "label"} & set(names)
    assert default.count() == 2 * 18
    everything = forecast.model_matrix(features, JobConfig(drop_leaky_features=False))
    assert len(forecast.matrix_features(everything)) == 58
    with pytest.raises(ValueError, match="profit"):
        forecast.model_matrix(features, JobConfig(target_column="profit"))


def test_split_is_repeatable_and_near_its_size(spark):
    df = spark.range(5000).select(
        F.lit("p").alias("platform"), F.col("id").cast("string").alias("campaign_id"),
        F.lit("2024-01-01").alias("date"),
    )
    split = forecast.hash_split(df, 0.2, 42)
    again = forecast.hash_split(df.repartition(13).orderBy(F.rand()), 0.2, 42)
    assert sorted_rows(split) == sorted_rows(again)
    counts = {r["is_validation"]: r["row_count"] for r in forecast.split_counts(split).collect()}
    assert sum(counts.values()) == 5000 and 900 < counts[True] < 1100
    assert sorted_rows(split) != sorted_rows(forecast.hash_split(df, 0.2, 43))


def test_split_by_time(matrix):
    split = forecast.time_split(matrix, 0.2)
    last = split.where(~F.col("is_validation")).agg(F.max("date")).first()[0]
    first = split.where("is_validation").agg(F.min("date")).first()[0]
    assert last < first
    assert split.where("is_validation").count() == 40


@pytest.mark.parametrize("size", [0.0, 1.0, 1.5, -0.1])
def test_test_size_is_checked(matrix, size):
    with pytest.raises(ValueError, match="test_size"):
        JobConfig(test_size=size)
    with pytest.raises(ValueError, match="test_size"):
        forecast.train(matrix, test_size=size)


def test_training_result(result, matrix):
    assert result.train_rows + result.validation_rows == matrix.count()
    assert result.model_name == "GBTRegressionModel"
    assert result.rmse >= result.mae >= 0 and 0 < result.r2 <= 1
    with pytest.raises(dataclasses.FrozenInstanceError):
        result.rmse = 0.0


def test_patience():
    losses = [9.0, 5.0, 6.0, 5.0, 7.0, 4.0, 8.0]
    assert forecast.best_round(losses, 10) == (6, tuple(losses))
    assert forecast.best_round(losses, 3) == (2, (9.0, 5.0, 6.0, 5.0, 7.0))
    assert forecast.best_round([3.0], 1) == (1, (3.0,))
    with pytest.raises(ValueError):
        forecast.best_round(losses, 0)


def test_best_round_is_kept(spark, tmp_path):
    """Deep trees at full step learn noise: the validation loss turns up long before the end."""
    rng = random.Random(11)
    rows = []
    for n in range(240):
        x = [rng.gauss(0, 1) for _ in range(3)]
        day = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
        rows.append((day, *x, 10 * x[0] + rng.gauss(0, 12)))
    matrix = spark.createDataFrame(rows, "date timestamp_ntz, f0 double, f1 double, f2 double, label double")
    matrix = forecast.hash_split(matrix, 0.4, 1, ["date"]).persist()
    params = dict(maxIter=12, maxDepth=5, maxBins=16, stepSize=0.3, minInstancesPerNode=1)
    path = str(tmp_path / "model")
    result = forecast.train(matrix, forecast.boosting(params), patience=4, model_path=path)
    curve = result.validation_curve
    assert result.best_round == curve.index(min(curve)) + 1 < 12
    assert len(curve) == min(12, result.best_round + 4)
    fitted = result.model.stages[-1]
    assert len(fitted.trees) == result.best_round and fitted.numFeatures == 6
    assert fitted.getStepSize() == 0.3
    # the scores are those of the prefix, before and after saving
    assert result.rmse**2 == pytest.approx(min(curve))
    held_out = matrix.where("is_validation")
    loaded = forecast.load_model(spark, path)
    assert len(loaded.stages[-1].trees) == result.best_round
    scored = forecast.score(loaded, held_out, ["label"])
    error = scored.agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0]
    assert error == pytest.approx(min(curve))
    assert {r["feature"] for r in forecast.feature_importance(spark, loaded).collect()} == {"f0", "f1", "f2"}
    # without patience the estimator's own tolerance stops it, and nothing is recorded
    plain = forecast.train(matrix, forecast.boosting({**params, "maxIter": 3}), patience=None)
    assert plain.best_round is None and plain.validation_curve == ()


def test_scoring_keeps_keys_and_rows(result, matrix):
    scores = forecast.score(result.model, matrix)
    assert scores.columns == ["date", "platform", "campaign_id", "campaign_name", "prediction"]
    assert dict(scores.dtypes)["prediction"] == "double"
    assert scores.count() == 200
    assert scores.where(F.col("prediction").isNull() | F.isnan("prediction")).count() == 0
    bare = forecast.score(result.model, matrix.select("f3", "f2", "f1", "f0"))
    assert bare.columns == ["prediction"]
    assert sorted(r[0] for r in bare.collect()) == sorted(r["prediction"] for r in scores.collect())


def test_scoring_names_missing_features(result, matrix):
    with pytest.raises(ValueError, match="f2"):
        forecast.score(result.model, matrix.drop("f2"))


def test_importance(spark, result):
    rows = forecast.feature_importance(spark, result.model).collect()
    assert {r["feature"] for r in rows} == {"f0", "f1", "f2", "f3"}
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)
    assert rows[0]["feature"] == "f0"


def test_save_and_load(spark, result, matrix, tmp_path):
    path = str(tmp_path / "deep" / "model")
    forecast.save_model(result.model, path)
    loaded = forecast.load_model(spark, path)
    assert isinstance(loaded, PipelineModel)
    assert sorted_rows(forecast.score(loaded, matrix)) == sorted_rows(
        forecast.score(result.model, matrix)
    )


def test_load_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        forecast.load_model(spark, str(tmp_path / "none"))
    (tmp_path / "junk" / "metadata").mkdir(parents=True)
    (tmp_path / "junk" / "metadata" / "part-0").write_text("not a model")
    with pytest.raises(ValueError, match="readable model"):
        forecast.load_model(spark, str(tmp_path / "junk"))


def test_only_fitted_models_score_or_save(matrix, tmp_path):
    with pytest.raises(TypeError):
        forecast.score(forecast.boosting(), matrix)
    with pytest.raises(TypeError):
        forecast.save_model(forecast.boosting(), str(tmp_path / "m"))


def test_training_input_is_checked(matrix):
    with pytest.raises(TypeError, match="Estimator"):
        forecast.train(matrix, estimator="boosting")
    with pytest.raises(ValueError, match="empty"):
        forecast.train(matrix.limit(0))
    with pytest.raises(ValueError, match="label"):
        forecast.train(matrix.drop("label"))
    with pytest.raises(ValueError, match="no numeric feature"):
        forecast.train(matrix.select("date", "label"))


def test_any_estimator_and_fit_params(spark, matrix, tmp_path):
    path = str(tmp_path / "linear")
    result = forecast.train(
        matrix, LinearRegression(), fit_params={"regParam": 0.5}, model_path=path
    )
    assert result.model_name == "LinearRegressionModel" and result.r2 > 0.8
    assert result.model.stages[-1].getRegParam() == 0.5
    assert forecast.load_model(spark, path).stages[-1].coefficients is not None
    with pytest.raises(ValueError, match="importances"):
        forecast.feature_importance(spark, result.model)


def test_own_split_column_is_used(matrix):
    marked = forecast.time_split(matrix, 0.25)
    result = forecast.train(marked, LinearRegression())
    assert result.validation_rows == marked.where("is_validation").count()
