from __future__ import annotations

import dataclasses
import datetime

import pytest

from adfacts.operators import evaluation
from adfacts.operators.metrics import checked_metrics, regression_metrics


def scored(spark, pairs):
    day = datetime.datetime(2024, 1, 1)
    rows = [(day + datetime.timedelta(days=i // 2), y, p) for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "date timestamp_ntz, revenue double, prediction double")


KNOWN = [(100.0, 110.0), (200.0, 190.0), (300.0, 310.0), (400.0, 390.0), (500.0, 510.0)]


def test_known_values(spark):
    got = checked_metrics(scored(spark, KNOWN))
    assert got["rmse"] == pytest.approx(10) and got["mae"] == pytest.approx(10)
    assert got["r2"] == pytest.approx(0.995)
    assert got["mape"] == pytest.approx(0.0456667, abs=1e-7)
    assert got["mape_nonzero"] == pytest.approx(got["mape"])


def test_perfect_and_constant(spark):
    perfect = checked_metrics(scored(spark, [(1.0, 1.0), (2.0, 2.0)]))
    assert (perfect["rmse"], perfect["r2"]) == (0.0, 1.0)
    assert checked_metrics(scored(spark, [(2.0, 2.0), (2.0, 2.0)]))["r2"] == 1.0
    assert checked_metrics(scored(spark, [(2.0, 2.0), (2.0, 3.0)]))["r2"] == 0.0
    assert checked_metrics(scored(spark, [(2.0, 3.0)]))["r2"] is None


def test_zero_actuals(spark):
    got = checked_metrics(scored(spark, [(0.0, 1.0), (2.0, 1.0)]))
    assert got["zero_actuals"] == 1 and got["mape_nonzero"] == 0.5
    assert got["mape"] > 1e15


def test_empty_or_incomplete_input(spark):
    with pytest.raises(ValueError, match="no rows"):
        checked_metrics(scored(spark, []))
    with pytest.raises(ValueError, match="1 rows lack"):
        checked_metrics(scored(spark, [(1.0, None), (1.0, 1.0)]))
    with pytest.raises(ValueError, match="prediction"):
        regression_metrics(scored(spark, KNOWN).drop("prediction"))


def test_groups(spark):
    df = scored(spark, KNOWN).withColumnRenamed("date", "day")
    rows = regression_metrics(df, by=["day"]).collect()
    assert sorted(r["row_count"] for r in rows) == [1, 2, 2]


def test_chart_tables(spark):
    df = scored(spark, KNOWN)
    lines = evaluation.actual_vs_predicted(df).orderBy("date").collect()
    assert [(r["actual"], r["predicted"]) for r in lines] == [(300, 300), (700, 700), (500, 510)]
    rest = evaluation.residuals(df).orderBy("predicted").collect()
    assert [r["residual"] for r in rest] == [-10, 10, -10, 10, -10]
    buckets = evaluation.residual_buckets(df, buckets=4).orderBy("bucket").collect()
    assert [(r["bucket"], r["row_count"]) for r in buckets] == [(0, 2), (2, 2), (3, 1)]
    cells = evaluation.prediction_error(df, buckets=5).collect()
    assert sum(r["row_count"] for r in cells) == 5
    assert {(r["line_low"], r["line_high"]) for r in cells} == {(100.0, 510.0)}
    assert max(r["predicted_bucket"] for r in cells) == 4


def test_buckets_of_a_single_value(spark):
    df = scored(spark, [(1.0, 1.0), (1.0, 1.0)])
    assert [r["bucket"] for r in evaluation.residual_buckets(df).collect()] == [0]


def test_report_bundle(spark):
    df = scored(spark, KNOWN)
    importance = spark.createDataFrame([("a", 0.1), ("b", 0.9)], "feature string, importance double")
    bundle = evaluation.evaluate(df, importance)
    assert bundle.metrics.first()["rmse"] == pytest.approx(10)
    assert [r["feature"] for r in bundle.feature_importance.collect()] == ["b", "a"]
    assert evaluation.evaluate(df).feature_importance is None
    with pytest.raises(dataclasses.FrozenInstanceError):
        bundle.metrics = None
    with pytest.raises(ValueError):
        evaluation.evaluate(df.limit(0))


def test_importance_checks(spark):
    empty = spark.createDataFrame([], "feature string, importance double")
    with pytest.raises(ValueError, match="empty"):
        evaluation.importance_table(empty)
    with pytest.raises(ValueError, match="importance"):
        evaluation.importance_table(empty.drop("importance"))
