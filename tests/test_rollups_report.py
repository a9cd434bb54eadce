from __future__ import annotations

import datetime
import json
import random
import re
import statistics

import pytest

from adfacts.operators import rollups
from adfacts.operators.median import exact_median
from adfacts.plans import report

SCHEMA = "date timestamp_ntz, platform string, campaign_id string, campaign_name string, prediction double"


def predictions(spark, rows):
    day = datetime.datetime(2024, 1, 15)
    return spark.createDataFrame(
        [(day + datetime.timedelta(days=i), p, n.lower(), n, v) for i, (p, n, v) in enumerate(rows)],
        SCHEMA,
    )


SAMPLE = [
    ("google_ads", "Alpha", 1000.5),
    ("google_ads", "Beta", 250.25),
    ("meta_ads", "Alpha", 9.25),
    ("microsoft_ads", "A campaign with a very long name indeed", 1234567.891),
    ("microsoft_ads", "Gamma", 0.0),
    ("meta_ads", "Delta", 40.0),
]


@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [1.0, 2.0],
        [5.0] * 50,
        [5.0] * 30 + [7.0] * 30,
        [1.0, 1.0, 2.0, 9.0],
        [float(n) for n in range(101)],
        [-1.7e308, 1.7e308, 0.0, 5.0],
        [1e9, 1e9 + 1.2e-7, 1e9 + 2.4e-7],
        [0.0, 5e-324, 1e-323],
        [random.Random(1).lognormvariate(0, 8) for _ in range(500)],
    ],
)
@pytest.mark.parametrize(("bins", "final_rows"), [(4096, 100_000), (3, 1)])
def test_median_is_exact(spark, values, bins, final_rows):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    assert exact_median(df, "v", bins, final_rows) == statistics.median(values)


@pytest.mark.parametrize("final_rows", [100_000, 1_000, 10])
def test_median_from_the_bracket_of_the_sketch(spark, final_rows):
    rng = random.Random(5)
    for values in (
        [rng.lognormvariate(0, 3) for _ in range(30_001)],
        [float(rng.randrange(40)) for _ in range(30_000)],
        [1.0] * 15_000 + [2.0] * 15_000,
    ):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
        assert exact_median(df, "v", final_rows=final_rows) == statistics.median(values)


def test_statistics_take_two_passes(spark, tmp_path):
    rows = [(float(i % 997),) for i in range(20_000)]
    spark.createDataFrame(rows, "prediction double").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # one job per action
    spark.sparkContext.setJobGroup("statistics", "")
    try:
        result = rollups.prediction_stats(df)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("statistics")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 3
    assert result.first()["median_prediction"] == statistics.median(v for v, in rows)


def test_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([], "v double"), "v") is None


def test_stats(spark):
    df = predictions(spark, SAMPLE)
    values = [v for _, _, v in SAMPLE]
    got = rollups.prediction_stats(df).first()
    assert got["row_count"] == 6 and got["median_prediction"] == statistics.median(values)
    assert got["total_revenue"] == pytest.approx(sum(values))
    assert got["std_prediction"] == pytest.approx(statistics.stdev(values))
    assert (got["min_prediction"], got["max_prediction"]) == (0.0, 1234567.891)
    approximate = rollups.prediction_stats(df, approximate_median=True).first()
    assert approximate["median_prediction"] in values


def test_platforms_largest_first_with_shares(spark):
    rows = rollups.platform_summary(predictions(spark, SAMPLE)).collect()
    assert [r["platform"] for r in rows] == ["microsoft_ads", "google_ads", "meta_ads"]
    assert sum(r["share_pct"] for r in rows) == pytest.approx(100)
    none = rollups.platform_summary(predictions(spark, [("a", "A", 0.0), ("b", "B", 0.0)]))
    assert [(r["platform"], r["share_pct"]) for r in none.collect()] == [("a", 0.0), ("b", 0.0)]


def test_campaigns_by_name_or_by_platform(spark):
    df = predictions(spark, SAMPLE)
    by_name = {r["campaign_name"]: r["total_revenue"] for r in rollups.campaign_totals(df).collect()}
    assert by_name["Alpha"] == 1009.75
    apart = rollups.campaign_totals(df, ("platform", "campaign_id"))
    assert apart.count() == 6
    top = [r["campaign_name"] for r in rollups.top_campaigns(df, 2).collect()]
    assert top == ["A campaign with a very long name indeed", "Alpha"]


def test_ties_go_by_name(spark):
    df = predictions(spark, [("p", n, 1.0) for n in "FEDCBA"])
    assert [r["campaign_name"] for r in rollups.top_campaigns(df).collect()] == list("ABCDE")


def test_date_range(spark):
    df = predictions(spark, SAMPLE)
    assert rollups.date_range(df).first()[0] == "2024-01-15 to 2024-01-20"
    assert rollups.date_range(df.limit(0)).first()[0] == "N/A"


def report_text(df, elapsed=None):
    return "\n".join(r["line"] for r in report.insights_report(df, elapsed).orderBy("line_no").collect())


def test_insights_report(spark):
    text = report_text(predictions(spark, SAMPLE), 1.234)
    assert "Date Range                : 2024-01-15 to 2024-01-20" in text
    assert "Total Predicted Revenue   : $1,235,867.89" in text
    assert "Best Performing Platform  : microsoft_ads" in text
    assert "Lowest Performing Platform: meta_ads" in text
    total, shares = 1235867.891, {}
    for platform, _, value in SAMPLE:
        shares.setdefault(platform, []).append(value)
    for platform, values in shares.items():
        s, m = sum(values), sum(values) / len(values)
        assert f"{platform.ljust(15)} : ${s:>12,.2f} ({s / total * 100:>5.1f}%) | Mean: ${m:>10,.2f}" in text
    assert f"1. {'A campaign with a very long name indeed'.ljust(30)} : ${1234567.891:>12,.2f}" in text
    assert f"2. {'Alpha'.ljust(30)} : ${1009.75:>12,.2f}" in text
    assert text.endswith("1.23 seconds")
    assert "Execution Time" not in report_text(predictions(spark, SAMPLE))


def test_best_and_lowest_with_ties(spark):
    text = report_text(predictions(spark, [("b", "B", 1.0), ("a", "A", 1.0)]))
    assert "Best Performing Platform  : a" in text
    assert "Lowest Performing Platform: b" in text


def test_summary_document(spark):
    document = report.summary_json(predictions(spark, SAMPLE), "2024-02-01T00:00:00Z", 2.5)
    got = json.loads(document.first()["value"])
    assert got["timestamp"] == "2024-02-01T00:00:00Z"
    assert got["date_range"] == "2024-01-15 to 2024-01-20"
    assert got["total_predicted_revenue"] == pytest.approx(1235867.891)
    assert list(got["platform_summary"]) == ["microsoft_ads", "google_ads", "meta_ads"]
    assert got["platform_summary"]["google_ads"] == {"total_revenue": 1250.75, "mean_revenue": 625.375}
    assert list(got["top_5_campaigns"].items())[1] == ("Alpha", 1009.75)
    assert len(got["top_5_campaigns"]) == 5 and got["execution_time_seconds"] == 2.5


@pytest.mark.parametrize(
    "values",
    [
        [float("-inf"), 1.0, 2.0, float("inf"), float("inf")],
        [float("inf")] * 4 + [1.0],
        [float("nan"), 3.0, 1.0, 2.0],
        [float("-inf"), -1.0, 5.0, 7.0],
        [float("inf")] * 9 + [float(i) for i in range(12)],
    ],
)
def test_median_ends_with_infinities_and_nan(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, key=lambda v: (v != v, v))
    low, high = ordered[(len(values) - 1) // 2], ordered[len(values) // 2]
    assert exact_median(df, "x", bins=3, final_rows=1) == (low if low == high else (low + high) / 2)


@pytest.mark.parametrize("make", [report.insights_report, report.summary_json])
def test_reports_read_the_rollup_twice(spark, make):
    rollup = report.campaign_rollup(predictions(spark, SAMPLE))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan is whole before it runs
    try:
        execution = make(None, rollup=rollup)._jdf.queryExecution()
        plan = spark._jvm.PythonSQLUtils.explainString(execution, "formatted")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = re.findall(r"^\(\d+\) Scan parquet", plan, re.M)
    exchanges = re.findall(r"^\(\d+\) Exchange", plan, re.M)
    assert len(scans) == 2 and 2 <= len(exchanges) <= 4, plan
    empty = make(predictions(spark, SAMPLE).limit(0))
    assert empty.count() >= 1
