from __future__ import annotations

import datetime
import json
import pathlib
import random

import pytest

from adfacts import session
from adfacts.operators import metrics
from adfacts.operators.series import SkewPolicy
from adfacts.plans import forecast, jobs, publish
from adfacts.plans.config import JobConfig


@pytest.fixture(scope="module")
def data_dir(tmp_path_factory):
    """Sixty days of three campaigns per platform."""
    rng = random.Random(3)
    folder = tmp_path_factory.mktemp("data")
    google = ["segments_date,campaign_name,metrics_impressions,metrics_clicks,metrics_cost_micros,metrics_conversions,metrics_conversions_value"]
    meta = ["date_start,date_stop,campaign_name,impressions,clicks,spend,conversion"]
    bing = ["TimePeriod,CampaignName,Impressions,Clicks,Spend,Conversions,Revenue"]
    for n in range(60):
        day = datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
        for c in range(3):
            clicks = rng.randrange(20, 200)
            spend, sales = clicks * 0.5, clicks * (c + 1) * 2
            google.append(f"{day},G{c},{clicks * 30},{clicks},{int(spend * 1e6)},{clicks // 9},{sales}")
            meta.append(f"{day},{day},M{c},{clicks * 40},{clicks},{spend},{clicks // 7}")
            bing.append(f'{day.month}/{day.day}/{day.year},B{c},"{clicks * 25:,}",{clicks},{spend},{clicks // 8},"{sales * 10:,}"')
    for name, lines in (("google_ads", google), ("meta_ads", meta), ("bing_ads", bing)):
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return folder


@pytest.fixture(scope="module")
def config(data_dir, tmp_path_factory):
    return JobConfig(
        data_dir=str(data_dir),
        models_dir=str(tmp_path_factory.mktemp("models")),
        boosting_rounds=4,
        boosting_params={"maxDepth": 3, "maxBins": 16},
    )


@pytest.fixture(scope="module")
def trained(spark, config):
    return jobs.run_training(spark, config.export_paths, config, save=True)


def test_training_run(trained):
    assert trained.unified.count() == 540 and trained.features.count() == 540
    assert len(trained.features.columns) == 65
    known = trained.training.train_rows + trained.training.validation_rows
    assert known == 360  # one platform reports no revenue
    assert trained.evaluation.metrics.first()["row_count"] == 360
    parts = {r["is_validation"]: r["row_count"] for r in trained.metrics_by_split.collect()}
    assert parts == {False: trained.training.train_rows, True: trained.training.validation_rows}
    assert trained.training.r2 > 0.3
    assert trained.importance.count() == 55
    assert trained.evaluation.residuals.count() == 360


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_scoring_run(spark, config, trained, tmp_path, file_format):
    output = tmp_path / "out" / "predictions"
    policy = SkewPolicy(pieces=30)  # histories are cut into pieces
    scored = jobs.run_scoring(
        spark, config.export_paths, config.model_path, str(output), file_format, policy
    )
    assert scored.count() == 540
    direct = forecast.score(trained.training.model, trained.features)
    key = ("date", "platform", "campaign_id", "campaign_name")
    expected = {tuple(r[k] for k in key): r["prediction"] for r in direct.collect()}
    got = {tuple(r[k] for k in key): r["prediction"] for r in scored.collect()}
    assert got == pytest.approx(expected)

    def lines(name):
        parts = sorted((tmp_path / "out" / name).glob("part-*"))
        return "".join(p.read_text() for p in parts)

    assert "Revenue Contribution by Platform" in lines("predictions_insights")
    assert lines("predictions_insights").startswith("=" * 30 + "\nBusiness Insights\n")
    summary = json.loads(lines("predictions_summary"))
    # totals per platform belong to the rows that were scored
    for platform, figures in summary["platform_summary"].items():
        total = sum(v for k, v in expected.items() if k[1] == platform)
        assert figures["total_revenue"] == pytest.approx(total)
    audit = {r["platform"]: r for r in map(json.loads, lines("predictions_audit").splitlines())}
    assert len(audit) == 3 and all(r["kept_rows"] == 180 for r in audit.values())
    statistics = json.loads(lines("predictions_statistics"))
    assert statistics["total_revenue"] == pytest.approx(sum(expected.values()))
    if file_format == "csv":
        first = next(output.glob("part-*.csv")).read_text().splitlines()
        assert first[0] == "date,platform,campaign_id,campaign_name,prediction"
        assert len(first[1].split(",")[0]) == len("2024-01-01")


def test_scoring_needs_model_and_exports(spark, config, trained, tmp_path):
    with pytest.raises(FileNotFoundError):
        jobs.run_scoring(spark, config.export_paths, str(tmp_path / "none"), str(tmp_path / "o"))
    with pytest.raises(FileNotFoundError):
        jobs.run_scoring(
            spark, JobConfig(data_dir=str(tmp_path)).export_paths, trained.training.model,
            str(tmp_path / "o"),
        )


def shared_names(spark):
    folder = session.shared_folder(spark)
    return {p.name for p in pathlib.Path(folder.removeprefix("file:")).glob("*")}


def test_an_empty_export_leaves_earlier_outputs(spark, config, trained, tmp_path):
    output, empty = tmp_path / "out" / "p", tmp_path / "empty.csv"
    jobs.run_scoring(spark, config.export_paths, trained.training.model, str(output))
    before = {p: p.read_bytes() for p in sorted((tmp_path / "out").rglob("*")) if p.is_file()}
    manifest = "".join(p.read_text() for p in (tmp_path / "out").glob("p_manifest/part-*"))
    assert json.loads(manifest) == {"rows_read": 540, "rows_dropped": 0, "rows_scored": 540}
    header = pathlib.Path(config.export_paths["google_ads"]).read_text().splitlines()[0]
    empty.write_text(header + "\n")
    tables = shared_names(spark)
    with pytest.raises(ValueError, match="nothing to score"):
        jobs.run_scoring(spark, {"google_ads": str(empty)}, trained.training.model, str(output))
    assert {p: p.read_bytes() for p in sorted((tmp_path / "out").rglob("*")) if p.is_file()} == before
    assert shared_names(spark) == tables  # no scratch table stays behind
    jobs.run_scoring(spark, config.export_paths, trained.training.model, str(output))
    assert shared_names(spark) == tables
    assert len(list((tmp_path / "out").iterdir())) == 6


def test_publication_returns_what_was_there(spark, tmp_path):
    for name in ("p", "p_a"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x").write_text("old")
    (tmp_path / "p_b").write_text("a file is in the way of nothing: it is moved aside too")
    with publish.Publication(spark, str(tmp_path / "p")) as out:
        for suffix in ("", "_a", "_b"):
            pathlib.Path(out.stage(suffix)).mkdir(parents=True)
            (pathlib.Path(out.folder) / f"new{suffix}" / "x").write_text("new")
    assert [(tmp_path / n / "x").read_text() for n in ("p", "p_a", "p_b")] == ["new"] * 3

    def fail(spark, source, target):
        if "new_a" in source:
            raise OSError("no")
        return session.move_folder(spark, source, target)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(publish, "move_folder", fail)
        with pytest.raises(OSError), publish.Publication(spark, str(tmp_path / "p")) as out:
            for suffix in ("", "_a"):
                pathlib.Path(out.stage(suffix)).mkdir(parents=True)
                (pathlib.Path(out.folder) / f"new{suffix}" / "x").write_text("newer")
    assert [(tmp_path / n / "x").read_text() for n in ("p", "p_a", "p_b")] == ["new"] * 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["p", "p_a", "p_b"]


def test_rows_lost_are_counted_by_column(spark, tmp_path):
    header = "segments_date,campaign_name,metrics_impressions,metrics_clicks,metrics_cost_micros,metrics_conversions,metrics_conversions_value"
    lines = [
        "2024-02-01,A,10,1,1000000,1,5", "2024-02-03,A,10,1,-1000000,1,-5",
        "soon,A,10,1,1000000,1,5", "2024-02-01,,10,1,1000000,1,5",
        "2024-02-01,A,10,1,much,1,5", "2024-02-01,A,10,1,1000000,,5", "2999-01-01,A,10,1,1,1,5",
        "2200-01-01,A,10,1,1,1,",
    ]
    path = tmp_path / "google_ads.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    unified, audit = jobs._ingested(spark, {"google_ads": str(path), "meta_ads": None}, True)
    (row,) = audit.collect()
    assert unified.count() == row["kept_rows"] == 3 and row["row_count"] == 8
    dropped = {c: row[f"dropped_{c}"] for c in ("date", "campaign_name", "spend", "conversions")}
    assert dropped == {"date": 2, "campaign_name": 1, "spend": 1, "conversions": 1}
    assert (row["negative_spend"], row["negative_revenue_rows"], row["future_rows"]) == (1, 1, 1)
    assert row["revenue_nulls"] == 2
    assert row["min_date"] == datetime.datetime(2024, 2, 1)


def test_command_line(spark, config, trained, tmp_path, capsys):
    jobs.main(
        ["train", "--data-dir", config.data_dir, "--models-dir", str(tmp_path / "m"), "--rounds", "2"]
    )
    assert "rmse=" in capsys.readouterr().out
    jobs.main(
        ["score", "--data-dir", config.data_dir, "--output", str(tmp_path / "p"),
         "--model", str(tmp_path / "m" / "revenue_forecast"), "--format", "csv"]
    )
    assert list((tmp_path / "p").glob("part-*.csv"))


def test_wide_stages_are_compiled_and_rows_are_scored_once(spark, config, monkeypatch):
    """Methods beyond the JVM's limit are interpreted; the validation part was scored twice."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit, None)
    limits, measured = {}, []

    def seen(df, label):
        limits[label] = spark.conf.get(limit)
        return session.written(df, label)

    def checked(df, *columns):
        measured.extend(df.inputFiles())
        return metrics.checked_metrics(df, *columns)

    monkeypatch.setattr(jobs, "written", seen)
    monkeypatch.setattr(forecast, "checked_metrics", checked)
    with session.Scratch(spark):
        result = jobs.run_training(spark, config.export_paths, config)
        rows = {r["is_validation"]: r for r in result.metrics_by_split.collect()}
    assert set(limits) == {"unified", "features"} and set(limits.values()) == {"8000"}
    assert spark.conf.get(limit, None) == before
    assert measured and all("scored-" in file for file in measured)
    assert result.training.rmse == pytest.approx(rows[True]["rmse"])
    assert result.training.validation_rows == rows[True]["row_count"]
