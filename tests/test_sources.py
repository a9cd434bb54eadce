from __future__ import annotations

import dataclasses
import datetime

import pytest
from pyspark.sql import functions as F

from adfacts.schema import CANONICAL_COLUMNS, CANONICAL_SCHEMA
from adfacts.sources import SOURCES, SourceSpec, ingest, load_source, normalise, read_export
from adfacts.sources.exports import in_canonical_order, ingest_summary, unified_summary
from tests.conftest import GOOGLE, sorted_rows

DAY = datetime.datetime(2024, 1, 15)


def types(df):
    return [(f.name, f.dataType) for f in df.schema]


@pytest.mark.parametrize("platform", list(SOURCES))
def test_every_source_yields_the_canonical_schema(spark, exports, platform):
    df = load_source(spark, exports[platform], SOURCES[platform])
    assert types(df) == [(f.name, f.dataType) for f in CANONICAL_SCHEMA]
    assert {r["platform"] for r in df.collect()} == {platform}


def test_google(spark, exports):
    df = load_source(spark, exports["google_ads"], SOURCES["google_ads"])
    rows = {(r["campaign_name"], r["date"]): r for r in df.collect()}
    first = rows["Winter Boots", DAY]
    assert (first["spend"], first["revenue"], first["conversions"]) == (64.0, 960.0, 16.0)
    assert (first["clicks"], first["impressions"]) == (200, 5000)
    assert first["campaign_id"] == "cea7f8d788b9c17f"
    assert rows["Idle", datetime.datetime(2024, 1, 17)]["revenue"] == 0.0
    assert rows["Refunds", datetime.datetime(2024, 1, 17)]["revenue"] is None


def test_meta_has_no_revenue_and_drops_platform_ratios(spark, exports):
    df = load_source(spark, exports["meta_ads"], SOURCES["meta_ads"])
    assert df.columns == CANONICAL_COLUMNS
    rows = df.orderBy("date").collect()
    assert [r["revenue"] for r in rows] == [None, None]
    assert [r["spend"] for r in rows] == [31.25, 30.75]
    assert rows[1]["conversions"] == 2.5


def test_microsoft_dates_and_commas(spark, exports):
    df = load_source(spark, exports["microsoft_ads"], SOURCES["microsoft_ads"])
    first, second = df.orderBy("date").collect()
    assert first["date"] == DAY
    assert (first["impressions"], first["clicks"], first["spend"]) == (2045310, 3020, 1987.25)
    assert (first["revenue"], second["revenue"]) == (6150.75, 0.0)


def test_commas_only_count_as_thousands_where_the_platform_writes_them(spark, tmp_path):
    path = tmp_path / "g.csv"
    path.write_text(GOOGLE.splitlines()[0] + '\n2024-01-15,A,"1,600",1,1000000,1,1\n')
    row = load_source(spark, str(path), SOURCES["google_ads"]).first()
    assert row["impressions"] == 0 and row["spend"] == 1.0


@pytest.mark.parametrize("platform", list(SOURCES))
def test_missing_source_columns_are_named(spark, tmp_path, platform):
    path = tmp_path / "short.csv"
    columns = SOURCES[platform].required
    path.write_text(",".join(columns[:3]) + "\n1,2,3\n")
    with pytest.raises(ValueError) as error:
        load_source(spark, str(path), SOURCES[platform])
    assert str(sorted(columns[3:])) in str(error.value)


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest(spark, {"google_ads": str(tmp_path / "none.csv")})


def test_no_or_unknown_platform(spark, exports):
    with pytest.raises(ValueError, match="at least one"):
        ingest(spark, {"google_ads": None})
    with pytest.raises(ValueError, match="unknown"):
        ingest(spark, {"billboards": exports["google_ads"]})


def test_unified(spark, exports):
    df = ingest(spark, exports)
    assert df.columns == CANONICAL_COLUMNS
    summary = unified_summary(df).first()
    assert summary["row_count"] == 9
    assert summary["platforms"] == "google_ads,meta_ads,microsoft_ads"
    assert summary["campaign_count"] == 5
    assert (summary["min_date"], summary["max_date"]) == (DAY, DAY + datetime.timedelta(days=2))
    per_platform = {r["platform"]: r["row_count"] for r in ingest_summary(df).collect()}
    assert per_platform == {"google_ads": 5, "meta_ads": 2, "microsoft_ads": 2}


def test_order_at_the_sink(spark, exports):
    rows = in_canonical_order(ingest(spark, exports)).collect()
    keys = [(r["date"], r["platform"], r["campaign_id"]) for r in rows]
    assert keys == sorted(keys) and len(rows) == 9


def test_one_platform_is_enough(spark, exports):
    assert ingest(spark, {"meta_ads": exports["meta_ads"]}).count() == 2


def test_parts_with_another_column_order(spark, tmp_path):
    header, first, second, *_ = GOOGLE.splitlines()
    reverse = [",".join(reversed(line.split(","))) for line in (header, second)]
    (tmp_path / "a.csv").write_text(f"{header}\n{first}\n")
    (tmp_path / "b.csv").write_text("\n".join(reverse) + "\n")
    spec = SOURCES["google_ads"]
    # as separate paths they are matched by name
    apart = load_source(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], spec)
    assert sorted(r["spend"] for r in apart.collect()) == [64.0, 72.0]
    # under one path the differing header is an error, not a silent swap
    with pytest.raises(Exception, match="CSV header does not conform"):
        load_source(spark, str(tmp_path), spec).collect()


def test_quotes_line_breaks_and_byte_order_mark(spark, tmp_path):
    path = tmp_path / "g.csv"
    header = GOOGLE.splitlines()[0]
    path.write_bytes(
        b"\xef\xbb\xbf" + header.encode() + b'\n2024-01-15,"Say ""hi"",\nnow",1,1,1000000,1,1\n'
    )
    row = load_source(spark, str(path), SOURCES["google_ads"], multi_line=True).first()
    assert row["campaign_name"] == 'Say "hi",\nnow'
    assert row["date"] == DAY


BROKEN = {  # in all but the last two a row goes on in the next line
    "break": '2024-01-15,"a\nb",1\n',
    "several": '2024-01-15,"a\n\n""q""\nb",1\n',
    "windows": '2024-01-15,"a\r\nb",1\r\n',
    "old": '2024-01-15,a,1\r2024-01-16,b,2\r',
    "no end": '2024-01-15,"a\nb",1',
    "quoted": '2024-01-15,"say ""hi"", b",1\n\n2024-01-16,,2\n',
    "plain": "2024-01-15,a,1\r\n2024-01-16,b,2\r\n",
}


@pytest.mark.parametrize("kind", list(BROKEN))
def test_files_are_split_only_where_every_line_is_a_row(spark, tmp_path, kind):
    from adfacts.sources.exports import files_with_broken_rows

    head = "day,name,n\n"
    if kind in ("windows", "plain"):
        head = "day,name,n\r\n"
    elif kind == "old":
        head = "day,name,n\r"
    folder = tmp_path / "with blank"
    folder.mkdir()
    (folder / "one file.csv").write_bytes((head + BROKEN[kind]).encode())
    (folder / "other.csv").write_text("day,name,n\n2024-02-01,x,1\n2024-02-02,y,2\n")
    found = files_with_broken_rows(spark, str(folder))
    assert len(found) == (kind not in ("quoted", "plain"))
    assert not any("other" in name for name in found)
    whole = read_export(spark, str(folder))
    assert sorted_rows(read_export(spark, str(folder), multi_line=None)) == sorted_rows(whole)


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = "".join(f'2024-01-15,"c{i}, ""x""",{i}\n' for i in range(20_000))
    (folder / "large.csv").write_text("day,name,n\n" + lines)
    (folder / "small.csv").write_text('day,name,n\n2024-01-15,"a\nb",1\n')
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "100000")
        rows = read_export(spark, str(folder), multi_line=None)
        readers = rows.select("name", F.spark_partition_id().alias("task"))
        per_task = [r["n"] for r in readers.groupBy("task").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set(key, before)
    assert sum(per_task) == 20_001 and len(per_task) > 4
    assert sorted_rows(rows) == sorted_rows(read_export(spark, str(folder)))


def test_text_of_missing_values(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\nNA,""\nn/a, NA\n')
    assert sorted_rows(read_export(spark, str(path))) == [(None, " NA"), (None, None)]


def test_blanks_around_a_date(spark, tmp_path):
    path = tmp_path / "g.csv"
    path.write_text(GOOGLE.splitlines()[0] + "\n\t2024-01-15 ,A,1,1,1000000,1,1\n")
    assert load_source(spark, str(path), SOURCES["google_ads"]).first()["date"] == DAY


def test_audit_flags(spark, exports):
    def flags(platform):
        spec = SOURCES[platform]
        raw = read_export(spark, exports[platform], spec.required)
        return normalise(raw, spec, audit=True).agg(
            F.count_if("negative_revenue"), F.count_if("grain_mismatch")
        ).first()

    assert tuple(flags("google_ads")) == (1, 0)
    assert tuple(flags("meta_ads")) == (0, 1)


def test_name_without_value_keeps_an_id_but_is_dropped(spark, tmp_path):
    path = tmp_path / "g.csv"
    path.write_text(GOOGLE.splitlines()[0] + "\n2024-01-15,,1,1,1000000,1,1\n")
    row = load_source(spark, str(path), SOURCES["google_ads"]).first()
    assert row["campaign_name"] is None and len(row["campaign_id"]) == 16
    assert ingest(spark, {"google_ads": str(path)}).count() == 0


def test_hash_of_trimmed_name(spark):
    spec = SOURCES["meta_ads"]
    raw = spark.createDataFrame(
        [("2024-01-15", n, "1", "1", "1", "1") for n in ("A", " A ")],
        ", ".join(f"{c} string" for c in spec.required),
    )
    assert normalise(raw, spec).select("campaign_id").distinct().count() == 2
    trimmed = normalise(raw, spec, hash_trimmed_name=True)
    assert trimmed.select("campaign_id").distinct().count() == 1


def test_a_new_platform_is_a_new_entry(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("when,what,paid\n2024.01.15,A,EUR 3.50\n")
    spec = SourceSpec(
        platform="trade_desk",
        columns={"date": "when", "campaign_name": "what", "spend": "paid"},
        date_patterns=((r"^\d{4}\.\d{2}\.\d{2}$", ["yyyy.MM.dd"]),),
        cleaners={"spend": lambda c: F.replace(c, F.lit("EUR"), F.lit(""))},
    )
    row = load_source(spark, str(path), spec).first()
    assert (row["date"], row["spend"], row["revenue"], row["clicks"]) == (DAY, 3.5, None, 0)
    changed = dataclasses.replace(SOURCES["google_ads"], platform="google_copy")
    assert changed.required == SOURCES["google_ads"].required


def test_text_is_parsed_once(spark, exports):
    """The filter on required values must not repeat the parsing expressions."""
    df = ingest(spark, {"google_ads": exports["google_ads"]})
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("RLIKE" in line for line in filters)
    assert "Python" not in plan and "Exchange" not in plan


def test_filter_on_platform_reads_one_export(spark, exports):
    df = ingest(spark, exports).where("platform = 'meta_ads'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert df.count() == 2


def test_only_needed_columns_are_read(spark, exports):
    df = load_source(spark, exports["meta_ads"], SOURCES["meta_ads"]).select("date", "spend")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<date_start:string,spend:string>" in plan


def test_row_wise_steps_run_on_a_stream(spark, exports, tmp_path):
    from adfacts.operators.validation import validate

    spec = SOURCES["google_ads"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(GOOGLE)
    schema = ", ".join(f"{c} string" for c in GOOGLE.splitlines()[0].split(","))
    stream = spark.readStream.schema(schema).option("header", True).csv(str(folder))
    query = (
        validate(normalise(stream, spec))
        .writeStream.format("memory")
        .queryName("streamed_facts")
        .option("checkpointLocation", str(tmp_path / "state"))
        .start()
    )
    query.processAllAvailable()
    query.stop()
    batch = ingest(spark, {"google_ads": exports["google_ads"]})
    assert sorted_rows(spark.table("streamed_facts")) == sorted_rows(batch)
