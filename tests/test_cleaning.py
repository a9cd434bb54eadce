from __future__ import annotations

import datetime

import pandas as pd
import pytest
from pandas._libs.parsers import STR_NA_VALUES
from pyspark.sql import functions as F

from adfacts.functions import cleaning


def apply(spark, change, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, x string").select("i", change(F.col("x")).alias("y"))
    return [r["y"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_missing_value_texts_are_those_of_pandas():
    assert set(cleaning.NA_TOKENS) == set(STR_NA_VALUES)


def test_whitespace_is_what_python_strips():
    everything = {chr(code) for code in range(0x3001) if chr(code).isspace()}
    assert set(cleaning.WHITESPACE) == everything


def test_numbers_agree_with_pandas(spark):
    texts = ["12", " 12.5 ", "-3", "+4", ".5", "5.", "1e3", "1E-2", "bad", "12d", "0x1A", "", "1,600",
             "1 2", "--1", "e5", "1e", "NaN", None]
    expected = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    got = apply(spark, cleaning.to_double, texts)
    assert got == [None if pd.isna(v) else v for v in expected]


def test_infinite_and_overflowing_numbers_are_malformed(spark):
    texts = ["inf", "-Infinity", "1e999", "9" * 400]
    assert apply(spark, cleaning.to_double, texts) == [None] * 4


def test_counts_truncate_toward_zero_and_default_to_zero(spark):
    texts = ["120.7", "-5.9", "bad", None, "1e3", "1e50"]
    assert apply(spark, cleaning.to_count, texts) == [120, -5, 0, 0, 1000, 0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-15", (2024, 1, 15)),
        ("2024-1-5", (2024, 1, 5)),
        ("2024-01-15 10:11:12", (2024, 1, 15, 10, 11, 12)),
        ("2024-01-15T10:11:12", (2024, 1, 15, 10, 11, 12)),
        ("2024/01/15", (2024, 1, 15)),
        ("20240115", (2024, 1, 15)),
        ("1/15/2024", (2024, 1, 15)),
        ("3/4/2024", (2024, 3, 4)),
        ("13/1/2024", (2024, 1, 13)),
        ("1/15/24", (2024, 1, 15)),
        ("1-15-2024", (2024, 1, 15)),
        ("15-Jan-2024", (2024, 1, 15)),
        ("15 january 2024", (2024, 1, 15)),
        ("5-JAN-24", (2024, 1, 5)),
        ("Jan 5, 2024", (2024, 1, 5)),
        ("January 5, 2024", (2024, 1, 5)),
        ("2024-02-30", None),
        ("13/13/2024", None),
        ("2024", None),
        ("10:30", None),
        ("0001-01-01", None),
        ("9999-12-31", None),
        ("soon", None),
        (None, None),
    ],
)
def test_dates(spark, text, expected):
    got = apply(spark, cleaning.to_date_time, [text])[0]
    assert got == (None if expected is None else datetime.datetime(*expected))


def test_dates_do_not_move_with_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 2018-11-04 00:00 does not exist there, nor does 02:30 on 2024-03-10 in New York
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        texts = ["2018-11-04", "11/4/2018", "2018-11-04 00:30:00"]
        df = spark.createDataFrame([(t,) for t in texts], "x string")
        got = df.select(cleaning.to_date_time(F.col("x")).cast("string").alias("y")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r["y"] for r in got] == [
        "2018-11-04 00:00:00", "2018-11-04 00:00:00", "2018-11-04 00:30:00",
    ]


def test_campaign_id_is_a_stable_hash_of_the_untrimmed_name(spark):
    ids = apply(
        spark,
        lambda c: cleaning.campaign_id("google_ads", c),
        ["Winter Boots", "Winter Boots ", None],
    )
    assert ids[0] == "cea7f8d788b9c17f"
    assert len(set(ids)) == 3 and all(len(i) == 16 for i in ids)
    meta = apply(spark, lambda c: cleaning.campaign_id("meta_ads", c), ["Retargeting - Dynamic"])
    assert meta == ["01cc02857c82e1a5"]


def test_text_helpers(spark):
    assert apply(spark, cleaning.strip_commas, ["1,234,567.5"]) == ["1234567.5"]
    assert apply(spark, cleaning.strip_whitespace, ["\t A b \n", " "]) == ["A b", ""]
    got = apply(spark, lambda _: cleaning.null_tokens("x"), ["NA", "", "na", " NA", None])
    assert got == [None, None, "na", " NA", None]


def test_negative_values(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (2.0,), (None,)], "x double")
    revenue = [r[0] for r in df.select(cleaning.sanitise_revenue(F.col("x"))).collect()]
    assert revenue == [None, 0.0, 2.0, None]
    clamped = [r[0] for r in df.select(cleaning.clamp_negative(F.col("x"))).collect()]
    assert clamped == [0.0, 0.0, 2.0, None]


def test_dates_as_exports_write_them(spark):
    texts = {
        "2024-01-15 00:00": "2024-01-15 00:00:00", "1/15/2024 0:00": "2024-01-15 00:00:00",
        "1/15/2024 12:00:00 AM": "2024-01-15 00:00:00", "1/15/2024 1:05 pm": "2024-01-15 13:05:00",
        "2024.01.15": "2024-01-15 00:00:00", "15.01.2024": "2024-01-15 00:00:00",
        "Monday, January 15, 2024": "2024-01-15 00:00:00", "1/15/99": "1999-01-15 00:00:00",
        "1-Jan-99": "1999-01-01 00:00:00", "1/15/24": "2024-01-15 00:00:00",
        "1690-01-01": "1690-01-01 00:00:00", "2205-03-01": "2205-03-01 00:00:00",
        "1600-01-01": None, "9999-01-01": None, "1/15/2024 25:00": None, "1/15/2024 13:00 PM": None,
    }
    got = apply(spark, lambda c: cleaning.to_date_time(c).cast("string"), list(texts))
    assert got == list(texts.values())


def test_long_exponents_are_numbers_and_overflow_is_not(spark):
    texts = ["1e+005", "1.5E-007", "1e100", "1" * 250, "1e400", "-1e999"]
    got = apply(spark, cleaning.to_double, texts)
    assert got == [1e5, 1.5e-7, 1e100, float("1" * 250), None, None]


AS_PANDAS_READS_THEM = """
2024-01-15T10:00:00Z|2024-01-15T10:00:00+02:00|2024-01-15T10:00:00-0530|2024-01-15T10:00:00+02
2024-01-15 10:00:00 UTC|2024-01-15 10:00:00 GMT|2024-01-15 10:00:00+00:00|2024-01-15T10:00Z
2024-01-15T10:00:00.123Z|2024-01-15 10:00:00 +0200|1/15/2024 10:00 +01:00|2024-01-15T10:11:12.123456
Jan 15 2024|2024-Jan-15|2024-01-15T10|2024-01-15 10|Sept 5, 2024|5 Sept 2024|Sep 5, 2024
Mon, 15 Jan 2024 10:00:00 GMT|Mon Jan 15 2024|Jan 5th, 2024|5th January 2024|Jan. 5, 2024|15Jan2024
15/Jan/2024|Jan-15-2024|2024 Jan 15|20240115T101112|20240115 10:11|1/15/2024 10:00:00.250
24-01-15|2024-13-01|29/2/2023|Feb 30, 2024|Foo 5, 2024|2024-01-15x|x2024-01-15|0/1/2024|2024-01-15 10:61
Sunday|2/29/2024|13-1-2024|1.2.2024|2262-04-12|2262-04-11|1677-09-22|1677-09-21
"""


def test_dates_agree_with_pandas(spark):
    texts = AS_PANDAS_READS_THEM.replace("\n", "|").strip("|").split("|")
    expected = []
    for text in texts:
        value = pd.to_datetime(pd.Series([text]), format="mixed", errors="coerce")[0]
        value = value.tz_convert("UTC").tz_localize(None) if value.tzinfo else value
        expected.append(None if pd.isna(value) else value.to_pydatetime())
    got = apply(spark, cleaning.to_date_time, texts)
    assert dict(zip(texts, got)) == dict(zip(texts, expected))


def test_code_generated_for_parsing_is_compiled(spark, exports):
    """Methods of more than 8,000 bytes are run by the interpreter, those over 64 KB not built."""
    from adfacts import ingest

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ingest(spark, exports)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    parts = getattr(debug, "MODULE$").codegenStringSeq(plan)
    sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    assert sizes and all(0 < size < 8000 for size in sizes)
