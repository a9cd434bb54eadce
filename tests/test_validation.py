from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from adfacts.operators.validation import (
    quality_audit,
    revenue_null_audit,
    revenue_null_map,
    validate,
)
from tests.conftest import canonical, sorted_rows

DAY = datetime.datetime(2024, 1, 15)


def row(**changes):
    values = dict(
        date=DAY, platform="google_ads", campaign_id="a", campaign_name="A", spend=1.0,
        revenue=2.0, conversions=3.0, clicks=4, impressions=5,
    )
    return tuple({**values, **changes}.values())


def test_clean_rows_pass_unchanged(spark):
    df = canonical(spark, [row(), row(revenue=None)])
    assert sorted_rows(validate(df)) == sorted_rows(df)


def test_negative_amounts_become_zero(spark):
    df = canonical(spark, [row(spend=-10.0, conversions=-1.0, clicks=-5, impressions=-7)])
    got = validate(df).first()
    assert (got["spend"], got["conversions"], got["clicks"], got["impressions"]) == (0, 0, 0, 0)


@pytest.mark.parametrize("column", ["date", "campaign_name", "spend", "conversions", "clicks"])
def test_rows_lacking_a_required_value_are_dropped(spark, column):
    assert validate(canonical(spark, [row(**{column: None}), row()])).count() == 1


def test_validating_twice_changes_nothing(spark):
    df = canonical(spark, [row(spend=-1.0), row(spend=None), row()])
    assert sorted_rows(validate(validate(df))) == sorted_rows(validate(df))


def test_missing_column(spark):
    with pytest.raises(ValueError, match="clicks"):
        validate(canonical(spark, [row()]).drop("clicks"))


def test_empty_input_stays_empty(spark):
    assert validate(canonical(spark, [])).count() == 0


def test_audit_counts_each_dropped_row_once(spark):
    rows = [
        row(),
        row(date=None, spend=None),
        row(spend=None),
        row(spend=-1.0, revenue=None),
        row(date=DAY + datetime.timedelta(days=9)),
    ]
    as_of = F.lit(datetime.date(2024, 1, 20))
    got = quality_audit(canonical(spark, rows), as_of).first()
    assert (got["row_count"], got["kept_rows"]) == (5, 3)
    assert (got["dropped_date"], got["dropped_spend"], got["dropped_clicks"]) == (1, 1, 0)
    assert (got["negative_spend"], got["revenue_nulls"], got["future_rows"]) == (1, 1, 1)
    assert got["calendar_days"] == 10


def test_revenue_nulls_by_platform_and_in_total(spark):
    rows = [row(), row(revenue=None), row(platform="meta_ads", revenue=None)]
    df = canonical(spark, rows)
    got = {r["platform"]: (r["revenue_nulls"], r["row_count"]) for r in revenue_null_audit(df).collect()}
    assert got == {"google_ads": (1, 2), "meta_ads": (1, 1), "all": (2, 3)}
    assert revenue_null_map(df).first()[0] == {"google_ads": 1, "meta_ads": 1}
