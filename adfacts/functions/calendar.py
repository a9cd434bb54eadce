"""Calendar parts of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CALENDAR_COLUMNS = [
    "day_of_week",
    "day_name",
    "month",
    "month_name",
    "quarter",
    "week_of_year",
    "day_of_month",
    "day_of_year",
    "is_weekend",
]


def calendar_columns(date: Column) -> dict[str, Column]:
    weekday = F.weekday(date)  # Monday is 0
    values = [
        weekday.cast("bigint"),
        F.date_format(date, "EEEE"),
        F.month(date).cast("bigint"),
        F.date_format(date, "MMMM"),
        F.quarter(date).cast("bigint"),
        F.weekofyear(date).cast("bigint"),  # ISO 8601
        F.dayofmonth(date).cast("bigint"),
        F.dayofyear(date).cast("bigint"),
        weekday.isin(5, 6).cast("bigint"),
    ]
    return dict(zip(CALENDAR_COLUMNS, values, strict=True))
