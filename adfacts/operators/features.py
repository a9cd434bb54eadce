"""Feature columns of the campaign fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from adfacts.functions.calendar import calendar_columns
from adfacts.functions.cleaning import strip_whitespace, to_date_time
from adfacts.functions.kpi import kpi_columns
from adfacts.operators.series import SkewPolicy, with_history
from adfacts.schema import CANONICAL_COLUMNS, SERIES_KEYS, require_columns

# What is lagged and averaged, and how far back.
HISTORY_METRICS = ["spend", "revenue", "clicks", "conversions"]
LAGS = [1, 7]
ROLLING_ROWS = [7, 14]


def _require_history(df: DataFrame, what: str) -> None:
    require_columns(df.columns, [*SERIES_KEYS, "date", *HISTORY_METRICS], what)


def time_features(df: DataFrame) -> DataFrame:
    """Nine calendar columns. A text date is read first; a malformed one gives NULLs."""
    require_columns(df.columns, ["date"], "time features")
    if df.schema["date"].dataType.typeName() == "string":
        df = df.withColumn("date", to_date_time(strip_whitespace(F.col("date"))))
    return df.withColumns(calendar_columns(F.col("date")))


def marketing_features(df: DataFrame) -> DataFrame:
    """Seven ratios; see ``kpi_columns``."""
    needed = ["spend", "revenue", "conversions", "clicks", "impressions"]
    require_columns(df.columns, needed, "marketing features")
    return df.withColumns(kpi_columns())


def lag_columns(window: WindowSpec) -> dict[str, Column]:
    return {
        f"{metric}_lag_{n}": F.lag(F.col(metric).cast("double"), n).over(window)
        for metric in HISTORY_METRICS
        for n in LAGS
    }


def rolling_columns(window: WindowSpec) -> dict[str, Column]:
    """Statistics of the rows before the current one; the current row is left out."""
    columns = {}
    for metric in HISTORY_METRICS:
        value = F.col(metric).cast("double")
        for rows in ROLLING_ROWS:
            frame = window.rowsBetween(-rows, -1)
            columns[f"{metric}_rolling_mean_{rows}"] = F.avg(value).over(frame)
            columns[f"{metric}_rolling_std_{rows}"] = F.coalesce(
                F.stddev_samp(value).over(frame), F.lit(0.0)
            )
            columns[f"{metric}_rolling_min_{rows}"] = F.min(value).over(frame)
            columns[f"{metric}_rolling_max_{rows}"] = F.max(value).over(frame)
    return columns


def history_columns(window: WindowSpec) -> dict[str, Column]:
    return {**lag_columns(window), **rolling_columns(window)}


def lag_features(df: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Values of 1 and 7 rows earlier in the same campaign; gaps in dates do not count."""
    _require_history(df, "lag features")
    return with_history(df, lag_columns, max(LAGS), policy)


def rolling_features(df: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Mean, deviation, minimum and maximum of the previous 7 and 14 rows."""
    _require_history(df, "rolling features")
    return with_history(df, rolling_columns, max(ROLLING_ROWS), policy)


def feature_table(df: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Canonical rows plus 56 columns: calendar, ratios, lags, rolling statistics.

    The 40 history columns share one window, and the row-wise ones are added after
    it, so that only the canonical columns are shuffled.
    """
    require_columns(df.columns, CANONICAL_COLUMNS, "feature table")
    history = with_history(df, history_columns, max(ROLLING_ROWS), policy)
    added = [c for c in history.columns if c not in df.columns]
    wide = history.transform(time_features).transform(marketing_features)
    row_wise = [c for c in wide.columns if c not in history.columns]
    return wide.select(*df.columns, *row_wise, *added)
