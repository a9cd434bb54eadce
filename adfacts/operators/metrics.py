"""Regression metrics in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adfacts.schema import require_columns

# Fixed value: stands in for a zero actual in the percentage error.
SMALLEST_ACTUAL = 2.220446049250313e-16


def regression_metrics(
    df: DataFrame,
    actual: str = "revenue",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """RMSE, MAE, R2 and MAPE (as a fraction), overall or per group.

    R2 of a constant actual is 1 for a perfect fit and 0 otherwise, and NULL for fewer
    than two rows. A zero actual makes ``mape`` enormous; ``mape_nonzero`` leaves such
    rows out and ``zero_actuals`` counts them. A missing value is not skipped in
    silence: it shows up in ``missing_rows``.
    """
    require_columns(df.columns, [actual, prediction, *by], "regression metrics")
    y, p = F.col(actual).cast("double"), F.col(prediction).cast("double")
    error = F.col("_y") - F.col("_p")
    size = F.abs(F.col("_y"))
    both = F.col("_y").isNotNull() & F.col("_p").isNotNull()
    sums = (
        df.select(*by, y.alias("_y"), p.alias("_p"))
        .groupBy(*by)
        .agg(
            F.count_if(both).alias("row_count"),
            F.count_if(~both).alias("missing_rows"),
            F.sum(error * error).alias("_sse"),
            (F.var_pop(F.when(both, F.col("_y"))) * F.count_if(both)).alias("_sst"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(F.abs(error) / F.greatest(size, F.lit(SMALLEST_ACTUAL))).alias("mape"),
            F.avg(F.abs(error) / F.nullif(size, F.lit(0.0))).alias("mape_nonzero"),
            F.count_if(both & (F.col("_y") == 0)).alias("zero_actuals"),
        )
    )
    constant = F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    r2 = F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.nullif(F.col("_sst"), F.lit(0.0)))
    return sums.select(
        *by,
        "row_count",
        "missing_rows",
        F.sqrt(F.col("_sse") / F.nullif(F.col("row_count"), F.lit(0))).alias("rmse"),
        "mae",
        F.when(F.col("row_count") >= 2, F.coalesce(r2, constant)).alias("r2"),
        "mape",
        "mape_nonzero",
        "zero_actuals",
    )


def checked_metrics(
    df: DataFrame, actual: str = "revenue", prediction: str = "prediction"
) -> dict[str, float]:
    """The overall metrics as plain numbers; empty or incomplete input is an error."""
    row = regression_metrics(df, actual, prediction).first().asDict()
    if row["row_count"] == 0 and row["missing_rows"] == 0:
        raise ValueError("nothing to evaluate: no rows")
    if row["missing_rows"]:
        raise ValueError(f"{row['missing_rows']} rows lack an actual or a predicted value")
    return row
