"""Marketing ratios. A zero denominator gives NULL, never an error or infinity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def kpi_columns() -> dict[str, Column]:
    clicks, impressions, spend = (
        F.nullif(F.col(name), F.lit(0)) for name in ("clicks", "impressions", "spend")
    )
    conversions, revenue = F.col("conversions"), F.col("revenue")
    return {
        "ctr": F.col("clicks") / impressions,
        # spend is NULL when zero on both sides of a ratio: free clicks have no cost per click
        "cpc": spend / clicks,
        "cpm": spend / impressions * F.lit(1000),
        "conversion_rate": conversions / clicks,
        "roas": revenue / spend,
        "revenue_per_click": revenue / clicks,
        "revenue_per_impression": revenue / impressions,
    }
