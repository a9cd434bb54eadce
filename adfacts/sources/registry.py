"""What each ad platform calls its columns. A new platform is a new entry."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

MICROS_PER_UNIT = 1_000_000


@dataclass(frozen=True)
class SourceSpec:
    """Maps one platform's export to the canonical table.

    ``columns`` maps canonical names to source names; all are required. A canonical
    column without an entry is NULL. ``cleaners`` rewrites the text of a canonical
    column before it is typed.
    """

    platform: str
    columns: Mapping[str, str]
    spend_divisor: int = 1
    thousands_commas: bool = False
    grain_end: str | None = None  # optional last-day column of a multi-day report
    date_patterns: tuple[tuple[str, list[str]], ...] = ()
    cleaners: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return list(self.columns.values())


GOOGLE_ADS = SourceSpec(
    platform="google_ads",
    columns={
        "date": "segments_date",
        "campaign_name": "campaign_name",
        "impressions": "metrics_impressions",
        "clicks": "metrics_clicks",
        "spend": "metrics_cost_micros",
        "conversions": "metrics_conversions",
        "revenue": "metrics_conversions_value",
    },
    spend_divisor=MICROS_PER_UNIT,
)

# The export has no revenue column, so revenue stays NULL.
META_ADS = SourceSpec(
    platform="meta_ads",
    columns={
        "date": "date_start",
        "campaign_name": "campaign_name",
        "impressions": "impressions",
        "clicks": "clicks",
        "spend": "spend",
        "conversions": "conversion",
    },
    grain_end="date_stop",
)

MICROSOFT_ADS = SourceSpec(
    platform="microsoft_ads",
    columns={
        "date": "TimePeriod",
        "campaign_name": "CampaignName",
        "impressions": "Impressions",
        "clicks": "Clicks",
        "spend": "Spend",
        "conversions": "Conversions",
        "revenue": "Revenue",
    },
    thousands_commas=True,
)

SOURCES: dict[str, SourceSpec] = {
    spec.platform: spec for spec in (GOOGLE_ADS, META_ADS, MICROSOFT_ADS)
}
