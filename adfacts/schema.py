"""The canonical campaign fact table and the fixed values tied to it."""

from __future__ import annotations

from pyspark.sql import types as T

CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("date", T.TimestampNTZType()),
        T.StructField("platform", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("campaign_name", T.StringType()),
        T.StructField("spend", T.DoubleType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("conversions", T.DoubleType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("impressions", T.LongType()),
    ]
)
CANONICAL_COLUMNS = CANONICAL_SCHEMA.fieldNames()

# revenue may be missing: some platforms report none
REQUIRED_COLUMNS = [c for c in CANONICAL_COLUMNS if c != "revenue"]
NON_NEGATIVE_COLUMNS = ["spend", "conversions", "clicks", "impressions"]

# One campaign's history is the rows sharing these two columns.
SERIES_KEYS = ["platform", "campaign_id"]

# Columns carried next to a prediction.
PREDICTION_KEYS = ["date", "platform", "campaign_id", "campaign_name"]


def missing_columns(columns: list[str], required: list[str]) -> list[str]:
    return sorted(set(required) - set(columns))


def require_columns(columns: list[str], required: list[str], what: str) -> None:
    """Raise ``ValueError`` naming every column of ``required`` that is absent."""
    missing = missing_columns(columns, required)
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; found {sorted(columns)}")
