"""Advertising analytics on Spark: ingestion, features, forecasting, reporting."""

from adfacts.operators.features import feature_table
from adfacts.operators.validation import validate
from adfacts.plans.config import JobConfig
from adfacts.sources import ingest

__all__ = ["JobConfig", "feature_table", "ingest", "validate"]
