from adfacts.sources.exports import ingest, load_source, normalise, read_export
from adfacts.sources.registry import SOURCES, SourceSpec

__all__ = ["SOURCES", "SourceSpec", "ingest", "load_source", "normalise", "read_export"]
