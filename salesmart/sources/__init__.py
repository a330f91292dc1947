"""Source registry, readers for raw files and the test-data mapping."""

from salesmart.sources.readers import NA_TOKENS, read_source, read_sources
from salesmart.sources.sinks import write_table
from salesmart.sources.specs import SOURCES, SourceSpec

__all__ = ["NA_TOKENS", "SOURCES", "SourceSpec", "read_source", "read_sources", "write_table"]
