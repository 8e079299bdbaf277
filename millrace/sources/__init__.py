"""Reading files and event feeds, once or incrementally."""

from millrace.sources.envelope import (
    ENVELOPE_SCHEMA, bronze_envelope, envelope_of, parse_topic,
)
from millrace.sources.files import copy_into, file_stream, ingest_files, with_provenance

__all__ = [
    "ENVELOPE_SCHEMA", "bronze_envelope", "copy_into", "envelope_of", "file_stream", "ingest_files", "parse_topic",
    "with_provenance",
]
