"""Structured Streaming: sinks, deduplication, late rows and joins."""

from millrace.streaming.dedup import dedup_stream, dedup_upsert, dedup_within
from millrace.streaming.joins import stream_static_join, stream_stream_join
from millrace.streaming.late import LateSplit, dropped_rows
from millrace.streaming.newest import newest_version_join
from millrace.streaming.sinks import (
    append_to, complete_to, complete_writer, each_batch, run_available_now, run_every, stop_all,
)

__all__ = [
    "LateSplit", "append_to", "complete_to", "complete_writer", "dedup_stream", "dedup_upsert", "dedup_within", "dropped_rows",
    "each_batch", "newest_version_join", "run_available_now", "run_every", "stop_all", "stream_static_join", "stream_stream_join",
]
