"""Structured Streaming: stateful change detection and the ingest queries."""

from airtrace.streaming.counters import CounterListener, read_counters
from airtrace.streaming.dedup_state import dedup_stream, read_stream_state
from airtrace.streaming.ingest import run_available, start_ingest, stateful, stop_after

__all__ = [
    "CounterListener", "dedup_stream", "read_counters", "read_stream_state", "run_available", "start_ingest",
    "stateful", "stop_after",
]
