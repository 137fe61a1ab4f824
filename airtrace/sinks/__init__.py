"""Sinks: day-partitioned raw and curated archives, topic publishing, reports."""

from airtrace.sinks.files import (
    kafka_sink_options,
    one_line,
    publish,
    write_curated,
    write_raw,
    write_reports,
)

__all__ = [
    "kafka_sink_options",
    "one_line",
    "publish",
    "write_curated",
    "write_raw",
    "write_reports",
]
