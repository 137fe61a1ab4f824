"""Sources: curated scan, raw archive, Kafka topic, test-table adapter."""

from airtrace.sources.curated import read_city, read_curated
from airtrace.sources.raw import (
    bootstrap_servers,
    kafka_source_options,
    read_city_archive,
    read_kafka_stream,
    read_raw_archive,
    topic_for,
)

__all__ = [
    "bootstrap_servers",
    "kafka_source_options",
    "read_city",
    "read_city_archive",
    "read_curated",
    "read_kafka_stream",
    "read_raw_archive",
    "topic_for",
]
