"""DataFrame -> DataFrame operators (usable with ``df.transform``)."""

from airtrace.operators.curation import (
    complete_keys,
    curate,
    drop_invalid,
    messages_per_day,
    parse_messages,
    project_curated,
    observe_keys,
    skip_counts,
    status_ok,
    validity_counts,
    with_day,
)
from airtrace.operators.dedup import drop_repeats, station_state
from airtrace.operators.normalize import ensure_pollutants, normalize
from airtrace.operators.reports import (
    aqi_category_distribution,
    average_pollutants,
    daily_aqi,
    dominant_pollutants,
    hourly_aqi,
    preview,
    strongest_correlation,
    summary,
    weather_correlations,
)

__all__ = [
    "aqi_category_distribution",
    "average_pollutants",
    "complete_keys",
    "curate",
    "daily_aqi",
    "dominant_pollutants",
    "drop_invalid",
    "drop_repeats",
    "ensure_pollutants",
    "hourly_aqi",
    "messages_per_day",
    "normalize",
    "parse_messages",
    "preview",
    "project_curated",
    "observe_keys",
    "skip_counts",
    "station_state",
    "status_ok",
    "strongest_correlation",
    "summary",
    "validity_counts",
    "weather_correlations",
    "with_day",
]
