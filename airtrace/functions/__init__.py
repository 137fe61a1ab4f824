"""Column-level building blocks (JVM expressions only, no Python UDFs)."""

from airtrace.functions.aqi import aqi_category
from airtrace.functions.payload import (
    day_key,
    geo_value,
    payload_double,
    payload_int,
    payload_string,
    pollutant_map,
    station_key,
)
from airtrace.functions.stats import safe_corr
from airtrace.functions.time import event_time, wall_clock

__all__ = [
    "aqi_category",
    "day_key",
    "event_time",
    "geo_value",
    "payload_double",
    "payload_int",
    "payload_string",
    "pollutant_map",
    "safe_corr",
    "station_key",
    "wall_clock",
]
