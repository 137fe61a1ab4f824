"""Normalization of curated records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtrace.functions.time import SESSION, day_of, event_time, hour_of, wall_clock
from airtrace.schemas import POLLUTANT_MAP_TYPE


def ensure_pollutants(df: DataFrame) -> DataFrame:
    """Add a NULL ``pollutants`` map when the column is missing."""
    if "pollutants" in df.columns:
        return df
    return df.withColumn("pollutants", F.lit(None).cast(POLLUTANT_MAP_TYPE))


def normalize(df: DataFrame, tz: str = SESSION) -> DataFrame:
    """Curated records -> analysable observations.

    Adds ``event_timestamp`` (the parsed instant), ``day`` (``yyyy-MM-dd``)
    and ``hour``; keeps only rows with a parseable timestamp and an ``aqi``
    (F4).  ``tz`` picks the clock that ``day``/``hour`` are read from, see
    :func:`airtrace.functions.time.wall_clock`; the default reproduces the
    session-zone rendering.  An existing ``day`` column is overwritten.

    Everything is one narrow projection and filter: Catalyst pushes the
    ``IsNotNull`` filters into the scan and fuses the rest into one codegen
    stage.
    """
    out = ensure_pollutants(df).withColumns(
        {
            "pollutants": F.coalesce(
                F.col("pollutants"), F.create_map().cast(POLLUTANT_MAP_TYPE)
            ),
            "event_timestamp": event_time("timestamp"),
        }
    )
    out = out.where(F.col("event_timestamp").isNotNull() & F.col("aqi").isNotNull())
    wall = wall_clock("timestamp", "event_timestamp", tz)
    if tz == SESSION:
        day = F.date_format("event_timestamp", "yyyy-MM-dd")
    else:
        day = day_of(wall)
    return out.withColumns({"day": day, "hour": hour_of(wall)})
