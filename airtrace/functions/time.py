"""Timestamp parsing and the explicit time-zone rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SESSION = "session"
SOURCE = "source"


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def event_time(text: Column | str = "timestamp") -> Column:
    """Instant of an ISO-8601 text; malformed text gives NULL, not an error."""
    value = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(value)


def wall_clock(text: Column | str, instant: Column | str, tz: str = SESSION) -> Column:
    """Local date-time (TIMESTAMP_NTZ) that ``day`` and ``hour`` are read from.

    * ``"session"``: the instant as rendered in the session time zone (the
      literal behaviour of a plain ``date_format``/``hour`` on the instant);
    * ``"source"``: the wall clock written in the text, offset ignored, so the
      result does not depend on any zone setting (falls back to the session
      rendering for texts without a date, such as ``10:15``);
    * any zone id (``"UTC"``, ``"Europe/Sofia"``, ``"+03:00"``): the instant
      converted to that zone.
    """
    txt = F.col(text) if isinstance(text, str) else text
    ts = F.col(instant) if isinstance(instant, str) else instant
    session_wall = ts.cast("timestamp_ntz")
    if tz == SESSION:
        return session_wall
    if tz == SOURCE:
        return F.coalesce(_source_wall(txt), session_wall)
    utc_wall = F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch_ntz())
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def _source_wall(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def day_of(wall: Column) -> Column:
    """``yyyy-MM-dd`` text of a wall clock (date cast, never the session)."""
    return wall.cast("date").cast("string")


def hour_of(wall: Column) -> Column:
    return F.hour(wall)
