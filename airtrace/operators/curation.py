"""Raw message -> curated observation record.

Input: any DataFrame with a ``value`` text column (Kafka ``value`` cast to
STRING, a text archive, a test projection) plus any order columns.  All
parsing and typing is done by JVM expressions over one VARIANT parse, so a
malformed message costs one NULL, never a Python round trip or a job failure.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from airtrace.functions.payload import (
    day_key,
    geo_value,
    parse_wrapped,
    payload_double,
    payload_int,
    payload_string,
    pollutant_map,
    single_value,
    station_key,
)
from airtrace.schemas import CURATED_COLUMNS, WEATHER_COLUMNS

PAYLOAD = "payload"
_WRAPPED = "_wrapped_payload"

_OBSERVATION_IDS = itertools.count(1)


def message_text(value: Column | str = "value") -> Column:
    """Message bytes or text as STRING; NULL (so: invalid) when not UTF-8.

    A message that is not valid UTF-8 is dropped and counted like invalid
    JSON instead of failing the job.
    """
    col = F.col(value) if isinstance(value, str) else value
    return F.try_validate_utf8(col.cast("string"))


_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def last_key_wins(spark) -> None:
    """From now on repeated keys of a JSON object are allowed, the last one counts.

    The parse reads the setting whenever its expression is copied, by any
    self-join or union of what comes after it, so the session keeps it; a
    stream takes it along when it is started.
    """
    if spark.conf.get(_REPEATED_KEYS, "false").lower() != "true":
        spark.conf.set(_REPEATED_KEYS, "true")


def parse_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the parsed ``payload`` VARIANT (NULL when not valid JSON).

    Of repeated keys in an object the last one wins (:func:`last_key_wins`).
    The parse is its own projection; the validity test above it reads the
    parsed value several times without parsing again (Catalyst does not
    merge a projection whose expensive result is used more than once).
    """
    last_key_wins(df.sparkSession)
    wrapped = df.withColumn(_WRAPPED, parse_wrapped(F.col(value)))
    return wrapped.withColumn(PAYLOAD, single_value(F.col(_WRAPPED))).drop(_WRAPPED)


def drop_invalid(df: DataFrame) -> DataFrame:
    """Keep messages that are exactly one JSON value (F1)."""
    return df.where(F.col(PAYLOAD).isNotNull())


def valid_messages(
    df: DataFrame, value: str = "value", observation: Observation | str | None = None
) -> DataFrame:
    """Valid messages with their ``payload``, each parsed once.

    The parsed payload passes an ``observe`` node that counts messages and
    invalid JSON while the query runs, without an extra job.  The node also
    keeps the parse single: neither the test for validity nor any filter above
    is pushed below it, where Catalyst would inline - and so repeat - the parse
    into each predicate.
    """
    if observation is None:
        observation = f"airtrace_curation_{next(_OBSERVATION_IDS)}"
    parsed = parse_messages(df, value).observe(
        observation,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col(PAYLOAD).isNull()).alias("invalid_json"),
    )
    return drop_invalid(parsed)


def status_ok(df: DataFrame) -> DataFrame:
    """Optional gate: keep payloads whose ``status`` is ``"ok"`` (F2)."""
    return df.where(F.try_variant_get(PAYLOAD, "$.status", "string") == "ok")


def with_day(df: DataFrame, processing_date: str | None = None) -> DataFrame:
    """Add the storage ``day`` key of each payload.

    ``processing_date`` is the fallback day for payloads without a usable
    time; it defaults to the current date of the query.
    """
    return df.withColumn("day", day_key(PAYLOAD, processing_date))


def with_record_day(df: DataFrame, processing_date: str | Column | None = None) -> DataFrame:
    """Storage ``day`` of already curated records, by the rule of C6."""
    if processing_date is None:
        processing_date = F.current_date().cast("string")
    fallback = F.lit(processing_date) if isinstance(processing_date, str) else processing_date
    ts = F.col("timestamp")
    return df.withColumn(
        "day", F.when(F.length(ts) >= 10, F.substring(ts, 1, 10)).otherwise(fallback)
    )


def curated_columns(payload: str = PAYLOAD) -> list[Column]:
    """Typed curated fields of the payload column, in curated order."""
    fields = {
        "timestamp": payload_string(payload, "$.data.time.iso"),
        "station_id": payload_int(payload, "$.data.idx"),
        "station_name": payload_string(payload, "$.data.city.name"),
        "latitude": geo_value(payload, 0),
        "longitude": geo_value(payload, 1),
        "aqi": payload_int(payload, "$.data.aqi"),
        "dominant_pollutant": payload_string(payload, "$.data.dominentpol"),
        "pollutants": pollutant_map(payload),
    }
    for key, column in WEATHER_COLUMNS.items():
        fields[column] = payload_double(payload, f"$.data.iaqi.{key}.v")
    return [fields[name].alias(name) for name in CURATED_COLUMNS]


def project_curated(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Curated record of each payload (C3), plus ``station_key`` and ``keep``.

    A payload without a ``data`` object still yields a record (all fields
    NULL, ``pollutants`` empty).  ``station_key`` is the untyped station id
    as text, used by de-duplication (so ``42`` and ``"42"`` are one station
    even though the typed ``station_id`` of ``"42"`` is NULL).  A column of
    ``keep`` that is not there is an error, so an arrival order cannot get
    lost.
    """
    missing = [c for c in keep if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {', '.join(df.columns)}")
    passthrough = list(keep)
    return df.select(
        *curated_columns(PAYLOAD),
        station_key(PAYLOAD).alias("station_key"),
        *passthrough,
    )


def curate(
    df: DataFrame,
    processing_date: str | None = None,
    keep: tuple[str, ...] = ("seq",),
    value: str = "value",
    require_status_ok: bool = False,
    observation: Observation | str | None = None,
) -> DataFrame:
    """Raw messages -> curated records with ``day`` (C1-C8, F1, optional F2).

    The parsed payload always passes an ``observe`` node
    (:func:`valid_messages`).  Pass an :class:`Observation` (batch) or a name
    (streaming progress) to read its counters; otherwise a unique name is used.
    """
    valid = valid_messages(df, value, observation)
    if require_status_ok:
        valid = status_ok(valid)
    dated = with_day(valid, processing_date)
    return project_curated(dated, keep=tuple(keep) + ("day",))


def complete_keys(
    df: DataFrame, key: str = "station_key", version: str = "timestamp"
) -> DataFrame:
    """Drop records without a station or a timestamp."""
    return df.where(F.col(key).isNotNull() & F.col(version).isNotNull())


def messages_per_day(curated: DataFrame) -> DataFrame:
    """Number of valid messages per storage day."""
    return (
        curated.groupBy("day")
        .agg(F.count(F.lit(1)).alias("raw_messages"))
        .orderBy("day")
    )


def validity_counts(df: DataFrame, value: str = "value") -> DataFrame:
    """One row: valid and invalid message counts."""
    payload = F.col(PAYLOAD)
    return parse_messages(df, value).agg(
        F.count_if(payload.isNotNull()).alias("valid_messages"),
        F.count_if(payload.isNull()).alias("invalid_messages"),
    )


def observe_keys(
    curated: DataFrame,
    observation: Observation | str,
    key: str = "station_key",
    version: str = "timestamp",
) -> DataFrame:
    """Count records with and without a complete dedup key as they pass."""
    incomplete = F.col(key).isNull() | F.col(version).isNull()
    return curated.observe(
        observation,
        F.count_if(incomplete).alias("incomplete_keys"),
        F.count_if(~incomplete).alias("complete_keys"),
    )


def skip_counts(
    raw: DataFrame, curated: DataFrame, kept: DataFrame,
    key: str = "station_key", version: str = "timestamp",
) -> DataFrame:
    """One row of what the stages of a batch curation left out.

    ``raw`` are the messages, ``curated`` the records of the valid ones and
    ``kept`` what change detection kept of the complete ones.  Three scans
    with partial counts; only sums are exchanged.
    """
    incomplete = F.col(key).isNull() | F.col(version).isNull()
    zero = F.lit(0).cast("long")
    invalid = parse_messages(raw).agg(
        F.count_if(F.col(PAYLOAD).isNull()).alias("invalid_json"), F.max(zero).alias("incomplete_keys"),
        F.max(zero).alias("repeats_dropped"))
    keys = curated.agg(
        F.max(zero).alias("invalid_json"), F.count_if(incomplete).alias("incomplete_keys"),
        F.count_if(~incomplete).alias("repeats_dropped"))
    rest = kept.agg(
        F.max(zero).alias("invalid_json"), F.max(zero).alias("incomplete_keys"),
        (-F.count("*")).alias("repeats_dropped"))
    counts = invalid.unionByName(keys).unionByName(rest)
    return counts.agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in counts.columns])
