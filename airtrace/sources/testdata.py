"""Adapter from the driver's ``events`` table to station observations.

The test tables hold no air-quality data; ``events`` plays the observation
stream.  Two views are derived, both by Spark from the whole table:

* :func:`observations` - curated records, one per event;
* :func:`raw_payloads` - one raw JSON message per event, with deliberate
  defects (missing time, text station ids, non-integer AQI, text readings,
  truncated JSON) so that curation is exercised on every kind of value.

Fixed values: ``user_id`` is the station, ``event_id`` the arrival order,
``event_type`` the dominant pollutant, ``floor(value)`` the AQI, ``props.k``
the temperature and a second pollutant ``k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# --- fixed values -----------------------------------------------------------
# Fallback processing day for payloads without a usable time.
FALLBACK_DAY = "2024-02-01"
# Defect rules of the raw payloads (by event_id).
NO_TIME_EVERY = 7          # event_id % 7 == 0: no data.time
TRUNCATED_EVERY = 10       # event_id % 10 == 0: JSON cut in half (invalid)
TEXT_ID_EVERY, TEXT_ID_AT = 3, 1       # idx written as a JSON string
FLOAT_AQI_EVERY, FLOAT_AQI_AT = 11, 5  # aqi written as 16.0 (not an integer)
TEXT_READING_EVERY = 13    # iaqi.k.v written as a JSON string
# ---------------------------------------------------------------------------


# Declared schemas of the driver tables read here (no footer inference).
TABLE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table with its declared schema."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ts is TIMESTAMP_NTZ: its text form does not depend on the session zone.
_ISO = "concat(replace(substring(CAST(ts AS STRING), 1, 19), ' ', 'T'), '+00:00')"
_K = "CAST(get_json_object(props, '$.k') AS DOUBLE)"
_HUMIDITY = "CASE WHEN event_type <> 'error' THEN value END"
_LAT = "42.0D + CAST(user_id AS DOUBLE) / 1000"
_LON = "23.0D + CAST(user_id AS DOUBLE) / 1000"


def observations(events: DataFrame) -> DataFrame:
    """Curated observation records (with ``seq`` and ``station_key``)."""
    return events.selectExpr(
        "event_id AS seq",
        f"{_ISO} AS timestamp",
        "CAST(user_id AS INT) AS station_id",
        "CAST(user_id AS STRING) AS station_key",
        "concat('station-', CAST(user_id AS STRING)) AS station_name",
        f"{_LAT} AS latitude",
        f"{_LON} AS longitude",
        "CAST(floor(value) AS INT) AS aqi",
        "event_type AS dominant_pollutant",
        f"CAST(map(event_type, value, 'k', {_K}) AS map<string,double>) AS pollutants",
        f"{_K} AS temperature",
        f"{_HUMIDITY} AS humidity",
        "1.0D AS wind",
        "CAST(NULL AS DOUBLE) AS pressure",
        "CAST(NULL AS DOUBLE) AS dew",
    )


def _num(sql: str) -> str:
    return f"coalesce(CAST({sql} AS STRING), 'null')"


def raw_payloads(events: DataFrame) -> DataFrame:
    """One raw JSON message per event: ``seq BIGINT, value STRING``."""
    idx = (
        f"CASE WHEN event_id % {TEXT_ID_EVERY} = {TEXT_ID_AT} "
        "THEN concat('\"', CAST(user_id AS STRING), '\"') ELSE CAST(user_id AS STRING) END"
    )
    aqi = (
        f"CASE WHEN event_id % {FLOAT_AQI_EVERY} = {FLOAT_AQI_AT} "
        "THEN CAST(CAST(floor(value) AS DOUBLE) AS STRING) ELSE CAST(floor(value) AS STRING) END"
    )
    k_reading = (
        f"CASE WHEN event_id % {TEXT_READING_EVERY} = 0 "
        f"THEN concat('\"', {_num(_K)}, '\"') ELSE {_num(_K)} END"
    )
    time = (
        f"CASE WHEN event_id % {NO_TIME_EVERY} <> 0 "
        f"THEN concat(',\"time\":{{\"iso\":\"', {_ISO}, '\",\"tz\":\"+00:00\"}}') "
        "ELSE '' END"
    )
    text = (
        "concat('{\"status\":\"ok\",\"data\":{\"aqi\":', " + aqi + ", "
        "',\"idx\":', " + idx + ", "
        "',\"city\":{\"geo\":[', " + _num(_LAT) + ", ',', " + _num(_LON) + ", "
        "'],\"name\":\"station-', CAST(user_id AS STRING), '\"}', "
        "',\"dominentpol\":\"', event_type, '\"', "
        "',\"iaqi\":{\"', event_type, '\":{\"v\":', " + _num("value") + ", "
        "'},\"k\":{\"v\":', " + k_reading + ", "
        "'},\"h\":{\"v\":', " + _num(_HUMIDITY) + ", "
        "'},\"t\":{\"v\":', " + _num(_K) + ", "
        "'},\"w\":{\"v\":1.0}}', " + time + ", '}}')"
    )
    value = (
        f"CASE WHEN event_id % {TRUNCATED_EVERY} = 0 "
        f"THEN substring(t, 1, CAST(floor(length(t) / 2) AS INT)) ELSE t END"
    )
    # the table may be one row group, which one task would write and parse alone
    return events.repartition("event_id").selectExpr("event_id", f"{text} AS t").selectExpr(
        "event_id AS seq", f"{value} AS value"
    )
