"""Normalization N1-N5 and the explicit time-zone rule."""

import pytest

from airtrace.operators.normalize import normalize

SCHEMA = "timestamp string, aqi int, pollutants map<string,double>"


@pytest.fixture()
def session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")

    def use(zone):
        spark.conf.set("spark.sql.session.timeZone", zone)

    yield use
    spark.conf.set("spark.sql.session.timeZone", old)


def test_source_clock_keeps_written_hour(spark):
    df = spark.createDataFrame([("2031-11-05T17:05:30+05:30", 12, {"ash": 0.5})], SCHEMA)
    r = normalize(df, tz="source").first()
    assert (r.day, r.hour) == ("2031-11-05", 17)


def test_session_clock_depends_on_session(spark, session_zone):
    df = spark.createDataFrame([("2031-11-05T17:05:30+05:30", 12, {"ash": 0.5})], SCHEMA)
    session_zone("UTC")
    assert normalize(df).first().hour == 11
    session_zone("Asia/Tokyo")
    assert normalize(df).first().hour == 20


def test_explicit_zone_ignores_session(spark, session_zone):
    df = spark.createDataFrame([("2026-04-07T23:30:00+00:00", 1, None)], SCHEMA)
    for zone in ("UTC", "Europe/Sofia", "America/New_York"):
        session_zone(zone)
        r = normalize(df, tz="Europe/Sofia").first()
        assert (r.day, r.hour) == ("2026-04-08", 2)
        r = normalize(df, tz="UTC").first()
        assert (r.day, r.hour) == ("2026-04-07", 23)


def test_midnight_near_offset_source_vs_utc(spark):
    df = spark.createDataFrame([("2026-04-08T00:30:00+03:00", 5, None)], SCHEMA)
    src = normalize(df, tz="source").first()
    utc = normalize(df, tz="UTC").first()
    assert (src.day, src.hour) == ("2026-04-08", 0)
    assert (utc.day, utc.hour) == ("2026-04-07", 21)


def test_rows_without_a_time_or_an_aqi_are_removed(spark):
    good = "2031-11-05T17:05:30+05:30"
    df = spark.createDataFrame(
        [(t, a) for t in (good, None, "", "soon", "2031-13-05T00:00:00+00:00") for a in (None, -3)],
        "timestamp string, aqi int",
    )
    out = normalize(df, tz="source").collect()
    assert [(r.aqi, r.day, r.hour, r.pollutants) for r in out] == [(-3, "2031-11-05", 17, {})]


def test_offset_without_seconds_is_rejected(spark):
    df = spark.createDataFrame([("2026-04-07T10:15+03:00", 5, None)], SCHEMA)
    assert normalize(df).count() == 0


def test_null_and_empty_maps_become_empty(spark):
    df = spark.createDataFrame(
        [("2026-04-07T10:00:00+00:00", 1, None), ("2026-04-07T10:00:00+00:00", 2, {})], SCHEMA
    )
    assert [r.pollutants for r in normalize(df).collect()] == [{}, {}]


def test_existing_day_is_overwritten(spark):
    df = spark.createDataFrame(
        [("2026-04-07T10:00:00+00:00", 1, "1999-01-01")], "timestamp string, aqi int, day string"
    )
    assert normalize(df, tz="source").first().day == "2026-04-07"


def test_filters_reach_the_scan(spark, tmp_dir):
    from airtrace.schemas import CURATED_COLUMNS
    from airtrace.sources.curated import read_curated

    spark.createDataFrame([("2026-04-07T10:00:00+00:00", 1)], "timestamp string, aqi int") \
        .write.json(tmp_dir)
    df = read_curated(spark, tmp_dir).select(*CURATED_COLUMNS)
    plan = normalize(df)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(timestamp)" in plan and "IsNotNull(aqi)" in plan
