"""Raw payload -> curated record (C1-C8, F1-F3) on hand-made messages."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from airtrace.operators import curation as C
from airtrace.schemas import CURATED_COLUMNS

FULL = {
    "status": "ok",
    "data": {
        "idx": 51007,
        "aqi": 133,
        "time": {"iso": "2031-11-05T22:40:00-04:00", "note": "local"},
        "dominentpol": "nh3",
        "city": {"name": "Harbour mast 3", "geo": [-12.25, 130.75, 9.0], "extra": {"a": [1]}},
        "iaqi": {
            "w": {"v": 7.25}, "nh3": {"v": 133}, "t": {"v": 28.5}, "ash": {"v": 0.125},
            "p": {"v": 998.5}, "dew": {"v": 21}, "h": {"v": 64}, "c6h6": {"v": -1.5},
        },
        "unknown": [{"deep": None}],
    },
}


def curate(spark, messages, day="2026-04-07", **kw):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "seq long, value string")
    return C.curate(df, processing_date=day, **kw).orderBy("seq")


def one(spark, payload, **kw):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    got = curate(spark, [text], **kw).withColumn(
        "pollutants_json", F.to_json("pollutants")
    ).collect()
    assert len(got) == 1
    return got[0]


def test_full_projection(spark):
    r, data = one(spark, FULL), FULL["data"]
    readings = {k: float(x["v"]) for k, x in sorted(data["iaqi"].items())}
    weather = {k: readings.pop(k) for k in ("t", "h", "w", "p", "dew")}
    assert tuple(r.asDict().keys())[:-1] == CURATED_COLUMNS + ("station_key", "seq", "day")
    assert (r.timestamp, r.day) == (data["time"]["iso"], data["time"]["iso"][:10])
    assert (r.station_id, r.station_key, r.station_name) == (data["idx"], str(data["idx"]), data["city"]["name"])
    assert [r.latitude, r.longitude] == data["city"]["geo"][:2]
    assert (r.aqi, r.dominant_pollutant) == (data["aqi"], data["dominentpol"])
    assert json.loads(r.pollutants_json) == readings and list(json.loads(r.pollutants_json)) == list(readings)
    assert (r.temperature, r.humidity, r.wind, r.pressure, r.dew) == tuple(weather.values())


def test_geo_index_and_short_geo(spark):
    r = one(spark, {"data": {"city": {"geo": [-12.5, 0]}}})
    assert (r.latitude, r.longitude) == (-12.5, 0.0)
    r = one(spark, {"data": {"city": {"geo": [-12.5]}}})
    assert (r.latitude, r.longitude) == (-12.5, None)
    r = one(spark, {"data": {"city": {"geo": "-12.5,0"}}})
    assert (r.latitude, r.longitude) == (None, None)


def test_day_fallback_and_verbatim_prefix(spark):
    assert one(spark, {"data": {"idx": 7}}).day == "2026-04-07"
    assert one(spark, {"data": {"time": {"iso": "not-a-time!"}}}).day == "not-a-time"
    assert one(spark, {"data": {"time": {"iso": "2026-05"}}}).day == "2026-04-07"
    assert one(spark, {"data": {"time": {"iso": 1234567890123}}}).day == "2026-04-07"


@pytest.mark.parametrize("payload", ["[1]", "7", "null", '"text"', '{"data": 7}', '{"data": [1]}'])
def test_valid_json_without_data_object_gives_empty_record(spark, payload):
    r = one(spark, payload)
    assert all(getattr(r, c) is None for c in CURATED_COLUMNS if c != "pollutants")
    assert r.pollutants == {} and r.day == "2026-04-07"


@pytest.mark.parametrize(
    "text", ["not-json", "", '{"a":1} x', '{"a":1},{"b":2}', "NaN", '{"data":', "   ", '{"a":1}] x', '{"a":1}]',
             "1],[2", "[1]]", '1,"end"']
)
def test_invalid_json_is_dropped(spark, text):
    assert curate(spark, [text]).count() == 0


def test_invalid_dropped_from_raw_and_counted(spark):
    obs = Observation("counters")
    df = spark.createDataFrame([(1, "not-json"), (2, '{"data":{"idx":7}}')], "seq long, value string")
    got = C.curate(df, observation=obs).collect()
    assert [r.station_id for r in got] == [7]
    assert obs.get == {"messages": 2, "invalid_json": 1}


def test_of_repeated_keys_the_last_wins(spark):
    text = '{"data":{"aqi":1,"idx":3,"aqi":2}}'
    assert one(spark, text).aqi == 2
    assert curate(spark, [text]).where("aqi = 2").select("station_id").first()[0] == 3
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "true"  # for copies of the parse


def test_a_missing_order_column_is_an_error(spark):
    df = spark.createDataFrame([(1, "{}")], "seq long, value string")
    with pytest.raises(ValueError, match="offset"):
        C.curate(df, keep=("partition", "offset"))


@pytest.mark.parametrize(
    "aqi, expected", [(16, 16), ("-", None), (16.0, None), ("16", None), (True, None),
                      (3000000000, None), (-3, -3), (None, None)],
)
def test_aqi_typed_like_a_typed_scan(spark, aqi, expected):
    assert one(spark, {"data": {"aqi": aqi}}).aqi == expected


def test_station_key_untyped(spark):
    a = one(spark, {"data": {"idx": 42}})
    b = one(spark, {"data": {"idx": "42"}})
    assert (a.station_id, a.station_key) == (42, "42")
    assert (b.station_id, b.station_key) == (None, "42")


def test_pollutant_entries_typed_one_by_one(spark):
    iaqi = {"no2": {"v": "5"}, "pm10": {"v": 11}, "co": {"v": None}, "b": {"v": True},
            "x": 3, "o3": {}, "so2": {"v": [1]}, "t": {"v": "warm"}}
    r = one(spark, {"data": {"iaqi": iaqi}})
    assert r.pollutants_json == '{"b":1.0,"pm10":11.0}'
    assert r.temperature is None


@pytest.mark.parametrize("iaqi", [[1, 2], "x", None, 5])
def test_non_object_iaqi_gives_empty_map(spark, iaqi):
    assert one(spark, {"data": {"iaqi": iaqi}}).pollutants == {}


def test_weather_numbers_and_nan_text(spark):
    iaqi = {"t": {"v": "NaN"}, "h": {"v": "7"}, "w": {"v": True}, "p": {"v": 1013}}
    r = one(spark, {"data": {"iaqi": iaqi}})
    assert r.temperature != r.temperature  # NaN
    assert (r.humidity, r.wind, r.pressure) == (None, None, 1013.0)


def test_status_gate_optional(spark):
    msgs = [json.dumps({"status": "error", "data": {"idx": 1}}), json.dumps(FULL)]
    assert curate(spark, msgs).count() == 2
    assert curate(spark, msgs, require_status_ok=True).count() == 1


def test_two_days_in_one_batch(spark):
    with_time = json.dumps({"data": {"idx": 1, "time": {"iso": "2031-11-06T01:00:00-04:00"}}})
    cur = curate(spark, [with_time, '{"data":{}}'])
    got = {r.day: r.raw_messages for r in C.messages_per_day(cur).collect()}
    assert got == {"2026-04-07": 1, "2031-11-06": 1}


def test_complete_keys(spark):
    df = spark.createDataFrame(
        [("42", "10:00"), (None, "11:00"), ("42", None)], "station_key string, timestamp string"
    )
    assert [tuple(r) for r in C.complete_keys(df).collect()] == [("42", "10:00")]


def test_validity_counts(spark):
    df = spark.createDataFrame([("{}",), ("x",), ("[1]",), ("",)], "value string")
    assert tuple(C.validity_counts(df).first()) == (2, 2)


def test_single_parse_in_plan(spark):
    """Filters stay above the parse: the JSON text is parsed once per row."""
    df = spark.createDataFrame([(1, json.dumps(FULL))], "seq long, value string")
    plan = C.curate(df).where("aqi is not null")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_non_utf8_bytes_are_invalid(spark):
    df = spark.createDataFrame(
        [(1, bytearray(b'{"data":{"idx":1}}')), (2, bytearray(b'{"data":{"idx":"\\xff\\xfe"}}'))],
        "seq long, raw binary",
    ).select("seq", C.message_text("raw").alias("value"))
    obs = Observation("utf8")
    got = C.curate(df, observation=obs).collect()
    assert [r.seq for r in got] == [1]
    assert obs.get == {"messages": 2, "invalid_json": 1}
