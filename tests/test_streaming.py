"""Streaming: stateful change detection across restarts and the ingest queries."""

import json
import os

import pytest

from pyspark.sql import functions as F

from airtrace.operators.dedup import drop_repeats
from airtrace.schemas import CURATED_SCHEMA
from airtrace.sources.curated import read_curated
from airtrace.streaming.dedup_state import dedup_stream
from airtrace.streaming.ingest import run_available, start_ingest, stateful

OBS = "seq long, station_key string, timestamp string, aqi int"


def _write_json(spark, rows, path):
    spark.createDataFrame(rows, OBS).write.mode("append").json(path)


def _stream_once(spark, src, sink, ck):
    stream = spark.readStream.schema(OBS).json(src)
    run_available(dedup_stream(stream), "json", sink, ck)


def test_stream_equals_batch_across_restarts(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    first = [(1, "42", "A", 1), (2, "42", "A", 2), (3, "42", "B", 3), (4, "7", "X", 4)]
    second = [(5, "42", "B", 5), (6, "42", "A", 6), (7, "7", "X", 7), (8, None, "Z", 8)]
    _write_json(spark, first, src)
    _stream_once(spark, src, sink, ck)
    _write_json(spark, second, src)
    _stream_once(spark, src, sink, ck)  # restart: state comes from the checkpoint
    got = sorted(r.seq for r in spark.read.schema(OBS).json(sink).collect())
    batch = drop_repeats(spark.createDataFrame(first + second, OBS))
    assert got == sorted(r.seq for r in batch.collect()) == [1, 3, 4, 6]


def test_state_survives_restart_with_repeated_last_value(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    _write_json(spark, [(1, "1", "A", 1), (2, "1", "A", 1), (3, "1", "B", 1)], src)
    _stream_once(spark, src, sink, ck)
    _write_json(spark, [(4, "1", "B", 1), (5, "1", "A", 1)], src)
    _stream_once(spark, src, sink, ck)
    got = sorted(r.seq for r in spark.read.schema(OBS).json(sink).collect())
    assert got == [1, 3, 5]


def _payload(idx, iso, aqi):
    data = {"idx": idx, "aqi": aqi, "iaqi": {"pm10": {"v": aqi / 2}, "t": {"v": 10}}}
    if iso is not None:
        data["time"] = {"iso": iso}
    return json.dumps({"status": "ok", "data": data}, indent=1)  # pretty: several lines


def test_ingest_writes_raw_and_curated_by_day(spark, tmp_dir):
    src, root, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    messages = [
        (1, _payload(1, "2026-04-07T10:00:00+03:00", 40)),
        (2, _payload(1, "2026-04-07T10:00:00+03:00", 40)),  # repeat: raw only
        (3, "not-json"),
        (4, _payload(1, "2026-04-08T11:00:00+03:00", 60)),
        (5, _payload(2, None, 7)),  # no time: fallback day, incomplete key
    ]
    spark.createDataFrame(messages, "seq long, value string").write.parquet(src)
    source = spark.readStream.schema("seq long, value string").parquet(src)
    raw_q, cur_q = start_ingest(source, root, "sofia", ck, processing_date="2026-04-09",
                                raw_format="text")
    for q in (raw_q, cur_q):
        q.awaitTermination()
        assert q.exception() is None

    raw = spark.read.schema("value string, day string").text(f"{root}/sofia/raw")
    assert sorted((r.day, json.loads(r.value)["data"]["idx"]) for r in raw.collect()) == [
        ("2026-04-07", 1), ("2026-04-07", 1), ("2026-04-08", 1), ("2026-04-09", 2)
    ]
    assert all("\n" not in r.value for r in raw.collect())

    curated_lines = spark.read.text(f"{root}/sofia/curated").collect()
    assert len(curated_lines) == 2
    first = json.loads(curated_lines[0].value)
    assert list(first.keys()) == [f.name for f in CURATED_SCHEMA.fields]
    assert first["station_name"] is None  # nulls are written

    cur = read_curated(spark, f"{root}/sofia/curated").orderBy("timestamp").collect()
    assert [(r.storage_day, r.aqi, r.pollutants) for r in cur] == [
        ("2026-04-07", 40, {"pm10": 20.0}), ("2026-04-08", 60, {"pm10": 30.0})
    ]
    assert os.path.isdir(f"{ck}/curated/state")


WIDE = ("seq long, station_key string, timestamp string, aqi int, big long, "
        "temperature double, pollutants map<string,double>, tags array<string>")


def test_packed_columns_round_trip_exactly(spark, tmp_dir):
    src, sink, ck = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    rows = [
        (1, "1", "A", 7, 2**62 + 1, float("nan"), {"pm10": 0.1 + 0.2, "co": None}, ["x"]),
        (2, "1", "B", None, None, 1e-300, {}, []),
        (3, "2", "A", -1, -5, -0.0, None, None),
    ]
    spark.createDataFrame(rows, WIDE).write.parquet(src)
    stream = spark.readStream.schema(WIDE).parquet(src)
    run_available(dedup_stream(stream), "parquet", sink, ck)
    got = {r.seq: r for r in spark.read.schema(WIDE).parquet(sink).collect()}
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert one.big == 2**62 + 1 and one.temperature != one.temperature
    assert one.pollutants == {"pm10": 0.1 + 0.2, "co": None} and one.tags == ["x"]
    assert got[2].aqi is None and got[2].temperature == 1e-300 and got[2].pollutants == {}
    assert got[3].pollutants is None and got[3].tags is None


def test_two_order_columns_like_kafka(spark, tmp_dir):
    """Arrival order given as (partition, offset)."""
    schema = "partition int, offset long, station_key string, timestamp string"
    rows = [(0, 2, "1", "B"), (0, 1, "1", "A"), (1, 0, "1", "B"), (0, 3, "1", "B")]
    src, sink, ck = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    spark.createDataFrame(rows, schema).write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    run_available(dedup_stream(stream, order=["partition", "offset"]), "parquet", sink, ck)
    got = sorted((r.partition, r.offset) for r in spark.read.parquet(sink).collect())
    # order: (0,1)A (0,2)B (0,3)B (1,0)B -> keep A, B
    assert got == [(0, 1), (0, 2)]


class _Value:
    """A value state without a store."""

    def __init__(self, value=None):
        self.value = value

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return (self.value,)

    def update(self, row):
        (self.value,) = row


def _processor(value=None, order=("seq",)):
    from pyspark.sql.types import StringType

    from airtrace.streaming.dedup_state import StationVersions

    step = StationVersions("timestamp", list(order), StringType())
    state = _Value(value)
    step.init(state)
    return step, state


def _rows(versions):
    from pyspark.sql import Row

    return [Row(p=0, seq=i + 1, timestamp=v) for i, v in enumerate(versions)]


def test_processor_compares_row_after_row():
    rows = _rows("AABBAAC")
    step, state = _processor()
    out = list(step.handleInputRows(("42",), iter(rows), None))
    assert [r.seq for r in out] == [1, 3, 5, 7] and state.value == "C"
    assert [r.seq for r in _processor("A")[0].handleInputRows(("42",), iter(rows), None)] == [3, 5, 7]
    step, state = _processor("A")
    assert list(step.handleInputRows(("42",), iter([]), None)) == [] and state.value == "A"

    def broken():  # a row is passed on before the next one is asked for
        yield rows[0]
        raise LookupError

    passed = _processor()[0].handleInputRows(("42",), broken(), None)
    assert next(passed).seq == 1
    with pytest.raises(LookupError):
        next(passed)


def test_processor_refuses_records_out_of_order():
    rows = _rows("ABC")
    assert len(list(_processor(order=("p", "seq"))[0].handleInputRows(("1",), iter(rows), None))) == 3
    with pytest.raises(ValueError, match="order"):
        list(_processor(order=("p", "seq"))[0].handleInputRows(("1",), iter(rows[::-1]), None))


def test_hot_station_in_random_files_and_a_seed(spark, tmp_dir):
    """A third of the rows in one station, spread at random over files; a seeded checkpoint."""
    import random

    from airtrace.operators.dedup import station_state

    rnd = random.Random(4)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 20}", rnd.choice("AB"), i) for i in range(6000)]
    before = [(-1, "hot", "A", 0), (-2, "s1", "B", 0), (-3, "gone", "C", 0)]
    spark.createDataFrame(rows, OBS).orderBy(F.rand(1)).repartition(7).write.parquet(f"{tmp_dir}/src")
    seed = station_state(spark.createDataFrame(before, OBS))
    stream = spark.readStream.schema(OBS).parquet(f"{tmp_dir}/src")
    run_available(dedup_stream(stream, initial_state=seed), "parquet", f"{tmp_dir}/sink", f"{tmp_dir}/ck", partitions=3)
    got = sorted(r.seq for r in spark.read.schema(OBS).parquet(f"{tmp_dir}/sink").collect())
    want = drop_repeats(spark.createDataFrame(before + rows, OBS))
    assert got == sorted(r.seq for r in want.collect() if r.seq >= 0)


@pytest.mark.parametrize("seeded", [False, True])
def test_python_gets_two_records_of_a_hot_station(spark, tmp_dir, monkeypatch, seeded):
    """The runner gathers a key's records in Python, so their number must not grow with the station."""
    from airtrace.streaming import dedup_state

    class Two(dedup_state.StationVersions):
        def handleInputRows(self, key, rows, timerValues):
            rows = list(rows)
            if len(rows) > 2:
                raise ValueError(f"{len(rows)} records of {key}")
            yield from super().handleInputRows(key, iter(rows), timerValues)

    monkeypatch.setattr(dedup_state, "StationVersions", Two)
    state = [("hot", "A"), ("gone", "B")]
    seed = spark.createDataFrame(state, "station_key string, last_timestamp string") if seeded else None
    rows = [(i, "hot" if i % 3 else "cold", "AABBC"[i % 5], i) for i in range(900)]
    rows += [(1000, "once", "A", 1), (1001, "twice", "A", 1), (1002, "twice", "A", 2)]
    want = []
    last = dict(state) if seeded else {}
    for part in (rows[:500], rows[500:]):
        _write_json(spark, part, f"{tmp_dir}/src")
        stream = spark.readStream.schema(OBS).json(f"{tmp_dir}/src")
        run_available(dedup_stream(stream, initial_state=seed), "json", f"{tmp_dir}/sink", f"{tmp_dir}/ck", partitions=3)
        for seq, station, version, _ in part:
            if last.get(station) != version:
                want.append(seq)
            last[station] = version
    assert sorted(r.seq for r in spark.read.schema(OBS).json(f"{tmp_dir}/sink").collect()) == want


def test_a_micro_batch_is_read_and_exchanged_once(spark, tmp_dir):
    """Both paths of change detection share one exchange; ties of the order lose nothing."""
    rows = [(i // 2, f"s{i % 4 // 2}", "AB"[i // 4 % 2], i) for i in range(80)]
    spark.createDataFrame(rows, OBS).repartition(5).write.parquet(f"{tmp_dir}/src")
    kept = dedup_stream(spark.readStream.schema(OBS).parquet(f"{tmp_dir}/src"))
    with stateful(spark, 2):
        query = kept.writeStream.format("parquet").option("path", f"{tmp_dir}/sink").option(
            "checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.count("FileScan") == plan.count("REPARTITION_BY_COL") - plan.count("ReusedExchange") == 1
    assert query.lastProgress["numInputRows"] == 80
    got = sorted((r.station_key, r.seq) for r in spark.read.parquet(f"{tmp_dir}/sink").collect())
    assert got == [(f"s{k}", i) for k in (0, 1) for i in range(k, 40, 2)]


def test_state_of_a_stream_seeds_another_partition_count(spark, tmp_dir):
    from airtrace.operators.dedup import station_state
    from airtrace.streaming import read_stream_state

    rows = [(i, f"s{i % 7}", "AB"[i % 3 % 2], i) for i in range(90)]
    _write_json(spark, rows[:40], f"{tmp_dir}/src")
    stream = spark.readStream.schema(OBS).json(f"{tmp_dir}/src")
    run_available(dedup_stream(stream), "json", f"{tmp_dir}/sink", f"{tmp_dir}/ck", partitions=2)
    state = read_stream_state(spark, f"{tmp_dir}/ck")
    batch = station_state(spark.createDataFrame(rows[:40], OBS))
    assert state.columns == batch.columns
    assert sorted(map(tuple, state.collect())) == sorted(map(tuple, batch.collect()))
    _write_json(spark, rows[40:], f"{tmp_dir}/src2")
    stream = spark.readStream.schema(OBS).json(f"{tmp_dir}/src2")
    run_available(dedup_stream(stream, initial_state=state), "json", f"{tmp_dir}/sink2", f"{tmp_dir}/ck2", partitions=5)
    got = sorted(r.seq for p in ("sink", "sink2") for r in spark.read.schema(OBS).json(f"{tmp_dir}/{p}").collect())
    assert got == sorted(r.seq for r in drop_repeats(spark.createDataFrame(rows, OBS)).collect())


def test_a_missing_sliced_state_is_an_error_and_scratch_goes(spark, tmp_dir):
    """Ten micro-batches leave no scratch; an unfinished state stops the query."""
    import random

    from airtrace.paths import file_system
    from airtrace.session import scratch_made
    from airtrace.streaming import sliced

    rnd = random.Random(8)
    rows = [(i, rnd.choice("abc"), rnd.choice("xy"), i) for i in range(100)]
    for at in range(0, 100, 10):
        spark.createDataFrame(rows[at : at + 10], OBS).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src")

    def start():
        stream = spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src")
        query = sliced.start_sliced_dedup(stream, f"{tmp_dir}/out", f"{tmp_dir}/state", f"{tmp_dir}/ck")
        query.awaitTermination()
        return query

    with scratch_made() as made:
        assert start().exception() is None
        assert made == []  # filled when the block ends
    assert not any(file_system(spark, p)[0].exists(file_system(spark, p)[1]) for p in made)
    got = sorted(r.seq for r in sliced.read_sliced(spark, f"{tmp_dir}/out", "seq long, station_key string, timestamp string, aqi int").collect())
    assert got == sorted(r.seq for r in drop_repeats(spark.createDataFrame(rows, OBS)).collect())
    (last,) = [p for p in os.listdir(f"{tmp_dir}/state") if p == "batch=000000000009"]
    os.remove(f"{tmp_dir}/state/{last}/{sliced._MARKER}")
    spark.createDataFrame([(200, "a", "x", 0)], OBS).write.mode("append").parquet(f"{tmp_dir}/src")
    with pytest.raises(Exception, match="missing or was not finished"):
        start()


def test_processing_time_trigger_bounded_run(spark, tmp_dir):
    from airtrace.streaming.ingest import stop_after

    src, sink, ck = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    # one file: both rows arrive in the same micro-batch, ordered by seq
    spark.createDataFrame([(1, "1", "A", 1), (2, "1", "A", 1)], OBS).coalesce(1).write.json(src)
    stream = spark.readStream.schema(OBS).option("maxFilesPerTrigger", 1).json(src)
    with stateful(spark):
        query = (
            dedup_stream(stream).writeStream.format("json")
            .option("path", sink).option("checkpointLocation", ck)
            .trigger(processingTime="1 second").start()
        )
    assert stop_after(query, 1, timeout=120) >= 1
    assert not query.isActive
    assert [r.seq for r in spark.read.schema(OBS).json(sink).collect()] == [1]


def test_ingest_with_parquet_raw_archive_parses_once(spark, tmp_dir):
    from airtrace.operators.dedup import drop_repeats as batch_dedup
    from airtrace.sources.raw import read_parquet_archive

    src, root, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    messages = [
        (1, _payload(1, "2026-04-07T10:00:00+03:00", 40)),
        (2, _payload(1, "2026-04-07T10:00:00+03:00", 40)),
        (3, "not-json"),
        (4, _payload(1, "2026-04-08T11:00:00+03:00", 60)),
        (5, _payload(2, None, 7)),
    ]
    spark.createDataFrame(messages, "seq long, value string").write.parquet(src)
    source = spark.readStream.schema("seq long, value string").parquet(src)
    raw_q, cur_q = start_ingest(source, root, "sofia", ck, processing_date="2026-04-09",
                                raw_format="parquet")
    for q in (raw_q, cur_q):
        q.awaitTermination()
        assert q.exception() is None
    archive = read_parquet_archive(spark, f"{root}/sofia/raw")
    assert sorted(r.seq for r in archive.collect()) == [1, 2, 4, 5]
    assert all("\n" not in r.value for r in archive.collect())
    cur = read_curated(spark, f"{root}/sofia/curated").orderBy("timestamp").collect()
    assert [(r.storage_day, r.aqi) for r in cur] == [("2026-04-07", 40), ("2026-04-08", 60)]
    # batch replay of the Parquet archive: numeric order, no JSON parsing
    replayed = batch_dedup(archive.drop("value"))
    assert sorted(r.seq for r in replayed.collect()) == [1, 4]
    from airtrace.plans.replay import curate_parquet_archive

    assert sorted(r.aqi for r in curate_parquet_archive(archive).collect()) == [40, 60]
    plan = replayed._jdf.queryExecution().executedPlan().toString()
    assert "parseJson" not in plan


def test_state_partitions_apply_to_new_checkpoint_only(spark, tmp_dir):
    from airtrace.streaming.ingest import state_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    src, sink, ck = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ck"
    _write_json(spark, [(1, "1", "A", 1), (2, "2", "B", 1)], src)
    stream = spark.readStream.schema(OBS).json(src)
    run_available(dedup_stream(stream), "json", sink, ck, partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    import os

    assert sorted(n for n in os.listdir(f"{ck}/state/0") if n.isdigit()) == ["0", "1", "2"]
    with state_partitions(spark, None):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before


def _run_ingest(spark, source, root, ck, **kw):
    for q in start_ingest(source, root, "port", ck, **kw):
        q.awaitTermination()
        assert q.exception() is None


def _kept(df):
    return sorted((r.station_id, r.timestamp, r.aqi) for r in df.collect())


def test_replay_of_a_streamed_archive_follows_the_arrival_order(spark, tmp_dir):
    """Many micro-batches, a change back (A, B, A) across them, and late days."""
    from airtrace.plans.replay import curate_archive, curate_parquet_archive
    from airtrace.sources.raw import read_parquet_archive, read_raw_archive

    src, root, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    a, b, early = "2031-11-06T01:00:00Z", "2031-11-06T02:00:00Z", "2031-11-05T23:00:00Z"
    arrivals = [a, a, b, a, early, a, a, early, early, b]
    for seq, iso in enumerate(arrivals):
        messages = [(2 * seq, _payload(1, iso, seq)), (2 * seq + 1, _payload(2, a, 50 + seq))]
        spark.createDataFrame(messages, "seq long, value string").write.mode("append").parquet(src)
        source = spark.readStream.schema("seq long, value string").parquet(src)
        _run_ingest(spark, source, root, ck)
    want = [s for s, iso in enumerate(arrivals) if s == 0 or arrivals[s - 1] != iso]
    streamed = _kept(read_curated(spark, f"{root}/port/curated"))
    assert sorted(aqi for station, _, aqi in streamed if station == 1) == want
    assert [aqi for station, _, aqi in streamed if station == 2] == [50]
    archive = read_parquet_archive(spark, f"{root}/port/raw")
    assert _kept(curate_parquet_archive(archive)) == streamed
    again = curate_archive(archive.select("value", "seq"), order="seq")  # parsed anew
    assert _kept(again) == streamed
    one_day = read_parquet_archive(spark, f"{root}/port/raw", "2031-11-05", "2031-11-05")
    assert {r.timestamp for r in one_day.collect()} == {early}
    with pytest.raises(ValueError, match="arrival order"):
        read_raw_archive(spark, f"{root}/port/raw")
    with pytest.raises(ValueError, match="stream"):
        from airtrace.sinks.files import write_curated

        write_curated(again.limit(1), root, "port")


def test_bounded_run_counts_beyond_the_progress_window(spark, tmp_dir):
    """More micro-batches than the recent progress reports keep."""
    from airtrace.streaming.ingest import stop_after

    src = f"{tmp_dir}/src"
    spark.range(40).repartition(40).write.parquet(src)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
        query = (stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/ck")
                 .trigger(processingTime="0 seconds").start())
        assert stop_after(query, 20, timeout=200) >= 20
        assert not query.isActive
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_bounded_run_that_misses_its_timeout_raises(spark, tmp_dir):
    from airtrace.streaming.ingest import stop_after

    src = f"{tmp_dir}/src"
    spark.range(1).write.parquet(src)
    query = (spark.readStream.schema("id long").parquet(src).writeStream.format("noop")
             .option("checkpointLocation", f"{tmp_dir}/ck").trigger(processingTime="1 second").start())
    with pytest.raises(TimeoutError):
        stop_after(query, 5, timeout=8)
    assert not query.isActive


def test_stream_counters_and_one_fallback_day(spark, tmp_dir, monkeypatch):
    """Invalid messages, incomplete keys and repeats are counted; the fallback
    day is fixed when the queries are built."""
    src, root, ck = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    iso = "2031-11-06T01:00:00Z"
    messages = [(0, _payload(1, iso, 1)), (1, _payload(1, iso, 1)), (2, "{"), (3, _payload(2, None, 7)),
                (4, '{"data":{"idx":3,"idx":4,"time":{"iso":"' + iso + '"}}}')]
    spark.createDataFrame(messages, "seq long, value string").write.parquet(src)
    source = spark.readStream.schema("seq long, value string").parquet(src)
    raw, curated = start_ingest(source, root, "port", ck)
    for q in (raw, curated):
        q.awaitTermination()
        assert q.exception() is None

    def total(query, name):
        rows = [p["observedMetrics"][name] for p in query.recentProgress if p["numInputRows"]]
        return [sum(r[i] for r in rows) for i in range(len(rows[0]))]

    assert total(raw, "airtrace_ingest_port") == [5, 1]
    assert total(curated, "airtrace_keys_port") == [1, 3]
    assert total(curated, "airtrace_kept_port") == [2]
    today = str(spark.sql("select current_date()").first()[0])
    days = {r.day for r in spark.read.parquet(f"{root}/port/raw").selectExpr("cast(day as string) day").collect()}
    assert days <= {"2031-11-06", today}
    got = read_curated(spark, f"{root}/port/curated").collect()
    assert sorted(r.station_id for r in got) == [1, 4]  # of repeated keys the last counts


def test_sliced_micro_batches_run_again_and_seeded(spark, tmp_dir):
    """Small slices, restarts, a hot station, a repeated micro-batch, a seed."""
    import random
    import shutil

    from airtrace.operators.dedup import drop_repeats, station_state
    from airtrace.streaming.sliced import read_sliced, seed_state, start_sliced_dedup

    rng = random.Random(12)
    schema = "seq long, station_key string, timestamp string, aqi int"
    rows = [(i, rng.choice(["hot", "hot", "b", "c", None]), rng.choice(["x", "y"]), i) for i in range(120)]
    src, out, state, ck = (f"{tmp_dir}/{x}" for x in ("src", "out", "state", "ck"))

    def run(part, out=out, state=state, ck=ck):
        spark.createDataFrame(part, schema).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        query = start_sliced_dedup(stream, out, state, ck, slice_size=7)
        query.awaitTermination()
        assert query.exception() is None

    def kept(*outs):
        return sorted(r.seq for o in outs for r in read_sliced(spark, o, schema).collect())

    want = sorted(r.seq for r in drop_repeats(spark.createDataFrame(rows, schema)).collect())
    run(rows[:50])
    run(rows[50:90])
    shutil.rmtree(f"{ck}/commits")  # the last micro-batch was written but not committed
    os.makedirs(f"{ck}/commits")
    with open(f"{ck}/commits/0", "w") as fh:
        fh.write("v1\n{}")
    run(rows[90:])
    assert kept(out) == want
    other = f"{tmp_dir}/other"
    seed_state(station_state(spark.createDataFrame(rows[:90], schema)), f"{other}/state")
    src = f"{tmp_dir}/src2"
    run(rows[90:], f"{other}/out", f"{other}/state", f"{other}/ck")
    assert kept(f"{other}/out") == [s for s in want if s >= 90]
