"""Archives: range replay, replaced days, compaction, variants, partials, counters."""

from __future__ import annotations

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airtrace.functions.time import SOURCE
from airtrace.operators import curation as C
from airtrace.operators.arrival import poll_order
from airtrace.operators.dedup import drop_repeats
from airtrace.operators.normalize import normalize
from airtrace.paths import dataset_path
from airtrace.plans.edges import day_edges, read_day_edges, state_around, write_day_edges
from airtrace.plans.partials import read_partials, reports_from_partials, update_partials
from airtrace.plans.replay import replay_raw, skip_report
from airtrace.plans.reports import run_reports
from airtrace.schemas import CURATED_SCHEMA
from airtrace.session import scratch_path
from airtrace.sinks.compact import compact_days, drop_generations, pack_bins, read_compacted, read_manifest
from airtrace.sinks.files import compact_curated, write_curated, write_raw, write_raw_ordered, write_raw_variant
from airtrace.sources.curated import read_city, read_curated
from airtrace.sources.raw import read_parquet_archive, read_raw_archive

RECORDS = "seq long, station_key string, timestamp string, day string"


def _records(seed, n=300, days=9):
    """Records whose days mostly go on with the arrival, with late ones between."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        day = max(1, min(days, i * days // n + 1 + rnd.choice([0, 0, 0, 0, -1, -3, 1])))
        rows.append((i, rnd.choice(["a", "a", "b", "c"]), rnd.choice("XY"), f"2031-01-{day:02}"))
    return rows


def _changes(rows):
    last, kept = {}, []
    for seq, key, version, day in sorted(rows):
        if last.get(key) != version:
            kept.append((seq, day))
        last[key] = version
    return kept


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("low,high", [("2031-01-03", "2031-01-05"), ("2031-01-01", "2031-01-02"), ("2031-01-06", None), (None, "2031-01-04")])
def test_edges_of_other_days_make_a_range_exact(spark, seed, low, high):
    rows = _records(seed)
    df = spark.createDataFrame(rows, RECORDS)
    edges = day_edges(df)
    inside = df.where((F.lit(low is None) | (F.col("day") >= (low or ""))) & (F.lit(high is None) | (F.col("day") <= (high or ""))))
    state = state_around(edges, inside, "seq", low, high)
    got = sorted((r["seq"], r["day"]) for r in drop_repeats(inside, initial_state=state).collect())
    assert got == [(s, d) for s, d in _changes(rows) if (low is None or d >= low) and (high is None or d <= high)]
    assert edges.count() < 0.8 * len(rows)


def test_edges_of_what_has_arrived_since_are_appended(spark):
    rows = _records(4)
    df = spark.createDataFrame(rows, RECORDS)
    old, new = df.where("seq < 170"), df.where("seq >= 170")
    first = day_edges(old)
    appended = first.unionByName(day_edges(new, before=first))
    inside = df.where("day BETWEEN '2031-01-04' AND '2031-01-06'")
    for edges in (day_edges(df), appended):
        state = state_around(edges, inside, "seq", "2031-01-04", "2031-01-06")
        got = sorted((r["seq"], r["day"]) for r in drop_repeats(inside, initial_state=state).collect())
        assert got == [(s, d) for s, d in _changes(rows) if "2031-01-04" <= d <= "2031-01-06"]


def _message(idx, aqi, iso, extra=""):
    return f'{{"status":"ok","data":{{{extra}"idx":{idx},"aqi":{aqi},"time":{{"iso":"{iso}"}}}}}}'


def _archive(spark, tmp_dir, kind, seed=5):
    """A raw archive of one of its layouts; returns the order to replay it by."""
    rows = _records(seed, 200)
    raw = spark.createDataFrame(
        [(s, _message({"a": 1, "b": 2, "c": 3}[k], s, f"{d}T{'01' if v == 'X' else '02'}")) for s, k, v, d in rows],
        "seq long, value string")
    if kind == "variant":
        valid = C.drop_invalid(C.parse_messages(raw))
        write_raw_variant(C.with_day(valid, "2031-01-01"), tmp_dir, "port")
    else:
        dated = C.curate(raw, "2031-01-01", keep=("seq", "value"))
        if kind == "text":
            one = dated.coalesce(1).sortWithinPartitions("seq")
            write_raw(one.coalesce(1), tmp_dir, "port")
            return None
        write_raw_ordered(dated, tmp_dir, "port")
    return "seq"


@pytest.mark.parametrize("kind", ["parquet", "variant", "text"])
def test_replay_of_a_range_leaves_what_a_whole_replay_does(spark, tmp_dir, kind):
    order = _archive(spark, tmp_dir, kind)
    replay_raw(spark, tmp_dir, "port", f"{tmp_dir}/all", "2031-01-01", order)
    whole = read_city(spark, f"{tmp_dir}/all", "port").select("aqi", "storage_day").collect()
    with pytest.raises(FileNotFoundError, match="write_day_edges"):
        replay_raw(spark, tmp_dir, "port", f"{tmp_dir}/some", "2031-01-01", order, "2031-01-04", "2031-01-06")
    write_day_edges(spark, tmp_dir, "port", "2031-01-01", order)
    replay_raw(spark, tmp_dir, "port", f"{tmp_dir}/some", "2031-01-01", order, "2031-01-04", "2031-01-06")
    some = read_city(spark, f"{tmp_dir}/some", "port").select("aqi", "storage_day").collect()
    assert sorted(some) == sorted(r for r in whole if "2031-01-04" <= r["storage_day"] <= "2031-01-06") and some
    # the same days replayed into the whole archive change nothing
    replay_raw(spark, tmp_dir, "port", f"{tmp_dir}/all", "2031-01-01", order, "2031-01-04", "2031-01-06")
    assert sorted(read_city(spark, f"{tmp_dir}/all", "port").select("aqi", "storage_day").collect()) == sorted(whole)


@pytest.mark.parametrize("kind", ["parquet", "text"])
def test_snapshots_shorten_what_a_range_reads(spark, tmp_dir, kind):
    from airtrace.plans.edges import _since, newest_snapshot, write_state_snapshot

    order = _archive(spark, tmp_dir, kind, seed=8)
    replay_raw(spark, tmp_dir, "port", f"{tmp_dir}/all", "2031-01-01", order)
    whole = read_city(spark, f"{tmp_dir}/all", "port").select("aqi", "storage_day").collect()
    write_day_edges(spark, tmp_dir, "port", "2031-01-01", order)
    for day in ("2031-01-03", "2031-01-05", "2031-01-08"):  # the second begins with the first
        write_state_snapshot(spark, tmp_dir, "port", day, order)
    for low, high in (("2031-01-06", "2031-01-07"), ("2031-01-05", "2031-01-09"), ("2031-01-01", "2031-01-02")):
        out = f"{tmp_dir}/{low}"
        replay_raw(spark, tmp_dir, "port", out, "2031-01-01", order, low, high)
        got = read_city(spark, out, "port").select("aqi", "storage_day").collect()
        assert sorted(got) == sorted(r for r in whole if low <= r["storage_day"] <= high) and got
    if kind == "parquet":
        begin = newest_snapshot(spark, tmp_dir, "port", (10**9,))
        edges = read_day_edges(spark, tmp_dir, "port")
        later = _since(edges, begin, {"seq": edges.schema["seq"].dataType})
        assert f"GreaterThanOrEqual(seq,{begin[0][0]})" in later._jdf.queryExecution().executedPlan().toString()
        assert later.count() < edges.count() / 2
        assert newest_snapshot(spark, tmp_dir, "port", (-1,)) is None
    with pytest.raises(ValueError, match="no record"):
        write_state_snapshot(spark, tmp_dir, "port", "2040-01-01", order)


def test_replace_empties_days_that_are_gone(spark, tmp_dir):
    def frame(days):
        rows = [tuple([f"{d}T00", i] + [None] * 5 + [{}] + [None] * 5 + [d]) for i, d in enumerate(days)]
        from pyspark.sql.types import StringType, StructField, StructType

        return spark.createDataFrame(rows, StructType([*CURATED_SCHEMA.fields, StructField("day", StringType())]))

    def days():
        return sorted(r["storage_day"] for r in read_city(spark, tmp_dir, "port").collect())

    write_curated(frame(["2031-01-01", "2031-01-02", "2031-01-03", "2031-01-03"]), tmp_dir, "port")
    write_curated(frame(["2031-01-02"]), tmp_dir, "port", "replace", "2031-01-02", "2031-01-03")
    assert days() == ["2031-01-01", "2031-01-02"]
    write_curated(frame(["2031-01-05"]), tmp_dir, "port", "replace")
    assert days() == ["2031-01-05"]
    write_curated(frame([]), tmp_dir, "port", "replace")
    assert days() == []
    # a compaction of some days leaves the others
    write_curated(frame([f"2031-01-{d:02}" for d in range(1, 31)]), tmp_dir, "port")
    compact_curated(read_city(spark, tmp_dir, "port"), f"{tmp_dir}/compact")
    compact_curated(read_city(spark, tmp_dir, "port", "2031-01-04", "2031-01-05"), f"{tmp_dir}/compact")
    assert read_curated(spark, f"{tmp_dir}/compact", fmt="parquet").count() == 30


def test_text_archives_of_unsortable_names_are_refused(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/day=2031-01-01")
    for name in ("part-99999.txt", "part-100000.txt"):
        with open(f"{tmp_dir}/day=2031-01-01/{name}", "w") as fh:
            fh.write(_message(1, 2, "2031-01-01T00") + "\n")
    with pytest.raises(ValueError, match="lengths"):
        read_raw_archive(spark, tmp_dir)
    assert read_raw_archive(spark, tmp_dir, in_order=True).count() == 2


def test_flat_scan_plans_only_the_days_asked_for(spark, tmp_dir):
    os.makedirs(tmp_dir)
    for day in range(1, 10):
        with open(f"{tmp_dir}/2031-01-{day:02}.jsonl", "w") as fh:
            fh.write(f'{{"timestamp":"t","aqi":{day}}}\n' * day)
    got = read_curated(spark, tmp_dir, "2031-01-03", "2031-01-04")
    assert sorted({f.rsplit("/", 1)[-1] for f in got.inputFiles()}) == ["2031-01-03.jsonl", "2031-01-04.jsonl"]
    assert "InMemoryFileIndex(2 paths)" in got._jdf.queryExecution().toString()
    assert sorted((r["storage_day"], r["aqi"]) for r in got.collect()) == [("2031-01-03", 3)] * 3 + [("2031-01-04", 4)] * 4
    assert read_curated(spark, tmp_dir, "2032-01-01").collect() == []
    assert read_curated(spark, tmp_dir).count() == 45


def test_variants_are_parsed_once_and_keep_number_types(spark, tmp_dir):
    numbers = ["16", "16.0", '"16"', "1e1", "true", "null", "99999999999"]
    raw = spark.createDataFrame(
        [(i, _message(i % 3, n, "2031-01-01T00", '"new":{"x":[1,2]},"aqi":-5,')) for i, n in enumerate(numbers * 20)]
        + [(999, "{broken")], "seq long, value string")
    parsed = C.drop_invalid(C.parse_messages(raw))
    write_raw_variant(C.with_day(parsed, "2031-01-01"), tmp_dir, "port")
    archive = read_parquet_archive(spark, dataset_path(tmp_dir, "port", "raw"))
    again = C.project_curated(archive, keep=("seq", "day"))
    assert "parse_json" not in again._jdf.queryExecution().toString()
    want = C.curate(raw, "2031-01-01")
    columns = [c for c in want.columns if c != "pollutants"]
    assert sorted(map(str, again.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    assert {r[0] for r in archive.selectExpr("try_variant_get(payload, '$.data.new.x[1]', 'int')").collect()} == {2}


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1), st.integers(1, 60), max_size=30), st.integers(1, 50))
def test_bins_hold_every_file_once(sizes, target):
    bins = pack_bins(sizes, target)
    assert sorted(n for b in bins for n in b) == sorted(sizes)
    assert all(sum(sizes[n] for n in b) <= target or len(b) == 1 for b in bins)
    half = [sum(sizes[n] for n in b) for b in bins]
    assert sum(2 * h <= target for h in half) <= 1  # first fit leaves one bin at most half empty


def test_compaction_of_a_growing_stream(spark, tmp_dir):
    from airtrace.streaming import run_available

    def arrive(part):
        rows = [(f"2031-01-0{1 + i % 3}T00", 1000 * part + i, f"2031-01-0{1 + i % 3}") for i in range(60)]
        (spark.createDataFrame(rows, "timestamp string, aqi int, day string").repartition(6)
         .write.mode("append").parquet(f"{tmp_dir}/source"))
        stream = spark.readStream.schema("timestamp string, aqi int, day string").parquet(f"{tmp_dir}/source")
        run_available(stream, "json", f"{tmp_dir}/archive", f"{tmp_dir}/ck", partition_by=("day",))

    def read(**days):
        return read_compacted(spark, f"{tmp_dir}/archive", f"{tmp_dir}/compact", CURATED_SCHEMA, **days)

    def values(df):
        return sorted(r["aqi"] for r in df.collect())

    arrive(0)
    everything = [i for i in range(60)]
    assert values(read()) == everything
    packed = compact_days(spark, f"{tmp_dir}/archive", f"{tmp_dir}/compact", CURATED_SCHEMA, day_to="2031-01-02")
    assert packed >= 4
    begun = read()  # a reader that began before the next compaction
    assert values(begun) == everything
    files = begun.where("day = '2031-01-01'").inputFiles()
    arrive(1)
    everything += [1000 + i for i in range(60)]
    assert values(read()) == everything
    compact_days(spark, f"{tmp_dir}/archive", f"{tmp_dir}/compact", CURATED_SCHEMA)
    assert values(begun) == everything[:60] and files
    assert values(read()) == everything
    assert values(read(day_from="2031-01-02", day_to="2031-01-02")) == [v for v in everything if v % 1000 % 3 == 1]
    assert read_manifest(spark, f"{tmp_dir}/compact")["number"] == 2
    # small files: one bin a day and generation
    by_day = {}
    for f in read().inputFiles():
        by_day.setdefault(f.split("day=")[1][:10], []).append(f)
    assert {len(v) for v in by_day.values()} <= {1, 2}
    assert compact_days(spark, f"{tmp_dir}/archive", f"{tmp_dir}/compact", CURATED_SCHEMA) == 0
    assert drop_generations(spark, f"{tmp_dir}/compact") == 0  # the newest manifest names both
    assert values(read()) == everything
    # two writers: the second to finish is refused
    from airtrace.sinks.compact import _write_manifest

    with pytest.raises(RuntimeError, match="another compaction"):
        _write_manifest(spark, f"{tmp_dir}/compact", {"number": 2, "days": {}})


def _observations(spark, seed, n=600, days=6):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        day = rnd.randint(1, days)
        some = rnd.random()
        rows.append((
            f"2031-01-{day:02}T{rnd.randint(0, 23):02}:00:00+00:00", i, f"s{i}", 1.0, 2.0,
            None if some < 0.1 else rnd.randint(0, 400), rnd.choice([None, "pm10", "o3"]),
            rnd.choice([None, {}, {"pm10": rnd.random()}, {"o3": None, "pm10": rnd.random()}]),
            1e3 + rnd.random() if some < 0.7 else None, rnd.random() if some > 0.3 else None, 1.0, None, None,
            f"2031-01-{day:02}"))
    from pyspark.sql.types import StringType, StructField, StructType

    return spark.createDataFrame(rows, StructType([*CURATED_SCHEMA.fields, StructField("day", StringType())]))


def _tables(reports):
    def value(v):
        return float(f"{v:.9g}") if isinstance(v, float) else v

    return {
        name: [tuple(value(v) for v in r) for r in df.collect()]
        for name, df in reports.items() if name != "normalized"
    }


def test_partials_equal_a_full_scan_day_by_day(spark, tmp_dir):
    first, second = _observations(spark, 1), _observations(spark, 2, days=8)
    write_curated(first, tmp_dir, "port")
    update_partials(spark, tmp_dir, "port", tz=SOURCE)
    write_curated(second.where("day >= '2031-01-07'"), tmp_dir, "port")
    update_partials(spark, tmp_dir, "port", day_from="2031-01-07", tz=SOURCE)
    write_curated(second.where("day = '2031-01-03'"), tmp_dir, "port", "replace", "2031-01-03", "2031-01-04")
    update_partials(spark, tmp_dir, "port", "2031-01-03", "2031-01-04", tz=SOURCE)
    got = _tables(reports_from_partials(read_partials(spark, tmp_dir, "port")))
    curated = read_city(spark, tmp_dir, "port")
    want = _tables(run_reports(curated.drop("storage_day"), tz=SOURCE))
    assert set(got) == set(want) and "2031-01-04" not in [r[0] for r in want["daily_aqi"]]
    for name in want:
        assert sorted(got[name], key=repr) == sorted(want[name], key=repr), name
    assert [len(got[n]) for n in ("daily_aqi", "weather_correlations")] == [7, 1]


def test_partials_of_one_day_scan_that_day(spark, tmp_dir, monkeypatch):
    from airtrace.plans import partials

    write_curated(_observations(spark, 3), tmp_dir, "port")
    update_partials(spark, tmp_dir, "port", tz=SOURCE)
    seen = []
    plain = partials.day_partials

    def spy(normalized):
        seen.append(normalized._jdf.queryExecution().executedPlan().toString())
        return plain(normalized)

    monkeypatch.setattr(partials, "day_partials", spy)
    update_partials(spark, tmp_dir, "port", "2031-01-02", "2031-01-02", tz=SOURCE)
    assert "PartitionFilters: [isnotnull(day" in seen[0] and "2031-01-02" in seen[0]


def test_merged_moments_do_not_cancel(spark):
    """Deviations of a millionth around a billion survive the merge of the days."""
    rnd = random.Random(9)
    rows = [(f"d{i % 5}", i, 1e9 + rnd.random() * 1e-3) for i in range(500)]
    df = spark.createDataFrame(rows, "storage_day string, aqi int, temperature double").selectExpr(
        "*", "temperature AS humidity", "CAST(NULL AS DOUBLE) AS wind", "0 AS hour", "storage_day AS day",
        "'x' AS dominant_pollutant", "CAST(NULL AS map<string,double>) AS pollutants")
    from airtrace.plans.partials import day_partials

    (row,) = reports_from_partials(day_partials(df))["weather_correlations"].collect()
    import numpy as np

    want = np.corrcoef([r[1] for r in rows], [r[2] - 1e9 for r in rows])[0, 1]
    assert abs(row["aqi_temperature_corr"] - want) < 1e-4 and row["aqi_wind_corr"] is None
    (none,) = reports_from_partials(day_partials(df.limit(0)))["weather_correlations"].collect()
    assert list(none) == [None] * 3


def test_order_of_polls_worked_off_by_day(spark):
    rnd = random.Random(6)
    rows = [(i // 20, i, f"d{rnd.randint(1, 4)}", rnd.choice("ab"), rnd.choice("XY")) for i in range(300)]
    df = spark.createDataFrame(rows, "batch int, seq long, day string, station_key string, timestamp string")
    ordered, order = poll_order(df)
    got = sorted(r["seq"] for r in drop_repeats(ordered, order=order).collect())
    last, want, plain = {}, [], {}
    for poll in range(15):
        messages = [r for r in rows if r[0] == poll]
        groups = {}  # as a consumer groups a poll: days in the order of their first message
        for r in messages:
            groups.setdefault(r[2], []).append(r)
        for r in (r for g in groups.values() for r in g):
            if last.get(r[3]) != r[4]:
                want.append(r[1])
            last[r[3]] = r[4]
    assert got == sorted(want)
    assert got != sorted(r["seq"] for r in drop_repeats(df).collect()) and plain == {}


def test_skip_report_counts_in_passing(spark):
    rows = [(0, "{"), (1, _message(1, 1, "A" * 10)), (2, _message(1, 1, "A" * 10)), (3, '{"data":{"idx":1}}'),
            (4, _message(2, 1, "B" * 10)), (5, "nul")]
    got = skip_report(spark.createDataFrame(rows, "seq long, value string"), "2031-01-01").collect()
    assert [tuple(r) for r in got] == [(2, 1, 1)]
    empty = skip_report(spark.createDataFrame([], "seq long, value string"), "2031-01-01").collect()
    assert [tuple(r) for r in empty] == [(0, 0, 0)]


def test_listener_writes_counters_and_ends_a_bounded_run(spark, tmp_dir, monkeypatch):
    from airtrace.streaming import CounterListener, read_counters
    from airtrace.streaming.counters import day_counts

    schema = "seq long, day string"
    for at in range(6):
        (spark.createDataFrame([(10 * at + i, f"d{i % 2}") for i in range(10)], schema).coalesce(1)
         .write.mode("append").parquet(f"{tmp_dir}/src"))
    listener = CounterListener(spark, f"{tmp_dir}/counters")
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src").observe(
            "seen", F.count(F.lit(1)).alias("messages"), day_counts().alias("by_day"))
        query = (stream.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
                 .option("checkpointLocation", f"{tmp_dir}/ck").trigger(processingTime="100 milliseconds").start())
        assert 3 <= listener.run_batches(query, 3, timeout=120)
        assert not query.isActive
        rows = read_counters(spark, f"{tmp_dir}/counters").where("batch_id < 3").collect()
        got = sorted((r["batch_id"], r["counter"], r["key"] or "", r["value"]) for r in rows)
        assert got == sorted(x for b in range(3) for x in [
            (b, "messages", "", 10), (b, "by_day", "d0", 5), (b, "by_day", "d1", 5)])
        idle = (stream.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
                .option("checkpointLocation", f"{tmp_dir}/ck").trigger(processingTime="100 milliseconds").start())
        with pytest.raises(TimeoutError):
            listener.run_batches(idle, 1000, timeout=3)
        assert not idle.isActive
        # a run that the listener has not been told of is an error, not an endless wait
        from airtrace.streaming import counters

        monkeypatch.setattr(counters, "REPORT_SECONDS", 2.0)
        with pytest.raises(RuntimeError, match="not reported"):
            CounterListener(spark, f"{tmp_dir}/other").run_batches(query, 5)
    finally:
        spark.streams.removeListener(listener)


def test_scratch_of_a_block_can_be_deleted(spark):
    from airtrace.paths import file_system
    from airtrace.session import delete_scratch, scratch_made

    outside = scratch_path(spark, "outside")
    with scratch_made() as made:
        inside = scratch_path(spark, "inside")
    spark.range(3).write.parquet(inside)
    spark.range(3).write.parquet(outside)
    assert made == [inside]
    delete_scratch(spark, made)
    assert [file_system(spark, p)[0].exists(file_system(spark, p)[1]) for p in (inside, outside)] == [False, True]
    delete_scratch(spark, [outside])


def test_edges_folder_is_named_when_missing(spark, tmp_dir):
    with pytest.raises(FileNotFoundError, match="edges"):
        read_day_edges(spark, tmp_dir, "nowhere")


def _payload_events(spark, path):
    spark.range(40).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-03 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id AS int)) AS ts",
        "id % 3 AS user_id", "'view' AS event_type", "1.5D * id AS value", "'{\"k\":1}' AS props",
    ).write.parquet(f"{path}/events.parquet")


def test_variant_archive_parses_each_message_once(spark, tmp_dir, monkeypatch):
    from airtrace.plans import archive_queries

    written = []
    monkeypatch.setattr(archive_queries, "write_raw_variant", lambda df, *args: (
        written.append(df._jdf.queryExecution().executedPlan().toString()), write_raw_variant(df, *args)))
    _payload_events(spark, tmp_dir)
    assert archive_queries.q_variant_archive(spark, tmp_dir).count() == 36
    assert [plan.count("parseJson") for plan in written] == [1]


def test_replayed_archive_is_built_from_one_parse(spark, tmp_dir, monkeypatch):
    """Range partitions read their input twice, so both deliveries come from written lines."""
    from airtrace.plans import queries

    built = []
    kind = type(spark.range(1))
    ranged = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda df, *args: (
        built.append(df._jdf.queryExecution().executedPlan().toString()), ranged(df, *args))[1])
    _payload_events(spark, tmp_dir)
    out = queries.q_replay_archive(spark, tmp_dir)
    assert [plan.count("parseJson") for plan in built] == [0]
    want = [i for i in range(40) if i % 10 and i % 7]
    assert sorted(r.timestamp for r in out.collect()) == [f"2024-01-03T00:{i:02d}:00+00:00" for i in want]
