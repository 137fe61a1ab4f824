"""Driver queries over archives, partial results and running streams.

As :mod:`airtrace.plans.queries`: every query reads the whole ``events`` table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from airtrace.functions.time import SOURCE
from airtrace.operators import curation as C
from airtrace.operators.arrival import poll_order
from airtrace.operators.dedup import drop_repeats
from airtrace.paths import dataset_path
from airtrace.plans.edges import write_day_edges, write_state_snapshot
from airtrace.plans.partials import read_partials, reports_from_partials, update_partials
from airtrace.plans.queries import (
    _CURATED_SCALARS,
    _LATE,
    _LATE_STATIONS,
    _OBS,
    _RAW,
    ORACLES,
    ROUND,
    QueryFn,
    _late_messages,
    _observations,
)
from airtrace.plans.replay import replay_raw
from airtrace.schemas import CORRELATED_METRICS, CURATED_SCHEMA
from airtrace.session import scratch_path
from airtrace.sinks.compact import compact_days, read_compacted
from airtrace.sinks.files import curated_records, write_curated, write_raw_ordered, write_raw_variant
from airtrace.sources.curated import read_city
from airtrace.sources.raw import read_parquet_archive
from airtrace.sources.testdata import FALLBACK_DAY, load_table, raw_payloads
from airtrace.streaming import (
    CounterListener,
    dedup_stream,
    read_counters,
    read_stream_state,
    run_available,
    start_ingest,
)


def q_stream_dedup_seeded(spark, sf_dir):
    """A new checkpoint seeded with the state of another one.

    A station holds a third of all rows.  The first half of the month is
    processed with two state partitions; the state is read from that
    checkpoint and seeds a query with five, which processes the rest.
    """
    obs = C.with_record_day(_observations(spark, sf_dir), FALLBACK_DAY).withColumn(
        "station_key", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("station_key")))
    base = scratch_path(spark, "stream-seeded")
    first = F.coalesce(F.col("day") <= "2024-01-15", F.lit(False))
    state = None
    for name, half, partitions in (("a", first, 2), ("b", ~first, 5)):
        obs.where(half).write.parquet(f"{base}/{name}/source")
        stream = spark.readStream.schema(obs.schema).parquet(f"{base}/{name}/source")
        kept = dedup_stream(stream, version="dominant_pollutant", initial_state=state)
        run_available(kept, "parquet", f"{base}/{name}/sink", f"{base}/{name}/checkpoint", partitions=partitions)
        state = read_stream_state(spark, f"{base}/{name}/checkpoint", version="dominant_pollutant")
    kept = [spark.read.schema(obs.schema).parquet(f"{base}/{name}/sink") for name in "ab"]
    return kept[0].unionByName(kept[1]).select("seq", "station_key", "dominant_pollutant", "aqi")


def q_replay_range(spark, sf_dir):
    """Days 10 to 20 of an archive replayed alone, late rows included."""
    base = scratch_path(spark, "replay-range")
    late = _late_messages(load_table(spark, sf_dir, "events"))
    write_raw_ordered(C.curate(late, processing_date=FALLBACK_DAY, keep=("seq", "value")), base, "late-city")
    write_day_edges(spark, base, "late-city", FALLBACK_DAY, order="seq")
    write_state_snapshot(spark, base, "late-city", "2024-01-05", order="seq")
    replay_raw(spark, base, "late-city", base, FALLBACK_DAY, "seq", "2024-01-10", "2024-01-20")
    return read_city(spark, base, "late-city").select(
        F.col("station_id").cast("string").alias("station_key"), "timestamp", "aqi", "storage_day")


def q_variant_archive(spark, sf_dir):
    """Curated again from an archive of parsed payloads, which parses nothing."""
    base = scratch_path(spark, "variant-archive")
    raw = raw_payloads(load_table(spark, sf_dir, "events"))
    write_raw_variant(C.with_day(C.valid_messages(raw), FALLBACK_DAY), base, "city")
    archive = read_parquet_archive(spark, dataset_path(base, "city", "raw"))
    cur = C.project_curated(archive, keep=("seq", "day"))
    return cur.select(*_CURATED_SCALARS, F.size("pollutants").alias("n_pollutants"), "day")


def q_repeated_keys(spark, sf_dir):
    """Messages that repeat a key, through the two reads of a hot station."""
    raw = load_table(spark, sf_dir, "events").selectExpr(
        "event_id AS seq",
        "concat('{\"data\":{', CASE WHEN event_id % 2 = 0 THEN '\"aqi\":-1,' ELSE '' END, '\"aqi\":', "
        "CAST(floor(value) AS INT), ',\"idx\":', user_id % 3, ',\"time\":{\"iso\":\"', event_type, "
        "'-------------\"}}}') AS value")
    kept = drop_repeats(C.curate(raw, processing_date=FALLBACK_DAY), slice_size=1000)
    return kept.select("seq", "station_key", "aqi")


def q_daily_partials(spark, sf_dir):
    """A1-A8 merged from daily partials, after days were added and one was rewritten."""
    root = scratch_path(spark, "partials")
    obs = C.with_record_day(_observations(spark, sf_dir), FALLBACK_DAY)
    early = F.coalesce(F.col("day") <= "2024-01-20", F.lit(False))
    write_curated(obs.where(early).where("seq % 5 <> 0 OR day <> '2024-01-07'"), root, "city")
    update_partials(spark, root, "city", tz=SOURCE)
    write_curated(obs.where(~early | (F.col("day") == "2024-01-07")), root, "city", mode="append")
    write_curated(obs.where("day = '2024-01-07'"), root, "city", "replace", "2024-01-07", "2024-01-07")
    update_partials(spark, root, "city", "2024-01-07", "2024-01-07", tz=SOURCE)
    update_partials(spark, root, "city", day_from="2024-01-21", tz=SOURCE)
    reports = reports_from_partials(read_partials(spark, root, "city"))
    none = F.lit(None)
    entries = ", ".join(f"'{m}', aqi_{m}_corr" for m in CORRELATED_METRICS)
    parts = [
        reports["hourly_aqi"].select(F.lit("hourly_aqi"), F.col("hour").cast("string"), "avg_aqi", none.cast("long")),
        reports["daily_aqi"].select(F.lit("daily_aqi"), "day", "avg_aqi", none.cast("long")),
        reports["aqi_category_distribution"].select(
            F.lit("aqi_category_distribution"), "aqi_category", none.cast("double"), "count"),
        reports["dominant_pollutants"].select(
            F.lit("dominant_pollutants"), "dominant_pollutant", none.cast("double"), "count"),
        reports["average_pollutants"].select(
            F.lit("average_pollutants"), "pollutant", F.round("avg_value", ROUND), "measurement_count"),
        reports["weather_correlations"].selectExpr(f"stack({len(CORRELATED_METRICS)}, {entries}) AS (key, value)").select(
            F.lit("weather_correlations"), "key", F.round("value", ROUND), none.cast("long")),
    ]
    out = parts[0].toDF("report", "key", "value", "n")
    for part in parts[1:]:
        out = out.unionByName(part.toDF("report", "key", "value", "n"))
    return out


def q_compacted_archive(spark, sf_dir):
    """K2, K5: a streamed archive compacted day by day while it grows, read whole."""
    base = scratch_path(spark, "compacted")
    obs = C.with_record_day(_observations(spark, sf_dir), FALLBACK_DAY)
    rows = curated_records(obs)
    for part in range(3):
        rows.where(f"coalesce(station_id, 0) % 3 = {part}").write.mode("append").parquet(f"{base}/source")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/source")
        run_available(stream, "json", f"{base}/archive", f"{base}/checkpoint", partition_by=("day",), ignoreNullFields="false")
        if part < 2:  # what arrives last stays uncompacted
            compact_days(spark, f"{base}/archive", f"{base}/compacted", CURATED_SCHEMA, day_from="2024-01-05")
    back = read_compacted(spark, f"{base}/archive", f"{base}/compacted", CURATED_SCHEMA)
    return back.groupBy("day").agg(
        F.count(F.lit(1)).alias("records"), F.sum("aqi").cast("long").alias("sum_aqi"),
        F.countDistinct("station_id").alias("stations"))


_POLL = "event_id % 97"
_IN_POLL = "(event_id % 97) * 4294967296 + (event_id * 7919) % 2147483647"


def q_dedup_poll_order(spark, sf_dir):
    """D1 in the order of polls that are worked off day by day; days interleave in a poll."""
    events = load_table(spark, sf_dir, "events").selectExpr(
        f"{_POLL} AS batch", f"{_IN_POLL} AS seq", "substring(CAST(ts AS STRING), 1, 10) AS day",
        f"CAST(user_id % {_LATE_STATIONS} AS STRING) AS station_key", "event_type AS timestamp")
    ordered, order = poll_order(events)
    return drop_repeats(ordered, order=order).select("batch", "seq", "station_key", "day")


def q_stream_counters(spark, sf_dir):
    """Counters of each micro-batch of the running ingest, written by a listener."""
    base = scratch_path(spark, "stream-counters")
    events = load_table(spark, sf_dir, "events")
    listener = CounterListener(spark, f"{base}/counters")
    spark.streams.addListener(listener)
    first = F.coalesce(F.col("ts") < "2024-01-16", F.lit(False))
    try:
        for half in (first, ~first):
            raw = raw_payloads(events.where(half))
            raw.write.mode("append").parquet(f"{base}/source")
            stream = spark.readStream.schema(raw.schema).parquet(f"{base}/source")
            for query in start_ingest(stream, f"{base}/archive", "city", f"{base}/checkpoint", FALLBACK_DAY, partitions=4):
                listener.run_batches(query, 1 << 30)  # until the query ends by itself
    finally:
        spark.streams.removeListener(listener)
    counters = read_counters(spark, f"{base}/counters")
    return counters.select("batch_id", "counter", "key", "value")


ARCHIVE_QUERIES: dict[str, QueryFn] = {
    "stream_dedup_seeded": q_stream_dedup_seeded,
    "replay_range": q_replay_range,
    "variant_archive": q_variant_archive,
    "repeated_keys": q_repeated_keys,
    "daily_partials": q_daily_partials,
    "compacted_archive": q_compacted_archive,
    "dedup_poll_order": q_dedup_poll_order,
    "stream_counters": q_stream_counters,
}

_COUNTED = """
  SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS batch_id, * FROM events"""

ARCHIVE_ORACLES: dict[str, str] = {
    "stream_dedup_seeded": ORACLES["stream_dedup_sliced"],
    "replay_range": _LATE
    + """SELECT station_key, "timestamp", aqi, day AS storage_day FROM kept
    WHERE day BETWEEN '2024-01-10' AND '2024-01-20'""",
    "variant_archive": ORACLES["curate_raw"],
    "repeated_keys": """SELECT seq, station_key, aqi FROM (
      SELECT event_id AS seq, CAST(user_id % 3 AS VARCHAR) AS station_key, CAST(floor(value) AS INTEGER) AS aqi,
             event_type, lag(event_type) OVER (PARTITION BY user_id % 3 ORDER BY event_id) AS prev
      FROM events) WHERE prev IS DISTINCT FROM event_type""",
    "daily_partials": ORACLES["report_bundle"],
    "compacted_archive": _OBS
    + """SELECT day, count(*) AS records, CAST(sum(aqi) AS BIGINT) AS sum_aqi,
           count(DISTINCT station_id) AS stations FROM obs GROUP BY day""",
    "dedup_poll_order": f"""WITH e AS (
      SELECT {_POLL} AS batch, {_IN_POLL} AS seq, strftime(ts, '%Y-%m-%d') AS day,
             CAST(user_id % {_LATE_STATIONS} AS VARCHAR) AS station_key, event_type FROM events),
    o AS (SELECT *, min(seq) OVER (PARTITION BY batch, day) AS day_first FROM e)
    SELECT batch, seq, station_key, day FROM (
      SELECT *, lag(event_type) OVER (PARTITION BY station_key ORDER BY batch, day_first, seq) AS prev FROM o)
    WHERE prev IS DISTINCT FROM event_type""",
    "stream_counters": _RAW.rstrip()
    + f""", e AS ({_COUNTED}),
    c AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS batch_id, * FROM cur),
    k AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS batch_id FROM (
      SELECT *, lag("timestamp") OVER (PARTITION BY station_key ORDER BY batch_id, seq) AS prev
      FROM c WHERE "timestamp" IS NOT NULL) WHERE prev IS DISTINCT FROM "timestamp"),
    x AS (
      SELECT batch_id, 'messages' AS counter, NULL AS key, count(*) AS value FROM e GROUP BY 1
      UNION ALL SELECT batch_id, 'invalid_json', NULL, count(*) FILTER (WHERE event_id % 10 = 0) FROM e GROUP BY 1
      UNION ALL SELECT batch_id, 'raw_messages', day, count(*) FROM c GROUP BY 1, 3
      UNION ALL SELECT batch_id, 'incomplete_keys', NULL, count(*) FILTER (WHERE "timestamp" IS NULL) FROM c GROUP BY 1
      UNION ALL SELECT batch_id, 'complete_keys', NULL, count(*) FILTER (WHERE "timestamp" IS NOT NULL) FROM c GROUP BY 1
      UNION ALL SELECT batch_id, 'kept', NULL, count(*) FROM k GROUP BY 1)
    SELECT CAST(batch_id AS BIGINT) AS batch_id, counter, key, value FROM x""",
}
