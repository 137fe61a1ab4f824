"""Driver queries over the test tables and their SQL oracles.

Every query reads the whole ``events`` table (through the adapter of
:mod:`airtrace.sources.testdata`) and runs the library operators on it.  The
oracle of each query is an independent DuckDB formulation over the raw
``events`` table.  Floating averages and coefficients are rounded to six
places on both sides so that summation order cannot change the result;
normalization uses the ``"source"`` clock, so no result depends on the
session time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrace.functions.time import SOURCE
from airtrace.operators import curation as C
from airtrace.operators import reports as R
from airtrace.operators.dedup import drop_repeats, station_state
from airtrace.operators.normalize import normalize
from airtrace.plans.replay import curate_archive, curate_parquet_archive, replay_raw, skip_report
from airtrace.plans.reports import materialize, report_table, run_city_reports, summary_table
from airtrace.session import scratch_path
from airtrace.paths import dataset_path
from airtrace.sinks.files import one_line, write_curated, write_raw, write_raw_ordered
from airtrace.sources.curated import read_city
from airtrace.sources.raw import read_parquet_archive, read_raw_archive
from airtrace.sources.testdata import FALLBACK_DAY, load_table, observations, raw_payloads
from airtrace.streaming.dedup_state import dedup_stream
from airtrace.streaming.ingest import run_available, start_ingest
from airtrace.streaming.sliced import read_sliced, seed_state, start_sliced_dedup

QueryFn = Callable[[SparkSession, str], DataFrame]

ROUND = 6


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(load_table(spark, sf_dir, "events"))


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(_observations(spark, sf_dir), tz=SOURCE)


def _curated_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_payloads(load_table(spark, sf_dir, "events"))
    return C.curate(raw, processing_date=FALLBACK_DAY, keep=("seq",))


def _cores(spark: SparkSession) -> int:
    """State partitions for the streaming test queries: the session's cores."""
    return spark.sparkContext.defaultParallelism


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(
        *[F.round(c, ROUND).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


# --- reports ----------------------------------------------------------------

def q_hourly_aqi(spark, sf_dir):
    return R.hourly_aqi(_normalized(spark, sf_dir))


def q_daily_aqi(spark, sf_dir):
    return R.daily_aqi(_normalized(spark, sf_dir))


def q_aqi_category_distribution(spark, sf_dir):
    return R.aqi_category_distribution(_normalized(spark, sf_dir))


def q_average_pollutants(spark, sf_dir):
    return _rounded(R.average_pollutants(_normalized(spark, sf_dir)), "avg_value")


def q_dominant_pollutants(spark, sf_dir):
    return R.dominant_pollutants(_normalized(spark, sf_dir))


def q_weather_correlations(spark, sf_dir):
    return _rounded(
        R.weather_correlations(_normalized(spark, sf_dir)),
        "aqi_temperature_corr",
        "aqi_humidity_corr",
        "aqi_wind_corr",
    )


# --- de-duplication -----------------------------------------------------------

def q_dedup_consecutive(spark, sf_dir):
    """D1 batch; the dominant pollutant plays the station timestamp."""
    kept = drop_repeats(_observations(spark, sf_dir), version="dominant_pollutant")
    return kept.select("seq", "station_key", "dominant_pollutant", "aqi")


def q_station_state(spark, sf_dir):
    """Each station's last accepted timestamp, by arrival."""
    return station_state(_observations(spark, sf_dir))


def q_stream_dedup(spark, sf_dir):
    """D1 stream form, W1-W5: two ``availableNow`` runs on one checkpoint.

    The observations are written as files in two halves; each half is
    processed by a run that restarts from the same checkpoint, so the second
    half only sees the first through the state store.  The sink is read back
    and must equal the batch ``lag`` form.
    """
    obs = C.with_record_day(_observations(spark, sf_dir), FALLBACK_DAY)
    base = scratch_path(spark, "stream-dedup")
    source_dir, sink_dir = f"{base}/source", f"{base}/sink"
    schema = obs.schema
    for half in (F.col("day") <= "2024-01-15", F.col("day") > "2024-01-15"):
        obs.where(half).write.mode("append").parquet(source_dir)
        stream = spark.readStream.schema(schema).parquet(source_dir)
        kept = dedup_stream(stream, version="dominant_pollutant")
        run_available(kept, "parquet", sink_dir, f"{base}/checkpoint",
                      partitions=_cores(spark))
    out = spark.read.schema(schema).parquet(sink_dir)
    return out.select("seq", "station_key", "dominant_pollutant", "aqi")


def q_stream_dedup_sliced(spark, sf_dir):
    """The micro-batch form with sliced change detection.

    As ``stream_dedup``, with one station holding a third of all rows, and
    a checkpoint that begins with the state of the first half (the second
    half is a new query, seeded).
    """
    base = scratch_path(spark, "stream-sliced")
    obs = C.with_record_day(_observations(spark, sf_dir), FALLBACK_DAY).withColumn(
        "station_key", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("station_key")))
    first = F.col("day") <= "2024-01-15"
    for name, half in (("a", first), ("b", ~first)):
        obs.where(half).write.parquet(f"{base}/{name}/source")
        if name == "b":
            done = spark.read.schema(obs.schema).parquet(f"{base}/a/source")
            seed_state(station_state(done, version="dominant_pollutant"), f"{base}/b/state")
        stream = spark.readStream.schema(obs.schema).parquet(f"{base}/{name}/source")
        query = start_sliced_dedup(stream, f"{base}/{name}/out", f"{base}/{name}/state",
                                   f"{base}/{name}/checkpoint", version="dominant_pollutant")
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    kept = [read_sliced(spark, f"{base}/{name}/out", obs.schema) for name in "ab"]
    return kept[0].unionByName(kept[1]).select("seq", "station_key", "dominant_pollutant", "aqi")


# --- curation from raw text ----------------------------------------------------

_CURATED_SCALARS = (
    "seq", "timestamp", "station_id", "station_key", "station_name", "latitude",
    "longitude", "aqi", "dominant_pollutant", "temperature", "humidity", "wind",
    "pressure", "dew",
)


def q_curate_raw(spark, sf_dir):
    """Raw payload text -> typed curated records with storage day."""
    cur = _curated_raw(spark, sf_dir)
    return cur.select(*_CURATED_SCALARS, F.size("pollutants").alias("n_pollutants"), "day")


def q_pollutants_long(spark, sf_dir):
    """C5 + explode: every pollutant reading kept from the raw text."""
    cur = _curated_raw(spark, sf_dir)
    return cur.select("seq", F.explode("pollutants").alias("pollutant", "value"))


def q_drop_malformed(spark, sf_dir):
    """valid and invalid message counts."""
    raw = raw_payloads(load_table(spark, sf_dir, "events"))
    return C.validity_counts(raw)


def q_raw_per_day(spark, sf_dir):
    """Valid messages per storage day, with the fallback day."""
    return C.messages_per_day(_curated_raw(spark, sf_dir))


def q_incomplete_keys(spark, sf_dir):
    """records that carry a complete de-duplication key."""
    cur = C.complete_keys(_curated_raw(spark, sf_dir))
    return cur.select("seq", "station_key", "timestamp")


def q_normalize_observations(spark, sf_dir):
    """N1-N5, F4 over records curated from raw text (source clock)."""
    norm = normalize(_curated_raw(spark, sf_dir), tz=SOURCE)
    return norm.select(
        "seq", "station_id", "timestamp", "aqi", "dominant_pollutant", "temperature",
        "humidity", "wind", F.unix_seconds("event_timestamp").alias("event_epoch"),
        "day", "hour", F.size("pollutants").alias("n_pollutants"),
    )


def q_report_summary(spark, sf_dir):
    """L3-L6 over the report bundle of the observations."""
    norm = _normalized(spark, sf_dir)
    bundle = {
        "hourly_aqi": R.hourly_aqi(norm),
        "daily_aqi": R.daily_aqi(norm),
        "aqi_category_distribution": R.aqi_category_distribution(norm),
        "dominant_pollutants": R.dominant_pollutants(norm),
        "weather_correlations": R.weather_correlations(norm),
    }
    return _rounded(R.summary(bundle), "strongest_corr")


def q_report_summary_one_scan(spark, sf_dir):
    """L3-L6 from one scan: the same summary as ``report_summary``."""
    return _rounded(summary_table(_normalized(spark, sf_dir)), "strongest_corr")


def q_report_bundle(spark, sf_dir):
    """A8 in one pass: all six reports as one long table, one scan."""
    return report_table(_normalized(spark, sf_dir), digits=ROUND)


def q_observation_preview(spark, sf_dir):
    """L2: five rows of the main columns, first by arrival."""
    return R.preview(_normalized(spark, sf_dir), 5, order="seq")


def q_day_pruned_scan(spark, sf_dir):
    """Write day partitions, read a day range back (pruned)."""
    obs = C.with_record_day(_observations(spark, sf_dir), FALLBACK_DAY)
    root = scratch_path(spark, "archive")
    write_curated(obs, root, "test-city")
    back = read_city(spark, root, "test-city", day_from="2024-01-10", day_to="2024-01-20")
    return back.select(
        "timestamp", "station_id", "station_name", "latitude", "longitude", "aqi",
        "dominant_pollutant", "temperature", "humidity", "wind", "pressure", "dew",
        F.size("pollutants").alias("n_pollutants"), "storage_day",
    )


def q_replay_archive(spark, sf_dir):
    """S4, K1, C1-C7, D1 (archive form): replay a raw archive with repeats.

    Every message is archived twice in a row, as an at-least-once source
    re-delivers it; the archive is day-partitioned text whose files keep
    arrival order (range partitions by (day, seq), so a big day is split
    over several ordered files).  Replaying it with the streaming rules must
    keep each complete message exactly once.
    """
    raw = raw_payloads(load_table(spark, sf_dir, "events"))
    dated = C.curate(raw, processing_date=FALLBACK_DAY, keep=("seq", "value"))
    lines = materialize(dated.select("seq", "value", "day"))  # range partitions read their input twice
    archive = scratch_path(spark, "raw-archive")
    (
        lines.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
        .repartitionByRange("day", "seq")
        .sortWithinPartitions("day", "seq")
        .select(one_line("value").alias("value"), "day")
        .write.partitionBy("day")
        .text(archive)
    )
    kept = curate_archive(read_raw_archive(spark, archive), processing_date=FALLBACK_DAY)
    return kept.select("station_key", "timestamp", "aqi", "day")


def q_archive_daily_aqi(spark, sf_dir):
    """Curated JSONL archive written, scanned, reported."""
    curated = drop_repeats(materialize(_curated_raw(spark, sf_dir)))
    root = scratch_path(spark, "curated-archive")
    write_curated(curated, root, "events-city")
    return run_city_reports(spark, root, "events-city", tz=SOURCE)["daily_aqi"]


def _stream_ingest(spark, sf_dir, raw_format):
    events = load_table(spark, sf_dir, "events")
    base = scratch_path(spark, "stream-ingest")
    source_dir, root = f"{base}/source", f"{base}/archive"
    first = F.coalesce(F.col("ts") < "2024-01-16", F.lit(False))
    for half in (first, ~first):
        raw = raw_payloads(events.where(half))
        raw.write.mode("append").parquet(source_dir)
        stream = spark.readStream.schema(raw.schema).parquet(source_dir)
        for query in start_ingest(stream, root, "events-city", f"{base}/checkpoint",
                                  processing_date=FALLBACK_DAY, raw_format=raw_format,
                                  partitions=_cores(spark)):
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()
    curated = read_city(spark, root, "events-city")
    return curated.select("timestamp", "station_id", "aqi", "temperature", "storage_day")


def q_stream_ingest(spark, sf_dir):
    """The raw and curated streaming queries, restarted once.

    Raw messages arrive as files in two halves (first and second half of
    the month); each half is processed by both ingest queries with
    ``availableNow`` from their checkpoints.  The curated archive is read
    back through the typed scan (S1).
    """
    return _stream_ingest(spark, sf_dir, "text")


def q_stream_ingest_parse_once(spark, sf_dir):
    """As ``stream_ingest`` with a Parquet raw archive: one parse per message."""
    return _stream_ingest(spark, sf_dir, "parquet")


# --- arrival order, counters and odd inputs ------------------------------------

#: Arrival order of the late messages: the residue of the event number first,
#: so every part of the archive sweeps the whole month again.
_RESIDUES = 97
_ARRIVAL = f"(event_id % {_RESIDUES}) * 1000000000 + event_id"  # NULL ids arrive first
_LATE_STATIONS = 50
_LATE_ISO = "concat(substring(CAST(ts AS STRING), 1, 10), 'T00:00:00Z')"


def _late_messages(events):
    """Messages of few stations with day-coarse times, in late arrival order."""
    return events.selectExpr(
        f"{_ARRIVAL} AS seq", "event_id",
        f"to_json(named_struct('status', 'ok', 'data', named_struct('idx', user_id % {_LATE_STATIONS}, "
        f"'aqi', CAST(floor(value) AS INT), 'time', named_struct('iso', {_LATE_ISO})))) AS value",
    )


def q_replay_streamed_archive(spark, sf_dir):
    """The Parquet raw archive of a stream replayed by its order.

    Three runs bring the messages in late arrival order (each run sweeps all
    days, so days come late and times change back); the archive they leave
    is replayed and must equal change detection over the arrival order.
    """
    base = scratch_path(spark, "streamed-archive")
    late = _late_messages(load_table(spark, sf_dir, "events"))
    bounds = (0, 33, 66, _RESIDUES)
    for low, high in zip(bounds, bounds[1:], strict=False):
        part = late.where(f"coalesce(event_id % {_RESIDUES}, 0) BETWEEN {low} AND {high - 1}")
        part.select("seq", "value").write.mode("append").parquet(f"{base}/source")
        stream = spark.readStream.schema("seq BIGINT, value STRING").parquet(f"{base}/source")
        for query in start_ingest(stream, base, "late-city", f"{base}/checkpoint",
                                  processing_date=FALLBACK_DAY, partitions=_cores(spark)):
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()
    archive = read_parquet_archive(spark, dataset_path(base, "late-city", "raw"))
    return curate_parquet_archive(archive).select("station_key", "timestamp", "aqi")


def q_replay_twice(spark, sf_dir):
    """A batch raw archive with its order, replayed twice.

    The second replay replaces the days that the first one wrote.
    """
    base = scratch_path(spark, "replay-twice")
    late = _late_messages(load_table(spark, sf_dir, "events"))
    dated = C.curate(late, processing_date=FALLBACK_DAY, keep=("seq", "value"))
    write_raw_ordered(dated, base, "late-city")
    for _ in range(2):
        replay_raw(spark, base, "late-city", base, processing_date=FALLBACK_DAY, order="seq")
    curated = read_city(spark, base, "late-city")
    return curated.groupBy("storage_day").agg(
        F.count(F.lit(1)).alias("records"), F.sum("aqi").cast("long").alias("sum_aqi"))


def q_skip_counters(spark, sf_dir):
    """Invalid messages, incomplete keys and repeats, over every event."""
    return skip_report(raw_payloads(load_table(spark, sf_dir, "events")), FALLBACK_DAY)


def q_status_gate(spark, sf_dir):
    """messages whose status is not ok are left out, by station."""
    events = load_table(spark, sf_dir, "events")
    raw = events.selectExpr(
        "event_id AS seq",
        "to_json(named_struct('status', CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END, "
        "'data', named_struct('idx', user_id))) AS value")
    gated = C.curate(raw, processing_date=FALLBACK_DAY, require_status_ok=True)
    return gated.groupBy("station_key").agg(F.count(F.lit(1)).alias("messages"))


def _sparse(spark, sf_dir):
    """Observations with NULL dominant pollutants, NULL maps and all weather."""
    return _observations(spark, sf_dir).selectExpr(
        "seq", "timestamp", "station_id", "station_name", "latitude", "longitude", "aqi",
        "CASE WHEN dominant_pollutant <> 'error' THEN dominant_pollutant END AS dominant_pollutant",
        "CASE WHEN seq % 3 <> 0 THEN pollutants END AS pollutants",
        "temperature", "humidity", "wind", "CAST(aqi AS DOUBLE) + 1000 AS pressure",
        "temperature - 5 AS dew",
    )


def q_sparse_reports(spark, sf_dir):
    """Reports over NULL buckets, NULL maps and no map column."""
    sparse = _sparse(spark, sf_dir)
    norm = normalize(sparse, tz=SOURCE)
    mapless = normalize(sparse.drop("pollutants"), tz=SOURCE)
    dominant = R.dominant_pollutants(norm).selectExpr(
        "'dominant' AS report", "dominant_pollutant AS key", "count AS n")
    readings = R.average_pollutants(norm).selectExpr(
        "'readings' AS report", "pollutant AS key", "measurement_count AS n")
    empty = mapless.agg(F.count_if(F.size("pollutants") == 0).alias("n")).selectExpr(
        "'empty maps' AS report", "CAST(NULL AS STRING) AS key", "n")
    return dominant.unionByName(readings).unionByName(empty)


def q_report_order(spark, sf_dir):
    """L1: the rows of the closed-domain reports with their positions."""
    norm = _normalized(spark, sf_dir)
    at = F.monotonically_increasing_id().alias("position")  # one sorted task
    hourly = R.hourly_aqi(norm).select(F.lit("hourly").alias("report"), F.col("hour").cast("string").alias("key"), at)
    daily = R.daily_aqi(norm).select(F.lit("daily").alias("report"), F.col("day").alias("key"), at)
    bands = R.aqi_category_distribution(norm).select(
        F.lit("bands").alias("report"), F.col("aqi_category").alias("key"), at)
    return materialize(hourly).unionByName(materialize(daily)).unionByName(materialize(bands))


def q_written_jsonl(spark, sf_dir):
    """K2-K5: curated JSON lines read back as text; written nulls by day."""
    root = scratch_path(spark, "written-jsonl")
    sparse = C.with_record_day(_sparse(spark, sf_dir), FALLBACK_DAY)
    write_curated(sparse, root, "port")
    lines = spark.read.schema("value STRING, day STRING").text(dataset_path(root, "port", "curated"))
    return lines.groupBy("day").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("value").contains('"dominant_pollutant":null')).alias("null_dominant"),
        F.count_if(F.col("value").contains('"pollutants":null')).alias("null_maps"),
        F.count_if(F.col("value").contains('"pressure":1')).alias("pressures"),
    )


def q_raw_text_archive(spark, sf_dir):
    """Raw messages as day-partitioned text, read back by day."""
    root = scratch_path(spark, "raw-text")
    raw = raw_payloads(load_table(spark, sf_dir, "events"))
    dated = C.curate(raw, processing_date=FALLBACK_DAY, keep=("seq", "value"))
    write_raw(dated, root, "port")
    back = read_raw_archive(spark, dataset_path(root, "port", "raw"))
    return C.messages_per_day(C.curate(back, processing_date=FALLBACK_DAY, keep=()))


QUERIES: dict[str, QueryFn] = {
    "hourly_aqi": q_hourly_aqi,
    "daily_aqi": q_daily_aqi,
    "aqi_category_distribution": q_aqi_category_distribution,
    "average_pollutants": q_average_pollutants,
    "dominant_pollutants": q_dominant_pollutants,
    "weather_correlations": q_weather_correlations,
    "dedup_consecutive": q_dedup_consecutive,
    "station_state": q_station_state,
    "stream_dedup": q_stream_dedup,
    "curate_raw": q_curate_raw,
    "pollutants_long": q_pollutants_long,
    "drop_malformed": q_drop_malformed,
    "raw_per_day": q_raw_per_day,
    "incomplete_keys": q_incomplete_keys,
    "normalize_observations": q_normalize_observations,
    "report_summary": q_report_summary,
    "report_summary_one_scan": q_report_summary_one_scan,
    "report_bundle": q_report_bundle,
    "observation_preview": q_observation_preview,
    "day_pruned_scan": q_day_pruned_scan,
    "replay_archive": q_replay_archive,
    "archive_daily_aqi": q_archive_daily_aqi,
    "stream_ingest": q_stream_ingest,
    "stream_ingest_parse_once": q_stream_ingest_parse_once,
    "stream_dedup_sliced": q_stream_dedup_sliced,
    "replay_streamed_archive": q_replay_streamed_archive,
    "replay_twice": q_replay_twice,
    "skip_counters": q_skip_counters,
    "status_gate": q_status_gate,
    "sparse_reports": q_sparse_reports,
    "report_order": q_report_order,
    "written_jsonl": q_written_jsonl,
    "raw_text_archive": q_raw_text_archive,
}


# --- oracles ------------------------------------------------------------------

_OBS = """
WITH obs AS (
  SELECT event_id AS seq,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp",
         CAST(user_id AS INTEGER) AS station_id,
         CAST(user_id AS VARCHAR) AS station_key,
         'station-' || CAST(user_id AS VARCHAR) AS station_name,
         CAST(floor(value) AS INTEGER) AS aqi,
         event_type AS dominant_pollutant,
         value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CASE WHEN event_type <> 'error' THEN value END AS humidity,
         CAST(1.0 AS DOUBLE) AS wind,
         CAST(hour(ts) AS INTEGER) AS hour,
         strftime(ts, '%Y-%m-%d') AS day,
         ts
  FROM events)
"""


def _corr(a: str, b: str) -> str:
    return (
        f"round(covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0), {ROUND})"
    )


_CATEGORY = """CASE WHEN aqi <= 50 THEN 'Good'
              WHEN aqi <= 100 THEN 'Moderate'
              WHEN aqi <= 150 THEN 'Unhealthy for Sensitive Groups'
              WHEN aqi <= 200 THEN 'Unhealthy'
              WHEN aqi <= 300 THEN 'Very Unhealthy'
              ELSE 'Hazardous' END"""

ORACLES: dict[str, str] = {
    "hourly_aqi": _OBS + "SELECT hour, avg(aqi) AS avg_aqi FROM obs GROUP BY hour",
    "daily_aqi": _OBS + "SELECT day, avg(aqi) AS avg_aqi FROM obs GROUP BY day",
    "aqi_category_distribution": _OBS
    + f"SELECT {_CATEGORY} AS aqi_category, count(*) AS count FROM obs GROUP BY 1",
    "average_pollutants": _OBS
    + f"""SELECT pollutant, round(avg(v), {ROUND}) AS avg_value, count(v) AS measurement_count
    FROM (SELECT dominant_pollutant AS pollutant, value AS v FROM obs
          UNION ALL SELECT 'k', k FROM obs) GROUP BY pollutant""",
    "dominant_pollutants": _OBS
    + "SELECT dominant_pollutant, count(*) AS count FROM obs GROUP BY 1",
    "weather_correlations": _OBS
    + f"""SELECT {_corr('aqi', 'k')} AS aqi_temperature_corr,
           {_corr('aqi', 'humidity')} AS aqi_humidity_corr,
           {_corr('aqi', 'wind')} AS aqi_wind_corr FROM obs""",
    "dedup_consecutive": _OBS
    + """SELECT seq, station_key, dominant_pollutant, aqi FROM (
      SELECT *, lag(dominant_pollutant) OVER (PARTITION BY station_key ORDER BY seq) AS prev
      FROM obs) WHERE prev IS DISTINCT FROM dominant_pollutant""",
    "station_state": _OBS
    + """SELECT station_key, arg_max("timestamp", seq) AS last_timestamp
    FROM obs GROUP BY station_key""",
}

# Expected curated record of each raw payload (see the defect rules of
# airtrace.sources.testdata): valid messages only.
_RAW = """
WITH cur AS (
  SELECT event_id AS seq,
         CASE WHEN event_id % 7 <> 0
              THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS "timestamp",
         CASE WHEN event_id % 3 <> 1 THEN CAST(user_id AS INTEGER) END AS station_id,
         CAST(user_id AS VARCHAR) AS station_key,
         'station-' || CAST(user_id AS VARCHAR) AS station_name,
         CAST(42.0 AS DOUBLE) + CAST(user_id AS DOUBLE) / 1000 AS latitude,
         CAST(23.0 AS DOUBLE) + CAST(user_id AS DOUBLE) / 1000 AS longitude,
         CASE WHEN event_id % 11 <> 5 THEN CAST(floor(value) AS INTEGER) END AS aqi,
         event_type AS dominant_pollutant,
         value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS temperature,
         CASE WHEN event_type <> 'error' THEN value END AS humidity,
         CAST(1.0 AS DOUBLE) AS wind,
         CAST(NULL AS DOUBLE) AS pressure,
         CAST(NULL AS DOUBLE) AS dew,
         CAST(CASE WHEN event_id % 13 = 0 THEN 1 ELSE 2 END AS INTEGER) AS n_pollutants,
         CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d')
              ELSE '""" + FALLBACK_DAY + """' END AS day,
         ts
  FROM events WHERE event_id % 10 <> 0)
"""

# Complete records whose timestamp changed since the station's previous one
# (change detection on the station timestamp, in arrival order).
_KEPT = """, kept AS (
  SELECT * FROM (
    SELECT *, lag("timestamp") OVER (PARTITION BY station_key ORDER BY seq) AS prev_ts
    FROM cur WHERE "timestamp" IS NOT NULL)
  WHERE prev_ts IS DISTINCT FROM "timestamp")
"""

_SCALARS = ", ".join(f'"{c}"' if c == "timestamp" else c for c in _CURATED_SCALARS)


def _first_by(col: str, table: str, order: str, where: str = "") -> str:
    return f"(SELECT {col} FROM {table} {where} ORDER BY {order} LIMIT 1)"


ORACLES.update({
    "stream_dedup": ORACLES["dedup_consecutive"],
    "curate_raw": _RAW + f"SELECT {_SCALARS}, n_pollutants, day FROM cur",
    "pollutants_long": _RAW
    + """SELECT seq, dominant_pollutant AS pollutant, value FROM cur
    UNION ALL SELECT seq, 'k', temperature FROM cur WHERE seq % 13 <> 0""",
    "drop_malformed": """SELECT count(*) FILTER (WHERE event_id % 10 <> 0) AS valid_messages,
    count(*) FILTER (WHERE event_id % 10 = 0) AS invalid_messages FROM events""",
    "raw_per_day": _RAW + "SELECT day, count(*) AS raw_messages FROM cur GROUP BY day",
    "incomplete_keys": _RAW
    + 'SELECT seq, station_key, "timestamp" FROM cur WHERE "timestamp" IS NOT NULL',
    "normalize_observations": _RAW
    + """SELECT seq, station_id, "timestamp", aqi, dominant_pollutant, temperature,
           humidity, wind, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS event_epoch,
           day, CAST(hour(ts) AS INTEGER) AS hour, n_pollutants
    FROM cur WHERE "timestamp" IS NOT NULL AND aqi IS NOT NULL""",
    "report_summary": _OBS
    + f""", hourly AS (SELECT hour, avg(aqi) AS a FROM obs GROUP BY hour),
    daily AS (SELECT day, avg(aqi) AS a FROM obs GROUP BY day),
    cat AS (SELECT {_CATEGORY} AS c, count(*) AS n FROM obs GROUP BY 1),
    dom AS (SELECT dominant_pollutant AS d, count(*) AS n FROM obs GROUP BY 1),
    cor AS (SELECT covar_samp(aqi, k) / nullif(stddev_samp(aqi) * stddev_samp(k), 0) AS t,
                   covar_samp(aqi, humidity)
                     / nullif(stddev_samp(aqi) * stddev_samp(humidity), 0) AS h,
                   covar_samp(aqi, wind) / nullif(stddev_samp(aqi) * stddev_samp(wind), 0) AS w
            FROM obs),
    cl AS (SELECT 0 AS pos, 'temperature' AS metric, t AS v FROM cor
           UNION ALL SELECT 1, 'humidity', h FROM cor
           UNION ALL SELECT 2, 'wind', w FROM cor)
    SELECT {_first_by('hour', 'hourly', 'a DESC, hour')} AS peak_hour,
           {_first_by('a', 'hourly', 'a DESC, hour')} AS peak_avg_aqi,
           {_first_by('day', 'daily', 'a DESC, day')} AS peak_day,
           {_first_by('a', 'daily', 'a DESC, day')} AS peak_day_avg_aqi,
           {_first_by('c', 'cat', 'n DESC, c')} AS top_category,
           {_first_by('n', 'cat', 'n DESC, c')} AS top_category_count,
           {_first_by('d', 'dom', 'n DESC, d')} AS top_pollutant,
           {_first_by('n', 'dom', 'n DESC, d')} AS top_pollutant_count,
           {_first_by('metric', 'cl', 'abs(v) DESC, pos', 'WHERE v IS NOT NULL AND NOT isnan(v)')}
             AS strongest_metric,
           round({_first_by('v', 'cl', 'abs(v) DESC, pos', 'WHERE v IS NOT NULL AND NOT isnan(v)')},
                 {ROUND}) AS strongest_corr""",
    "report_bundle": _OBS
    + f"""SELECT 'hourly_aqi' AS report, CAST(hour AS VARCHAR) AS key, avg(aqi) AS value,
           CAST(NULL AS BIGINT) AS n FROM obs GROUP BY hour
    UNION ALL SELECT 'daily_aqi', day, avg(aqi), NULL FROM obs GROUP BY day
    UNION ALL SELECT 'aqi_category_distribution', {_CATEGORY}, NULL, count(*) FROM obs GROUP BY 2
    UNION ALL SELECT 'average_pollutants', pollutant, round(avg(v), {ROUND}), count(v)
      FROM (SELECT dominant_pollutant AS pollutant, value AS v FROM obs
            UNION ALL SELECT 'k', k FROM obs) GROUP BY pollutant
    UNION ALL SELECT 'dominant_pollutants', dominant_pollutant, NULL, count(*) FROM obs GROUP BY 2
    UNION ALL SELECT 'weather_correlations', 'temperature', {_corr('aqi', 'k')}, NULL FROM obs
    UNION ALL SELECT 'weather_correlations', 'humidity', {_corr('aqi', 'humidity')}, NULL FROM obs
    UNION ALL SELECT 'weather_correlations', 'wind', {_corr('aqi', 'wind')}, NULL FROM obs""",
    "observation_preview": _OBS
    + """SELECT "timestamp", station_name, aqi, dominant_pollutant, day, hour
    FROM obs ORDER BY seq LIMIT 5""",
    "replay_archive": _RAW + _KEPT
    + """SELECT station_key, "timestamp", aqi, day FROM kept""",
    "stream_ingest": _RAW + _KEPT
    + """SELECT "timestamp", station_id, aqi, temperature, day AS storage_day FROM kept""",
    "stream_ingest_parse_once": _RAW + _KEPT
    + """SELECT "timestamp", station_id, aqi, temperature, day AS storage_day FROM kept""",
    "archive_daily_aqi": _RAW + _KEPT
    + """SELECT day, avg(aqi) AS avg_aqi FROM kept WHERE aqi IS NOT NULL GROUP BY day""",
    "day_pruned_scan": _OBS
    + """SELECT "timestamp", station_id, station_name,
           CAST(42.0 AS DOUBLE) + CAST(station_id AS DOUBLE) / 1000 AS latitude,
           CAST(23.0 AS DOUBLE) + CAST(station_id AS DOUBLE) / 1000 AS longitude,
           aqi, dominant_pollutant, k AS temperature, humidity, wind,
           CAST(NULL AS DOUBLE) AS pressure, CAST(NULL AS DOUBLE) AS dew,
           CAST(2 AS INTEGER) AS n_pollutants, day AS storage_day
    FROM obs WHERE day BETWEEN '2024-01-10' AND '2024-01-20'""",
})

ORACLES["report_summary_one_scan"] = ORACLES["report_summary"]

_LATE = f"""
WITH late AS (
  SELECT {_ARRIVAL} AS seq, CAST(user_id % {_LATE_STATIONS} AS VARCHAR) AS station_key,
         strftime(ts, '%Y-%m-%d') || 'T00:00:00Z' AS "timestamp", strftime(ts, '%Y-%m-%d') AS day,
         CAST(floor(value) AS INTEGER) AS aqi
  FROM events),
kept AS (
  SELECT * FROM (
    SELECT *, lag("timestamp") OVER (PARTITION BY station_key ORDER BY seq) AS prev FROM late)
  WHERE prev IS DISTINCT FROM "timestamp")
"""

ORACLES.update({
    "stream_dedup_sliced": _OBS
    + """SELECT seq, station_key, dominant_pollutant, aqi FROM (
      SELECT seq, dominant_pollutant, aqi, CASE WHEN seq % 3 = 0 THEN 'hot' ELSE station_key END AS station_key,
             lag(dominant_pollutant) OVER (
               PARTITION BY CASE WHEN seq % 3 = 0 THEN 'hot' ELSE station_key END ORDER BY seq) AS prev
      FROM obs) WHERE prev IS DISTINCT FROM dominant_pollutant""",
    "replay_streamed_archive": _LATE + 'SELECT station_key, "timestamp", aqi FROM kept',
    "replay_twice": _LATE
    + """SELECT day AS storage_day, count(*) AS records, CAST(sum(aqi) AS BIGINT) AS sum_aqi
    FROM kept GROUP BY day""",
    "skip_counters": _RAW + _KEPT
    + """SELECT CAST((SELECT count(*) FILTER (WHERE event_id % 10 = 0) FROM events) AS BIGINT) AS invalid_json,
           CAST(count(*) FILTER (WHERE "timestamp" IS NULL) AS BIGINT) AS incomplete_keys,
           CAST(count(*) FILTER (WHERE "timestamp" IS NOT NULL) - (SELECT count(*) FROM kept) AS BIGINT)
             AS repeats_dropped
    FROM cur""",
    "status_gate": """SELECT CAST(user_id AS VARCHAR) AS station_key, count(*) AS messages
    FROM events WHERE event_type <> 'error' GROUP BY user_id""",
    "sparse_reports": _OBS
    + """SELECT 'dominant' AS report, dominant_pollutant AS key, count(*) AS n FROM obs
           WHERE dominant_pollutant <> 'error' GROUP BY 2
    UNION ALL SELECT 'readings', pollutant, count(v) FROM (
      SELECT dominant_pollutant AS pollutant, value AS v FROM obs WHERE seq % 3 <> 0
      UNION ALL SELECT 'k', k FROM obs WHERE seq % 3 <> 0) GROUP BY 2
    UNION ALL SELECT 'empty maps', NULL, count(*) FROM obs""",
    "report_order": _OBS
    + f"""SELECT 'hourly' AS report, CAST(hour AS VARCHAR) AS key,
           row_number() OVER (ORDER BY hour) - 1 AS position FROM (SELECT DISTINCT hour FROM obs)
    UNION ALL SELECT 'daily', day, row_number() OVER (ORDER BY day) - 1 FROM (SELECT DISTINCT day FROM obs)
    UNION ALL SELECT 'bands', c, row_number() OVER (ORDER BY n DESC, c) - 1
      FROM (SELECT {_CATEGORY} AS c, count(*) AS n FROM obs GROUP BY 1)""",
    "written_jsonl": _OBS
    + """SELECT day, count(*) AS lines,
           count(*) FILTER (WHERE dominant_pollutant = 'error') AS null_dominant,
           count(*) FILTER (WHERE seq % 3 = 0) AS null_maps,
           count(*) FILTER (WHERE CAST(aqi + 1000 AS VARCHAR) LIKE '1%') AS pressures
    FROM obs GROUP BY day""",
    "raw_text_archive": ORACLES["raw_per_day"],
})
