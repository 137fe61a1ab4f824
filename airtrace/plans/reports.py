"""The report bundle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrace.functions.aqi import aqi_category
from airtrace.functions.time import SESSION
from airtrace.operators import reports as R
from airtrace.operators.normalize import normalize
from airtrace.schemas import CORRELATED_METRICS, CURATED_COLUMNS
from airtrace.session import scratch_path
from airtrace.sources.curated import read_city

# Columns the reports read; everything else is pruned before materializing.
REPORT_INPUT_COLUMNS = (
    "timestamp",
    "station_name",
    "aqi",
    "dominant_pollutant",
    "pollutants",
    "temperature",
    "humidity",
    "wind",
    "event_timestamp",
    "day",
    "hour",
)


def materialize(df: DataFrame, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder.

    Returns a frame that reads the written copy: later reports scan a
    columnar file (pruned to the columns each needs) instead of re-running
    the JSON scan and the normalization, and a lost executor costs a file
    re-read, not a recomputation of the lineage.
    """
    spark = df.sparkSession
    if columns is not None:
        df = df.select(*[c for c in columns if c in df.columns])
    path = scratch_path(spark, "normalized")
    df.write.parquet(path)
    return spark.read.parquet(path)


_KEYS = ("hour", "day", "aqi_category", "dominant_pollutant")


def observation_cube(normalized: DataFrame, *more: str) -> DataFrame:
    """Sum and count of the AQI by (hour, day, band, dominant pollutant).

    ``more`` columns are keys as well.

    One aggregate of the narrow observation rows; every report but the
    pollutant averages and the coefficients rolls up from it.  AQI values
    are integers, so their sums are exact and averages of the cube equal
    averages of the rows.
    """
    return (
        normalized.select(
            *more, "hour", "day", aqi_category("aqi").alias("aqi_category"), "dominant_pollutant", "aqi")
        .groupBy(*more, *_KEYS)
        .agg(F.sum("aqi").alias("sum_aqi"), F.count("aqi").alias("n_aqi"), F.count("*").alias("n"))
    )


def _rolled(cube: DataFrame) -> DataFrame:
    """(report key columns, _key, avg_aqi, count) of each single-key rollup."""
    sets = [[k] for k in _KEYS]
    ids = _set_ids()
    which = F.create_map(*[x for k in _KEYS for x in (F.lit(ids[k]), F.lit(k))])
    return (
        cube.groupingSets(sets, *_KEYS)
        .agg((F.sum("sum_aqi") / F.sum("n_aqi")).alias("avg_aqi"), F.sum("n").alias("count"),
             F.max(F.grouping_id()).cast("int").alias("_set"))
        .withColumn("_key", which[F.col("_set")])
    )


def _set_ids() -> dict[str, int]:
    """grouping_id of each single-key set (first column = highest bit)."""
    full = (1 << len(_KEYS)) - 1
    return {k: full ^ (1 << (len(_KEYS) - 1 - i)) for i, k in enumerate(_KEYS)}


def single_pass_reports(
    normalized: DataFrame | None, persist: bool = True, cube: DataFrame | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All six reports; four of them from one persisted cube (those alone from a given ``cube``).

    Hours, days, bands and dominant pollutants roll up from
    :func:`observation_cube`, computed once; pollutant averages and the
    coefficients are aggregates of their own over the columns they read.
    Returns the reports and the cube (``unpersist`` it when done).
    """
    cube = observation_cube(normalized) if cube is None else cube
    if persist:
        cube = cube.persist()

    def mean(key: str) -> DataFrame:
        out = cube.where(F.col(key).isNotNull()).groupBy(key)
        return R.sort_small(out.agg((F.sum("sum_aqi") / F.sum("n_aqi")).alias("avg_aqi")), key)

    def number(key: str) -> DataFrame:
        out = cube.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n").alias("count"))
        return out.orderBy(F.desc("count"), F.asc(key))

    rolled = {
        "hourly_aqi": mean("hour"),
        "daily_aqi": mean("day"),
        "aqi_category_distribution": number("aqi_category"),
    }
    if normalized is not None:
        rolled["average_pollutants"] = R.average_pollutants(normalized)
    rolled["dominant_pollutants"] = number("dominant_pollutant")
    if normalized is not None:
        rolled["weather_correlations"] = R.weather_correlations(normalized)
    return rolled, cube


def report_table(normalized: DataFrame, digits: int | None = None) -> DataFrame:
    """Every report as rows of one long table.

    Columns ``report, key, value, n``: ``value`` is the average (AQI or
    reading) or the coefficient, ``n`` the count where the report has one.
    Three aggregates of narrow projections: the rollups of the cube, the
    exploded pollutant readings, and one global row of coefficients, which
    an empty input has as well.  ``digits`` rounds the floating values.
    """
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    names = {
        "hour": "hourly_aqi", "day": "daily_aqi", "aqi_category": "aqi_category_distribution",
        "dominant_pollutant": "dominant_pollutants",
    }
    is_mean = F.col("_key").isin("hour", "day")
    key = F.coalesce(*[F.when(F.col("_key") == k, F.col(k).cast("string")) for k in _KEYS])
    report = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("_key")]
    rolled = _rolled(observation_cube(normalized)).select(
        report.alias("report"), key.alias("key"), F.when(is_mean, F.col("avg_aqi")).alias("value"),
        F.when(~is_mean, F.col("count")).alias("n"),
    ).where(F.col("key").isNotNull())
    readings = (
        normalized.select(F.explode("pollutants").alias("key", "_value")).groupBy("key")
        .agg(rnd(F.avg("_value")).alias("value"), F.count("_value").alias("n"))
        .select(F.lit("average_pollutants").alias("report"), "key", "value", "n")
    )
    entries = ", ".join(f"'{m}', aqi_{m}_corr" for m in CORRELATED_METRICS)
    coefficients = R.weather_correlations(normalized).selectExpr(
        f"stack({len(CORRELATED_METRICS)}, {entries}) as (key, value)"
    ).select(F.lit("weather_correlations").alias("report"), "key", rnd(F.col("value")).alias("value"),
             F.lit(None).cast("long").alias("n"))
    return rolled.unionByName(readings).unionByName(coefficients)


def summary_table(normalized: DataFrame) -> DataFrame:
    """The one-row summary (L3-L6) from the cube and the coefficients.

    Same result as :func:`airtrace.operators.reports.summary` over the
    report bundle, in two scans: the cube's rollups, and one global
    aggregate with the coefficients.  A final aggregate over both picks each
    extreme together with its tie-break by ``min_by`` with a composite
    ordering (highest average, then smallest hour or day; highest count,
    then smallest name).  The strongest coefficient has the largest absolute
    value, ties in column order, NULL and NaN skipped.  Empty input gives
    one row of NULLs.
    """
    rolled = _rolled(observation_cube(normalized)).unionByName(
        R.weather_correlations(normalized), allowMissingColumns=True)

    def first_of(key: str, value: str, order: Column) -> Column:
        there = (F.col("_key") == key) & F.col(key).isNotNull()
        return F.min_by(F.when(there, F.col(value)), F.when(there, F.struct(order, F.col(key))))

    peak, most = -F.col("avg_aqi"), -F.col("count")
    folded = rolled.agg(
        first_of("hour", "hour", peak).alias("peak_hour"),
        first_of("hour", "avg_aqi", peak).alias("peak_avg_aqi"),
        first_of("day", "day", peak).alias("peak_day"),
        first_of("day", "avg_aqi", peak).alias("peak_day_avg_aqi"),
        first_of("aqi_category", "aqi_category", most).alias("top_category"),
        first_of("aqi_category", "count", most).alias("top_category_count"),
        first_of("dominant_pollutant", "dominant_pollutant", most).alias("top_pollutant"),
        first_of("dominant_pollutant", "count", most).alias("top_pollutant_count"),
        *[F.max(f"aqi_{m}_corr").alias(m) for m in CORRELATED_METRICS],
    )
    # Strongest coefficient: a later metric wins only with a strictly larger
    # absolute value, so ties go to the earlier column.
    best_metric, best_value = F.lit(None).cast("string"), F.lit(None).cast("double")
    for m in CORRELATED_METRICS:
        c = F.col(m)
        usable = c.isNotNull() & ~F.isnan(c)
        better = usable & (best_value.isNull() | (F.abs(c) > F.abs(best_value)))
        best_metric = F.when(better, F.lit(m)).otherwise(best_metric)
        best_value = F.when(better, c).otherwise(best_value)
    return folded.select(
        *R.SUMMARY_COLUMNS[:8],
        best_metric.alias("strongest_metric"),
        best_value.alias("strongest_corr"),
    )


def run_reports(
    curated: DataFrame,
    tz: str = SESSION,
    reuse: str | None = None,
    pairwise_corr: bool = False,
) -> dict[str, DataFrame]:
    """Normalize curated records and build every report.

    Returns lazy DataFrames keyed ``normalized, hourly_aqi, daily_aqi,
    aqi_category_distribution, average_pollutants, dominant_pollutants,
    weather_correlations``.  Each report is an independent aggregate.  When
    several reports will be collected, ``reuse`` avoids re-scanning the
    input for each: ``"parquet"`` materializes the narrow normalized input
    once (see :func:`materialize`), ``"cache"`` persists it (memory, then
    disk) for the caller to ``unpersist``, ``"single_pass"`` rolls four
    reports up from one cube (:func:`single_pass_reports`), a small table below
    the checkpoint folder that :func:`airtrace.session.delete_scratch` releases.
    """
    normalized = normalize(curated, tz=tz)
    if reuse == "single_pass":
        if pairwise_corr:
            raise ValueError("single_pass computes the non-pairwise coefficients")
        cube = materialize(observation_cube(normalized))
        reports, _ = single_pass_reports(normalized, persist=False, cube=cube)
        return {"normalized": normalized, **reports}
    base = normalized
    if reuse == "parquet":
        base = materialize(normalized, REPORT_INPUT_COLUMNS)
    elif reuse == "cache":
        base = normalized.select(*REPORT_INPUT_COLUMNS).persist()
    return {
        "normalized": normalized,
        "hourly_aqi": R.hourly_aqi(base),
        "daily_aqi": R.daily_aqi(base),
        "aqi_category_distribution": R.aqi_category_distribution(base),
        "average_pollutants": R.average_pollutants(base),
        "dominant_pollutants": R.dominant_pollutants(base),
        "weather_correlations": R.weather_correlations(base, pairwise=pairwise_corr),
    }


def run_city_reports(
    spark: SparkSession,
    root: str,
    city: str,
    tz: str = SESSION,
    day_from: str | None = None,
    day_to: str | None = None,
    reuse: str | None = None,
    layout: str | None = None,
) -> dict[str, DataFrame]:
    """Scan one city's curated archive and build the report bundle."""
    curated = read_city(spark, root, city, day_from, day_to, layout=layout)
    return run_reports(curated.select(*CURATED_COLUMNS), tz=tz, reuse=reuse)


def describe(normalized: DataFrame) -> tuple[int, str]:
    """Row count and schema text of the normalized table."""
    return normalized.count(), normalized.schema.simpleString()
