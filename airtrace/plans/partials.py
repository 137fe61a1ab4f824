"""Reports from daily partial results.

For each storage day three small tables are kept: the cube of AQI sums and
counts by (hour, day, band, dominant pollutant), sums and counts of the
readings by pollutant, and moments for the weather coefficients.  Reports are
merges of the days' partials, so a day that is added or rewritten costs a
scan of that day alone.

Moments are merged by the pairwise formula: of two parts with counts n, m and
means a, b, the deviations add up to ``M_a + M_b + (b - a)^2 n m / (n + m)``,
and co-moments likewise, so nothing cancels.  The coefficients divide a
covariance of the pairs by deviations of all values of each side; pairs and
sides therefore have moments of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrace.functions.time import SESSION
from airtrace.operators.normalize import normalize
from airtrace.operators.reports import sort_small
from airtrace.paths import day_folders, file_system, join_path
from airtrace.plans.reports import observation_cube, single_pass_reports
from airtrace.schemas import CORRELATED_METRICS, CURATED_COLUMNS, STORAGE_DAY
from airtrace.sources.curated import read_city

_TABLES = ("cube", "readings", "moments")


def _side(column: str) -> Column:
    """(n, mean, deviations, least, greatest) of a column's values."""
    x = F.col(column).cast("double")
    return F.struct(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"),
        F.min(x).alias("least"), F.max(x).alias("greatest"))


def _pair(a: str, b: str) -> Column:
    """(n, means, co-moment) of the rows that have both values."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    n = F.count_if(both)
    return F.struct(
        n.alias("n"), F.avg(F.when(both, x)).alias("mean_a"), F.avg(F.when(both, y)).alias("mean_b"),
        (F.covar_pop(x, y) * n).alias("c"))


def day_partials(normalized: DataFrame) -> dict[str, DataFrame]:
    """Partials of normalized observations with their storage day, by table."""
    by_day = normalized.withColumnRenamed(STORAGE_DAY, "_storage")
    cube = observation_cube(by_day, "_storage")
    readings = (
        by_day.select("_storage", F.explode("pollutants").alias("pollutant", "value"))
        .groupBy("_storage", "pollutant")
        .agg(F.sum("value").alias("sum_value"), F.count("value").alias("n_value"))
    )
    moments = by_day.groupBy("_storage").agg(
        _side("aqi").alias("aqi"),
        *[_side(m).alias(m) for m in CORRELATED_METRICS],
        *[_pair("aqi", m).alias(f"aqi_{m}") for m in CORRELATED_METRICS],
    )
    tables = {"cube": cube, "readings": readings, "moments": moments}
    return {name: t.withColumnRenamed("_storage", STORAGE_DAY) for name, t in tables.items()}


def _folder(root: str, city: str, table: str) -> str:
    return join_path(root, city, "partials", table)


def update_partials(
    spark: SparkSession, root: str, city: str, day_from: str | None = None, day_to: str | None = None,
    tz: str = SESSION, layout: str | None = None,
) -> None:
    """(Re)compute the partials of a day range of a city's curated archive.

    Only the folders of these days are scanned; partials of days that the
    archive no longer holds are dropped.
    """
    curated = read_city(spark, root, city, day_from, day_to, layout=layout)
    normalized = normalize(curated.select(*CURATED_COLUMNS, STORAGE_DAY), tz=tz)
    for name, table in day_partials(normalized).items():
        path = _folder(root, city, name)
        there = {
            day: found for day, found in day_folders(spark, path, STORAGE_DAY).items()
            if found and (day_from is None or day >= day_from) and (day_to is None or day <= day_to)
        }
        names = {day: {f.getPath().getName() for f in found} for day, found in there.items()}
        (table.repartition(STORAGE_DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(STORAGE_DAY).parquet(path))
        after = day_folders(spark, path, STORAGE_DAY)
        fs, _ = file_system(spark, path)
        for day, found in there.items():
            if {f.getPath().getName() for f in after.get(day, ())} == names[day]:
                fs.delete(found[0].getPath().getParent(), True)


def read_partials(spark: SparkSession, root: str, city: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(_folder(root, city, name)) for name in _TABLES}


def _merged(parts: Column, names: tuple[str, ...], co: str) -> Column:
    """Moments of all parts; ``names`` are the means whose deviations ``co`` multiplies."""
    zero = F.struct(
        F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(m) for m in names], F.lit(0.0).alias(co))
    left, right = names[0], names[-1]

    def merge(s: Column, p: Column) -> Column:
        n = s["n"] + p["n"]
        means = [(s[m] + (p[m] - s[m]) * p["n"] / n).alias(m) for m in names]
        apart = (p[left] - s[left]) * (p[right] - s[right]) * (s["n"] * p["n"] / n)
        return F.when(p["n"] == 0, s).otherwise(F.struct(n.alias("n"), *means, (s[co] + p[co] + apart).alias(co)))

    return F.aggregate(parts, zero, merge)


def _coefficients(moments: DataFrame) -> DataFrame:
    """The weather coefficients of all days, one row (also without days)."""
    sides = ("aqi", *CORRELATED_METRICS)
    pairs = tuple(f"aqi_{m}" for m in CORRELATED_METRICS)
    # one element a day, in the order of the days: the same sum on every run
    days = moments.agg(F.array_sort(F.collect_list(F.struct(STORAGE_DAY, *sides, *pairs))).alias("days"))
    side = {s: _merged(F.col("days")[s], ("mean",), "m2") for s in sides}
    pair = {p: _merged(F.col("days")[p], ("mean_a", "mean_b"), "c") for p in pairs}
    varies = {
        f"{s}_varies": F.array_min(F.col("days")[s]["least"]) < F.array_max(F.col("days")[s]["greatest"])
        for s in sides
    }
    whole = days.select(*[c.alias(n) for n, c in {**side, **pair, **varies}.items()])

    def sample(part: str, co: str) -> Column:
        return F.when(F.col(f"{part}.n") > 1, F.col(f"{part}.{co}") / (F.col(f"{part}.n") - 1))

    return whole.select(*[
        F.when(  # a constant series may keep a deviation of rounding
            F.col("aqi_varies") & F.col(f"{m}_varies"),
            F.try_divide(sample(f"aqi_{m}", "c"), F.sqrt(sample("aqi", "m2")) * F.sqrt(sample(m, "m2"))),
        ).alias(f"aqi_{m}_corr")
        for m in CORRELATED_METRICS
    ])


def reports_from_partials(partials: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six reports, merged from daily partials; the same as of a full scan."""
    reports, _ = single_pass_reports(None, persist=False, cube=partials["cube"])
    readings = (
        partials["readings"].groupBy("pollutant")
        .agg(F.sum("sum_value").alias("s"), F.sum("n_value").alias("measurement_count"))
        .select("pollutant", F.try_divide("s", "measurement_count").alias("avg_value"), "measurement_count")
    )
    return {
        **reports,
        "average_pollutants": sort_small(readings, F.desc("measurement_count"), F.asc("pollutant")),
        "weather_correlations": _coefficients(partials["moments"]),
    }
