"""Reports A1-A7 and the summary L3-L6 against plain Python over own rows."""

import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from airtrace.operators import reports as R
from airtrace.plans.reports import report_table, run_reports, single_pass_reports, summary_table

SCHEMA = (
    "hour int, day string, aqi int, dominant_pollutant string, pollutants map<string,double>, "
    "temperature double, humidity double, wind double"
)
LIMITS = ((50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"),
          (200, "Unhealthy"), (300, "Very Unhealthy"))


def band(aqi):
    return next((name for top, name in LIMITS if aqi is not None and aqi <= top), "Hazardous")


def observations(seed, n=250):
    """Sparse maps, NULL buckets, AQI at and beside every band edge."""
    rng = random.Random(seed)
    edges = [x for top, _ in LIMITS for x in (top, top + 1)] + [-4, 0, 777]
    out = []
    for _ in range(n):
        keys = rng.sample(["dust", "ash", "nh3", "c6h6"], rng.randint(0, 3))
        readings = {k: rng.choice([None, rng.randint(0, 40) / 4]) for k in keys}
        out.append((
            rng.choice([None, *range(24)]), rng.choice([None, "2031-11-05", "2031-11-06", "no day"]),
            rng.choice(edges), rng.choice([None, "dust", "ash", "nh3"]), rng.choice([None, readings]),
            rng.choice([None, rng.uniform(-9, 30)]), rng.uniform(0, 100), 3.5,
        ))
    return out


@pytest.fixture(scope="module")
def table():
    return observations(1)


@pytest.fixture()
def frame(spark, table):
    return spark.createDataFrame(table, SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def means(table, at):
    by = defaultdict(list)
    for r in table:
        if r[at] is not None:
            by[r[at]].append(r[2])
    return [(k, statistics.fmean(v)) for k, v in sorted(by.items())]


def most_first(counter):
    return sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))


def readings(table):
    by = defaultdict(list)
    for r in table:
        for k, v in (r[4] or {}).items():
            by[k].append(v)
    out = []
    for k, values in by.items():
        there = [v for v in values if v is not None]
        out.append((k, statistics.fmean(there) if there else None, len(there)))
    return sorted(out, key=lambda x: (-x[2], x[0]))


def test_means_by_hour_and_day_are_ordered(frame, table):
    assert rows(R.hourly_aqi(frame)) == [pytest.approx(x) for x in means(table, 0)]
    assert [k for k, _ in rows(R.daily_aqi(frame))] == [k for k, _ in means(table, 1)]
    assert [v for _, v in rows(R.daily_aqi(frame))] == pytest.approx([v for _, v in means(table, 1)])


def test_bands_and_dominant_pollutants_most_frequent_first(frame, table):
    assert rows(R.aqi_category_distribution(frame)) == most_first(Counter(band(r[2]) for r in table))
    assert rows(R.dominant_pollutants(frame)) == most_first(Counter(r[3] for r in table if r[3]))


def test_pollutant_means_of_sparse_maps(frame, table):
    got, want = rows(R.average_pollutants(frame)), readings(table)
    assert [(k, n) for k, _, n in got] == [(k, n) for k, _, n in want]
    assert [v for _, v, _ in got] == pytest.approx([v for _, v, _ in want])


def test_a_key_with_null_readings_only_keeps_its_row(spark):
    df = spark.createDataFrame([({"ash": None},), (None,), ({},)], "pollutants map<string,double>")
    assert rows(R.average_pollutants(df)) == [("ash", None, 0)]


def test_a_missing_aqi_falls_through_every_band(spark):
    df = spark.createDataFrame([(None,)], "aqi int")
    assert rows(R.aqi_category_distribution(df)) == [("Hazardous", 1)]


CORR_SCHEMA = "aqi double, temperature double, humidity double, wind double"


def moments(xs, ys):
    """covar_samp over the pairs, by the deviations of each whole column."""
    pairs = [(x, y) for x, y in zip(xs, ys, strict=True) if x is not None and y is not None]
    mx, my = statistics.fmean(x for x, _ in pairs), statistics.fmean(y for _, y in pairs)
    covar = sum((x - mx) * (y - my) for x, y in pairs) / (len(pairs) - 1)
    sd = [statistics.stdev([v for v in col if v is not None]) for col in (xs, ys)]
    return covar / (sd[0] * sd[1])


def test_coefficients_use_each_columns_own_deviation(spark):
    rng = random.Random(3)
    aqi = [float(rng.randint(0, 200)) for _ in range(60)]
    temperature = [None if rng.random() < 0.3 else a / 9 + rng.gauss(0, 4) for a in aqi]
    humidity = [rng.uniform(20, 90) for _ in aqi]
    df = spark.createDataFrame([(a, t, h, 2.0) for a, t, h in zip(aqi, temperature, humidity, strict=True)], CORR_SCHEMA)
    (got,) = rows(R.weather_correlations(df))
    assert got[:2] == pytest.approx((moments(aqi, temperature), moments(aqi, humidity)))
    assert got[2] is None  # a constant column has no coefficient
    (pairwise,) = rows(R.weather_correlations(df, pairwise=True))
    assert pairwise[0] == pytest.approx(df.agg(F.corr("aqi", "temperature")).first()[0])
    assert pairwise[0] != pytest.approx(got[0], abs=1e-6)


@pytest.mark.parametrize("n", [0, 1])
def test_coefficients_are_one_row_of_nulls_without_variation(spark, n):
    df = spark.createDataFrame([(7.0, -2.0, 55.0, 0.5)] * n, CORR_SCHEMA)
    assert rows(R.weather_correlations(df)) == [(None, None, None)]


def _bundle(df):
    return {
        "hourly_aqi": R.hourly_aqi(df),
        "daily_aqi": R.daily_aqi(df),
        "aqi_category_distribution": R.aqi_category_distribution(df),
        "dominant_pollutants": R.dominant_pollutants(df),
        "weather_correlations": R.weather_correlations(df),
    }


def test_summary_picks_the_extremes(frame, table):
    (s,) = R.summary(_bundle(frame)).collect()
    top = min(means(table, 0), key=lambda kv: (-kv[1], kv[0]))
    assert (s.peak_hour, s.peak_avg_aqi) == (top[0], pytest.approx(top[1]))
    top = min(means(table, 1), key=lambda kv: (-kv[1], kv[0]))
    assert (s.peak_day, s.peak_day_avg_aqi) == (top[0], pytest.approx(top[1]))
    assert (s.top_category, s.top_category_count) == most_first(Counter(band(r[2]) for r in table))[0]
    assert (s.top_pollutant, s.top_pollutant_count) == most_first(Counter(r[3] for r in table if r[3]))[0]
    found = {m: moments([r[2] for r in table], [r[i] for r in table]) for m, i in (("temperature", 5), ("humidity", 6))}
    name = max(found, key=lambda m: abs(found[m]))
    assert (s.strongest_metric, s.strongest_corr) == (name, pytest.approx(found[name]))


def test_equal_peaks_go_to_the_smaller_key(spark):
    data = [(h, d, 40, None, None, None, None, None) for h, d in ((19, "b"), (6, "a"), (6, "b"), (19, "a"))]
    df = spark.createDataFrame(data, SCHEMA)
    for s in (R.summary(_bundle(df)).first(), summary_table(df).first()):
        assert (s.peak_hour, s.peak_day) == (6, "a")


@pytest.mark.parametrize("seed", [2, 9])
def test_cube_forms_equal_the_single_reports(spark, seed):
    df = spark.createDataFrame(observations(seed, 120), SCHEMA)
    want = {k: v for k, v in run_reports_of(df).items()}
    reports, cube = single_pass_reports(df)
    for name, report in reports.items():
        assert [tuple(map(_rounded, r)) for r in rows(report)] == [tuple(map(_rounded, r)) for r in rows(want[name])]
    cube.unpersist()
    assert [_rounded(v) for v in summary_table(df).first()] == [_rounded(v) for v in R.summary(want).first()]
    table = rows(report_table(df))
    assert len(table) == sum(want[k].count() for k in want if k != "weather_correlations") + 3


def run_reports_of(df):
    return {**_bundle(df), "average_pollutants": R.average_pollutants(df)}


def _rounded(v):
    return round(v, 9) if isinstance(v, float) else v


def test_every_bundle_form_has_the_coefficient_row_on_empty_input(spark):
    empty = spark.createDataFrame([], "timestamp string, aqi int, dominant_pollutant string, "
                                  "pollutants map<string,double>, temperature double, humidity double, "
                                  "wind double, station_name string")
    for reuse in (None, "cache", "parquet", "single_pass"):
        reports = run_reports(empty, tz="UTC", reuse=reuse)
        assert rows(reports["weather_correlations"]) == [(None, None, None)]
        assert rows(reports["daily_aqi"]) == [] and rows(reports["average_pollutants"]) == []
    normalized = run_reports(empty, tz="UTC")["normalized"]
    table = rows(report_table(normalized))
    assert [(r[0], r[2]) for r in table] == [("weather_correlations", None)] * 3
    for s in (summary_table(normalized).collect(), R.summary(run_reports_of(normalized)).collect()):
        assert len(s) == 1 and all(v is None for v in s[0])


def test_final_aggregate_stays_parallel(frame):
    """The exchange into one task lies above the final aggregate."""
    for report in (R.hourly_aqi(frame), R.daily_aqi(frame), R.aqi_category_distribution(frame)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "Coalesce 1" not in plan
        assert plan.index("SinglePartition") < plan.index("HashAggregate")


def test_strongest_correlation_ties_go_to_column_order(spark):
    names = [f"aqi_{m}_corr" for m in ("temperature", "humidity", "wind")]
    schema = ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame([(None, -0.25, 0.25)], schema)
    assert rows(R.strongest_correlation(df)) == [("humidity", -0.25)]
    assert rows(R.strongest_correlation(spark.createDataFrame([(float("nan"), None, None)], schema))) == []


def test_preview_limits_and_orders(spark):
    data = [(i, f"at {i}", "mast", i * 3, "ash", "2031-11-05", i % 24) for i in random.Random(5).sample(range(90), 30)]
    df = spark.createDataFrame(
        data, "seq int, timestamp string, station_name string, aqi int, dominant_pollutant string, day string, hour int")
    assert rows(R.preview(df, 4, order="seq")) == [r[1:] for r in sorted(data)[:4]]
