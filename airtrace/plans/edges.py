"""Station state around a day range: what a replay of some days has to know.

Change detection compares a record with the station's previous one, which may
lie on another storage day, also between two records of a range (a late
message of another day).  An *edge* is a record whose next record of the same
station lies on another storage day, or that is the station's last: about one
a station and day.  The edges of the days outside a range are all that its
replay needs: the newest one before the range's first arrival gives each
station's state, those inside the range's arrivals stand between its records.

Edges are kept as Parquet, partitioned by day and sorted by arrival, beside
the archives (``<root>/<city>/edges``).  A *state snapshot* folds all edges
before the first arrival of some day into one row a station
(``<root>/<city>/states``); a replay begins with the newest snapshot that its
first arrival allows and reads only later edges, so a long archive does not
make the replay of a few days long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrace.operators.curation import PAYLOAD, complete_keys, curate, project_curated
from airtrace.operators.dedup import with_previous
from airtrace.paths import dataset_path, file_system
from airtrace.plans.reports import materialize
from airtrace.sources.raw import read_parquet_archive, read_raw_archive

_PREV = "_prev"


def arrival_columns(order: str | list[str] | None) -> tuple[list[str], list[str] | None]:
    """(order, slice) columns of an archive: stored ones, or (file, block, line) of text."""
    if order is None:
        return ["line"], ["file", "block"]
    return ([order] if isinstance(order, str) else list(order)), None


def archive_records(
    spark: SparkSession,
    root: str,
    city: str,
    processing_date: str | None = None,
    order: str | list[str] | None = None,
    day_from: str | None = None,
    day_to: str | None = None,
) -> DataFrame:
    """Curated records of a raw archive with their arrival, nothing parsed twice.

    An archive of the ingest holds its parse results, one of variants
    (:func:`airtrace.sinks.files.write_raw_variant`) its parsed payloads; any
    other is parsed once into a copy below the checkpoint folder.
    """
    path = dataset_path(root, city, "raw")
    order_cols, slices = arrival_columns(order)
    read = read_raw_archive if order is None else read_parquet_archive
    raw = read(spark, path, day_from, day_to)
    if "station_key" in raw.columns:
        return raw.drop("value")
    if PAYLOAD in raw.columns:
        return project_curated(raw, keep=(*order_cols, "day"))
    return materialize(curate(raw, processing_date, keep=(*(slices or ()), *order_cols)))


def day_edges(
    records: DataFrame,
    order: str | list[str] | None = "seq",
    key: str = "station_key",
    version: str = "timestamp",
    before: DataFrame | None = None,
) -> DataFrame:
    """Edges of ``records`` (with ``day`` and their arrival columns).

    Columns: ``key``, ``last_<version>``, the arrival columns and ``day``.
    ``before`` are edges of earlier records; with them the edges of what has
    arrived since can be appended to an archive's, earlier ones stay valid.
    """
    order_cols, slices = arrival_columns(order)
    arrival = [*(slices or ()), *order_cols]
    last = f"last_{version}"
    complete = complete_keys(records, key, version).select(key, version, "day", *arrival)
    fields = {last: F.col(version), **{c: F.col(c) for c in arrival}, "day": F.col("day")}
    rows = with_previous(complete, fields, key, order_cols, slice_cols=slices, before=before)
    crossed = rows.where(F.col(f"{_PREV}.day") != F.col("day")).select(key, f"{_PREV}.*")
    ends = complete.groupBy(key).agg(
        F.max_by(F.struct(*[c.alias(n) for n, c in fields.items()]), F.struct(*arrival)).alias("_end"))
    return crossed.unionByName(ends.select(key, "_end.*"))


def write_day_edges(
    spark: SparkSession,
    root: str,
    city: str,
    processing_date: str | None = None,
    order: str | list[str] | None = None,
) -> None:
    """(Re)build the edges of a city's whole raw archive."""
    records = archive_records(spark, root, city, processing_date, order)
    edges = day_edges(records, order)
    order_cols, slices = arrival_columns(order)
    # sorted, so that a bound on the arrival skips row groups
    (edges.hint("rebalance", "day").sortWithinPartitions("day", *(slices or ()), *order_cols)
     .write.mode("overwrite").partitionBy("day").parquet(dataset_path(root, city, "edges")))


def read_day_edges(spark: SparkSession, root: str, city: str) -> DataFrame:
    path = dataset_path(root, city, "edges")
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        raise FileNotFoundError(f"{path}: write_day_edges builds what a replay of a day range has to know")
    df = spark.read.parquet(path)
    return df.withColumn("day", F.col("day").cast("string"))


def _at(row, kinds: dict) -> Column:
    """A place in the arrival order as a struct literal."""
    return F.struct(*[F.lit(v).cast(kind).alias(c) for v, (c, kind) in zip(row, kinds.items(), strict=True)])


def write_state_snapshot(
    spark: SparkSession, root: str, city: str, day: str, order: str | list[str] | None = None,
) -> None:
    """Fold the edges before the first arrival of a storage day, one row a station.

    Earlier snapshots shorten later ones.  To be written again when the
    edges are rebuilt.
    """
    order_cols, slices = arrival_columns(order)
    arrival = [*(slices or ()), *order_cols]
    read = read_raw_archive if order is None else read_parquet_archive
    records = read(spark, dataset_path(root, city, "raw"), day, day)
    first = records.agg(F.min(F.struct(*arrival)).alias("p")).first()["p"]
    if first is None:
        raise ValueError(f"no record of {day}")
    kinds = {c: records.schema[c].dataType for c in arrival}
    edges = read_day_edges(spark, root, city)
    begin = newest_snapshot(spark, root, city, tuple(first))
    folded = _newest(_since(edges, begin, kinds), begin, _at(first, kinds), arrival)
    path = f"{dataset_path(root, city, 'states')}/day={day}"
    folded.write.mode("overwrite").parquet(f"{path}/state")
    spark.createDataFrame([tuple(first)], records.select(*arrival).schema).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/upto")


def newest_snapshot(spark: SparkSession, root: str, city: str, first: tuple) -> tuple[tuple, DataFrame] | None:
    """(place, state) of the latest snapshot that is not after ``first``."""
    path = dataset_path(root, city, "states")
    fs, at = file_system(spark, path)
    found = []
    for status in fs.listStatus(at) if fs.exists(at) else ():
        folder = status.getPath().toString()
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/upto/_SUCCESS")
        if fs.exists(done):  # written after the state
            place = tuple(spark.read.parquet(f"{folder}/upto").first())
            if place <= first:
                found.append((place, folder))
    if not found:
        return None
    place, folder = max(found)
    return place, spark.read.parquet(f"{folder}/state")


def _since(edges: DataFrame, begin: tuple[tuple, DataFrame] | None, kinds: dict) -> DataFrame:
    """The edges that a snapshot has not folded; the first arrival column is a pushed filter."""
    if begin is None:
        return edges
    leading, kind = next(iter(kinds.items()))
    return edges.where((F.col(leading) >= F.lit(begin[0][0]).cast(kind)) & (F.struct(*kinds) >= _at(begin[0], kinds)))


def _newest(edges: DataFrame, begin: tuple[tuple, DataFrame] | None, upto: Column, arrival: list[str],
            key: str = "station_key") -> DataFrame:
    """Each station's newest edge before a place, a snapshot's states included."""
    place = F.struct(*arrival)
    rest = [c for c in edges.columns if c not in (key, "day")]
    rows = edges.where(place < upto).select(key, *rest)
    if begin is not None:
        rows = rows.unionByName(begin[1].select(key, *rest))
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), place).alias("_newest")).select(key, "_newest.*")


def state_around(
    edges: DataFrame,
    records: DataFrame,
    order: str | list[str] | None,
    day_from: str | None,
    day_to: str | None,
    key: str = "station_key",
    snapshot: Callable[[tuple], tuple[tuple, DataFrame] | None] | None = None,
) -> DataFrame | None:
    """Edges of other days as an initial state of ``records`` of a day range.

    Of the edges before the first record of the range each station's newest
    one counts (combined map-side); of later ones all up to the last record.
    ``snapshot`` finds the states to begin with (:func:`newest_snapshot`).
    """
    order_cols, slices = arrival_columns(order)
    arrival = [*(slices or ()), *order_cols]
    place = F.struct(*arrival)
    span = records.agg(F.min(place).alias("first"), F.max(place).alias("last")).first()
    if span["first"] is None:
        return None
    kinds = {c: records.schema[c].dataType for c in arrival}
    begin = snapshot(tuple(span["first"])) if snapshot is not None else None
    outside = F.lit(False)
    if day_from is not None:
        outside = outside | (F.col("day") < day_from)
    if day_to is not None:
        outside = outside | (F.col("day") > day_to)
    others = _since(edges.where(outside), begin, kinds)
    earlier = _newest(others, begin, _at(span["first"], kinds), arrival, key)
    between = others.where((place > _at(span["first"], kinds)) & (place < _at(span["last"], kinds)))
    return earlier.unionByName(between.select(*earlier.columns))
