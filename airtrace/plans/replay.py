"""Batch replay of the raw archive with the streaming rules (S4 -> D1 -> K2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airtrace.operators.curation import curate, observe_keys
from airtrace.operators.dedup import drop_repeats
from airtrace.plans.edges import (
    archive_records,
    arrival_columns,
    newest_snapshot,
    read_day_edges,
    state_around,
)
from airtrace.plans.reports import materialize
from airtrace.sinks.files import write_curated


def curate_archive(
    raw: DataFrame, processing_date: str | None = None, materialize_curated: bool = True,
    order: str | list[str] | None = None,
) -> DataFrame:
    """Curated, change-detected records of an archive frame.

    ``order`` names the arrival order columns that ``raw`` carries.  Without
    it ``raw`` comes from :func:`airtrace.sources.raw.read_raw_archive`; its
    arrival order is (file, block, line).  Change detection then slices each
    hot station by ``(file, block)`` - one input split - and orders by
    ``line`` inside it, so a station that fills many files is spread over
    many tasks.

    Change detection counts the stations before it reads the rows, and reads
    those of hot stations twice; so that the JSON is parsed once, the curated
    records (a small fraction of the raw text) are by default written as
    Parquet below the checkpoint folder when this is called.
    """
    order_cols, slices = arrival_columns(order)
    keep = (*(slices or ()), *order_cols)
    curated = curate(raw, processing_date=processing_date, keep=keep)
    if materialize_curated:
        curated = materialize(curated)
    return drop_repeats(curated, order=order_cols, slice_cols=slices).drop(*keep)


def replay_raw(
    spark: SparkSession,
    root: str,
    city: str,
    out_root: str,
    processing_date: str | None = None,
    order: str | list[str] | None = None,
    day_from: str | None = None,
    day_to: str | None = None,
) -> None:
    """Rebuild a city's curated archive from its raw archive.

    ``order`` reads a Parquet archive by its order columns, else a text
    archive is read by file and line.  The curated days of the replay are
    replaced, days that it no longer holds are emptied, so a second replay
    leaves the same rows.

    A day range replays those storage days only and leaves their rows as a
    replay of everything does: stations begin with the state that the edges
    of the other days give (:func:`airtrace.plans.edges.write_day_edges`, to be
    run when the archive has changed), from the newest state snapshot on
    (:func:`airtrace.plans.edges.write_state_snapshot`) if there are any.
    """
    order_cols, slices = arrival_columns(order)
    records = archive_records(spark, root, city, processing_date, order, day_from, day_to)
    state = None
    if day_from is not None or day_to is not None:
        state = state_around(
            read_day_edges(spark, root, city), records, order, day_from, day_to,
            snapshot=lambda first: newest_snapshot(spark, root, city, first))
    kept = drop_repeats(records, order=order_cols, slice_cols=slices, initial_state=state)
    write_curated(kept, out_root, city, mode="replace", day_from=day_from, day_to=day_to)


def curate_parquet_archive(
    archive: DataFrame, order: str | list[str] = "seq"
) -> DataFrame:
    """Change-detected curated records of a Parquet raw archive.

    The archive (ingest with ``raw_format="parquet"``) already holds the
    parse results and the arrival order, so the replay parses nothing and
    slices each hot station by its stored order (e.g. ``(partition, offset)``).
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    kept = drop_repeats(archive.drop("value"), order=order_cols)
    return kept.drop(*[c for c in order_cols if c in kept.columns])


def skip_report(
    raw: DataFrame, processing_date: str | None = None, order: str | list[str] = "seq"
) -> DataFrame:
    """One row of what a batch curation leaves out, counted as it runs.

    The messages are parsed once (into a copy below the checkpoint folder)
    and the records read once more for change detection; the counters are
    observed on the way.
    """
    order_cols, slices = arrival_columns(order)
    seen, keys, repeats = Observation(), Observation(), Observation()
    curated = curate(raw, processing_date, keep=tuple(order_cols), observation=seen)
    records = materialize(observe_keys(curated, keys))
    drop_repeats(records, order=order_cols, slice_cols=slices, observation=repeats).write.format("noop").mode(
        "overwrite").save()
    return raw.sparkSession.range(1).select(
        F.lit(seen.get["invalid_json"]).cast("long").alias("invalid_json"),
        F.lit(keys.get["incomplete_keys"]).cast("long").alias("incomplete_keys"),
        F.lit(repeats.get["repeats_dropped"]).cast("long").alias("repeats_dropped"),
    )

