"""Streaming ingest: raw archive and curated archive queries.

Source -> parse (C1, F1) -> day (C6) ->
  query 1: raw file sink, every valid message, no de-duplication (K1);
  query 2: curate (C3-C5) -> complete keys (F3) -> stateful change
           detection (D1) -> curated JSON file sink (K2).
With a Parquet raw archive, query 2 reads query 1's output instead of the
source, so each message is parsed once.

Each query has its own checkpoint; the file sinks commit through their
metadata log, so a restart neither loses nor repeats output (exactly-once,
stronger than commit-after-write).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airtrace.operators.curation import (
    PAYLOAD,
    drop_invalid,
    observe_keys,
    parse_messages,
    project_curated,
    with_day,
)
from airtrace.paths import dataset_path
from airtrace.schemas import CURATED_COLUMNS
from airtrace.sinks.files import one_line
from airtrace.streaming.counters import day_counts
from airtrace.streaming.dedup_state import dedup_stream


STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_partitions(spark, partitions: int | None):
    """Number of state-store partitions for queries started inside the block.

    A stateful query fixes its partition count (``spark.sql.shuffle.
    partitions`` at its first start) for the life of its checkpoint, so it
    is chosen deliberately: e.g. the cluster's cores.  The stream keeps its
    own copy of the setting, so the session value is restored right after.
    """
    if not partitions:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(partitions)))
    try:
        yield
    finally:
        spark.conf.set(key, old)


@contextmanager
def state_on_disk(spark):
    """Queries started inside the block keep their state in RocksDB.

    The default provider holds all stations on the executors' heaps.  A
    checkpoint keeps the provider it was begun with.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, STATE_PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(key, old) if old else spark.conf.unset(key)


@contextmanager
def sorted_partitions(spark):
    """Queries started inside the block may sort the partitions of a micro-batch.

    Spark's checker of streaming plans refuses every sort; it is off while
    the queries of the block are started.
    """
    key = "spark.sql.streaming.unsupportedOperationCheck"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old) if old else spark.conf.unset(key)


@contextmanager
def stateful(spark, partitions: int | None = None):
    """What queries with :func:`dedup_stream` are started in."""
    with state_partitions(spark, partitions), state_on_disk(spark), sorted_partitions(spark):
        yield


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_ingest(
    source: DataFrame,
    root: str,
    city: str,
    checkpoint_root: str,
    processing_date: str | None = None,
    order: str | list[str] = "seq",
    trigger: str | None = None,
    raw_format: str = "parquet",
    partitions: int | None = None,
    initial_state: DataFrame | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the raw and curated archive queries over a message stream.

    ``source`` is a streaming frame with ``value`` text and the arrival
    order column(s) ``order`` (``partition``/``offset`` for Kafka).
    ``trigger``: ``None``/``"availableNow"`` processes what is there and
    stops; an interval such as ``"5 seconds"`` runs continuously.

    ``raw_format="parquet"`` (default) parses each message once: the first
    query writes the raw archive as day-partitioned Parquet holding the
    original one-line ``value`` together with its parse results and arrival
    order; the second query streams that archive (no second parse) into
    change detection and the curated sink, and a batch replay follows the
    stored order.  With ``availableNow`` the second query is started after
    the first one has finished.  ``raw_format="text"`` keeps the raw archive
    as day-partitioned JSON lines instead; both queries read the source and
    parse each message, and such an archive cannot be replayed with change
    detection.  ``partitions`` sets the state partitions of a new checkpoint
    (see :func:`state_partitions`), ``initial_state`` the station state that
    it begins with.

    The fallback day of messages without a time is fixed when the queries
    are built (``processing_date``, by default the current date).  Progress
    reports carry the counters ``messages`` and ``invalid_json``
    (``airtrace_ingest_<city>``), ``raw_messages`` by day
    (``airtrace_days_<city>``), ``incomplete_keys`` and ``complete_keys``
    (``airtrace_keys_<city>``), and ``kept`` (``airtrace_kept_<city>``);
    complete keys less kept records are the repeats dropped.
    """
    if processing_date is None:
        processing_date = str(source.sparkSession.sql("SELECT current_date() AS d").first()["d"])
    order_cols = [order] if isinstance(order, str) else list(order)
    parsed = parse_messages(source).observe(
        f"airtrace_ingest_{city}",
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col(PAYLOAD).isNull()).alias("invalid_json"),
    )
    dated = with_day(drop_invalid(parsed), processing_date).observe(
        f"airtrace_days_{city}", day_counts().alias("raw_messages"))
    raw_path = dataset_path(root, city, "raw")
    raw_checkpoint = f"{checkpoint_root.rstrip('/')}/raw"

    if raw_format == "text":
        raw = dated.select(one_line("value").alias("value"), "day")
        raw_query = _start(raw, "text", raw_path, raw_checkpoint, trigger)
        curated = project_curated(dated, keep=tuple(order_cols) + ("day",))
    elif raw_format == "parquet":
        staged = project_curated(
            dated.withColumn("value", one_line("value")),
            keep=tuple(order_cols) + ("value", "day"),
        )
        raw_query = _start(staged, "parquet", raw_path, raw_checkpoint, trigger)
        if trigger is None or trigger == "availableNow":
            raw_query.awaitTermination()
            if raw_query.exception() is not None:
                raise raw_query.exception()
        spark = source.sparkSession
        curated = spark.readStream.schema(staged.schema).parquet(raw_path).drop("value")
    else:
        raise ValueError(f"unknown raw_format {raw_format!r}")

    counted = observe_keys(curated, f"airtrace_keys_{city}")
    kept = dedup_stream(counted, order=order_cols, initial_state=initial_state).select(*CURATED_COLUMNS, "day")
    kept = kept.observe(f"airtrace_kept_{city}", F.count(F.lit(1)).alias("kept"))
    with stateful(source.sparkSession, partitions):
        curated_query = _start(
            kept,
            "json",
            dataset_path(root, city, "curated"),
            f"{checkpoint_root.rstrip('/')}/curated",
            trigger,
            ignoreNullFields="false",
        )
    return raw_query, curated_query


def _start(df: DataFrame, fmt: str, path: str, checkpoint: str, trigger, **options):
    writer = (
        df.writeStream.format(fmt)
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    for name, value in options.items():
        writer = writer.option(name, value)
    return _trigger(writer, trigger).start()


def stop_after(query: StreamingQuery, batches: int, timeout: float | None = None) -> int:
    """Let a continuously triggered query complete ``batches`` micro-batches,
    then stop it (W1: a bounded number of polls, then close).

    Counts by the batch number of the latest progress report, which numbers
    every micro-batch that was run; triggers without data run none.  Returns
    the number completed since the call, which may be more than asked for.
    Without a ``timeout`` (seconds) it waits as long as it takes; with one
    that is missed the query is stopped and a ``TimeoutError`` is raised.
    """
    import time

    def following(progress) -> int:
        # an idle trigger reports the number of the batch that is to come
        return progress["batchId"] + bool(progress["numInputRows"])

    begin, done = time.monotonic(), 0
    first = None if query.lastProgress is None else following(query.lastProgress)
    while query.isActive and done < batches:
        if timeout is not None and time.monotonic() - begin > timeout:
            query.stop()
            raise TimeoutError(f"{done} of {batches} micro-batches in {timeout} s")
        if query.lastProgress is not None:
            if first is None:  # nothing had been reported at the call
                first = min(p["batchId"] for p in query.recentProgress)
            done = following(query.lastProgress) - first
        query.awaitTermination(0.2)
    query.stop()
    if query.exception() is not None:
        raise query.exception()
    return done


def run_available(
    stream: DataFrame,
    fmt: str,
    path: str,
    checkpoint: str,
    partitions: int | None = None,
    partition_by: tuple[str, ...] = (),
    **options,
) -> None:
    """Process everything available once into a file sink, then stop."""
    writer = (
        stream.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for name, value in options.items():
        writer = writer.option(name, value)
    with stateful(stream.sparkSession, partitions):
        query = writer.start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
