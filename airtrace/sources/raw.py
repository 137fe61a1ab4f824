"""Raw message sources: the raw archive (S4) and a Kafka topic."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrace.operators.curation import message_text
from airtrace.paths import dataset_path, file_system, is_streamed

# --- fixed values -----------------------------------------------------------
TOPIC_PREFIX = "air_quality_"
# ---------------------------------------------------------------------------
# Records of a micro-batch (the rest stay in the topic for the next one): it
# bounds the rows one station can bring into one step of change detection.
MAX_OFFSETS_PER_TRIGGER = 1_000_000

_BOM = "\ufeff"


def _days(df: DataFrame, day_from: str | None, day_to: str | None) -> DataFrame:
    if day_from is not None:
        df = df.where(F.col("day") >= day_from)
    return df if day_to is None else df.where(F.col("day") <= day_to)


def _check_names(spark: SparkSession, path: str) -> None:
    """Raise if numbered files of a folder have names of several lengths."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return
    lengths: dict[str, int] = {}
    files = fs.listFiles(at, True)
    while files.hasNext():
        file = files.next().getPath()
        name = file.getName()
        if name.startswith(("_", ".")) or not re.search(r"[0-9]", name):
            continue
        folder = file.getParent().toString()
        if lengths.setdefault(folder, len(name)) != len(name):
            raise ValueError(f"{folder}: names of several lengths do not sort in the order of their numbers ({name})")


def read_raw_archive(
    spark: SparkSession, path: str | list[str], day_from: str | None = None, day_to: str | None = None,
    in_order: bool | None = None,
) -> DataFrame:
    """Lines of a text archive as ``value`` with an arrival order.

    Text archives hold no arrival order; the order is that of the files'
    paths and of the lines inside them: right for archives of one growing
    file a day, or of part files that were written in order and have names
    of one length.  Folders with numbered files of names of several lengths
    (``part-99999``, ``part-100000``) are refused; ``in_order=True`` vouches
    for the order of the names.  A folder that a stream has written is
    refused, for its part files have random names; the ingest's Parquet
    archive keeps the order (:func:`read_parquet_archive`).

    Order columns: ``file`` (path), ``block`` (split start) and ``line`` (a
    per-task increasing id).  One split is always read by one task in line
    order, so ``(file, block, line)`` stays the same when a task is retried.
    A leading UTF-8 byte-order mark is removed.  ``day_from``/``day_to``
    prune the folders of a ``day=`` layout; without them files are found
    recursively in any layout.
    """
    paths = [path] if isinstance(path, str) else list(path)
    for p in paths:
        if is_streamed(spark, p):
            raise ValueError(f"{p} was written by a stream: its files carry no arrival order")
        if in_order is None:
            _check_names(spark, p)
    if day_from is None and day_to is None:
        df = spark.read.option("recursiveFileLookup", "true").text(paths)
    else:
        df = _days(spark.read.schema("value STRING, day STRING").text(paths), day_from, day_to)
    return df.select(
        F.regexp_replace("value", f"^{_BOM}", "").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def read_city_archive(spark: SparkSession, root: str, city: str) -> DataFrame:
    return read_raw_archive(spark, dataset_path(root, city, "raw"))


def read_parquet_archive(
    spark: SparkSession, path: str, day_from: str | None = None, day_to: str | None = None
) -> DataFrame:
    """A Parquet raw archive, which carries the arrival order.

    Written by the ingest (``raw_format="parquet"``): the original ``value``,
    the curated fields parsed at ingest, ``station_key``, the arrival order
    columns and ``day``, so replaying it needs no JSON parsing.  Written by
    :func:`airtrace.sinks.files.write_raw_ordered`: ``value``, the order
    columns and ``day``.  A day range becomes partition filters.
    """
    df = spark.read.parquet(path).withColumn("day", F.col("day").cast("string"))
    return _days(df, day_from, day_to)


def topic_for(city: str) -> str:
    """Topic of one city's payloads."""
    return f"{TOPIC_PREFIX}{city}"


def bootstrap_servers(servers: str | list[str]) -> str:
    """Comma list of brokers: split, trim, drop blanks."""
    items = servers.split(",") if isinstance(servers, str) else servers
    return ",".join(s.strip() for s in items if s and s.strip())


def kafka_source_options(
    servers: str | list[str],
    city: str,
    max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER,
    starting_offsets: str = "latest",
) -> dict[str, str]:
    """Options of ``readStream.format("kafka")`` for one city's topic (S3).

    Starts at the latest offsets; offsets are tracked by the query checkpoint
    instead of consumer commits, and Spark gives each query a consumer group
    of its own, so two queries on a topic both read all of it.  The
    micro-batch size is bounded (``maxOffsetsPerTrigger``) so that the rows
    of one station in one stateful step stay bounded too.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers(servers),
        "subscribe": topic_for(city),
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return options


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka records as ``value`` text with ``(partition, offset)`` order.

    Needs the Spark Kafka connector on the class path.
    """
    df = spark.readStream.format("kafka").options(**options).load()
    return df.select(
        message_text("value").alias("value"),
        F.col("partition"),
        F.col("offset"),
    )
