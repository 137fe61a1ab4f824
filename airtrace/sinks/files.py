"""Archive writers (K1-K5), topic publishing (K7) and report output (K8)."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrace.paths import dataset_path, day_folders, file_system, is_streamed
from airtrace.schemas import CURATED_COLUMNS


def one_line(value: Column | str = "value") -> Column:
    """Message text on one line: line breaks become blanks.

    Inside valid JSON a line break can only be whitespace between tokens, so
    this keeps the payload's meaning and its key order.
    """
    col = F.col(value) if isinstance(value, str) else value
    return F.translate(col, "\r\n", "  ")


def raw_lines(df: DataFrame) -> DataFrame:
    """``value`` (one line) and ``day`` of every valid message (K1)."""
    return df.select(one_line("value").alias("value"), "day")


def curated_records(df: DataFrame) -> DataFrame:
    """Curated columns and ``day`` in record order (K2, K4)."""
    return df.select(*CURATED_COLUMNS, "day")


def _batch_writer(df: DataFrame, path: str, mode: str):
    """A day-partitioned writer; ``replace`` rewrites the days that ``df`` holds.

    A folder that a stream has written takes no batch files: readers see
    only what the stream's log lists.
    """
    if is_streamed(df.sparkSession, path):
        raise ValueError(f"{path} was written by a stream; write to another root and read both")
    writer = df.hint("rebalance", "day").write.partitionBy("day")
    if mode == "replace":
        return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    return writer.mode(mode)


def write_raw(df: DataFrame, root: str, city: str, mode: str = "append") -> None:
    """Append every valid raw message to its day folder, no de-duplication (K1).

    The text layout keeps no arrival order; to replay an archive with change
    detection write it by :func:`write_raw_ordered`.  The ``rebalance`` hint
    groups rows by day so that a batch writes few files per day, while AQE
    splits a hot day over several tasks instead of one.
    """
    path = dataset_path(root, city, "raw")
    _batch_writer(raw_lines(df), path, mode).text(path)


def write_raw_ordered(
    df: DataFrame, root: str, city: str, order: str | list[str] = "seq", mode: str = "append"
) -> None:
    """Raw messages as Parquet with their arrival order columns."""
    cols = [order] if isinstance(order, str) else list(order)
    path = dataset_path(root, city, "raw")
    lines = df.select(one_line("value").alias("value"), *cols, "day")
    _batch_writer(lines, path, mode).parquet(path)


@contextmanager
def exact_variants(spark):
    """Variants written inside the block keep the type of every number.

    Shredding by an inferred schema stores the integers of a field that also
    holds decimals as decimals, after which ``16`` and ``16.0`` are alike and
    the integer gates of curation (C3) misjudge them.
    """
    key = "spark.sql.variant.inferShreddingSchema"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old) if old else spark.conf.unset(key)


def write_raw_variant(
    df: DataFrame, root: str, city: str, order: str | list[str] = "seq", mode: str = "append"
) -> None:
    """Raw messages as their parsed VARIANT with the arrival order.

    ``df`` has ``payload`` (:func:`airtrace.operators.curation.valid_messages`),
    the order columns and ``day``.  A later
    curation, also with other fields, reads paths of the stored variant and
    parses no text; the rule for repeated keys has been applied once.
    """
    cols = [order] if isinstance(order, str) else list(order)
    path = dataset_path(root, city, "raw")
    with exact_variants(df.sparkSession):
        _batch_writer(df.select("payload", *cols, "day"), path, mode).parquet(path)


def write_curated(
    df: DataFrame, root: str, city: str, mode: str = "append",
    day_from: str | None = None, day_to: str | None = None,
) -> None:
    """Append curated records as JSON lines to their day folders (K2-K5).

    NULL fields are written (``ignoreNullFields=false``) so every line has all
    thirteen keys.  Nothing is written when the frame is empty.  The mode
    ``replace`` rewrites the days that ``df`` holds and empties the others of
    the range (of all days without a range): what was there and is no longer.
    """
    path = dataset_path(root, city, "curated")
    spark = df.sparkSession

    def files() -> dict[str, frozenset[str]]:
        return {
            day: frozenset(f.getPath().getName() for f in found) for day, found in day_folders(spark, path).items()
            if (day_from is None or day >= day_from) and (day_to is None or day <= day_to)
        }

    before = files() if mode == "replace" else {}
    _batch_writer(curated_records(df), path, mode).option("ignoreNullFields", "false").json(path)
    if not before:
        return
    after = files()
    fs, at = file_system(spark, path)
    by_name = {day: found for day, found in day_folders(spark, path).items()}
    for day, names in before.items():
        if names and after.get(day) == names:  # a rewritten day has files of new names
            fs.delete(by_name[day][0].getPath().getParent(), True)


def compact_curated(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Columnar copy of a curated archive, same schema and day layout.

    ``df`` comes from :func:`airtrace.sources.curated.read_curated`; read the
    copy back with ``read_curated(..., fmt="parquet")`` for repeated report
    runs (vectorized scan, column pruning, no JSON parsing).  ``overwrite``
    replaces the days that ``df`` holds and leaves all others.
    """
    (
        df.withColumnRenamed("storage_day", "day")
        .select(*CURATED_COLUMNS, "day")
        .hint("rebalance", "day")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Options of ``write.format("kafka")`` publishing raw payloads (K7).

    Publish ``df.select("value")`` (no key), after the optional status gate.
    """
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def publish(df: DataFrame, servers: str, topic: str, value: str = "value") -> None:
    """Publish raw payload texts to a topic, no key (K7).

    Apply the optional status gate first; needs the Spark Kafka connector.
    """
    (
        df.select(F.col(value).cast("string").alias("value"))
        .write.format("kafka")
        .options(**kafka_sink_options(servers, topic))
        .save()
    )


def write_reports(reports: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """Write each report table as Parquet below ``path`` (K8)."""
    for name, report in reports.items():
        if name == "normalized":
            continue
        report.write.mode(mode).parquet(f"{path.rstrip('/')}/{name}")
