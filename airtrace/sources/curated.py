"""Curated table scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from airtrace.paths import curated_layout, dataset_path, file_system
from airtrace.schemas import CURATED_SCHEMA, STORAGE_DAY

# The day partition column is always read as text: day keys are taken
# verbatim from the payload and need not be dates.
_SCAN_SCHEMA = StructType(CURATED_SCHEMA.fields + [StructField("day", StringType(), True)])


def read_curated(
    spark: SparkSession,
    path: str | list[str],
    day_from: str | None = None,
    day_to: str | None = None,
    fmt: str = "json",
    layout: str | None = None,
) -> DataFrame:
    """Scan curated records with the fixed schema.

    PERMISSIVE JSON parsing: unknown keys are ignored, missing keys and
    values of the wrong type become NULL, a malformed line becomes an
    all-NULL row (removed later by normalization).  A ``day=`` partitioned
    layout is read with an explicit text ``day`` column, returned as
    ``storage_day``; ``day_from``/``day_to`` become partition filters, so
    other days are never listed or opened.  ``layout="flat"`` reads a folder
    of ``<day>.jsonl`` files instead, the day taken from the file name; of a
    day range only the files so named are planned.  By
    default each folder's layout is seen from what it holds, and folders of
    both layouts may be read together (S2).
    ``fmt="parquet"`` reads a compacted copy of the same schema.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if layout is None:
        kinds = {p: curated_layout(spark, p) for p in paths}
        parts = [
            read_curated(spark, [p for p in paths if kinds[p] == kind], day_from, day_to, fmt, kind)
            for kind in sorted(set(kinds.values()))
        ]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    reader = spark.read.schema(_SCAN_SCHEMA)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    if layout == "flat" and (day_from is not None or day_to is not None):
        paths = _files_of_days(spark, paths, day_from, day_to)
        if not paths:
            return spark.createDataFrame([], _SCAN_SCHEMA).withColumnRenamed("day", STORAGE_DAY)
    df = reader.format(fmt).load(paths)
    if layout == "flat":
        # One <day>.jsonl file per day: the day is only in the file name.
        day = F.nullif(
            F.regexp_extract(F.col("_metadata.file_name"), r"^(.+)\.jsonl$", 1), F.lit("")
        )
    elif layout == "partitioned":
        # Filters on the partition column alone become partition filters.
        day = F.col("day")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    if day_from is not None:
        df = df.where(day >= day_from)
    if day_to is not None:
        df = df.where(day <= day_to)
    return df.withColumn("day", day).withColumnRenamed("day", STORAGE_DAY)


def _files_of_days(spark: SparkSession, paths: list[str], day_from: str | None, day_to: str | None) -> list[str]:
    """The ``<day>.jsonl`` files of the folders that a day range asks for."""
    found = []
    for path in paths:
        fs, at = file_system(spark, path)
        for status in fs.listStatus(at) if fs.exists(at) else ():
            name = status.getPath().getName()
            day = name.removesuffix(".jsonl")
            if not status.isFile() or day == name or name.startswith(("_", ".")):
                continue
            if (day_from is None or day >= day_from) and (day_to is None or day <= day_to):
                found.append(status.getPath().toString())
    return sorted(found)


def read_city(
    spark: SparkSession,
    root: str,
    city: str,
    day_from: str | None = None,
    day_to: str | None = None,
    layout: str | None = None,
) -> DataFrame:
    """Curated records of one city below a storage root (S1 + S2)."""
    return read_curated(
        spark, dataset_path(root, city, "curated"), day_from, day_to, layout=layout
    )
