"""Compaction of small files, day by day, beside an archive that still grows (K2, K5).

A stream leaves up to one file per task, day and micro-batch, and readers of a
streamed folder see what the sink's log lists, so its files cannot be replaced
in place.  Compaction writes *generations* beside the archive instead: the
small files of a day are packed into bins of about ``target_bytes`` (first fit
by decreasing size), each bin becomes one Parquet file, and a manifest - one
new file, put in place by a rename - names, for each day, the generations and
the archive files that they stand for.  Readers take the newest manifest: what
it covers from the generations, all other files from the archive, so rows that
arrive meanwhile are seen once.  A reader that has begun with an older
manifest still finds its generations until :func:`drop_generations`.

Only names and sizes of files pass the driver.
"""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from airtrace.paths import file_system

TARGET_BYTES = 128 << 20
_MANIFEST = re.compile(r"^manifest-([0-9]{9})\.json$")
_DAY = re.compile(r"/day=([^/]*)/")


def _with_day(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("day", StringType(), True)])


def _files(spark: SparkSession, path: str, schema: StructType, fmt: str) -> list[str]:
    """The files that a reader of ``path`` sees, by the sink's log if there is one."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    return [unquote(f) for f in spark.read.schema(schema).format(fmt).load(path).inputFiles()]


def _day_of(file: str) -> str | None:
    found = _DAY.search(file)
    return unquote(found.group(1)) if found else None


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    found = [(m, s.getPath().toString()) for s in fs.listStatus(at) if (m := _MANIFEST.match(s.getPath().getName()))]
    return sorted((int(m.group(1)), place) for m, place in found)


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest: ``generations`` (folders) and ``covered`` (archive files) by day."""
    found = _manifests(spark, path)
    if not found:
        return {"number": 0, "days": {}}
    text = "\n".join(r["value"] for r in spark.read.text(found[-1][1], wholetext=True).collect())
    return json.loads(text)


def _write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    """Put a manifest in place under a new number; an error if another writer was first."""
    fs, at = file_system(spark, f"{path}/manifest-{manifest['number']:09d}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(json.dumps(manifest).encode()))
    stream.close()
    if fs.exists(at) or not fs.rename(draft, at):
        fs.delete(draft, False)
        raise RuntimeError(f"another compaction has written {at.toString()}")


def pack_bins(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Files in bins of at most ``target`` bytes (or one file): first fit, largest first."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda f: (-f[1], f[0])):
        for i, (used, names) in enumerate(bins):
            if used + size <= target:
                names.append(name)
                bins[i] = (used + size, names)
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins]


def compact_days(
    spark: SparkSession, archive: str, compacted: str, schema: StructType, fmt: str = "json",
    day_from: str | None = None, day_to: str | None = None, target_bytes: int = TARGET_BYTES,
) -> int:
    """Pack the uncovered small files of a day range into a new generation.

    ``schema`` is that of the rows without ``day``.  Files of ``target_bytes``
    or more, and days with a single file, stay as they are.  Returns the
    number of files that were packed.
    """
    compacted = compacted.rstrip("/")
    manifest = read_manifest(spark, compacted)
    with_day = _with_day(schema)
    covered = {day: set(entry["covered"]) for day, entry in manifest["days"].items()}
    by_day: dict[str, dict[str, int]] = {}
    for file in _files(spark, archive, with_day, fmt):
        day = _day_of(file)
        if day is None or (day_from is not None and day < day_from) or (day_to is not None and day > day_to):
            continue
        if file in covered.get(day, ()):
            continue
        fs, at = file_system(spark, file)
        size = fs.getFileStatus(at).getLen()
        if size < target_bytes:
            by_day.setdefault(day, {})[file] = size
    bins = [
        (day, number, file)
        for day, sizes in sorted(by_day.items()) if len(sizes) > 1
        for number, names in enumerate(pack_bins(sizes, target_bytes)) for file in names
    ]
    if not bins:
        return 0
    number = manifest["number"] + 1
    generation = f"{compacted}/generation-{number:09d}-{uuid.uuid4().hex[:8]}"
    own = {(day, b): i for i, (day, b) in enumerate(sorted({(d, b) for d, b, _ in bins}))}
    places = spark.createDataFrame(
        [(day, file.rsplit("/", 1)[-1], own[day, b]) for day, b, file in bins], "day string, _file string, _bin int")
    rows = (
        spark.read.schema(with_day).format(fmt).option("basePath", archive).load([f for _, _, f in bins])
        .withColumn("_file", F.col("_metadata.file_name"))
    )
    (
        rows.join(F.broadcast(places), ["day", "_file"], "left")
        .withColumn("_bin", F.coalesce("_bin", F.raise_error(F.concat(F.lit("unlisted file "), "_file")).cast("int")))
        .repartitionById(len(own), F.col("_bin")).drop("_file", "_bin")
        .write.partitionBy("day").parquet(generation)
    )
    for day, _, file in bins:
        entry = manifest["days"].setdefault(day, {"generations": [], "covered": []})
        entry["covered"].append(file)
        if generation not in entry["generations"]:
            entry["generations"].append(generation)
    _write_manifest(spark, compacted, {**manifest, "number": number})
    return len(bins)


def read_compacted(
    spark: SparkSession, archive: str, compacted: str, schema: StructType, fmt: str = "json",
    day_from: str | None = None, day_to: str | None = None,
) -> DataFrame:
    """All rows of an archive, compacted or not, with ``day``."""
    manifest = read_manifest(spark, compacted.rstrip("/"))
    with_day = _with_day(schema)

    def wanted(day: str) -> bool:
        return (day_from is None or day >= day_from) and (day_to is None or day <= day_to)

    covered = {f for entry in manifest["days"].values() for f in entry["covered"]}
    rest = [f for f in _files(spark, archive, with_day, fmt)
            if f not in covered and (day := _day_of(f)) is not None and wanted(day)]
    parts = []
    if rest:
        parts.append(spark.read.schema(with_day).format(fmt).option("basePath", archive).load(rest))
    by_generation: dict[str, list[str]] = {}
    for day, entry in sorted(manifest["days"].items()):
        for generation in entry["generations"] if wanted(day) else ():
            by_generation.setdefault(generation, []).append(day)
    for generation, days in by_generation.items():
        parts.append(spark.read.schema(with_day).parquet(generation).where(F.col("day").isin(days)))
    if not parts:
        return spark.createDataFrame([], with_day)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_generations(spark: SparkSession, compacted: str, keep: int = 1) -> int:
    """Delete manifests but the ``keep`` newest, and generations that none of those names."""
    compacted = compacted.rstrip("/")
    found = _manifests(spark, compacted)
    kept = set()
    for _, place in found[-keep:]:
        text = "\n".join(r["value"] for r in spark.read.text(place, wholetext=True).collect())
        kept |= {g for entry in json.loads(text)["days"].values() for g in entry["generations"]}
    fs, at = file_system(spark, compacted)
    gone = 0
    for _, place in found[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(place), False)
    names = {k.rsplit("/", 1)[-1] for k in kept}
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith("generation-") and name not in names:
            gone += bool(fs.delete(status.getPath(), True))
    return gone
