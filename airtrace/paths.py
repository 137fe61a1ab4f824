"""Storage layout helpers.

Layout: ``<root>/<city>/<kind>/day=<YYYY-MM-DD>/part-*`` where ``kind`` is
``raw`` or ``curated``.  Unlike a single appended file per day, the ``day=``
directories let many tasks write in parallel and let readers prune days.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

_SCHEME = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://")


def normalize_path(path: str) -> str:
    """Trim, turn back-slashes into slashes, drop a trailing slash.

    A URI scheme and authority (``hdfs://nn:9000``, ``s3a://bucket``) are
    kept, since Spark needs them; a bare path is made absolute.
    """
    value = str(path).strip().replace("\\", "/")
    match = _SCHEME.match(value)
    if match:
        prefix, rest = value[: match.end()], value[match.end():]
        authority, slash, tail = rest.partition("/")
        tail = "/" + tail.strip("/") if tail.strip("/") else ""
        return f"{prefix}{authority}{tail}" if slash or tail else f"{prefix}{authority}"
    value = value.rstrip("/")
    if not value.startswith("/"):
        value = "/" + value
    return value


def join_path(root: str, *parts: str) -> str:
    """Join ``root`` with child parts; empty parts are skipped."""
    base = normalize_path(root)
    suffix = "/".join(p.strip().strip("/") for p in parts if p and p.strip("/ "))
    if not suffix:
        return base
    return f"{base.rstrip('/')}/{suffix}"


def dataset_path(root: str, city: str, kind: str) -> str:
    """Folder of one record kind (``raw`` / ``curated``) of one city."""
    return join_path(root, city, kind)


def day_path(root: str, city: str, kind: str, day: str) -> str:
    """Folder holding one day of one record kind (K5)."""
    return join_path(root, city, kind, f"day={day}")


def file_system(spark, path: str):
    """Hadoop file system and path object of a path."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def is_streamed(spark, path: str) -> bool:
    """Whether a streaming file sink has written this folder (its log is there).

    Spark reads only the files that the sink's log lists, so files that a
    batch job adds to such a folder would be invisible.
    """
    fs, at = file_system(spark, f"{path.rstrip('/')}/_spark_metadata")
    return bool(fs.exists(at))


def day_folders(spark, path: str, column: str = "day") -> dict[str, list]:
    """Day -> statuses of the files in its ``day=`` folder, as far as there are any."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return {}
    return {
        unquote(s.getPath().getName()[len(column) + 1:]): [
            f for f in fs.listStatus(s.getPath()) if f.isFile() and not f.getPath().getName().startswith((".", "_"))]
        for s in fs.listStatus(at) if s.isDirectory() and s.getPath().getName().startswith(f"{column}=")
    }


def curated_layout(spark, path: str) -> str:
    """``partitioned`` if the folder holds ``day=`` folders, else ``flat``."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return "partitioned"
    days = any(s.isDirectory() and s.getPath().getName().startswith("day=") for s in fs.listStatus(at))
    return "partitioned" if days else "flat"
