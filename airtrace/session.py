"""Session access and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from airtrace.paths import file_system


def get_session(app_name: str = "airtrace") -> SparkSession:
    """Return the caller's active session, or build one without extra conf."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    return SparkSession.builder.appName(app_name).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session.  Only a local-mode session without
    the setting (tests, notebooks) gets a private folder; on a cluster an
    unset value is an error, because a machine-local folder would not be
    visible to other executors and would not survive their loss.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        try:
            conf = spark.sparkContext.getCheckpointDir()
        except Exception:  # no SparkContext in this client
            conf = None
    if conf:
        return conf.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError(
            "spark.checkpoint.dir is not set; point it at a shared folder"
        )
    local = tempfile.mkdtemp(prefix="airtrace-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", local)
    try:
        spark.sparkContext.setCheckpointDir(local)
    except Exception:
        pass
    return local.rstrip("/")


_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    What is written there serves lazy frames and so outlives the call that
    made it; :func:`clear_scratch` deletes it when they are done with.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


@contextmanager
def scratch_made() -> Iterator[list[str]]:
    """The scratch folders named inside the block, for :func:`delete_scratch`."""
    begin, made = len(_made), []
    try:
        yield made
    finally:
        made += _made[begin:]


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders whose frames are done with."""
    for path in list(paths):
        fs, at = file_system(spark, path)
        fs.delete(at, True)
        if path in _made:
            _made.remove(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process has named; how many there were.

    Frames that read them cannot be used afterwards.
    """
    count = 0
    while _made:
        fs, at = file_system(spark, _made.pop())
        count += bool(fs.delete(at, True))
    return count
