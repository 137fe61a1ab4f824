"""Change detection of a stream by micro-batches of the batch operator.

The stateful step (:mod:`airtrace.streaming.dedup_state`) passes a station's
rows of one micro-batch through one task.  Here each micro-batch runs the
sliced batch operator instead, which spreads a hot station over many tasks, and the state (one version per station) is a Parquet table per
micro-batch.  Nothing depends on a partition count that was fixed at the
first start, and a new checkpoint can be seeded with any station state.

Both the output and the state of a micro-batch go to folders named by its
number and are overwritten, so a micro-batch that is run again after a
failure replaces what it had written.  A state counts from when its marker
file is there, which is written last; a micro-batch whose predecessor has no
finished state is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airtrace.operators.dedup import drop_repeats, station_state
from airtrace.paths import file_system
from airtrace.plans.reports import materialize
from airtrace.session import delete_scratch, scratch_made

_SEED = "seed"
_MARKER = "_station_state_complete"
#: States kept behind the newest one, for a micro-batch that runs again.
_KEEP_STATES = 2


def _folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch={batch_id:012d}"


def _write_state(state: DataFrame, place: str) -> None:
    """Overwrite a state, then mark it as complete."""
    fs, marker = file_system(state.sparkSession, f"{place}/{_MARKER}")
    fs.delete(marker, False)
    state.write.mode("overwrite").parquet(place)
    fs.create(marker, True).close()


def _read_state(spark: SparkSession, path: str, batch_id: int, like: DataFrame) -> DataFrame | None:
    """The state before this micro-batch: that of the one before, or the seed.

    Only the first micro-batch of a checkpoint begins with the seed, or with
    nothing where there is none.
    """
    place = _folder(path, batch_id - 1) if batch_id else f"{path.rstrip('/')}/{_SEED}"
    fs, marker = file_system(spark, f"{place}/{_MARKER}")
    if fs.exists(marker):
        return spark.read.schema(like.schema).parquet(place)
    if batch_id or fs.exists(marker.getParent()):
        raise RuntimeError(f"the station state {place} is missing or was not finished")
    return None


def seed_state(state: DataFrame, state_path: str) -> None:
    """Station state (:func:`station_state`) that a new checkpoint begins with."""
    _write_state(state, f"{state_path.rstrip('/')}/{_SEED}")


def start_sliced_dedup(
    stream: DataFrame,
    out_path: str,
    state_path: str,
    checkpoint: str,
    key: str = "station_key",
    version: str = "timestamp",
    order: str | list[str] = "seq",
    slice_size: int | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Write the records of a stream whose version changed, exactly once.

    ``out_path`` gets one Parquet folder per micro-batch (``batch=<number>``;
    :func:`read_sliced` reads them).  The arrival order must not go back from
    one micro-batch to the next.  Each micro-batch costs one pass over the
    station states besides its own rows.
    """
    sliced = {} if slice_size is None else {"slice_size": slice_size}
    last = f"last_{version}"

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_made() as made:
            rows = materialize(batch)  # read again by the state
        try:
            latest = station_state(rows, key, version, order)
            before = _read_state(spark, state_path, batch_id, latest)
            kept = drop_repeats(rows, key, version, order, initial_state=before, **sliced)
            kept.write.mode("overwrite").parquet(_folder(out_path, batch_id))
            after = latest
            if before is not None:
                older = before.withColumnRenamed(last, "_older")
                after = latest.join(older, key, "full").select(key, F.coalesce(last, "_older").alias(last))
            _write_state(after, _folder(state_path, batch_id))
        finally:
            delete_scratch(spark, made)
        fs, old = file_system(spark, _folder(state_path, batch_id - _KEEP_STATES))
        fs.delete(old, True)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_sliced(spark: SparkSession, out_path: str, schema) -> DataFrame:
    """All records that the micro-batches have kept."""
    return spark.read.schema(schema).parquet(f"{out_path.rstrip('/')}/batch=*")
