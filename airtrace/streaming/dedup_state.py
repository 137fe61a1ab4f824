"""Change detection on a stream with per-station state (D1 stream form, D2).

A :class:`StationVersions` processor (``transformWithState``) holds one value
per station: the version (station timestamp) of its last accepted record.
The state lives in RocksDB, is committed together with each micro-batch and
the sink's log, and survives restarts from the checkpoint (W3, W4, W7).  No
watermark and no eviction: like the original consumer, every station is
remembered and late data is always accepted.

A micro-batch is exchanged once, by station, and sorted by station and arrival
in the JVM, where a sort spills.  There a ``lag`` compares each record with the
one before, which decides all but a station's first record of the micro-batch:
they are passed or dropped in the JVM.  Only a station's first and last record
go through the processor, which compares the first with the state and keeps the
last one's version.  Spark's Python runner gathers what a processor returns for
a key (and, beside an initial state, also what it gets) before passing it on,
so its memory would grow with the station; so it holds two records a station,
however many a station has.  Both paths read the same exchange, and the version
breaks ties of the arrival order, so they see the same sequence.  The processor
checks the order of what it gets; records that do not come in order are an
error, never a wrong result.

Spark's checker forbids any sort or window of a stream, since a global one
would never end.  Sorting the partitions of a micro-batch is well defined, so queries with
this step are started inside :func:`airtrace.streaming.ingest.stateful`, which
turns the checker off for the start (and puts the state into RocksDB).

A new checkpoint may begin with the state of an earlier run
(``initial_state``), whatever its number of partitions;
:func:`read_stream_state` reads that state from a checkpoint, also of a
running stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from airtrace.operators.curation import complete_keys

STATE = "last"


class StationVersions(StatefulProcessor):
    """Passes the records whose version differs from the station's last one."""

    def __init__(self, version: str, order: list[str], kind: DataType) -> None:
        self.version, self.order = version, order
        self.schema = StructType([StructField(STATE, kind, True)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState(STATE, self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        place = None
        for row in rows:
            arrival = tuple(row[c] for c in self.order)
            if place is not None and arrival < place:
                raise ValueError(f"records of station {key} do not come in the order of {self.order}")
            place = arrival
            if row[self.version] != last:  # a new station has no last version: NULL differs from all
                last = row[self.version]
                yield row
        if place is not None:
            self.last.update((last,))

    def handleInitialState(self, key: Any, initialState: Row, timerValues) -> None:
        self.last.update((initialState[STATE],))


_PACKED = "_packed"
_PREV = "_prev"
_NEXT = "_next"
_FIRST = "_first"
_JSON_EXACT = (StringType, IntegerType, LongType, DoubleType, BooleanType)


def _json_exact(dtype: DataType) -> bool:
    """Types that survive ``to_json`` -> ``from_json`` unchanged."""
    if isinstance(dtype, _JSON_EXACT):
        return True
    if isinstance(dtype, MapType):
        return isinstance(dtype.keyType, StringType) and _json_exact(dtype.valueType)
    if isinstance(dtype, ArrayType):
        return _json_exact(dtype.elementType)
    return False


def dedup_stream(
    df: DataFrame,
    key: str = "station_key",
    version: str = "timestamp",
    order: str | list[str] = "seq",
    initial_state: DataFrame | None = None,
) -> DataFrame:
    """Streaming form of :func:`airtrace.operators.dedup.drop_repeats`.

    Same rule, same result as the batch form over the same records in the
    same arrival order, also across query restarts.  Output mode ``append``:
    each accepted record is emitted once, in the micro-batch it arrives in.
    Start the query inside :func:`airtrace.streaming.ingest.stateful`.

    ``initial_state`` (``key``, ``last_<version>``; one row a station) is what
    a new checkpoint begins with; Spark ignores it on restarts.

    Only a station's first and last record of a micro-batch go through Python.
    Of these only the key, the version and the order columns need to be seen;
    the other columns are packed into one JSON text column by the JVM before
    the step and unpacked after it (when every one of them survives that round
    trip exactly), which keeps the Arrow transfer narrow.
    """
    complete = complete_keys(df, key, version)
    order_cols = [order] if isinstance(order, str) else list(order)
    used = [key, version, *order_cols]
    columns = complete.columns
    rest = [f for f in complete.schema.fields if f.name not in used]
    pack = bool(rest) and all(_json_exact(f.dataType) for f in rest)
    kind = complete.schema[version].dataType
    along = Window.partitionBy(key).orderBy(*order_cols, version)
    beside = complete.repartition(key).withColumn(_PREV, F.lag(version).over(along)).withColumn(
        _NEXT, F.lead(version).over(along))
    inside = beside.where(F.col(_PREV).isNotNull() & (F.col(_PREV) != F.col(version))).select(*columns)
    ends = beside.where(F.col(_PREV).isNull() | F.col(_NEXT).isNull())
    narrow = ends.select(
        *used, F.col(_PREV).isNull().alias(_FIRST),
        *([F.to_json(F.struct(*[f.name for f in rest])).alias(_PACKED)] if pack else [f.name for f in rest]))
    seed = None
    if initial_state is not None:
        stored = F.col(f"last_{version}").cast(kind).alias(STATE)
        seed = initial_state.select(F.col(key).cast(complete.schema[key].dataType).alias(key), stored).groupBy(key)
    first = (
        narrow.sortWithinPartitions(key, *order_cols, version).groupBy(key)
        .transformWithState(
            StationVersions(version, order_cols, kind),
            outputStructType=narrow.schema,
            outputMode="append",
            timeMode="none",
            initialState=seed,
        )
        .where(_FIRST)
    )
    if pack:
        first = first.withColumn(_PACKED, F.from_json(_PACKED, StructType(rest))).select(
            *[F.col(f"{_PACKED}.{c}").alias(c) if c not in used else F.col(c) for c in columns])
    return first.select(*columns).unionByName(inside)


def read_stream_state(
    spark: SparkSession,
    checkpoint: str,
    key: str = "station_key",
    version: str = "timestamp",
    batch_id: int | None = None,
) -> DataFrame:
    """Station state of a checkpoint of :func:`dedup_stream`.

    The snapshot after the last committed micro-batch, or after ``batch_id``
    (as long as the checkpoint retains it); the query may be running.  Same
    columns as :func:`airtrace.operators.dedup.station_state`, so it can seed
    a checkpoint with another number of partitions.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load().select(
        F.col("key").getField(key).alias(key), F.col("value").getField(STATE).alias(f"last_{version}"))
