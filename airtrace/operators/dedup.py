"""Per-station change detection (D1 batch form) and station state.

Rule: walk each station's complete records in arrival order; drop a record
iff its version (the station timestamp) equals the version of the station's
previous record; keep it otherwise.  ``A,A,B,B,A -> A,B,A``; a plain
``dropDuplicates`` would give ``A,B`` and is wrong.  Because a kept record
always becomes the station's state and a dropped one equals it, "previous
record" and "last kept record" are the same, so a ``lag`` is exact.

Plan: one exchange of the rows, on the station, and a ``lag``.  A station
with more rows than ``slice_size`` (a *hot* one) would make that one long
task, so its arrival order is cut into slices of ``slice_size`` sequence
numbers, which are exchanged and lagged on their own.  Only the first row of
a hot station's slice needs to know more: the version that the station's
previous slice ended with.  That carry has one row per slice of a hot station
(an aggregate, combined before its shuffle, and a ``lag`` over it), however
many stations there are.  Without hot stations the rows are all there is: one
scan, one exchange.

Which stations are hot is counted beforehand from the key column (combined
before its shuffle); at most ``HOT_STATIONS`` are sliced, the largest ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from airtrace.operators.curation import complete_keys

DEFAULT_SLICE_SIZE = 1 << 20
#: Bound of the keys that the driver holds; stations beyond it are smaller
#: than a ten-thousandth of the rows.
HOT_STATIONS = 10_000

_SLICE = "_slice"
_PREV = "_prev"
_CARRY = "_carry"
_LAST = "_last"
_SEEN = "_seen"


def drop_repeats(
    df: DataFrame,
    key: str = "station_key",
    version: str = "timestamp",
    order: str | list[str] | tuple[str, ...] = "seq",
    slice_size: int | None = DEFAULT_SLICE_SIZE,
    slice_cols: list[str] | tuple[str, ...] | None = None,
    initial_state: DataFrame | None = None,
    observation: Observation | str | None = None,
    hot: list[str] | None = None,
) -> DataFrame:
    """Keep records whose version changed since the station's previous one.

    ``initial_state`` (``key``, ``last_<version>``), e.g. the
    :func:`station_state` of an earlier run, continues from where that run
    stopped: a station's first record is dropped when it repeats the stored
    version.  Order columns that it has too place each stored version inside
    the arrival order; without them it stands before all records.

    ``observation`` (an :class:`Observation` or a name) counts the records
    seen and the repeats dropped while the query runs (A12).

    Records with a NULL key or version are dropped first (F3), without
    touching any station's state.  ``order`` is the arrival order, one
    column or several compared left to right (``("partition", "offset")``),
    unique per row and station.  Slices of a hot station:

    * ``slice_cols`` - explicit sortable columns that the arrival order
      refines, e.g. ``(file, block)`` of an archive with ``order="line"``;
    * else the leading order columns and ``floor(last / slice_size)`` of the
      last one, a number, date (days) or timestamp (seconds);
    * ``slice_size=None`` asks for a plain ``lag`` of every station.

    ``hot`` names the hot stations where they are known; else they are
    counted when this is called.  A hot station whose order cannot be sliced
    is an error, never one task in silence.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    complete = complete_keys(df, key, version)
    rows = with_previous(
        complete, {_SEEN: F.col(version)}, key, order_cols, slice_size, slice_cols,
        None if initial_state is None else initial_state.withColumn(_SEEN, F.col(f"last_{version}")), hot)
    repeat = F.col(_PREV)[_SEEN].eqNullSafe(F.col(version))
    if observation is not None:
        rows = rows.observe(
            observation,
            F.count(F.lit(1)).alias("complete_records"),
            F.count_if(repeat).alias("repeats_dropped"),
        )
    return rows.where(~repeat).drop(_PREV)


def hot_stations(df: DataFrame, key: str, more_than: int) -> list[str]:
    """Stations with more rows than that, the largest ``HOT_STATIONS`` of them."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)
    return [r[key] for r in counts.orderBy(F.desc("n"), key).limit(HOT_STATIONS).collect()]


def _slices(df: DataFrame, order_cols: list[str], slice_size: int | None, slice_cols) -> list[Column] | None:
    """Sortable columns that cut the arrival order, or None if nothing does."""
    if slice_cols:
        return [F.col(c) for c in slice_cols]
    last = df.schema[order_cols[-1]].dataType
    place = F.col(order_cols[-1])
    if isinstance(last, TimestampNTZType):
        place = place.cast("timestamp")
    if isinstance(last, (TimestampType, TimestampNTZType)):
        place = F.unix_seconds(place)
    elif isinstance(last, DateType):
        place = F.unix_date(place)
    elif not isinstance(last, NumericType):
        return None
    return [*(F.col(c) for c in order_cols[:-1]), F.floor(place / F.lit(int(slice_size))).cast("long")]


def with_previous(
    df: DataFrame,
    fields: dict[str, Column],
    key: str,
    order_cols: list[str],
    slice_size: int | None = DEFAULT_SLICE_SIZE,
    slice_cols: list[str] | tuple[str, ...] | None = None,
    before: DataFrame | None = None,
    hot: list[str] | None = None,
) -> DataFrame:
    """``df`` with ``_prev``: a struct of ``fields`` of the station's previous row.

    ``before`` holds rows that came earlier, with ``key``, columns named like
    the fields and maybe order columns; they are seen as previous rows but
    are not in the result.  ``_prev`` is NULL on a station's first row.
    """
    arrival = [*(slice_cols or ()), *order_cols]
    columns = df.columns
    rows = df.withColumn(_LAST, F.struct(*[c.alias(n) for n, c in fields.items()]))
    if slice_size is None and not slice_cols:
        hot = []
    elif hot is None:
        hot = hot_stations(df, key, slice_size or DEFAULT_SLICE_SIZE)
    slices = _slices(df, order_cols, slice_size or DEFAULT_SLICE_SIZE, slice_cols) if hot else []
    if slices is None:
        raise ValueError(
            f"{len(hot)} stations have more than {slice_size} rows, but their order {order_cols[-1]!r} "
            "can't be cut into slices; name slice_cols, or ask for slice_size=None")
    if before is not None:
        types = {f.name: f.dataType for f in rows.schema.fields}
        seen = before.select(
            F.col(key),
            *[(F.col(c) if c in before.columns else F.lit(None)).cast(types[c]).alias(c) for c in arrival],
            F.struct(*[F.col(n) for n in fields]).cast(types[_LAST]).alias(_LAST),
        ).where(F.col(key).isNotNull())
        rows = rows.withColumn(_SEEN, F.lit(False)).unionByName(
            seen.withColumn(_SEEN, F.lit(True)), allowMissingColumns=True)
    else:
        rows = rows.withColumn(_SEEN, F.lit(False))
    parts = [key]
    if hot:
        # one struct, so that slices with NULL parts are equal to themselves;
        # NULL for all other stations, whose rows then match no carry
        is_hot = F.col(key).isin(hot)
        rows = rows.withColumn(_SLICE, F.when(is_hot, F.struct(*slices)))
        parts = [key, _SLICE]

    along = Window.partitionBy(*parts).orderBy(*arrival)
    lagged = rows.repartition(*parts).withColumn(_PREV, F.lag(_LAST).over(along))
    if hot:
        # combined map-side: one row per slice of a hot station is exchanged
        ends = (
            rows.where(is_hot).groupBy(*parts)
            .agg(F.max_by(_LAST, F.struct(*arrival)).alias(_LAST))
            .withColumn(_CARRY, F.lag(_LAST).over(Window.partitionBy(key).orderBy(_SLICE)))
        )
        lagged = lagged.join(ends.drop(_LAST), parts, "left").withColumn(_PREV, F.coalesce(_PREV, _CARRY))
    return lagged.where(~F.col(_SEEN)).select(*columns, _PREV)


def station_state(
    df: DataFrame,
    key: str = "station_key",
    version: str = "timestamp",
    order: str | list[str] | tuple[str, ...] = "seq",
) -> DataFrame:
    """Station -> version of its last accepted record, by arrival.

    This is the state the change detection ends with: the last complete
    record's version (not the greatest one).  ``max_by`` aggregates map-side,
    so a hot station costs one partial row per task.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    position = F.struct(*order_cols) if len(order_cols) > 1 else F.col(order_cols[0])
    return (
        complete_keys(df, key, version)
        .groupBy(key)
        .agg(F.max_by(version, position).alias(f"last_{version}"))
    )
