"""Centroid clustering (Lloyd's rounds) over a VA-file.

Components are scaled to whole numbers, so every distance, sum and centroid
is exact and hangs on no order.  Beside the full vectors stands the
approximation of each: a cell of ``BITS`` bits per dimension, packed without
gaps.  For a set of centroids two lookup tables give the least and the
greatest squared distance that a cell allows in its dimension; their sums
over a vector's cells bound its distance to each centroid from below and
above.  A vector whose least upper bound lies below all other lower bounds
is assigned by its cells alone.  Only vectors whose intervals overlap are
compared in full, with the smaller number winning a tie.

A centroid's sums are kept from round to round: a vector that stays adds
nothing, so besides the undecided vectors only those that change their
cluster are fetched.  The first round, which has nothing to keep, and the
last assignment, which returns exact distances, read the full vectors of all
rows, but compare only the undecided ones with all centroids.

Cell edges come from a bounded sample (``SAMPLE`` vectors, the first by the
hash that also draws the first centroids).  The outermost cells are open, so
every vector has a cell; edges decide how much is fetched, never a result.
The driver holds the sample, ``k`` centroids and tables of
``k * dims * 2**BITS`` numbers, none of which grow with the vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrace.llm.common import key_bitmap, mark_keys, write_through

K = 16
DIMS = 64
SCALE = 64
ROUNDS = 3
SEED = 1
BITS = 6
CELLS = 1 << BITS
#: Vectors that the cells' edges are taken from.
SAMPLE = 4096
#: Components are at most this large, so that distances fit in 64 bits.
LARGEST = 1 << 25
#: Above any squared difference of two components, and summable over dimensions.
_OPEN = 1 << 53
BITMAP_BITS = 24
_ROWS = 4096  # vectors bounded at once
_ASSIGNED = "row long, cells binary, cluster int, n long, sums array<long>"


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, x) of the vectors of ``dims`` finite components, scaled and floored."""
    x = F.col("_v")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    small = F.forall(x, lambda c: F.abs(c * F.lit(float(scale))) < F.lit(float(LARGEST)))
    error = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))
    return (
        vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("_v"))
        .where((F.size(x) == dims) & finite)
        .select("vec_id", F.when(small, scaled).otherwise(error.cast("array<long>")).cast("array<int>").alias("x"))
    )


def cell_edges(sample: np.ndarray) -> np.ndarray:
    """(dims, CELLS - 1) edges: cells of even width over the sample's range.

    Cell 0 holds what is below the first edge, cell i what is at or above
    edge i - 1 and below edge i.  Cells of as many vectors each leave far
    more open: their wide outer cells dominate the bounds.
    """
    low, high = sample.min(axis=0)[:, None], sample.max(axis=0)[:, None] + 1
    return np.ceil(low + (high - low) * np.linspace(0, 1, CELLS - 1)[None]).astype(np.int64)


def cells_of(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """(rows, dims) cell numbers of whole vectors."""
    return np.column_stack([np.searchsorted(edges[d], x[:, d], side="right") for d in range(x.shape[1])])


def packed(cells: np.ndarray) -> list[bytes]:
    """``BITS`` bits a cell, the last byte filled up with zeros."""
    bits = np.unpackbits(cells.astype(np.uint8)[:, :, None], axis=2)[:, :, 8 - BITS :]
    return [row.tobytes() for row in np.packbits(bits.reshape(len(cells), -1), axis=1)]


def unpacked(column: pa.Array, dims: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), -1)
    bits = np.zeros((len(raw), dims, 8), dtype=np.uint8)
    bits[:, :, 8 - BITS :] = np.unpackbits(raw, axis=1, count=dims * BITS).reshape(len(raw), dims, BITS)
    return np.packbits(bits, axis=2)[:, :, 0]


@dataclass(frozen=True)
class Bounds:
    """Lookup tables of squared distances between cells and centroids."""

    centroids: np.ndarray  # (k, dims)
    least: np.ndarray  # (k, dims * CELLS)
    most: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray, edges: np.ndarray) -> Bounds:
        k, dims = centroids.shape
        far = centroids[:, :, None]
        # first and last value of each cell; the outermost are open
        low = np.concatenate([edges[:, :1] * 0, edges], axis=1)[None]
        high = np.concatenate([edges - 1, edges[:, :1] * 0], axis=1)[None]
        below, above = far - high, low - far  # positive where the centroid is outside
        below[:, :, -1] = above[:, :, 0] = 0
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(np.abs(far - low), np.abs(far - high)) ** 2
        most[:, :, 0] = most[:, :, -1] = _OPEN
        return cls(centroids, least.reshape(k, -1), most.reshape(k, -1))

    def decide(self, cells: np.ndarray) -> np.ndarray:
        """The only centroid that can be nearest, by the cells; -1 if there are several."""
        place = cells.astype(np.int64) + np.arange(cells.shape[1]) * CELLS
        least = np.stack([table[place].sum(axis=1) for table in self.least], axis=1)
        most = np.stack([table[place].sum(axis=1) for table in self.most], axis=1)
        near = least <= most.min(axis=1)[:, None]
        return np.where(near.sum(axis=1) == 1, near.argmax(axis=1), -1)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of full vectors, of several the first."""
        return np.stack([((x - c) ** 2).sum(axis=1) for c in self.centroids], axis=1).argmin(axis=1)

    def assign(self, cells: np.ndarray, x: np.ndarray) -> np.ndarray:
        found = self.decide(cells)
        open_ = found < 0
        if open_.any():
            found[open_] = self.nearest(x[open_])
        return found


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


class _Sums:
    """Component sums and counts by cluster, of the rows of one task."""

    def __init__(self, k: int, dims: int) -> None:
        self.sums, self.counts = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)

    def add(self, cluster: np.ndarray, x: np.ndarray, sign: int = 1) -> None:
        for c in np.unique(cluster):
            own = cluster == c
            self.sums[c] += sign * x[own].sum(axis=0)
            self.counts[c] += sign * int(own.sum())

    def batch(self) -> pa.RecordBatch:
        at = np.flatnonzero(self.counts.astype(bool) | self.sums.any(axis=1))
        none = [None] * len(at)
        return pa.RecordBatch.from_arrays(
            [pa.array(none, pa.int64()), pa.array(none, pa.binary()), pa.array(at, pa.int32()),
             pa.array(self.counts[at]), pa.array(self.sums[at].tolist(), pa.list_(pa.int64()))],
            names=["row", "cells", "cluster", "n", "sums"])


def _assigned(batch: pa.RecordBatch, cluster: np.ndarray) -> pa.RecordBatch:
    n = len(cluster)
    return pa.RecordBatch.from_arrays(
        [batch.column("row"), batch.column("cells"), pa.array(cluster, pa.int32()),
         pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))],
        names=["row", "cells", "cluster", "n", "sums"])


def _with_cells(x: Column, edges: np.ndarray) -> Column:
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(packed(cells_of(_matrix(batch), edges)) if len(batch) else [], pa.binary())

    return F.arrow_udf(cut, "binary")(x)


def _first_round(file: DataFrame, bounds: Bounds) -> DataFrame:
    """Assignment of all vectors, and each task's sums (rows without ``row``)."""
    shared = file.sparkSession.sparkContext.broadcast(bounds)
    k, dims = bounds.centroids.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k, dims)
        for batch in _slices(batches):
            x = _matrix(batch.column("x"))
            cluster = shared.value.assign(unpacked(batch.column("cells"), dims), x)
            sums.add(cluster, x)
            yield _assigned(batch, cluster)
        yield sums.batch()

    return write_through(file.select("row", "cells", "x").mapInArrow(step, _ASSIGNED), "va-round")


def _later_round(file: DataFrame, before: DataFrame, bounds: Bounds) -> DataFrame:
    """The next assignment, and each task's changes of the sums.

    The cells are judged first; the full vectors of those that they leave
    open or move are fetched by a join on the row number, the scan of the
    file dropping most others by a bitmap of fixed size.
    """
    shared = file.sparkSession.sparkContext.broadcast(bounds)
    k, dims = bounds.centroids.shape

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            now = shared.value.decide(unpacked(batch.column("cells"), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("cells"), batch.column("cluster"), pa.array(now, pa.int32())],
                names=["row", "cells", "cluster", "now"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k, dims)
        for batch in _slices(batches):
            x = _matrix(batch.column("x"))
            old, now = (batch.column(c).to_numpy().astype(np.int64) for c in ("cluster", "now"))
            open_ = now < 0
            if open_.any():
                now[open_] = shared.value.nearest(x[open_])
            moved = now != old
            sums.add(old[moved], x[moved], -1)
            sums.add(now[moved], x[moved])
            yield _assigned(batch, now)
        yield sums.batch()

    judged = write_through(
        before.where("row IS NOT NULL").select("row", "cells", "cluster")
        .mapInArrow(judge, "row long, cells binary, cluster int, now int"), "va-judged")
    wanted = judged.where("now != cluster")
    hashed = F.xxhash64("row")
    full = mark_keys(file.select("row", "x"), key_bitmap(wanted, hashed, BITMAP_BITS), hashed, BITMAP_BITS, "_near")
    fetched = wanted.join(full.where("_near").select("row", "x"), "row")
    settled = judged.where("now = cluster").select(
        "row", "cells", "cluster", F.lit(None).cast("long").alias("n"), F.lit(None).cast("array<long>").alias("sums"))
    columns = ["row", "cells", "cluster", "now", "x"]
    return write_through(settled.unionByName(fetched.select(*columns).mapInArrow(compare, _ASSIGNED)), "va-round")


def _moved_sums(assigned: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The tasks' sums and counts, added up by cluster."""
    total = _Sums(k, dims)
    added = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(dims)]
    for row in assigned.where("row IS NULL").groupBy("cluster").agg(F.sum("n").alias("n"), *added).collect():
        total.counts[row["cluster"]] = row["n"]
        total.sums[row["cluster"]] = [row[f"s{d}"] for d in range(dims)]
    return total.sums, total.counts


def _last_assignment(file: DataFrame, bounds: Bounds) -> DataFrame:
    """(vec_id, cluster, distance) of all vectors."""
    shared = file.sparkSession.sparkContext.broadcast(bounds)
    dims = bounds.centroids.shape[1]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            x = _matrix(batch.column("x"))
            cluster = shared.value.assign(unpacked(batch.column("cells"), dims), x)
            distance = ((x - shared.value.centroids[cluster]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)],
                names=["vec_id", "cluster", "distance"])

    kind = file.schema["vec_id"].dataType.simpleString()
    found = file.select("vec_id", "cells", "x").mapInArrow(step, f"vec_id {kind}, cluster int, distance long")
    return write_through(found, "va-distances")


def _named(spark: SparkSession, found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``found`` with the sums of distances and the digests of the centroids."""
    own = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    total = sum(own.values())
    rows = [
        (c, own.get(c, 0), total, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(centroids.tolist())
    ]
    table = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = DIMS,
    scale: int = SCALE, k: int = K, rounds: int = ROUNDS, seed: int = SEED,
) -> DataFrame:
    """One row per usable vector: its cluster and the squared distance to it.

    Usable are vectors of ``dims`` components, none null or not finite; each
    component x becomes floor(scale * x).  The ``k`` first centroids are the
    usable vectors with the smallest SHA-256 of ``<seed>:<id>``; each round
    assigns all vectors to the nearest centroid (ties: the smaller number)
    and replaces every centroid that has vectors by the floor of their mean.
    Returns ``id_col``, ``cluster``, ``distance``, ``cluster_inertia`` and
    ``inertia`` (distances summed) and ``centroid_sha256`` (of the components
    joined by commas).

    Null, short, long and non-finite vectors are not in the result.  Rows
    that repeat an id, or have none (hashed as the empty text), are vectors
    of their own; of equal hashes the smaller vector comes first.  Equal
    vectors have equal clusters.  With fewer than ``k`` usable vectors there
    are as many centroids; without any the result is empty.  Other columns
    are ignored.  Components beyond ``LARGEST`` after scaling are an error.
    """
    spark = vectors.sparkSession
    usable = whole_vectors(vectors, id_col, vec_col, dims, scale)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = [
        r["x"] for r in usable.orderBy(F.sha2(key.cast("binary"), 256), "x").limit(max(k, SAMPLE)).collect()
    ]
    if not first:
        kind = vectors.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string")
    sample = np.array(first, dtype=np.int64)
    edges, centroids = cell_edges(sample), sample[:k]
    file = write_through(
        usable.select(F.monotonically_increasing_id().alias("row"), "vec_id",
                      _with_cells(F.col("x"), edges).alias("cells"), "x"),
        "va-file")
    assigned, sums, counts = None, 0, 0
    for _ in range(rounds):
        bounds = Bounds.of(centroids, edges)
        assigned = _first_round(file, bounds) if assigned is None else _later_round(file, assigned, bounds)
        more, n = _moved_sums(assigned, len(centroids), dims)
        sums, counts = sums + more, counts + n
        centroids = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
    found = _last_assignment(file, Bounds.of(centroids, edges))
    return _named(spark, found, centroids).withColumnRenamed("vec_id", id_col)
