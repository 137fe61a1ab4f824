"""Best-fit packing of token sequences after Martello-Toth reduction.

Documents become pieces of at most ``capacity`` tokens.  How pieces are
packed depends on their lengths alone, so the instance is the histogram of
lengths: at most ``capacity`` numbers, however many documents there are.
The plan is made on that histogram, with multiplicities:

1. Reduction by dominance.  For the longest piece left, a set of one, two or
   three pieces is fixed as a sequence when every other feasible set with
   that piece could be exchanged for it without needing more sequences
   (:func:`_dominating`); it is fixed as many times as the criterion holds.
2. The pieces that no criterion settles are packed best-fit, longest first:
   into the fullest open sequence they fit, else into new ones.

The plan is a list of patterns (lengths, times).  Every piece gets a rank
among the pieces of its length, by counts per (length, cell) and a window
inside each cell, where a cell is a hash of the piece: no length is dealt to
one task.  Length and rank then name the piece's pattern, sequence and
offset by a search in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from airtrace.llm.common import shuffle_partitions, whole_text, write_through
from airtrace.llm.tokens import vocabulary, vocabulary_path

CAPACITY = 2048
END_ID = 0

Pattern = tuple[tuple[int, int], ...]  # ((length, copies), ...), longest first


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens; the first may be shorter."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def token_pieces(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its token ids and then the end id; a null text is empty
    and so one piece of one id.  ``ids_crc32`` is taken over the ids as
    little-endian unsigned 32-bit numbers; ``with_ids`` adds the ids
    themselves (``ids``, binary of that form).
    """
    path = path or vocabulary_path()
    rows = docs.select(F.col(id_col), whole_text(text_col).alias("_text"))
    longs = ("piece", "start", "length", "ids_crc32")
    fields = [rows.schema[id_col], *[StructField(c, LongType()) for c in longs]]
    schema = StructType(fields)
    if with_ids:
        schema = schema.add("ids", "binary")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        end = np.uint32(END_ID).tobytes()
        for batch in batches:
            rows, cols, blobs = [], [[] for _ in longs], []
            for row, text in enumerate(batch.column("_text")):
                ids = v.ids(text.as_py()).astype("<u4", copy=False).tobytes() + end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    blob = ids[4 * start : 4 * (start + length)]
                    rows.append(row)
                    for col, value in zip(cols, (k, start, length, zlib.crc32(blob)), strict=True):
                        col.append(value)
                    if with_ids:
                        blobs.append(blob)
            names = [id_col, *longs]
            arrays = [batch.column(id_col).take(pa.array(rows, pa.int64()))]
            arrays += [pa.array(c, pa.int64()) for c in cols]
            if with_ids:
                names.append("ids")
                arrays.append(pa.array(blobs, pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(pieces, schema)


def _dominating(left: np.ndarray, j: int, capacity: int) -> tuple[tuple[int, ...], int] | None:
    """A set of lengths that dominates every feasible set with length ``j``.

    ``left`` counts the pieces left by length (one of ``j`` is set aside).
    Returns the other lengths of the set and how often it can be fixed.
    With room r beside j, the criteria are: nothing else fits; some length is
    exactly r; two others never fit, so the largest that fits is best; three
    others never fit, and the largest that fits (a) leaves room for one (b)
    at least as long as the shorter of any feasible pair.
    """
    room = capacity - j
    others = left.copy()
    others[j] -= 1
    sizes = np.flatnonzero(others[: room + 1])
    if not len(sizes):
        return (), int(left[j])
    if others[room]:
        return (room,), int(left[j] // 2 if room == j else min(left[j], left[room]))
    smallest: list[int] = []
    for s in np.flatnonzero(others)[:3]:
        smallest += [int(s)] * int(min(3, others[s]))
    a = int(sizes[-1])
    if len(smallest) < 2 or sum(smallest[:2]) > room:
        return (a,), int(left[j] // 2 if a == j else min(left[j], left[a]))
    if len(smallest) >= 3 and sum(smallest[:3]) <= room:
        return None
    others[a] -= 1
    fits = np.flatnonzero(others[: room - a + 1])
    others[a] += 1
    if not len(fits):
        return None
    b = int(fits[-1])
    halves = sizes[sizes <= room // 2]  # the shorter of a pair is at most half of the room
    shorter = 0
    if len(halves):
        top = int(halves[-1])
        alone = others[top] < 2 and not np.any(others[top + 1 : room - top + 1])
        shorter = int(halves[-2]) if alone and len(halves) > 1 else (0 if alone else top)
    if shorter > b:
        return None
    need: dict[int, int] = {}
    for s in (j, a, b):
        need[s] = need.get(s, 0) + 1
    return (a, b), int(min(left[s] // k for s, k in need.items()))


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used, for pieces counted by length."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"no piece of {length} tokens fits {capacity}")
        left[length] += n
    used: dict[Pattern, int] = {}

    def fix(lengths: tuple[int, ...], times: int) -> None:
        pattern = tuple((s, lengths.count(s)) for s in sorted(set(lengths), reverse=True))
        used[pattern] = used.get(pattern, 0) + times
        for s, k in pattern:
            left[s] -= k * times

    for j in range(capacity, 0, -1):
        while left[j] and (found := _dominating(left, j, capacity)) and found[1]:
            fix((j, *found[0]), found[1])
    _best_fit(left, capacity, used)
    return sorted(used.items(), reverse=True)


def _best_fit(left: np.ndarray, capacity: int, used: dict[Pattern, int]) -> None:
    """Best-fit decreasing over counted lengths, into ``used``."""
    open_by_room: list[dict[Pattern, int]] = [{} for _ in range(capacity + 1)]

    def put(pattern: Pattern, room: int, times: int) -> None:
        if times:
            at = open_by_room[room]
            at[pattern] = at.get(pattern, 0) + times

    for length in range(capacity, 0, -1):
        n = int(left[length])
        room = length
        while n and room <= capacity:
            at = open_by_room[room]
            if not at:
                room += 1
                continue
            pattern, times = at.popitem()
            each = min(room // length, n)  # one sequence is filled before the next is begun
            full = min(times, n // each)
            put(pattern, room, times - full)
            put((*pattern, (length, each)), room - each * length, full)
            n -= full * each
            room = length
        each = capacity // length
        put(((length, each),), capacity - each * length, n // each)
        if n % each:
            put(((length, n % each),), capacity - (n % each) * length, 1)
    for at in open_by_room:
        for pattern, times in at.items():
            used[pattern] = used.get(pattern, 0) + times


def lay_out(patterns: list[tuple[Pattern, int]]) -> tuple[np.ndarray, ...]:
    """The plan as arrays sorted by (length, first rank), to be searched.

    Row i covers the ranks of one length in one pattern: ``key`` is
    ``length << 44 | first rank``, then the first sequence, the copies of the
    length in each sequence and the offset of the first copy.
    """
    next_rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, copies in pattern:
            rank = next_rank.get(length, 0)
            rows.append((length << 44 | rank, sequence, copies, offset))
            next_rank[length] = rank + copies * times
            offset += length * copies
        sequence += times
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) if rows else ()


def digested(packed: DataFrame) -> DataFrame:
    """Pieces packed ``with_ids``: ``ids_crc32`` taken of the ids as they
    arrive from the packing, in place of the ids."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def pack(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns the columns of :func:`token_pieces` with ``sequence_id`` and
    ``offset``; the pieces of a sequence follow each other from offset 0
    without a gap.  Rows that repeat a document are packed each; which of
    them goes where is open.  Null texts are empty, null ids stay null, other
    columns are ignored, an empty table gives an empty result.
    """
    pieces = write_through(
        token_pieces(docs, id_col=id_col, text_col=text_col, capacity=capacity, path=path,
                     with_ids=with_ids),
        "pieces", compression="zstd" if with_ids else "snappy",
    )
    cells = shuffle_partitions(docs.sparkSession)
    celled = pieces.withColumn("_cell", F.pmod(F.xxhash64(F.col(id_col), "piece", "ids_crc32"), F.lit(cells)))
    by_cell = celled.groupBy("length", "_cell").agg(F.count("*").alias("n")).persist()
    counts = {r["length"]: r["n"] for r in by_cell.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    arrays = lay_out(plan_patterns(counts, capacity))
    order = Window.partitionBy("length").orderBy("_cell")
    before = by_cell.select("length", "_cell", (F.sum("n").over(order) - F.col("n")).alias("_before"))
    inside = Window.partitionBy("length", "_cell").orderBy(id_col, "piece", "ids_crc32")
    ranked = (
        celled.withColumn("_in", F.row_number().over(inside) - 1)
        .join(before, ["length", "_cell"])
        .withColumn("_rank", F.col("_before") + F.col("_in"))
    )
    if not arrays:
        return ranked.select(*pieces.columns, F.lit(0).cast("long").alias("sequence_id"),
                             F.lit(0).cast("long").alias("offset"))
    plan = docs.sparkSession.sparkContext.broadcast(arrays)

    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        key, first, copies, start = plan.value
        size, at = (np.asarray(x.to_numpy(zero_copy_only=False), dtype=np.int64) for x in (length, rank))
        row = np.searchsorted(key, size << 44 | at, side="right") - 1
        nth = at - (key[row] & ((1 << 44) - 1))
        sequence = first[row] + nth // copies[row]
        offset = start[row] + nth % copies[row] * size
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    placed = F.arrow_udf(place, "sequence_id long, offset long")
    return ranked.withColumn("_at", placed("length", "_rank")).select(
        *pieces.columns, "_at.sequence_id", "_at.offset"
    )
