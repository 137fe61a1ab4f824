"""Importance resampling towards a target distribution by hashed n-grams.

Texts are described by the buckets of their n-grams.  A bucket's gain is the
(smoothed, scaled) logarithm of its share among the target's n-grams over its
share among all documents; a document's weight is the floored mean of the
gains over its n-grams.  Weight plus a Gumbel number drawn from a hash of
the document's id is its score, and the highest scores are drawn: sampling
without replacement in proportion to the importance, the same wherever it
runs.

The n-grams of a block of text are interned in an open-addressed numpy table
(:class:`GramTable`): 64-bit xxhash keys, linear probing, the bytes of every
occurrence compared with those of the slot that it is put in, so two n-grams
never share a slot.  A slot holds its n-gram's bucket and count, so the
bucket's CRC is taken once for each distinct n-gram of a block.  Counting
adds up the slots' counts; weighing gathers the gains by the occurrences'
slots.  Blocks hold ``BLOCK`` n-grams, also of a text that is longer.

Only the buckets' counts (``buckets`` numbers a table) pass the driver.  The
ranks need no window over all rows: scores are integers, so a histogram of
them (its size is that of their range, not of the data) gives the score that
the draw ends at; only rows from that score on are sorted, by ranges, and
numbered inside each range from the count of those before it.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrace.llm.common import shuffle_partitions, whole_text, write_through

BUCKETS = 10_000
SEED = 2024
#: Hundredths of the long enough documents that are drawn, and their words.
PERCENT = 10
LEAST_WORDS = 20
#: n-grams interned at once, and bytes of a text split into words at once.
BLOCK = 1 << 17
_PIECE = 1 << 19
_SCALE = 1000
#: Bytes of words, with A-Z in lower case; all others become blanks.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


class GramTable:
    """The n-grams of a block, interned by open addressing.

    ``slot`` holds the slot of each occurrence, ``count`` and ``bucket`` what
    each slot holds; free slots have the count 0.
    """

    def __init__(self, grams: list[bytes], buckets: int) -> None:
        from xxhash import xxh64_intdigest

        n = len(grams)
        size = 1 << max(4, (2 * n - 1).bit_length())
        keys = np.fromiter(map(xxh64_intdigest, grams), np.uint64, n)
        owner = np.full(size, -1, dtype=np.int64)  # the occurrence whose bytes the slot holds
        at = (keys & np.uint64(size - 1)).astype(np.int64)
        self.slot = np.zeros(n, dtype=np.int64)
        todo = np.arange(n)
        while len(todo):
            here = at[todo]
            free = owner[here] < 0
            owner[here[free]] = todo[free]  # of several, one gets the slot
            held = owner[here]
            same = keys[held] == keys[todo]
            mine = map(grams.__getitem__, todo[same].tolist())
            theirs = map(grams.__getitem__, held[same].tolist())
            same[same] = np.fromiter(map(operator.eq, mine, theirs), bool, int(same.sum()))
            self.slot[todo[same]] = here[same]
            todo = todo[~same]
            at[todo] = (at[todo] + 1) & (size - 1)
        used = np.flatnonzero(owner >= 0)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, dtype=np.int64)
        self.bucket[used] = [crc32(grams[i]) % buckets for i in owner[used].tolist()]


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, piece by piece."""
    folded = text.translate(_FOLD)
    start, end = 0, len(folded)
    while start < end:
        cut = end if end - start <= _PIECE else folded.find(b" ", start + _PIECE)
        cut = end if cut < 0 else cut
        yield folded[start:cut].split()
        start = cut


def text_grams(text: bytes, n: int) -> Iterator[tuple[int, list[bytes]]]:
    """(words, n-grams) of each piece: runs of 1 to ``n`` words, joined by a blank."""
    before: list[bytes] = []
    for words in _words(text):
        row = before + words
        grams = list(words)
        for width in range(2, n + 1):
            first = max(0, len(before) - width + 1)
            grams += [b" ".join(row[i : i + width]) for i in range(first, len(row) - width + 1)]
        yield len(words), grams
        before = row[len(row) - n + 1 :] if n > 1 else []


def _blocks(texts: pa.Array, n: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(n-grams, row of each, words found by row) of about ``BLOCK`` n-grams."""
    grams: list[bytes] = []
    rows: list[int] = []
    sizes: list[int] = []
    words = np.zeros(len(texts), dtype=np.int64)
    for row, text in enumerate(texts):
        for found, piece in text_grams(text.as_py(), n):
            words[row] += found
            for at in range(0, len(piece), BLOCK):
                part = piece[at : at + BLOCK]
                grams += part
                rows.append(row)
                sizes.append(len(part))
                if len(grams) >= BLOCK:
                    yield grams, np.repeat(rows, sizes), words
                    grams, rows, sizes, words = [], [], [], np.zeros_like(words)
    yield grams, np.repeat(np.array(rows, dtype=np.int64), sizes), words


def _binary(text: str) -> Column:
    return whole_text(text).cast("binary").alias("_text")


def bucket_counts(
    table: DataFrame, *, text_col: str = "text", n: int = 1, buckets: int = BUCKETS
) -> np.ndarray:
    """How often the n-grams of all texts fall in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for grams, _, _ in _blocks(batch.column(0), n):
                if grams:
                    interned = GramTable(grams, buckets)
                    total += np.bincount(interned.bucket, interned.count, buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["bucket", "n"])

    found = (
        table.select(_binary(text_col)).mapInArrow(count, "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    counts = np.zeros(buckets, dtype=np.int64)
    for row in found:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(target: np.ndarray, everything: np.ndarray) -> np.ndarray:
    """Each bucket's gain from its counts in the target and in all documents."""
    size, s_all, t_all = len(target), int(everything.sum()), int(target.sum())
    return np.array(
        [
            math.floor(_SCALE * math.log(float((t + 1) * (s_all + size)) / float((s + 1) * (t_all + size))))
            for s, t in zip(everything.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def weigh(
    docs: DataFrame, gain: np.ndarray, *, text_col: str = "text", n: int = 1, out: str = "_weighed"
) -> DataFrame:
    """``docs`` with the struct ``out``: ``words``, ``features`` and ``weight``.

    A null text counts as empty; a text without n-grams has the weight 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            words, features, total = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
            for grams, rows, found in _blocks(texts, n):
                words += found
                if grams:
                    interned = GramTable(grams, len(shared.value))
                    each = shared.value[interned.bucket][interned.slot]
                    features += np.bincount(rows, minlength=len(texts))
                    # whole numbers far below 2**53: sums of doubles are exact
                    total += np.bincount(rows, each, len(texts)).astype(np.int64)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.StructArray.from_arrays(
                [pa.array(words), pa.array(features), pa.array(weight)], ["words", "features", "weight"])

    measured = F.arrow_udf(measure, "words long, features long, weight long")
    return docs.withColumn(out, measured(_binary(text_col)))


def gumbel(seed: int, id_col: str) -> Column:
    """floor(1000 g) of a Gumbel number g drawn from a hash of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


def _ranked(scored: DataFrame, draw: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... of the ``draw`` highest ``_score``."""
    none = F.lit(None).cast("long")
    if not draw:
        return scored.withColumn("rank", none)
    eligible = F.col("_eligible")
    # as many rows as whole numbers in the range of the scores, however many documents
    histogram = scored.where(eligible).groupBy("_score").agg(F.count("*").alias("n")).collect()
    cut, above = 0, 0
    for row in sorted(histogram, key=operator.itemgetter("_score"), reverse=True):
        cut, above = row["_score"], above + row["n"]
        if above >= draw:
            break
    near = eligible & (F.col("_score") >= F.lit(cut))
    order = [F.desc("_score"), F.asc_nulls_last("_id"), F.asc("_features"), F.asc("_weight")]
    placed = write_through(
        scored.where(near).repartitionByRange(shuffle_partitions(scored.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        # the low 33 bits count the rows of a partition in their order
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "importance-ranges")
    sizes = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    before = scored.sparkSession.createDataFrame(starts, "_part int, _before long")
    rank = F.col("_before") + F.col("_at") + 1
    numbered = placed.join(F.broadcast(before), "_part").withColumn("rank", F.when(rank <= draw, rank))
    rest = scored.where(~near).withColumn("rank", none)
    return numbered.select(*rest.columns).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    target_text_col: str = "text", n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
    least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: its importance for ``target``, and its rank.

    Returns ``id_col``, ``n_features`` (n-grams, repeats counted), ``weight``,
    ``score`` and ``rank``: 1, 2, ... of the ``percent`` hundredths (rounded
    down) of the documents with at least ``least_words`` words that score
    highest, null for the others.  Ties of the score go to the smaller id, a
    null id last; then to fewer features and the smaller weight.

    Null and empty texts have no n-grams: weight 0, never drawn (unless
    ``least_words`` is 0).  Rows that repeat an id are documents of their
    own that share the random number; identical rows get ranks of their own.
    A null id draws as the empty text.  Texts of any length are split and
    interned piece by piece.  Other columns are ignored.  Without documents
    the result is empty; without a target every gain is that of smoothing
    alone.
    """
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    gain = gains(
        bucket_counts(target, text_col=target_text_col, n=n, buckets=buckets),
        bucket_counts(base, text_col="_text", n=n, buckets=buckets),
    )
    weighed = weigh(base, gain, text_col="_text", n=n)
    scored = write_through(
        weighed.select("_id", F.col("_weighed.features").alias("_features"),
                       F.col("_weighed.weight").alias("_weight"), F.col("_weighed.words").alias("_words"))
        .select("_id", "_features", "_weight", (F.col("_weight") + gumbel(seed, "_id")).alias("_score"),
                (F.col("_words") >= least_words).alias("_eligible")),
        "importance-scores")
    draw = scored.where("_eligible").count() * percent // 100
    return _ranked(scored, draw).select(
        F.col("_id").alias(id_col), F.col("_features").alias("n_features"), F.col("_weight").alias("weight"),
        F.col("_score").alias("score"), "rank",
    )

