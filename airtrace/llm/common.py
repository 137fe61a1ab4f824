"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrace.session import scratch_path

#: A group is hot when it holds more than 1/HOT_SHARE of all rows, so there
#: are fewer than HOT_SHARE hot groups: the bound of what is broadcast.
HOT_SHARE = 500


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_through(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files that every executor sees, so a lost
    executor costs only its running tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that are built and run inside the block delete their shuffle files at their end.

    For results that come to the driver or go to files, and whose frames are
    not used again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def whole_text(text: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def fold(doc_id: str, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % F.lit(n)


def fold_of(doc_id: object, n: int) -> int:
    """:func:`fold` outside Spark, for tests."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def left_join_groups(
    rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, row_id: Column
) -> DataFrame:
    """``rows`` left-joined with one row per group, hot groups split.

    ``key`` is a string column of both sides (unique in ``groups``), ``size``
    the group's row count, ``total`` the number of all rows.  Groups above
    ``total / HOT_SHARE`` rows, fewer than ``HOT_SHARE`` of them, are
    broadcast; their rows then take a key of their own (from ``row_id``), so
    the shuffle of the second join deals no group of more than
    ``total / HOT_SHARE`` rows.  Rows with a null key match nothing and are
    dealt by ``row_id`` too.
    """
    is_hot = F.col(size) * F.lit(HOT_SHARE) > F.lit(total)
    cols = [c for c in groups.columns if c != key]
    hot = groups.where(is_hot).select(key, F.struct(*cols).alias("_hot"))
    cold = groups.where(~is_hot).select(F.col(key).alias("_key"), F.struct(*cols).alias("_cold"))
    dealt = F.when(
        F.col("_hot").isNull() & F.col(key).isNotNull(), F.concat(F.lit("k"), F.col(key))
    ).otherwise(F.concat(F.lit("r"), F.coalesce(row_id.cast("string"), F.lit(""))))
    joined = (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn("_key", dealt)
        .join(cold.withColumn("_key", F.concat(F.lit("k"), "_key")), "_key", "left")
    )
    found = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[found[c].alias(c) for c in cols])


def key_bitmap(keys: DataFrame, hashed: Column, bits: int) -> DataFrame:
    """The 64-bit numbers ``hashed`` of ``keys`` as a bitmap of ``2**bits`` bits.

    One row for each page of 32,768 bits (``_page``, ``_map``); at most
    ``2**bits / 8`` bytes whatever the number of keys, so it may be broadcast.
    """
    slot = hashed.bitwiseAND(F.lit((1 << bits) - 1))
    return (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 15).alias("_page"))
        .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767))).alias("_map"))
    )


def mark_keys(rows: DataFrame, bitmap: DataFrame, hashed: Column, bits: int, out: str) -> DataFrame:
    """``rows`` with ``out``: whether the bitmap may hold ``hashed``.

    Never false for a key it was built from; true for others that share a bit.
    """
    slot = hashed.bitwiseAND(F.lit((1 << bits) - 1))
    place = (F.shiftright(slot, 3).bitwiseAND(F.lit(4095)) + 1).cast("int")
    byte = F.conv(F.hex(F.substring("_map", place, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, slot.bitwiseAND(F.lit(7)).cast("int"))
    return (
        rows.withColumn("_page", F.shiftright(slot, 15))
        .join(F.broadcast(bitmap), "_page", "left")
        .withColumn(out, F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False)))
        .drop("_page", "_map")
    )


def split_by_keys(docs: DataFrame, id_col: str, ids: DataFrame, bits: int = 24) -> tuple[DataFrame, DataFrame]:
    """``docs`` as (_row, a struct of all columns), parted by the ids in ``ids``.

    The second part holds all rows whose id is among ``ids`` (one column) and
    a few others that share a bit of the fixed-size bitmap; rows of the first
    part are none of them and need no join, so their texts are not shuffled.
    Null ids are told apart like any other.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    bitmap = key_bitmap(ids, F.xxhash64(F.col(ids.columns[0])), bits)
    marked = mark_keys(rows, bitmap, F.xxhash64(F.col("_row")[id_col]), bits, "_marked")
    return marked.where("NOT _marked").select("_row"), marked.where("_marked").select("_row")
