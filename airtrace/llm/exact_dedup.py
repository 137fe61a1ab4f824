"""Exact dedup by progressive refinement (DataFrame operations only).

Texts are equal when identical after every white-space character of
``[\\x20\\x09-\\x0D]`` is deleted.  The groups are refined in three steps:

1. rows are grouped by the length of the normalised text,
2. rows of a length that occurs twice or more by the hash of the text's
   first characters,
3. rows of a (length, prefix) group of two or more by the SHA-256 of the
   whole normalised text.

Each step is a scan that hashes only rows whose group survived the step
before.  Which rows those are is tested at the scan against a bitmap of a
fixed number of bits, broadcast: its size does not grow with the data, and
two groups that share a bit cost a needless hash, never a wrong result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrace.llm.common import (
    key_bitmap,
    left_join_groups,
    mark_keys,
    split_by_keys,
    whole_text,
    write_through,
)

#: log2 of the bitmap's bits: 2**24 bits are 2 MB at most.
SURVIVOR_BITS = 24
_SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def normalised(text: Column) -> Column:
    """The text without its white space."""
    for space in _SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def exact_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = 128,
    bits: int = SURVIVOR_BITS,
    hash_all: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its group of equal texts and who stays.

    Returns ``id_col``, ``keep_id`` (the id that stays), ``group_size``,
    ``kept`` and ``text_sha256``.  Of equal texts the row with the most code
    points in the original text stays, then the one with the smallest id.

    ``text_sha256`` is null for texts that the refinement told apart without
    it; ``hash_all`` asks for the digest of every row (the same scan takes
    it; the groups still come from the refinement).

    Null texts count as empty, and empty texts are equal to each other and
    to texts of white space.  A null id comes after all others: it is kept
    only if no longest row of its group has an id.  Rows that repeat an id
    are one document: flagged alike, each counted in ``group_size``.  Other
    columns of ``docs`` are ignored.  An empty table gives an empty result.
    """
    text = whole_text(text_col)
    base = docs.select(F.col(id_col).alias("_id"), normalised(text).alias("_norm"),
                       F.length(text).cast("long").alias("_chars"))
    measured = base.withColumn("_len", F.octet_length("_norm"))
    length_hash, group_hash = F.xxhash64("_len"), F.xxhash64("_len", "_prefix")

    def repeated(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)

    lengths = write_through(repeated(measured, "_len"), "exact-lengths")
    by_length = mark_keys(measured, key_bitmap(lengths, length_hash, bits), length_hash, bits, "_shared")
    prefixed = by_length.withColumn(
        "_prefix", F.when(F.col("_shared"), F.xxhash64(F.left("_norm", F.lit(prefix_chars)))))
    surviving = write_through(
        repeated(prefixed.where("_shared"), "_len", "_prefix"), "exact-prefixes")
    digest = F.sha2("_norm", 256)
    scanned = mark_keys(prefixed, key_bitmap(surviving, group_hash, bits), group_hash, bits, "_survives")
    scanned = scanned.withColumn("_sha", digest if hash_all else F.when(F.col("_survives"), digest))
    hashed = write_through(
        scanned.select("_id", "_chars", "_sha", F.when(F.col("_survives"), F.col("_sha")).alias("_key")),
        "exact-hashed",
    )
    best = F.min(F.struct((-F.col("_chars")).alias("fewer"), F.col("_id").isNull().alias("no_id"),
                          F.col("_id").alias("id")))
    groups = (
        hashed.where(F.col("_key").isNotNull()).groupBy("_key")
        .agg(F.count("*").alias("group_size"), best.alias("best"))
        .where("group_size > 1")
        .select("_key", "group_size", F.col("best.id").alias("keep_id"))
    )
    total = hashed.count()
    joined = left_join_groups(hashed, groups, "_key", "group_size", total, F.col("_id"))
    grouped = F.col("group_size").isNotNull()
    keep_id = F.when(grouped, F.col("keep_id")).otherwise(F.col("_id"))
    return joined.select(
        F.col("_id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep_id).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Rows that repeat the id and the text of the row that stays go as well;
    which of them stays is open, as they differ in other columns at most.
    Rows are told apart by id and text, so one id may have several texts.
    Null texts count as empty, and of empty texts one row stays.  Columns of
    any name pass unchanged; an empty table gives an empty result.

    Only rows that go, repeat, or share a bit with one that does are joined;
    the texts of all others stay where they are.
    """
    flagged = write_through(
        exact_groups(docs, id_col=id_col, text_col=text_col).where("group_size > 1")
        .select(F.col(id_col).alias("_of"), F.col("text_sha256").alias("_sha"), "kept"),
        "exact-flags",
    )
    dropped = flagged.where("not kept").select("_of", "_sha").distinct()
    repeated = (
        flagged.where("kept").groupBy("_of", "_sha").agg(F.count("*").alias("n"))
        .where("n > 1").select("_of", "_sha")
    )
    clear, near = split_by_keys(docs, id_col, dropped.select("_of").unionByName(repeated.select("_of")))
    text = F.coalesce(F.col("_row")[text_col], F.lit(""))
    named = near.withColumns({"_key": F.col("_row")[id_col], "_own": F.sha2(normalised(text), 256)})

    def of(keys: DataFrame):
        return F.col("_key").eqNullSafe(keys["_of"]) & (F.col("_own") == keys["_sha"])

    stay = named.join(dropped, of(dropped), "left_anti")
    if not repeated.isEmpty():
        once = stay.join(repeated, of(repeated), "left_anti")
        again = stay.join(repeated, of(repeated), "left_semi")
        stay = once.unionByName(again.dropDuplicates(["_key", "_own"]))
    return clear.unionByName(stay.select("_row")).select("_row.*")
