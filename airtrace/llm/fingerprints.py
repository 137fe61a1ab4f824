"""Document fingerprints by winnowing (DataFrame and SQL expressions only).

A text's tokens are its words in lower case (runs without white space, at
most 24 characters each; characters of scripts written without spaces stand
alone).  Every run of ``k`` tokens is hashed; of every ``w`` consecutive
hashes the smallest is chosen, the rightmost of equal ones, and the chosen
hashes are kept with their positions.  Two texts that share ``w + k - 1``
tokens in a row share a chosen hash there, and no match shorter than ``k``
tokens is reported.

The window minimum is built by doubling (``w`` is a power of two): the
rightmost smallest of 2, 4, ... hashes is one pass over the array each.
All of it is array expressions inside one row, so a text needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtrace.llm.common import shuffle_partitions, whole_text

K = 3
W = 4
MAX_BUCKETS = 4096
_ALONE = r"\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}"
_TOKEN = rf"[{_ALONE}]|[^\\s{_ALONE}]{{1,24}}"


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def winnow_sql(text: str, k: int = K, w: int = W) -> str:
    """SQL expression: array of (hash, pos) chosen from a non-null text.

    With fewer than ``k`` tokens the whole text is one run; with fewer than
    ``w`` runs all of them are one window; without a token the array is
    empty.  ``pos`` counts tokens from 0.
    """
    if w & (w - 1) or w < 1 or k < 1:
        raise ValueError("k must be positive and w a power of two")
    run = ", ".join(f"t[i + {j}]" if j else "t[i]" for j in range(k))
    hashes = (
        f"CASE WHEN size(t) >= {k} THEN transform(sequence(0, size(t) - {k}), i -> xxhash64({run})) "
        "WHEN size(t) > 0 THEN array(xxhash64(t)) ELSE array() END"
    )
    chosen, step = "sequence(0, size(h) - 1)", 1
    while step < w:
        name = f"b{step}"
        chosen = _let(
            name, chosen,
            f"transform(slice({name}, 1, size({name}) - {step}), (p, j) -> "
            f"IF(h[{name}[j + {step}]] <= h[p], {name}[j + {step}], p))",
        )
        step *= 2
    few = "array(cast(size(h) - array_position(reverse(h), array_min(h)) as int))"
    positions = (
        f"CASE WHEN size(h) >= {w} THEN "
        + _let("c", chosen, "filter(c, (p, j) -> j = 0 OR p != c[j - 1])")
        + f" WHEN size(h) > 0 THEN {few} ELSE array() END"
    )
    picked = f"transform({positions}, p -> struct(h[p] AS hash, p AS pos))"
    tokens = f"regexp_extract_all(lower({text}), '{_TOKEN}', 0)"
    return _let("t", tokens, _let("h", hashes, picked))


def fingerprint(docs: DataFrame, *, text_col: str = "text", out: str = "fingerprint",
                k: int = K, w: int = W) -> DataFrame:
    """``docs`` with the column ``out``: array of (hash, pos) of each text.

    A null or blank text has an empty array.  Other columns stay.
    """
    return docs.withColumn(out, F.expr(winnow_sql(f"coalesce(`{text_col}`, '')", k, w)))


def likeness(a: str, b: str) -> str:
    """SQL: shared share of the distinct hashes of two arrays (0 to 1).

    Two empty arrays are alike (1), an empty and another are not (0).
    """
    shared = f"size(array_intersect({a}, {b}))"
    return (
        f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1.0D "
        f"ELSE cast({shared} as double) / size(array_union({a}, {b})) END"
    )


def digest(prints: str) -> str:
    """SQL: a fingerprint as 32 hex digits (hashes and positions)."""
    return f"md5(array_join(transform({prints}, f -> concat(hex(f.hash), '@', f.pos)), ' '))"


def _bucket(bounds: list[int], doc_id: Column) -> Column:
    """Number of bounds at or below the id, in two steps of about sqrt(n)."""
    if not bounds:
        return F.lit(0)
    width = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*[F.lit(b[0]) for b in blocks])
    table = F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks])
    block = F.size(F.filter(heads, lambda x: x <= doc_id))
    inside = F.size(F.filter(F.element_at(table, block), lambda x: x <= doc_id))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * F.lit(width) + inside)


def with_next(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> tuple[DataFrame, str]:
    """(id, text, neighbours): rows dealt into ranges of ids, and the window.

    The rows of a range are sorted by descending id in one task; each range
    also gets a copy of the row that follows its last one (``_guest``), so a
    window over ``_bucket`` sees every row's successor.  The range bounds
    and the followers (one per range, at most ``MAX_BUCKETS``) are all that
    passes through the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    n = min(MAX_BUCKETS, buckets or 4 * shuffle_partitions(spark))
    marks = [i / n for i in range(1, n)]
    bounds: list[int] = []
    if marks:
        found = rows.agg(F.percentile_approx("_id", marks, 10 * n).alias("q")).first()["q"]
        bounds = sorted(set(found or []))
    dealt = rows.withColumn("_bucket", _bucket(bounds, F.col("_id")))
    tops = {
        r["_bucket"]: r["top"]
        for r in dealt.where("_id is not null").groupBy("_bucket").agg(F.max("_id").alias("top")).collect()
    }
    order = sorted(tops, reverse=True)
    follows = [(order[i], tops[order[(i + 1) % len(order)]]) for i in range(len(order))]
    guests = spark.createDataFrame(follows, "_bucket int, _id bigint")
    copies = rows.join(F.broadcast(guests), "_id").select("_id", "_text", "_bucket", F.lit(True).alias("_guest"))
    hosts = dealt.select(
        "_id", "_text",
        F.when(F.col("_id").isNull(), -1 - F.pmod(F.xxhash64("_text"), F.lit(n))).otherwise(F.col("_bucket"))
        .cast("int").alias("_bucket"),
        F.lit(False).alias("_guest"),
    )
    window = "(PARTITION BY _bucket ORDER BY _guest, _id DESC, xxhash64(_text))"
    return hosts.unionByName(copies), window


def edited_fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    buckets: int | None = None, k: int = K, w: int = W,
) -> DataFrame:
    """Fingerprints of every text and of the text edited with its successor.

    The edited text has its last floor(n_chars / 3) code points replaced by
    the first as many (or all) of the next row in descending id, after the
    last row the first.  Returns ``id_col``, ``n_chars``, ``edited_sha256``,
    the arrays ``prints`` and ``edited_prints`` of (hash, pos), and
    ``near_edited``, ``near_next``, the :func:`likeness` of the text's
    hashes to those of the edited text and of the next text.

    Null texts count as empty.  Rows that repeat an id follow each other in
    the order of a hash of their texts.  A row without an id has no
    successor and is none: its last third is cut off, ``near_next`` is that
    to an empty text.  A single row follows itself.  Other columns are
    ignored; an empty table gives an empty result.
    """
    rows, window = with_next(docs, id_col=id_col, text_col=text_col, buckets=buckets)
    n = "length(_text)"
    cut = f"cast({n} div 3 as int)"
    head = f"substring(_text, 1, cast({n} - {cut} as int))"
    tail = f"substring(coalesce(_next, ''), 1, {cut})"
    seen = (
        rows.withColumn("_next", F.expr(f"CASE WHEN _id IS NOT NULL THEN lead(_text) OVER {window} END"))
        .select(
            "_id", "_bucket", "_guest", F.expr("xxhash64(_text)").alias("_tie"),
            F.expr(n).cast("long").alias("n_chars"),
            F.expr(winnow_sql("_text", k, w)).alias("prints"),
            F.expr(f"CASE WHEN _guest THEN NULL ELSE concat({head}, {tail}) END").alias("_edited"),
        )
        .select(
            "*", F.expr("sha2(_edited, 256)").alias("edited_sha256"),
            F.expr(f"CASE WHEN _guest THEN NULL ELSE {winnow_sql('_edited', k, w)} END").alias("edited_prints"),
        )
        .drop("_edited")
        .withColumn("_hashes", F.expr("transform(prints, f -> f.hash)"))
    )
    after = window.replace("xxhash64(_text)", "_tie")
    none = "cast(array() as array<bigint>)"
    return (
        seen.withColumn("_after", F.expr(
            f"CASE WHEN _id IS NULL THEN {none} ELSE coalesce(lead(_hashes) OVER {after}, {none}) END"))
        .where("NOT _guest")
        .select(
            F.col("_id").alias(id_col), "n_chars", "edited_sha256", "prints", "edited_prints",
            F.expr(likeness("_hashes", "transform(edited_prints, f -> f.hash)")).alias("near_edited"),
            F.expr(likeness("_hashes", "_after")).alias("near_next"),
        )
    )
