"""Small document tables with the awkward cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return, as extra columns of an input.
CLASHING = ("n", "key", "score", "kept", "length", "row", "u", "v", "rep", "slot", "size", "word", "c")


def documents(spark: SparkSession, texts: list, ids: list | None = None, lang=None, source=None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    rows = [
        (i, t, lang[k] if lang else "en", source[k] if source else f"s{k % 3}", len(t or ""))
        for k, (i, t) in enumerate(zip(ids, texts, strict=True))
    ]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"x-{c}").alias(c) for c in CLASHING if c not in docs.columns])


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
