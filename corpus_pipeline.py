"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.

A stage begins by deleting the scratch files of the stage before, whose result
has been written by then, so a run holds the scratch of one stage at a time.

In every stage null and empty texts, repeated rows, null ids and sources and
extra columns of any name are rows and columns like others; what becomes of
them is said with the stage.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airtrace.llm.common import load, write_through
from airtrace.llm.exact_dedup import drop_exact_copies
from airtrace.llm.mixing import mix
from airtrace.llm.near_dups import drop_near_copies
from airtrace.llm.packing import digested, pack
from airtrace.llm.toxicity import fit_toxicity, score_toxicity
from airtrace.session import delete_scratch, scratch_made

TOXIC = 0.5
#: Words of a shingle and similarity, in percent, of near duplicates.
SHINGLE_WORDS = 5
SIMILAR = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch folders of the stage that was run last.
_left: list[str] = []


def _stage(work: Stage) -> Stage:
    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_scratch(spark, _left)
        with scratch_made() as made:
            out = work(spark, docs, sf_dir)
        _left[:] = made
        return out

    return stage


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC`` stay; the model learns from ``labels``.

    Null and empty texts are scored by features of 0; equal texts, also
    repeated rows, stay or go together.  A score of ``TOXIC`` goes.
    """
    model = fit_toxicity(docs, load(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model, out="_toxic")
    return scored.where(scored["_toxic"] < TOXIC).select(*docs.columns)


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal without white space stays.

    The longest, then the one with the smallest id (null last); null and
    empty texts are one group.  Of rows that repeat it one stays.
    """
    return drop_exact_copies(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    The one with the smallest id.  Texts without words and rows without an
    id have no near duplicates and stay; rows that repeat an id are one
    document.
    """
    return drop_near_copies(docs, k=SHINGLE_WORDS, percent=SIMILAR)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by Poisson draws towards the sources' weights.

    The null source is a source; rows that repeat an id draw alike, a null
    id draws as the empty text, and texts are not looked at.
    """
    return mix(docs).select(*docs.columns)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all copies, packed into sequences.

    Null and empty texts are pieces of the end token alone; a long text is
    cut into full sequences, its rest is packed.
    """
    return digested(pack(docs, with_ids=True))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("packing", packing),
]

#: Trained trees, MinHash groups and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, from ``documents``."""
    docs, before = load(spark, sf_dir, "documents"), []
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            with scratch_made() as written:
                docs = write_through(docs, f"stage-{name}")
            delete_scratch(spark, before)
            before = written
    return docs


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query: all rows of :func:`run`."""
    return run(spark, sf_dir)
