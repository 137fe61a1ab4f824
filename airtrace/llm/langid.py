"""Language identification: multinomial naive Bayes over hashed n-grams.

A text's features are its character 2- and 3-grams in lower case, with every
character that is no letter read as a blank, hashed into a fixed number of
buckets.  Counts per (language, bucket) are summed inside each task and then
by a grouped aggregate; the log-probability matrix (buckets x languages) is
all that passes through the driver, and is broadcast.  Scoring works on
blocks of characters in numpy: the n-grams of many texts are hashed at once,
their matrix rows gathered and summed per text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 16
SMOOTHING = 0.1
#: More languages than this are an error, not a bigger broadcast.
MAX_LANGUAGES = 1024
UNKNOWN = "und"
#: Characters worked on at once: what bounds a task's memory.
BLOCK = 1 << 18
_DOCS = -1  # the bucket that counts documents
_BLANK = 32


@functools.cache
def _letters() -> np.ndarray:
    """For each code point of the basic plane: itself if a letter, else blank."""
    table = np.full(1 << 16, _BLANK, dtype=np.uint32)
    for c in range(1 << 16):
        if chr(c).isalpha():
            table[c] = c
    return table


def _folded(text: str) -> np.ndarray:
    """Code points of a blank, the text in lower case, and two blanks."""
    raw = f" {text.lower()}  ".encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(raw, dtype="<u4")
    out = _letters()[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):
        letters = [c if chr(c).isalpha() else _BLANK for c in points[high].tolist()]
        out[high] = np.array(letters, dtype=np.uint32)
    return out


def _blocks(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(points, starts, texts' indices) of runs of at most about BLOCK points.

    A piece of a text carries two points past its own; no n-gram begins at
    those, so long texts are cut without losing or doubling one.
    """
    parts, starts, owner, size = [], [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        points = _folded(text)
        for a in range(0, len(points) - 2, BLOCK):
            piece = points[a : min(a + BLOCK, len(points) - 2) + 2]
            parts.append(piece)
            starts.append(size)
            owner.append(i)
            size += len(piece)
            if size >= BLOCK:
                yield np.concatenate(parts), np.array(starts), np.array(owner)
                parts, starts, owner, size = [], [], [], 0
    if parts:
        yield np.concatenate(parts), np.array(starts), np.array(owner)


def _grams(points: np.ndarray, starts: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, buckets) of the 2-grams and of the 3-grams of a block."""
    n = len(points)
    ends = np.append(starts[1:], n)
    begins = np.ones(n, dtype=bool)
    begins[ends - 1] = False
    begins[ends - 2] = False
    c = points.astype(np.uint64)
    letter = points != _BLANK
    one, two = c[1:], c[2:]
    pair = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + one * np.uint64(0xC2B2AE3D27D4EB4F)
    triple = pair[:-1] * np.uint64(0x165667B19E3779F9) + two * np.uint64(0x27D4EB2F165667C5)
    out = []
    for h, any_letter in (
        (pair, letter[:-1] | letter[1:]),
        (triple, letter[:-2] | letter[1:-1] | letter[2:]),
    ):
        at = np.flatnonzero(begins[: len(h)] & any_letter)
        mixed = h[at]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append((at, (mixed >> np.uint64(64 - bits)).astype(np.int64)))
    return out


def fit(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", bits: int = BUCKET_BITS,
    smoothing: float = SMOOTHING,
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities (buckets x languages), log priors).

    Learns from all rows with a text and a language.  Without such a row the
    list of languages is empty.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in langs:
                n_docs[lang] = n_docs.get(lang, 0) + 1
                if lang not in found:
                    if len(found) >= MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    found[lang] = np.zeros(1 << bits, dtype=np.int64)
            texts = batch.column("text").to_pylist()
            for lang in set(langs):
                own = [t for t, of in zip(texts, langs, strict=True) if of == lang]
                for points, starts, _ in _blocks(own):
                    for _, bucket in _grams(points, starts, bits):
                        found[lang] += np.bincount(bucket, minlength=1 << bits)
        for lang, counts in found.items():
            at = np.flatnonzero(counts)
            buckets = np.append(at, _DOCS).astype(np.int32)
            ns = np.append(counts[at], n_docs[lang]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(ns), pa.string()), pa.array(buckets), pa.array(ns)],
                names=["lang", "bucket", "n"],
            )

    counts = (
        rows.where("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    table = counts.toArrow()  # at most languages x buckets rows
    named = np.array(table["lang"].to_pylist(), dtype=object)
    langs = sorted(set(named.tolist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    column = {lang: i for i, lang in enumerate(langs)}
    matrix = np.zeros((1 << bits, len(langs)))
    docs_of = np.ones(len(langs))
    for lang, bucket, n in zip(named, table["bucket"].to_pylist(), table["n"].to_pylist(), strict=True):
        if bucket == _DOCS:
            docs_of[column[lang]] = n
        else:
            matrix[bucket, column[lang]] = n
    matrix += smoothing
    log_p = np.log(matrix / matrix.sum(axis=0)).astype(np.float32)
    return langs, log_p, np.log(docs_of / docs_of.sum()) if langs else np.zeros(0)


def score(texts: list[str | None], langs: list[str], log_p: np.ndarray, prior: np.ndarray,
          ) -> tuple[list[str], np.ndarray]:
    """Predicted language and its posterior probability of each text."""
    n, bits = len(texts), int(log_p.shape[0]).bit_length() - 1
    total = np.tile(prior.astype(np.float64), (n, 1))
    lettered = np.zeros(n, dtype=bool)
    for points, starts, owner in _blocks(texts):
        has = np.logical_or.reduceat(points != _BLANK, starts)
        lettered[owner[has]] = True
        for at, bucket in _grams(points, starts, bits):
            if not len(at):
                continue
            sums = np.zeros((len(starts), len(langs)))
            gathered = log_p[bucket]
            first = np.searchsorted(at, starts)
            some = np.append(first[1:], len(at)) > first
            sums[some] = np.add.reduceat(gathered, first[some], axis=0, dtype=np.float64)
            np.add.at(total, owner, sums)
    if not langs:
        return [UNKNOWN] * n, np.zeros(n)
    best = total.argmax(axis=1)
    odds = np.exp(total - total.max(axis=1, keepdims=True))
    p = odds.max(axis=1) / odds.sum(axis=1)
    names = [langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
    return names, np.where(lettered, p, 0.0)


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], *, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (its posterior probability).

    A text that is null or has no letter is ``und`` with the score 0, as is
    every text under a model without languages.  Of equal posteriors the
    language first in order wins.  Rows and other columns stay; columns of
    these two names are replaced.
    """
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, p = score(texts.to_pylist(), *shared.value)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(p)],
                                             ["lang_pred", "score"])

    predicted = F.arrow_udf(predict, "lang_pred string, score double")
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, predicted(F.col(text_col)).alias("_lang")).select(
        *kept, "_lang.lang_pred", "_lang.score"
    )
