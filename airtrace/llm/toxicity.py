"""Toxicity: gradient-boosted trees over dense features, isotonic scores.

A lexicon of words and word beginnings is learnt from labelled texts by
their log-odds.  A text's features are densities of lexicon words and
beginnings, their weights, second-person words and their nearness to lexicon
words, capitals, punctuation, and obfuscated spellings (with digits or signs
between letters, read back before the lookup).  Boosted trees turn them into
a margin, an isotonic curve the margin into a probability.  Lexicon, trees
and curve learn from different folds, so the trees see lexicon features as
they are on unseen texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrace.llm.calibration import label_counts, labelled_sample
from airtrace.llm.common import whole_text, write_through

if TYPE_CHECKING:  # not in the workers that measure features
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import IsotonicRegressionModel

#: Labelled texts of each class for the lexicon, the trees and the curve.
SAMPLE_ROWS = 5000
#: Entries of the lexicon at most, the strongest ones.
LEXICON_SIZE = 20_000
#: Texts that an entry must occur in, and its least log-odds.
LEAST_TEXTS = 4
LEAST_ODDS = 1.5
_PREFIXES = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")
_CAPITALS = re.compile(r"\b[^\W\d_a-z]{2,}\b")
_MIXED = re.compile(r"[^\W\d_][0-9@$*!|.]{1,4}[^\W\d_]")
_LONG = re.compile(r"([^\W\d_])\1\1")
_READ = str.maketrans("013457@$!|", "oieastasil", "*.-_")
#: Words that address the reader.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous"
    " votre vos ti tus usted ustedes vosotros su".split()
)
_NEAR = 5
_SIGNS = np.zeros(256, dtype=np.int64)
_SIGNS[ord("A") : ord("Z") + 1] = 1
_SIGNS[[ord(c) for c in "!?"]] = 2
_SIGNS[[ord(c) for c in "\"#$%&'()*+,-./:;<=>@[\\]^_`{|}~"]] = 3
_SIGNS[ord("0") : ord("9") + 1] = 4
FEATURES = (
    "words", "word_density", "word_hits", "word_top", "start_density", "start_hits", "start_top",
    "near_second_person", "second_person", "capitals", "shouted", "exclaimed", "punctuation",
    "digits", "obfuscated", "obfuscated_hits", "stretched",
)


def terms(text: str) -> set[str]:
    """A text's words and the beginnings of its longer words (with a ^)."""
    out = set()
    for word in set(_WORD.findall(text.lower())):
        out.add(word)
        out.update(f"{word[:n]}^" for n in _PREFIXES if len(word) > n)
    return out


class Lookup(dict):
    """word -> (weight as a word, weight of its best beginning), or None.

    A cache over the lexicon, emptied when it holds ``limit`` words.
    """

    limit = 100_000

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> tuple[float, float] | None:
        get = self.lexicon.get
        whole = get(word, 0.0)
        start = max([0.0, *(get(f"{word[:n]}^", 0.0) for n in _PREFIXES if len(word) > n)])
        found = (whole, start) if whole or start else None
        if len(self) >= self.limit:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


def features(text: str, lookup: Lookup) -> list[float]:
    """The values of ``FEATURES`` of one whole text."""
    words = _WORD.findall(text.lower())
    n = max(1, len(words))
    found = list(map(lookup.__getitem__, words))
    hits = [i for i, f in enumerate(found) if f]
    whole = [found[i][0] for i in hits if found[i][0]]
    start = [found[i][1] for i in hits if found[i][1]]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if hits and you:
        at = np.searchsorted(you, hits)
        you_at = np.array([-(10**9), *you, 10**9])
        gap = np.minimum(you_at[at + 1] - hits, hits - you_at[at])
        near = int((gap <= _NEAR).sum())
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    size = max(1, len(raw))
    signs = np.bincount(_SIGNS[raw], minlength=5) / size
    mixed = mixed_hits = a = b = 0
    for m in _MIXED.finditer(text):
        mixed += 1
        if m.start() >= b:  # not in the token of the match before: each character is passed once
            a = text.rfind(" ", b, m.start()) + 1 or b
            b = text.find(" ", m.end())
            b = len(text) if b < 0 else b
            read = lookup[text[a:b].strip(".,;:!?\n").translate(_READ).lower()]
        mixed_hits += bool(read and read[0])
    return [
        math.log1p(len(words)), len(whole) / n, math.log1p(len(whole)), max(whole, default=0.0),
        len(start) / n, math.log1p(len(start)), max(start, default=0.0), near / max(1, len(hits)),
        len(you) / n, signs[1], len(_CAPITALS.findall(text)) / n, signs[2], signs[3], signs[4],
        mixed / n, math.log1p(mixed_hits), len(_LONG.findall(text)) / n,
    ]


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    curve: IsotonicRegressionModel | None
    rate: float  # share of class 1, the score where nothing can be learnt


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log-odds of the terms of ``sample`` (_text, _label) that speak for 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: dict[str, list[int]] = {}
            rows = zip(batch.column("_text").to_pylist(), batch.column("_label").to_pylist(), strict=True)
            for text, label in rows:
                for term in terms(text):
                    n.setdefault(term, [0, 0])[label] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string())] + [pa.array([v[k] for v in n.values()], pa.int64()) for k in (0, 1)],
                names=["term", "n0", "n1"])

    rows = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    odds = F.log((F.col("n1") + 0.5) / F.lit(rows.get(1, 0) + 1.0)) - F.log(
        (F.col("n0") + 0.5) / F.lit(rows.get(0, 0) + 1.0))
    ranked = (
        sample.select("_text", "_label").mapInArrow(count, "term string, n0 long, n1 long")
        .groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .where(F.col("n1") >= LEAST_TEXTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc(F.col("odds") * F.log1p("n1")), "term").limit(LEXICON_SIZE)
    )
    return {r["term"]: r["odds"] for r in ranked.select("term", "odds").collect()}


def _with_features(rows: DataFrame, lexicon: dict[str, float], text: Column) -> DataFrame:
    shared: Broadcast = rows.sparkSession.sparkContext.broadcast(lexicon)

    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = Lookup(shared.value)
        for texts in batches:
            yield pa.array([features(t, lookup) for t in texts.to_pylist()], pa.list_(pa.float64()))

    return rows.withColumn("_x", F.arrow_udf(measure, "array<double>")(text))


def _with_margin(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    from pyspark.ml.functions import array_to_vector, vector_to_array

    judged = trees.transform(rows.withColumn("_features", array_to_vector("_x")))
    return judged.withColumn("_margin", vector_to_array("_raw")[1])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", where: Column | None = None,
    part: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    rows: int = SAMPLE_ROWS, trees: int = 20, depth: int = 4,
) -> ToxicityModel:
    """Learn from labels of the rows ``where`` (a condition on ``_id``).

    ``part`` (an expression of ``_id``, by default a hash) names the fold of
    a row: 0 and 1 for the lexicon, 2 for the trees, 3 for the curve.  Each
    learns from at most ``rows`` labelled texts of a class, weighted back to
    the share of the class.  Without labels of both classes in each part
    there is no model but the share of label 1.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    where = F.lit(True) if where is None else where
    part = F.pmod(F.xxhash64(F.lit(5), "_id"), F.lit(4)) if part is None else part
    counts = label_counts(labels, label_col=label_col, where=where, id_col=id_col)
    rate = counts[1] / max(1, counts[0] + counts[1])

    def sample(condition: Column) -> DataFrame:
        return write_through(labelled_sample(
            docs, labels, label_col=label_col, rows_per_class=rows, where=where & condition,
            id_col=id_col, text_col=text_col).select("_text", "_label"), "toxicity-sample")

    lexicon = learn_lexicon(sample(part.isin(0, 1)))
    nothing = ToxicityModel(lexicon, None, None, rate)

    def measured(condition: Column) -> DataFrame | None:
        x = write_through(
            _with_features(sample(condition), lexicon, F.col("_text")).select("_x", "_label"),
            "toxicity-features").repartition(4)
        n = {r["_label"]: r["n"] for r in x.groupBy("_label").agg(F.count("*").alias("n")).collect()}
        if len(n) < 2:
            return None
        weight = F.when(F.col("_label") == 1, F.lit(rate * 2 * n[0] / n[1] if n[1] else 1.0)).otherwise(
            F.lit((1 - rate) * 2))
        return x.select("_x", F.col("_label").cast("double").alias("_y"), weight.alias("_weight")).cache()

    learn, curve_rows = measured(part == 2), measured(part == 3)
    if learn is None or curve_rows is None:
        return nothing
    fitted = GBTClassifier(
        featuresCol="_features", labelCol="_y", predictionCol="_c", maxIter=trees, maxDepth=depth,
        stepSize=0.2, seed=3, maxBins=64,
    ).setRawPredictionCol("_raw").setProbabilityCol("_p").fit(learn.withColumn("_features", array_to_vector("_x")))
    margins = _with_margin(curve_rows, fitted).select("_margin", "_y", "_weight")
    curve = IsotonicRegression(
        featuresCol="_margin", labelCol="_y", weightCol="_weight", predictionCol="_score"
    ).fit(margins)
    for cached in (learn, curve_rows):
        cached.unpersist()
    return ToxicityModel(lexicon, fitted, curve, rate)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text",
                   out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the probability (0 to 1) of the label 1.

    Null texts count as empty; an empty text is scored by its features, all
    0.  Equal texts have equal scores.  Rows and other columns stay, a column
    named ``out`` is replaced; names that begin with an underscore are
    reserved for the operator.
    """
    kept = [c for c in docs.columns if c != out]
    if model.trees is None:
        return docs.select(*kept, F.lit(model.rate).alias(out))
    judged = _with_margin(_with_features(docs.select(*kept), model.lexicon, whole_text(text_col)), model.trees)
    scored = model.curve.transform(judged)
    return scored.select(*kept, F.least(F.greatest("_score", F.lit(0.0)), F.lit(1.0)).alias(out))
