"""Quality classifier by compression.

Two zstandard dictionaries are built, one from texts labelled good and one
from texts labelled bad.  A text is compressed with each; the difference of
the two sizes, normalised by the text's length, says which kind it is made
of, and the size that is left with the dictionary of good texts says how
much it repeats itself.  A logistic curve over these figures, fitted on
labelled rows of another fold, makes them a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrace.llm.calibration import fit_logistic, label_counts, labelled_sample, logistic
from airtrace.llm.common import whole_text

#: Labelled texts of each class for the dictionaries, the length of the pieces
#: that they are cut into, and the pieces of each class at most.
DICTIONARY_ROWS = 1500
PIECE_CHARS = 20_000
DICTIONARY_PIECES = 3000
DICTIONARY_BYTES = 112_640
#: Labelled texts of each class that the curve is fitted on.
CURVE_ROWS = 4000
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    curve: np.ndarray | None
    rate: float  # share of class 1, the score where nothing can be learnt


def _dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples.

    Training needs several samples of some length; where it has too few, the
    samples themselves are the dictionary (the last of them, if they are more
    than ``DICTIONARY_BYTES``).
    """
    import zstandard

    samples = sorted(samples)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Sizes:
    """Compressed sizes of texts under the two dictionaries."""

    def __init__(self, model: QualityModel) -> None:
        import zstandard

        self.by = []
        for raw in (model.good, model.bad):
            if len(raw) < 8:
                self.by.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
                continue
            own = zstandard.ZstdCompressionDict(raw)
            own.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=own, write_content_size=False, write_dict_id=False))

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text: normalised difference, what is left, and their bends."""
        good, bad = (by.compress for by in self.by)
        rows = np.array([(len(raw), len(good(raw)), len(bad(raw)))
                         for raw in (t.encode() for t in texts)], dtype=float).reshape(-1, 3)
        n = np.maximum(rows[:, 0], 1)
        apart = np.clip((rows[:, 2] - rows[:, 1]) / n, -0.5, 0.5)
        left = np.clip(rows[:, 1] / n, 0, 1)
        return np.column_stack([
            20 * apart, 20 * np.minimum(apart, 0.02), 20 * np.minimum(apart, 0), 5 * left,
            20 * np.minimum(left, 0.25), 100 * np.minimum(left, 0.05), 2 * np.log1p(np.minimum(n, 1000)) / 7,
        ])


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", where: Column,
    dictionary_where: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> QualityModel:
    """Learn from labels of the rows ``where`` (a condition on ``_id``).

    The dictionaries come from the rows that also meet ``dictionary_where``,
    the curve from the others (from all if there are none).  Both are fitted
    on bounded samples (``DICTIONARY_ROWS``, ``CURVE_ROWS`` a class).  The
    curve sees whole texts; for the dictionaries long texts are cut into
    pieces of ``PIECE_CHARS`` over their whole length, of which a hash draws
    ``DICTIONARY_PIECES`` a class at most.
    """
    counts = label_counts(labels, label_col=label_col, where=where, id_col=id_col)
    rate = counts[1] / max(1, counts[0] + counts[1])
    part = F.lit(True) if dictionary_where is None else dictionary_where

    def sample(rows: int, condition: Column) -> DataFrame:
        return labelled_sample(docs, labels, label_col=label_col, rows_per_class=rows,
                               where=condition, id_col=id_col, text_col=text_col)

    texts: dict[int, list[bytes]] = {0: [], 1: []}
    last = F.floor((F.greatest(F.length("_text"), F.lit(1)) - 1) / F.lit(PIECE_CHARS)).cast("int")
    pieces = sample(DICTIONARY_ROWS, where & part).select(
        "_label", "_id", "_text", F.explode(F.sequence(F.lit(0), last)).alias("_at")).select(
        "_label", "_id", "_at",
        F.substring("_text", F.col("_at") * PIECE_CHARS + 1, F.lit(PIECE_CHARS)).alias("_piece"))
    for label in (0, 1):
        drawn = pieces.where(F.col("_label") == label).orderBy(F.xxhash64("_at", "_id"), "_id", "_at")
        texts[label] = [row["_piece"].encode() for row in drawn.limit(DICTIONARY_PIECES).collect()]
    model = QualityModel(_dictionary(texts[1]), _dictionary(texts[0]), None, rate)
    if not counts[0] or not counts[1]:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value)
        for batch in batches:
            x = sizes.features(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_label"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["y", "x"])

    kept_out = where if dictionary_where is None else where & ~part
    found = (sample(CURVE_ROWS, kept_out).select("_label", "_text")
             .mapInArrow(measure, "y int, x array<double>").toArrow())
    y = np.array(found["y"].to_pylist(), dtype=float)
    if not len(y) or y.min() == y.max():
        return model
    x = np.array(found["x"].to_pylist())
    weight = np.where(y == 1, rate / y.mean(), (1 - rate) / (1 - y.mean()))
    return QualityModel(model.good, model.bad, fit_logistic(x, y, weight), rate)


def score_quality(docs: DataFrame, model: QualityModel, *, text_col: str = "text",
                  out: str = "score") -> DataFrame:
    """``docs`` with ``out``: the probability (0 to 1) of the label 1.

    Null and empty texts are scored as texts of length 0.  Without labels of
    both classes every text has the share of label 1 (0 without labels).
    Equal texts have equal scores; rows and other columns stay, a column
    named ``out`` is replaced.
    """
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sizes = Sizes(shared.value)
        for texts in batches:
            if shared.value.curve is None:
                yield pa.array([shared.value.rate] * len(texts), pa.float64())
            else:
                yield pa.array(logistic(sizes.features(texts.to_pylist()), shared.value.curve))

    return docs.withColumn(out, F.arrow_udf(predict, "double")(whole_text(text_col)))
