"""Small fits on bounded samples: logistic curve, labelled samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, *, label_col: str, rows_per_class: int, where: Column,
    id_col: str = "doc_id", text_col: str = "text", seed: int = 11,
) -> DataFrame:
    """(_id, _text, _label): at most ``rows_per_class`` rows of each class 0, 1.

    Which ids is decided on the narrow labels, by a hash; the ids, at most
    twice ``rows_per_class``, are then broadcast to fetch their texts.  Rows
    with a null id, label or other label value are left out, and of labels
    that repeat an id one (the smallest label) counts.
    """
    given = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & where)
        .groupBy("_id").agg(F.min("_label").alias("_label"))
    )
    order = F.xxhash64(F.lit(seed), "_id")
    picked = None
    for value in (0, 1):
        some = given.where(F.col("_label") == value).orderBy(order, "_id").limit(rows_per_class)
        picked = some if picked is None else picked.unionByName(some)
    spark = docs.sparkSession
    chosen = spark.createDataFrame(picked.collect(), picked.schema)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    return texts.join(F.broadcast(chosen), "_id")


def label_counts(labels: DataFrame, *, label_col: str, where: Column, id_col: str = "doc_id") -> dict[int, int]:
    """Rows of class 0 and 1 among the labels that may be learnt from."""
    rows = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & where)
        .groupBy("_label").agg(F.count("*").alias("n")).collect()
    )
    return {0: 0, 1: 0} | {r["_label"]: r["n"] for r in rows}


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3,
                 steps: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; last entry: bias."""
    a = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge * weight.sum() / max(1, len(x)))
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        slope = a.T @ (weight * (p - y)) + penalty * beta
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(curve + 1e-9 * np.eye(len(beta)), slope)
        size = np.abs(step).max()
        beta -= step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return beta


def logistic(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))
