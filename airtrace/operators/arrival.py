"""Arrival orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY_FIRST = "_day_first"


def poll_order(
    df: DataFrame, batch: str = "batch", day: str = "day", seq: str = "seq"
) -> tuple[DataFrame, list[str]]:
    """``df`` and its order columns when polls are worked off day by day.

    A consumer that groups the messages of a poll by storage day writes one
    day after another: by poll, then by the day whose first message came
    first, then by message.  Where days interleave inside a poll this differs
    from the arrival order.  The first message of each (poll, day) is an
    aggregate, combined before its shuffle, joined back.
    """
    first = df.groupBy(F.col(batch).alias("_b"), F.col(day).alias("_d")).agg(F.min(seq).alias(DAY_FIRST))
    same = df[batch].eqNullSafe(F.col("_b")) & df[day].eqNullSafe(F.col("_d"))
    return df.join(first, same).drop("_b", "_d"), [batch, DAY_FIRST, seq]
