"""Connected components by alternating large-star and small-star steps.

Each step replaces edges by edges to the smallest neighbour; after a few
rounds every node points at the smallest node of its component.  A step is a
grouped minimum (combined before its shuffle) and a join of the edges with
it; the edges are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airtrace.llm.common import write_through


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where("u != v").distinct()
    )


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) for every node u of ``edges`` (u, v) but the roots: v its root.

    The root is the smallest node of the component.  Edges are undirected;
    loops and repeats are ignored.
    """
    now = write_through(edges.where("u != v").select("u", "v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = write_through(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    return now
