"""Mixing sources to target weights by Poisson replication.

A source that should make up the share ``w`` of the mix is repeated
``rate = w * size / rows`` times on average.  Every document draws its own
number of copies from the Poisson distribution of that mean by inverting its
distribution function at a uniform number that a hash of the seed and the
document gives: no state, no order, the same draw wherever it runs.  The
copies are then put in the order of a hash of (seed, document, copy), a
global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtrace.llm.common import shuffle_partitions, write_through

SEED = 17
#: The share of a source is its row count to this power, renormalised:
#: below 1 it lifts small sources.
TEMPERATURE = 0.5
#: Rows of the mix for each row of the input.
EPOCHS = 1.0
#: The Poisson table ends where its tail falls below one uniform step.
_STEPS = 52


def uniform(seed: int, *cols: str) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 of the seed and columns."""
    parts = [F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]]
    digits = F.substring(F.md5(F.concat_ws("/", *parts).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**_STEPS))


def poisson_sql(rate: str, u: str) -> str:
    """SQL: smallest k with P(X <= k) > u for X ~ Poisson(rate).

    The distribution function is summed up to ``rate + 12 sqrt(rate) + 30``,
    beyond which less than one step of ``u`` is left; for rates above 500 it
    begins at ``rate - 12 sqrt(rate)``, below which as little lies, with the
    mass there by Stirling's series (``exp(-rate)`` would vanish).
    """
    last = f"cast(ceil({rate} + 12 * sqrt({rate}) + 30) as int)"
    first = f"IF({rate} > 500, cast(floor({rate} - 12 * sqrt({rate})) as int), 0)"
    low = f"floor({rate} - 12 * sqrt({rate}))"
    factorial = f"({low} * ln({low}) - {low} + 0.5 * ln(2 * pi() * {low}) + 1 / (12 * {low}) - 1 / (360 * pow({low}, 3)))"
    mass = f"IF({rate} > 500, exp({low} * ln({rate}) - {rate} - {factorial}), exp(-{rate}))"
    return (
        f"CASE WHEN {rate} > 0 THEN aggregate(sequence({first}, {last}), "
        f"named_struct('n', {first}, 'p', {mass}, 'cdf', {mass}), "
        f"(s, k) -> named_struct("
        f"'n', s.n + IF(s.cdf <= {u}, 1, 0), "
        f"'p', s.p * {rate} / (k + 1), "
        f"'cdf', s.cdf + s.p * {rate} / (k + 1)), s -> s.n) ELSE 0 END"
    )


def target_weights(
    docs: DataFrame, *, source_col: str = "source", temperature: float = TEMPERATURE
) -> DataFrame:
    """(source, weight): each source's share by its row count to a power."""
    n = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    return n.select("source", F.pow("n", F.lit(temperature)).alias("weight"))


def replication_rates(
    docs: DataFrame, weights: DataFrame, *, source_col: str = "source", epochs: float = EPOCHS
) -> DataFrame:
    """(source, rows, rate): the mean copies that bring each source to its weight.

    Weights need not sum to 1; a source without a weight, or a weight of 0
    or less, has the rate 0.  Sources are matched null-safely.
    """
    rows = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("rows"))
    given = weights.groupBy(F.col("source").alias("_source")).agg(F.sum("weight").alias("_weight"))
    joined = rows.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn(
        "_weight", F.greatest(F.coalesce("_weight", F.lit(0.0)), F.lit(0.0))
    )
    total = joined.agg(F.sum("_weight").alias("w"), F.sum("rows").alias("n")).first()
    size = epochs * float(total["n"] or 0)
    rates = joined.select(
        "source", "rows",
        (F.col("_weight") / F.lit(total["w"] or 1.0) * F.lit(size) / F.col("rows")).alias("rate"),
    )
    return write_through(rates, "rates")


def replicate(
    docs: DataFrame, rates: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """``docs`` repeated by their Poisson draws, with ``copy`` and ``position``.

    ``copy`` counts a document's copies from 0; ``position`` is the place in
    the mix as a number in [0, 1), by which the rows come range-partitioned
    (even parts of the interval: no sample of the rows is needed) and sorted.  Documents that draw 0 are not in the mix.  Draws hang on the
    seed and the id alone: rows that repeat an id draw alike, a null id
    draws as the empty text.  Rates of 0 and sources without a rate give no
    row.  The rates are broadcast if their size is known to be below
    ``spark.sql.autoBroadcastJoinThreshold``, as after
    :func:`replication_rates`, which writes them; else the join shuffles and
    adaptive execution splits a hot source.  Columns named ``copy`` or ``position`` are replaced.
    """
    table = rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate"))
    base = docs.drop("copy", "position")
    drawn = (
        base.join(table, base[source_col].eqNullSafe(F.col("_source")))
        .withColumn("_u", uniform(seed, id_col))
        .withColumn("_n", F.expr(poisson_sql("_rate", "_u")))
        .where("_n > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumn("position", uniform(seed + 1, id_col, "copy"))
    )
    n = shuffle_partitions(docs.sparkSession)
    return (
        drawn.select(*base.columns, "copy", "position")
        .repartitionById(n, F.floor(F.col("position") * F.lit(n)).cast("int"))
        .sortWithinPartitions("position", id_col, "copy")
    )


def mix(
    docs: DataFrame, weights: DataFrame | None = None, *, id_col: str = "doc_id",
    source_col: str = "source", epochs: float = EPOCHS, seed: int = SEED,
) -> DataFrame:
    """Mix the sources of ``docs`` to ``weights`` (default: by temperature)."""
    if weights is None:
        weights = target_weights(docs, source_col=source_col)
    rates = replication_rates(docs, weights, source_col=source_col, epochs=epochs)
    return replicate(docs, rates, id_col=id_col, source_col=source_col, seed=seed)
