"""Degenerate-safe correlation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(left: str, right: str, pairwise: bool = False) -> Column:
    """Sample covariance over the product of the sample deviations.

    NULL (never an error) for a constant series, one row or no rows.  This is
    deliberately not ``corr``: the covariance uses rows where both sides are
    present while each deviation uses all non-null rows of its own side, so
    with NULLs on one side the value differs from ``corr`` and may exceed 1.
    ``pairwise=True`` restricts both deviations to complete pairs (then the
    value equals ``corr`` except that degenerate inputs give NULL).
    """
    lcol, rcol = F.col(left), F.col(right)
    if pairwise:
        both = lcol.isNotNull() & rcol.isNotNull()
        lcol = F.when(both, lcol)
        rcol = F.when(both, rcol)
    # merging partial moments may leave a constant series a deviation of rounding
    varies = (F.min(lcol) < F.max(lcol)) & (F.min(rcol) < F.max(rcol))
    coefficient = F.try_divide(
        F.covar_samp(lcol, rcol), F.stddev_samp(lcol) * F.stddev_samp(rcol)
    )
    return F.when(varies, coefficient)
