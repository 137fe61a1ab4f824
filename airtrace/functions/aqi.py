"""AQI category bands (A3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airtrace.schemas import AQI_BANDS, AQI_TOP_BAND


def aqi_category(aqi: Column | str = "aqi") -> Column:
    """Band label of an AQI value.

    Bands are inclusive upper bounds; negative values fall into the first
    band and NULL (only possible on non-normalized input) into the top band.
    """
    value = F.col(aqi) if isinstance(aqi, str) else aqi
    expr = None
    for bound, label in AQI_BANDS:
        expr = (F.when if expr is None else expr.when)(value <= bound, F.lit(label))
    return expr.otherwise(F.lit(AQI_TOP_BAND))
