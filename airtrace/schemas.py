"""Fixed values of the data model: schemas, key lists and AQI bands.

These values must equal the reference behaviour to give the same results.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values -----------------------------------------------------------
# Curated record: column names and types, in output order.
CURATED_SCHEMA = StructType(
    [
        StructField("timestamp", StringType(), True),
        StructField("station_id", IntegerType(), True),
        StructField("station_name", StringType(), True),
        StructField("latitude", DoubleType(), True),
        StructField("longitude", DoubleType(), True),
        StructField("aqi", IntegerType(), True),
        StructField("dominant_pollutant", StringType(), True),
        StructField("pollutants", MapType(StringType(), DoubleType()), True),
        StructField("temperature", DoubleType(), True),
        StructField("humidity", DoubleType(), True),
        StructField("wind", DoubleType(), True),
        StructField("pressure", DoubleType(), True),
        StructField("dew", DoubleType(), True),
    ]
)

# Keys of the payload's `iaqi` object that are weather readings, not pollutants.
WEATHER_KEYS = ("dew", "h", "p", "t", "w")

# Weather key -> curated column.
WEATHER_COLUMNS = {
    "t": "temperature",
    "h": "humidity",
    "w": "wind",
    "p": "pressure",
    "dew": "dew",
}

# AQI bands: (inclusive upper bound, label); anything above the last bound,
# and NULL, is "Hazardous".
AQI_BANDS = (
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for Sensitive Groups"),
    (200, "Unhealthy"),
    (300, "Very Unhealthy"),
)
AQI_TOP_BAND = "Hazardous"

# Names of the report bundle, in the order they are produced.
REPORT_NAMES = (
    "normalized",
    "hourly_aqi",
    "daily_aqi",
    "aqi_category_distribution",
    "average_pollutants",
    "dominant_pollutants",
    "weather_correlations",
)

# Weather metrics correlated with AQI, in report column order.
CORRELATED_METRICS = ("temperature", "humidity", "wind")
# ---------------------------------------------------------------------------

CURATED_COLUMNS = tuple(f.name for f in CURATED_SCHEMA.fields)
POLLUTANT_MAP_TYPE = MapType(StringType(), DoubleType())

# Curated schema plus the storage day partition as it is read back from a
# ``day=`` directory layout (renamed so the derived report ``day`` stays free).
STORAGE_DAY = "storage_day"
