"""airtrace: a Spark-native engine for environmental station observations.

Raw JSON payloads (a stream or an archive) are curated into typed station
observations, de-duplicated by per-station change detection, normalized with
an explicit time-zone rule and summarized into report tables.  Every public
operator takes and returns DataFrames so it composes with ``df.transform``.
"""

__version__ = "0.1.0"
