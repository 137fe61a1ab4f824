"""Plan-level entry points: report bundle, raw replay, driver queries."""

from airtrace.plans.replay import curate_archive, curate_parquet_archive, replay_raw
from airtrace.plans.reports import materialize, run_reports, run_city_reports

__all__ = [
    "curate_archive",
    "curate_parquet_archive",
    "materialize",
    "replay_raw",
    "run_city_reports",
    "run_reports",
]
