"""Reading and writing tables."""

from .delta import read_delta, write_delta
from .months import (
    in_window, latest_period, latest_period_of_names, list_folders, observation_bounds,
    observation_window, scan_months,
)
from .tables import (
    read_csv, read_csv_text, read_table, sample_or_stored, unparsable_report, write_table,
)

__all__ = [
    "in_window", "latest_period", "latest_period_of_names", "list_folders", "observation_bounds",
    "observation_window", "read_csv", "read_csv_text", "read_delta", "read_table", "sample_or_stored",
    "scan_months", "unparsable_report", "write_delta", "write_table",
]
