from airlake.operators.reshape import explode_array, pivot_max
from airlake.operators.select import distinct_sorted, latest_key, preview, rows_at_max, top_n_on_latest
from airlake.operators.versions import duplicate_report, latest_per_key, rank_versions

__all__ = [
    "explode_array", "pivot_max", "preview", "distinct_sorted", "latest_key", "rows_at_max",
    "top_n_on_latest", "duplicate_report", "latest_per_key", "rank_versions",
]
