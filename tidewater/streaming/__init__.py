"""Incremental (batch) processing: partition windows, high-water marks, available-now file runs."""

from tidewater.streaming.incremental import incremental_load, rows_after_mark, run_available_files, years_to_reprocess

__all__ = ["incremental_load", "rows_after_mark", "run_available_files", "years_to_reprocess"]
