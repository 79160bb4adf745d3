"""Incremental runs of the file jobs (Structured Streaming, file sources)."""

from tablewright.streaming.incremental import incremental_filter_csv_copy

__all__ = ["incremental_filter_csv_copy"]
