"""Structured Streaming into directories of Parquet files."""

from kiln.streaming.file_append import file_stream, run_for, start_append, stream_files
from kiln.streaming.table_append import drifting_files, stream_into_table

__all__ = ["drifting_files", "file_stream", "run_for", "start_append", "stream_files", "stream_into_table"]
