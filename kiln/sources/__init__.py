"""Readers, writers and generated inputs."""

from kiln.sources.files import (
    cast_columns,
    read_csv_declared,
    read_csv_inferred,
    read_csv_text,
    read_json,
    read_parquet,
    read_tsv_inferred,
    shape_like,
    try_cast,
    write_csv,
    write_json,
    write_parquet,
    write_sorted_parquet,
)
from kiln.sources.literal import literal_rows, synthetic_usage

__all__ = [
    "cast_columns", "read_csv_declared", "read_csv_inferred", "read_csv_text", "read_json", "read_parquet",
    "read_tsv_inferred", "shape_like", "try_cast", "write_csv", "write_json", "write_parquet",
    "write_sorted_parquet", "literal_rows", "synthetic_usage",
]
