"""Column-expression helpers (no UDFs)."""

from kiln.functions.rules import high_usage, price_status_sql, quantity_band, quantity_band_sql, usage_cost
from kiln.functions.temporal import (
    compact_date_text,
    compact_to_timestamp,
    format_timestamp,
    month_from_text,
    parse_timestamp,
    year_of,
)

__all__ = [
    "high_usage", "price_status_sql", "quantity_band", "quantity_band_sql", "usage_cost",
    "compact_date_text", "compact_to_timestamp", "format_timestamp", "month_from_text", "parse_timestamp", "year_of",
]
