"""Query catalogue over the driver's tables, its DuckDB oracle, plan inspection."""
