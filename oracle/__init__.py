"""DuckDB oracle SQL for the named queries (tables are pre-registered views)."""
