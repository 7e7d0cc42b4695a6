"""DuckDB oracle SQL for the correctness gate (independent of the Spark code)."""
