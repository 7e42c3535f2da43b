"""Registered queries (Spark) and their SQL twins (for the DuckDB oracle)."""
