"""Structured Streaming jobs: incremental file ingest and rollups."""
