"""Typed readers, sinks and the driver-table fixtures."""
