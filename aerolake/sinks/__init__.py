"""Sinks: Bronze landing, partitioned Parquet lake tables, JDBC publish."""

from aerolake.sinks.lake import land_bronze, read_lake_table, write_partitioned

__all__ = ["land_bronze", "read_lake_table", "write_partitioned"]
