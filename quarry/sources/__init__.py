"""Readers and writers: parquet tables, schema-declared CSV, table sinks."""

from quarry.sources.io import (  # noqa: F401
    DRIVER_TABLES, Tables, load, read_csv, write_table,
)
