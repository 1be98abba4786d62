"""Readers and writers: driver parquet tables, text/TSV logs, CSV and Parquet sinks."""

from clickspark.sources.files import (
    read_csv,
    read_delimited_text,
    read_parquet_table,
    write_csv,
    write_delimited_text,
    write_parquet_table,
)
from clickspark.sources.clicklog import click_log_schema, content_key, read_click_log
from clickspark.sources.tables import TABLES, read_table

__all__ = [
    "TABLES", "click_log_schema", "content_key", "read_click_log", "read_table", "read_csv", "read_delimited_text", "read_parquet_table",
    "write_csv", "write_delimited_text", "write_parquet_table",
]
