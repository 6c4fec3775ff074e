"""Sinks: console (K1), rolling text files (K2), JDBC inserts (K3/K4) and a
keyed upsert store such as a Redis hash (K5)."""

from tidewater.sinks.console import print_rows
from tidewater.sinks.jdbc import jdbc_insert, jdbc_stream_writer, jdbc_upsert, jdbc_upsert_writer, read_jdbc
from tidewater.sinks.rolling_file import read_buckets, write_rolling_text, rolling_text_stream
from tidewater.sinks.upsert import collapse_latest, upsert_partitions, upsert_stream_writer

__all__ = ["print_rows", "jdbc_insert", "jdbc_stream_writer", "jdbc_upsert", "jdbc_upsert_writer", "read_jdbc", "read_buckets",
           "write_rolling_text", "rolling_text_stream", "collapse_latest", "upsert_partitions",
           "upsert_stream_writer"]
