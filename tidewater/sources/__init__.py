"""Sources: parquet tables (batch and file stream), literal collections, text
lines, the rate-limited order generator and Kafka."""

from tidewater.sources.collections import from_data
from tidewater.sources.generator import generate_orders, order_columns, order_stream
from tidewater.sources.kafka import decode_value, kafka_options, read_kafka
from tidewater.sources.tables import TABLES, read_table, table_schema, table_stream
from tidewater.sources.text import text_lines

__all__ = ["from_data", "generate_orders", "order_columns", "order_stream", "decode_value",
           "kafka_options", "read_kafka", "TABLES", "read_table", "table_schema",
           "table_stream", "text_lines"]
