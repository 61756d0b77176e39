"""Sinks: batch and streaming writers, Kafka value encoding, file reports."""

from airlake.sinks.writers import (
    counted,
    write_kafka,
    file_inventory,
    preview_stream,
    storage_smoke,
    to_kafka_value,
    write_json,
    write_stream,
    write_table,
)

__all__ = [
    "counted",
    "write_kafka",
    "file_inventory",
    "preview_stream",
    "storage_smoke",
    "to_kafka_value",
    "write_json",
    "write_stream",
    "write_table",
]
