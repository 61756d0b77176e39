"""Sources: batch tables, streams, Kafka options, and the test-table adapter."""

from airlake.sources.tables import (
    city_dimension,
    eventhub_kafka_options,
    kafka_options,
    read_stream,
    read_table,
)

__all__ = ["city_dimension", "eventhub_kafka_options", "kafka_options", "read_stream", "read_table"]
