"""Structured Streaming jobs: map-only Bronze, and incremental Silver/Gold per
micro-batch (``foreachBatch``)."""

from airlake.streaming.bronze_stream import (
    bronze_stream,
    file_value_stream,
    start_bronze_stream,
    start_incremental_stream,
)

__all__ = ["bronze_stream", "file_value_stream", "start_bronze_stream", "start_incremental_stream"]
