"""Message stream -> Bronze.

Two forms of the source system, both kept:

- ``"direct"``: decode, parse with the fixed schema and keep the API's rows,
  writing the 12 typed columns straight away;
- ``"raw"``: decode only, writing ``json_string``; the structured table is
  then a batch re-parse (:func:`airlake.plans.medallion.run_bronze_structured`).

The plan is map-only (no shuffle, no state), so it needs no watermark; the
checkpoint records source offsets and the file sink's commit log, which makes
restarts exactly-once for file sinks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, StructField, StructType

from airlake.operators.bronze import decode_value, parse_events
from airlake.sinks.writers import write_stream
from airlake.sources.tables import read_table

VALUE_SCHEMA = StructType([StructField("value", BinaryType())])


def file_value_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A file-backed stand-in for a Kafka topic: files of ``value BINARY``
    records, picked up as they land (each new file is new offsets)."""
    reader = spark.readStream.format(fmt).schema(VALUE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def bronze_stream(stream: DataFrame, form: str = "direct") -> DataFrame:
    """The Bronze transformation of a ``value BINARY`` stream (T-1)."""
    text = decode_value(stream)
    if form == "raw":
        return text
    if form == "direct":
        return parse_events(text)
    raise ValueError("form must be 'direct' or 'raw'")


def start_bronze_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    form: str = "direct",
    fmt: str = "parquet",
    trigger="availableNow",
) -> StreamingQuery:
    """Start the Bronze stream into ``path`` (K1, K2, T-2..T-6)."""
    return write_stream(bronze_stream(stream, form), path, checkpoint, fmt=fmt, trigger=trigger)


def start_incremental_stream(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    variant: str = "local",
    fmt: str = "parquet",
    as_of=None,
    trigger="availableNow",
    tie_break=(),
) -> StreamingQuery:
    """Message stream -> Bronze under ``root/bronze`` -> incremental Silver/Gold
    under ``root``, per micro-batch (``foreachBatch`` +
    :func:`airlake.plans.medallion.run_incremental`).

    The batch is landed first, in a folder of its number, and Silver is merged
    from what was landed: Silver and Gold can be rebuilt from Bronze at any time.
    A micro-batch replayed after a failure overwrites the same folder and is
    merged again with the same latest-wins rule, which gives the same tables
    (``tie_break`` columns decide between equal ingestion times; without them
    such a tie is arbitrary): the checkpoint's at-least-once batches yield
    exactly-once results."""
    from airlake.plans.medallion import run_incremental
    from airlake.sinks.writers import _apply_trigger, write_table

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landed = write_table(batch, f"{root.rstrip('/')}/bronze/batch_id={batch_id}", fmt)
        bronze = read_table(spark, landed, fmt, schema=batch.schema)
        run_incremental(spark, bronze, root, variant, fmt, as_of, tie_break)

    w = bronze_stream(stream, "direct").writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return _apply_trigger(w, trigger).start()
