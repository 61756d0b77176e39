"""Batch and streaming writers.

``fmt`` selects Parquet (default) or Delta/any other DataSource V1/V2 format
whose jar is on the classpath; the code path is identical."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airlake.session import scratch_path


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by=None,
    sort_within=None,
    options: dict | None = None,
) -> str:
    """Batch write (K4, K5). ``partition_by`` enables partition pruning for
    readers (e.g. ``["measurement_date"]``); ``sort_within`` sorts rows inside
    each output file (no global shuffle).

    A partitioned write is preceded by a ``rebalance`` on the partition
    columns: written straight from a wide shuffle, every task would write one
    file per partition value (tasks x dates files). AQE sizes the rebalanced
    partitions to its advisory size and splits a skewed value (a date holding
    a third of the rows) over several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if options:
        writer = writer.options(**options)
    writer.save(path)
    return path


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: str | dict = "availableNow",
    output_mode: str = "append",
    query_name: str | None = None,
    partition_by=None,
) -> StreamingQuery:
    """Streaming file/table sink with checkpointed progress (K1, K2, T-2..T-6).

    ``trigger``: ``"availableNow"`` drains what is there and stops;
    ``"continuous"``/``None`` = default micro-batches until stopped; a dict is
    passed to ``DataStreamWriter.trigger`` (e.g. ``{"processingTime": "1 minute"}``).
    """
    w = (
        df.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    if query_name:
        w = w.queryName(query_name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = _apply_trigger(w, trigger)
    return w.start()


def _apply_trigger(w, trigger):
    if trigger == "availableNow":
        return w.trigger(availableNow=True)
    if trigger in (None, "continuous", "default"):
        return w
    if isinstance(trigger, dict):
        return w.trigger(**trigger)
    raise ValueError(f"unknown trigger {trigger!r}")


def drain(query: StreamingQuery, timeout: float = 600.0, poll: float = 0.1) -> list:
    """Let a query with a default or interval trigger go on until it is seen to
    have polled its source and found nothing new, then stop it (T-6). Returns
    the progress reports of the micro-batches that had input, in order.

    A failed query raises its exception; one that is still busy after
    ``timeout`` seconds is stopped and raises ``TimeoutError``."""
    batches, end = {}, time.monotonic() + timeout
    try:
        while True:
            status = query.status
            batches |= {p.batchId: p for p in query.recentProgress if p.numInputRows}
            if query.exception() is not None:
                raise query.exception()
            # only a poll that finds no data leaves this message
            if status["message"] == "Waiting for data to arrive" and not status["isTriggerActive"]:
                break
            if not query.isActive:
                break
            if time.monotonic() > end:
                raise TimeoutError(f"stream still busy after {timeout} s")
            time.sleep(poll)
        batches |= {p.batchId: p for p in query.recentProgress if p.numInputRows}
    finally:
        query.stop()
    return [batches[i] for i in sorted(batches)]


def preview_stream(
    df: DataFrame,
    query_name: str,
    checkpoint: str | None = None,
    trigger: str | dict = "availableNow",
    rows: int | None = 1000,
) -> StreamingQuery:
    """Named preview of a stream, queryable as ``spark.table(query_name)`` (K3,
    T-8, S7): its first ``rows`` rows as found by the reader, all of them with
    ``rows=None``.

    What the source holds now goes to files under the shared scratch folder, never to the
    driver; the view reads them back with LIMIT, so what reaches the driver is
    bounded by ``rows`` however long the stream is; without ``rows`` there is no
    LIMIT, whose rows all pass through one task. Returns after that; with a
    trigger other than ``availableNow`` the query goes on until stopped."""
    spark = df.sparkSession
    path = scratch_path(spark, f"preview-{query_name}")
    checkpoint = checkpoint or scratch_path(spark, f"preview-{query_name}-checkpoint")
    query = write_stream(df, path, checkpoint, trigger=trigger, query_name=query_name)
    if trigger == "availableNow":
        query.awaitTermination()
    else:
        query.processAllAvailable()
    found = spark.read.schema(df.schema).parquet(path)
    (found if rows is None else found.limit(rows)).createOrReplaceTempView(query_name)
    return query


def to_kafka_value(df: DataFrame, columns=None, key_col: str | None = None, keep_nulls: bool = False) -> DataFrame:
    """Rows -> Kafka records: ``value`` = UTF-8 JSON of the row (K6, K7).

    ``to_json`` omits NULL fields unless ``keep_nulls``; a reader with a fixed
    schema sees NULL either way. Write with
    ``.write.format("kafka").options(**kafka_options(...)).option("topic", t)``.
    """
    cols = columns or df.columns
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    value = F.to_json(F.struct(*cols), opts).cast("binary").alias("value")
    if key_col:
        return df.select(F.col(key_col).cast("string").cast("binary").alias("key"), value)
    return df.select(value)


def producer_options(options: dict) -> dict:
    """The producer side of reader options: connection and security settings
    (``kafka.*``) only; subscription, offsets and rate limits are dropped."""
    return {k: v for k, v in options.items() if k.startswith("kafka.")}


def write_kafka(df: DataFrame, options: dict, topic: str, columns=None, key_col: str | None = None) -> None:
    """Publish rows as JSON records to a Kafka topic in one batch job (K6, K7).

    ``options`` come from :func:`airlake.sources.tables.kafka_options` (the
    subscription-only keys are dropped); each task writes its own partition's
    records, so nothing passes through the driver."""
    (
        to_kafka_value(df, columns, key_col)
        .write.format("kafka")
        .options(**producer_options(options))
        .option("topic", topic)
        .save()
    )


def counted(df: DataFrame, name: str = "records"):
    """Attach a row counter that is filled by the next action on the returned
    DataFrame (I6) — no extra job. Returns ``(df, observation)``; read
    ``observation.get["n_rows"]`` after the action."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n_rows")), obs


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON-lines sample files (K8); absent values are written as ``null``. Read
    back with ``spark.read.json``; a single JSON array file needs ``multiLine=True`` instead."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def file_inventory(spark: SparkSession, path: str, fmt: str = "parquet", pattern: str = "*.parquet") -> DataFrame:
    """Files of a table folder: path, name, size and row count (K9).

    Files are listed by the ``binaryFile`` source without reading their content,
    so files that hold no rows are reported too (0 rows); rows are counted from
    the hidden ``_metadata`` column (one partial row per file per task)."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("length").alias("file_size"),
        )
    )
    rows = (
        spark.read.format(fmt).load(path).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("n"))
    )
    return files.join(rows, "file_path", "left").select(
        "file_path", "file_name", "file_size", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


def storage_smoke(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Create a one-row frame, overwrite it to ``path`` and read it back
    (K12, S5): proves the sink location is writable and readable."""
    df = spark.createDataFrame([("abc", 123)], ["test_col", "value"])
    df.write.format(fmt).mode("overwrite").save(path)
    return spark.read.format(fmt).load(path)
