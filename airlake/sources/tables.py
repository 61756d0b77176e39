"""Batch and streaming readers.

Kafka and Delta are reached only through ``format`` + options: their
connector jars must be on the cluster's classpath. Everything else here is
plain Spark (Parquet, JSON, text, memory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from airlake.schemas import CITIES


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, spread: int | None = None) -> DataFrame:
    """Batch scan of a Parquet/Delta/JSON location.

    ``spread`` deals the rows over so many tasks before anything else is done
    with them, at the price of a shuffle of the columns read. It is for a caller who knows that the
    input is one file that cannot be split (a single row group) and that the work per row is heavy;
    nothing is spread unless asked."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    table = reader.load(path)
    return table.repartition(spread) if spread else table


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    sasl_username: str | None = None,
    sasl_password: str | None = None,
    login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
    extra: dict | None = None,
) -> dict:
    """Options for ``spark.readStream.format('kafka')``.

    Without credentials: a plaintext subscription. With them: SASL_SSL with the
    PLAIN mechanism and a JAAS line built from the given user and password (an
    Event Hubs namespace uses user ``$ConnectionString`` and the connection
    string as password). Callers pass secret values in; nothing is read here.

    ``max_offsets_per_trigger`` bounds each micro-batch (an ``availableNow``
    drain of a large backlog then runs as several bounded batches, each
    committed to the checkpoint); ``min_partitions`` splits topic partitions
    into more Spark tasks when the topic has fewer partitions than cores.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions is not None:
        opts["minPartitions"] = str(int(min_partitions))
    if sasl_username is not None:
        jaas = f'{login_module} required username="{sasl_username}" password="{sasl_password}";'
        opts.update(
            {
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config": jaas,
            }
        )
    if extra:
        opts.update(extra)
    return opts


def eventhub_kafka_options(namespace: str, name: str, policy: str, key: str, **kw) -> dict:
    """Kafka options for an Event Hubs namespace."""
    conn = f"Endpoint=sb://{namespace}.servicebus.windows.net/;SharedAccessKeyName={policy};SharedAccessKey={key}"
    return kafka_options(
        f"{namespace}.servicebus.windows.net:9093",
        name,
        sasl_username="$ConnectionString",
        sasl_password=conn,
        **kw,
    )


def read_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict | None = None,
    path: str | None = None,
    schema=None,
) -> DataFrame:
    """Streaming source (S1, S2). ``fmt='kafka'`` yields ``value BINARY``;
    file formats need a ``schema`` and a ``path``."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    return reader.load(path) if path is not None else reader.load()


_CITY_SCHEMA = StructType(
    [
        StructField("city_id", IntegerType()),
        StructField("city", StringType()),
        StructField("country", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
    ]
)


def city_dimension(spark: SparkSession) -> DataFrame:
    """The five-row city dimension as a DataFrame (bounded: safe to broadcast)."""
    return spark.createDataFrame(CITIES, _CITY_SCHEMA)
