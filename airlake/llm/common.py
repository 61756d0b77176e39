"""Helpers shared by the operators: Arrow mapping and hand-off tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType, _parse_datatype_string

from airlake.session import ensure_checkpoint_dir

#: Rows handed to a Python function at once; bounds a worker's memory by
#: this many texts whatever the Arrow batch size of the session is.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created there yet."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder named by
    ``spark.checkpoint.dir`` and read it back: cuts lineage, survives lost
    executors, and is computed once however often it is read."""
    path = shared_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def add_columns(
    df: DataFrame, fields: str, make: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]]
) -> DataFrame:
    """``df`` plus the columns of the DDL string ``fields``, computed by the
    function that ``make()`` returns (called once per task) from Arrow slices.
    Columns of ``df`` with the same names are replaced."""
    new: StructType = _parse_datatype_string(fields)
    base = df.drop(*new.names)

    def run(batches):
        compute = make()
        for part in slices(batches):
            added = compute(part)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *added], names=[*part.schema.names, *new.names]
            )

    return base.mapInArrow(run, StructType(base.schema.fields + new.fields))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as Python strings, null as the empty string."""
    return [t or "" for t in batch.column(column).to_pylist()]
