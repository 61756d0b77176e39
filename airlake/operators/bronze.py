"""Bronze: raw message text -> typed event columns (map-only; stream or batch)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from airlake.schemas import EVENT_SCHEMA, SOURCE_NAME


def decode_value(df: DataFrame, value_col: str = "value", alias: str = "json_string", keep=()) -> DataFrame:
    """Kafka ``value`` BINARY -> UTF-8 text column ``json_string``."""
    return df.select(*keep, F.col(value_col).cast("string").alias(alias))


def parse_events(
    df: DataFrame,
    json_col: str = "json_string",
    schema=EVENT_SCHEMA,
    source: str | None = SOURCE_NAME,
    keep=(),
) -> DataFrame:
    """Parse JSON text with the fixed event schema, expand it, keep one source
    (P2, P3, F1).

    Parsing is PERMISSIVE: malformed text, a top-level array, an empty string
    or NULL all give an all-NULL row, which the source filter then drops. A
    field whose JSON type does not match (``"40"`` or ``40.0`` for an int) is
    NULL on an otherwise parsed row. ``source=None`` keeps every parsed row.
    """
    # inline(array(...)) materialises the parsed struct as columns behind a
    # Generate node. Filters on parsed fields cannot be pushed below it, so the
    # JSON text is parsed once per row; a plain ``select("data.*")`` lets every
    # downstream predicate be rewritten into its own from_json call.
    out = df.select(*keep, F.inline(F.array(F.from_json(F.col(json_col), schema))))
    if source is not None:
        out = out.where(F.col("source") == F.lit(source))
    return out


def parse_events_with_quarantine(
    df: DataFrame,
    json_col: str = "json_string",
    schema=EVENT_SCHEMA,
    corrupt_col: str = "_corrupt_record",
) -> DataFrame:
    """Like :func:`parse_events` without the source filter, plus a column that
    holds the original text of every record that failed to parse or had a
    field of the wrong JSON type (extension: quarantine instead of silent drop).
    """
    with_corrupt = schema
    if corrupt_col not in schema.fieldNames():
        with_corrupt = StructType(list(schema.fields) + [StructField(corrupt_col, StringType())])
    data = F.from_json(
        F.col(json_col), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col}
    )
    # same Generate barrier as parse_events: later filters must not re-parse
    parsed = df.select(F.inline(F.array(F.struct(data.alias("data"), F.col(json_col).alias("_text")))))
    out = parsed.select("data.*", "_text")
    # an all-NULL row with no corrupt text (NULL input) is also quarantined
    return out.withColumn(
        corrupt_col,
        F.when(F.col(corrupt_col).isNotNull(), F.col(corrupt_col))
        .when(F.col("_text").isNull() | (F.col("source").isNull()), F.coalesce(F.col("_text"), F.lit("")))
        .otherwise(F.lit(None)),
    ).drop("_text")
