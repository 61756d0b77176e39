"""Silver: typed, validated, de-duplicated readings.

Order matters and follows the source system: cast -> key filter -> flags ->
keep rows whose flags are all true -> latest-wins de-duplication. Because
de-duplication runs after validation, an invalid newer reading never
displaces a valid older one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airlake.functions.checks import all_true, non_negative
from airlake.functions.timestamps import as_of_column, parse_timestamp
from airlake.schemas import DEDUP_KEYS, EVENT_COLUMNS, FLAG_COLUMNS, SOURCE_NAME


def typed_readings(df: DataFrame) -> DataFrame:
    """Cast both timestamp texts to TIMESTAMP (P4). Malformed text -> NULL."""
    cols = []
    for name in EVENT_COLUMNS:
        if name in ("measurement_timestamp", "ingestion_timestamp_utc"):
            cols.append(parse_timestamp(name).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def key_filtered(df: DataFrame, source: str = SOURCE_NAME) -> DataFrame:
    """Keep rows of ``source`` whose key fields and AQI are present (F2)."""
    return df.where(
        (F.col("source") == F.lit(source))
        & F.col("city_id").isNotNull()
        & F.col("measurement_timestamp").isNotNull()
        & F.col("european_aqi").isNotNull()
    )


def flag_readings(df: DataFrame, as_of=None) -> DataFrame:
    """Add the five boolean validity flags.

    Flags are NULL-safe (absent -> false; zero is valid). ``as_of`` is the
    "now" of the future check: ``None`` = ``current_timestamp()``.
    """
    return df.withColumns(
        {
            "is_valid_aqi": non_negative("european_aqi"),
            "is_valid_pm10": non_negative("pm10"),
            "is_valid_pm2_5": non_negative("pm2_5"),
            "is_valid_nitrogen_dioxide": non_negative("nitrogen_dioxide"),
            "is_not_future_measurement": F.col("measurement_timestamp") <= as_of_column(as_of),
        }
    )


def valid_readings(df: DataFrame) -> DataFrame:
    """Keep rows whose five flags are all true."""
    return df.where(all_true(FLAG_COLUMNS))


def latest_readings(
    df: DataFrame,
    keys=tuple(DEDUP_KEYS),
    order_col: str = "ingestion_timestamp_utc",
    tie_break=(),
) -> DataFrame:
    """Latest-wins de-duplication: one row per key, the greatest ``order_col``
    (W1, F6, P9).

    Planned as ``row_number() = 1``, which Catalyst turns into a partial
    ``WindowGroupLimit`` before the shuffle: each map task forwards at most one
    row per key, so a hot key costs one row per input partition, not all its
    rows. ``tie_break`` columns (descending) make equal ``order_col`` values
    deterministic; without them a tie is broken arbitrarily.
    """
    order = [F.col(order_col).desc()] + [F.col(c).desc() for c in tie_break]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def silver(df: DataFrame, as_of=None, tie_break=()) -> DataFrame:
    """Bronze structured rows -> Silver."""
    staged = valid_readings(flag_readings(key_filtered(typed_readings(df)), as_of))
    return latest_readings(staged, tie_break=tie_break)


def stage_counts(structured: DataFrame, as_of=None) -> DataFrame:
    """Row counts of each Silver stage in one job.

    structured_rows: Bronze structured input; filtered_rows: after the key
    filter; valid_rows: after the flag filter; silver_rows: distinct keys among
    valid rows (= rows after de-duplication).
    """
    flagged = flag_readings(typed_readings(structured), as_of)
    key_ok = (
        (F.col("source") == F.lit(SOURCE_NAME))
        & F.col("city_id").isNotNull()
        & F.col("measurement_timestamp").isNotNull()
        & F.col("european_aqi").isNotNull()
    )
    valid = key_ok & all_true(FLAG_COLUMNS)
    return flagged.select(key_ok.alias("_k"), valid.alias("_v"), *DEDUP_KEYS).agg(
        F.count(F.lit(1)).alias("structured_rows"),
        F.count_if(F.col("_k")).alias("filtered_rows"),
        F.count_if(F.col("_v")).alias("valid_rows"),
        F.count_distinct(F.when(F.col("_v"), F.struct(*DEDUP_KEYS))).alias("silver_rows"),
    )
