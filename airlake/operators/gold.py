"""Gold: daily reporting tables derived from Silver.

Two variants of the source system disagree on several details; each is a
parameter here and a preset in :data:`VARIANTS`:

=====================  ==========================  ============================
aspect                 local                        cloud
=====================  ==========================  ============================
PM2.5 / NO2 avg scale  2 decimals                   0 decimals
record_count column    no                           yes
ranking                dense_rank within a day      rank within a city
rank column            ``aqi_rank``                 ``rank``
freshness columns      latest ingestion             + latest measurement
=====================  ==========================  ============================

All aggregates are algebraic (avg, max, count), so Spark plans partial
aggregation before the shuffle: a city holding a third of all rows costs
one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.operators.ranking import rank_within
from airlake.schemas import EXPECTED_READINGS_PER_DAY, MEASURES
from airlake.session import ensure_checkpoint_dir

EXACT_SCALES = dict.fromkeys(MEASURES)
LOCAL_SCALES = {"european_aqi": 2, "pm10": 2, "pm2_5": 2, "nitrogen_dioxide": 2}
CLOUD_SCALES = {"european_aqi": 2, "pm10": 2, "pm2_5": 0, "nitrogen_dioxide": 0}

VARIANTS = {
    "local": {
        "scales": LOCAL_SCALES,
        "with_count": False,
        "rank_partition": "measurement_date",
        "rank_method": "dense_rank",
        "rank_alias": "aqi_rank",
        "freshness": ("ingestion_timestamp_utc",),
    },
    "cloud": {
        "scales": CLOUD_SCALES,
        "with_count": True,
        "rank_partition": "city",
        "rank_method": "rank",
        "rank_alias": "rank",
        "freshness": ("ingestion_timestamp_utc", "measurement_timestamp"),
    },
}

DAILY_KEYS = ("city", "measurement_date")


def with_measurement_date(df: DataFrame) -> DataFrame:
    """Add ``measurement_date`` = session-zone date of the measurement."""
    return df.withColumn("measurement_date", F.to_date("measurement_timestamp"))


def daily_city_aqi(
    df: DataFrame,
    scales: dict | None = None,
    with_count: bool = False,
    keys=DAILY_KEYS,
    sort: bool = False,
) -> DataFrame:
    """Per (city, date): rounded average and maximum of each measure (A1, A2).

    ``scales`` maps a measure to the decimals of its rounded average (HALF_UP);
    None leaves the average as it is.
    ``with_count`` adds ``record_count``. ``sort`` orders the result by the
    keys (a range shuffle; do it at the sink, not before further work).
    """
    scales = LOCAL_SCALES if scales is None else scales
    if "measurement_date" in keys and "measurement_date" not in df.columns:
        df = with_measurement_date(df)
    aggs = []
    for m in MEASURES:
        average = F.avg(m) if scales[m] is None else F.round(F.avg(m), scales[m])
        aggs.append(average.alias(f"avg_{m}"))
        aggs.append(F.max(m).alias(f"max_{m}"))
    if with_count:
        aggs.append(F.count(F.lit(1)).alias("record_count"))
    out = df.groupBy(*keys).agg(*aggs)
    return out.orderBy(*keys) if sort else out


def rank_daily(
    daily: DataFrame,
    partition_by: str = "measurement_date",
    method: str = "dense_rank",
    alias: str = "aqi_rank",
    order_col: str = "avg_european_aqi",
    strategy: str = "window",
) -> DataFrame:
    """Rank daily rows by the (rounded) average AQI, highest first.

    Ties come from rounding and are kept as ties. Unrounded averages
    (``EXACT_SCALES``) of many cities need ``strategy="ranges"``."""
    return rank_within(daily, partition_by, order_col, method=method, alias=alias, strategy=strategy)


def data_freshness(df: DataFrame, columns=("ingestion_timestamp_utc",), key: str = "city") -> DataFrame:
    """Per city, the latest value of each timestamp column (A3, A4).

    ``ingestion_timestamp_utc`` -> ``latest_ingestion_timestamp_utc`` and
    ``measurement_timestamp`` -> ``latest_measurement_timestamp``."""
    return df.groupBy(key).agg(*[F.max(c).alias(f"latest_{c}") for c in columns])


def data_completeness(
    df: DataFrame, expected: int = EXPECTED_READINGS_PER_DAY, keys=DAILY_KEYS
) -> DataFrame:
    """Per (city, date) with at least one reading: actual vs expected count and
    the percentage rounded to 2 decimals (A5, P7, P8). Silent days are absent."""
    if "measurement_date" in keys and "measurement_date" not in df.columns:
        df = with_measurement_date(df)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("actual_records"))
        .withColumn("expected_records", F.lit(int(expected)))
        .withColumn(
            "completeness_pct",
            F.round(F.col("actual_records") / F.col("expected_records") * 100, 2),
        )
    )


def completeness_from_daily(daily: DataFrame, expected: int = EXPECTED_READINGS_PER_DAY) -> DataFrame:
    """:func:`data_completeness` from a daily table that carries ``record_count``
    (no second pass over Silver)."""
    return daily.select(
        "city",
        "measurement_date",
        F.col("record_count").alias("actual_records"),
        F.lit(int(expected)).alias("expected_records"),
        F.round(F.col("record_count") / F.lit(int(expected)) * 100, 2).alias("completeness_pct"),
    )


def gold_rollup(silver: DataFrame, variant: str = "local") -> DataFrame:
    """One row per (city, date) with every aggregate any Gold table needs."""
    p = VARIANTS[variant]
    aggs = []
    for m in MEASURES:
        aggs.append(F.round(F.avg(m), p["scales"][m]).alias(f"avg_{m}"))
        aggs.append(F.max(m).alias(f"max_{m}"))
    aggs += [
        F.count(F.lit(1)).alias("record_count"),
        F.max("ingestion_timestamp_utc").alias("latest_ingestion_timestamp_utc"),
        F.max("measurement_timestamp").alias("latest_measurement_timestamp"),
    ]
    return with_measurement_date(silver).groupBy(*DAILY_KEYS).agg(*aggs)


def gold_from_rollup(rollup: DataFrame, variant: str = "local") -> dict[str, DataFrame]:
    """The four Gold tables from a (city, date) rollup that is checkpointed or
    written (the ranking and each table read it again).

    Cities within a day (local variant) are ranked by distinct values: a window
    over the cities of a day would be one task per day. Days within a city
    (cloud variant) are bounded by the calendar: a window."""
    p = VARIANTS[variant]
    keep = ["city", "measurement_date"] + [f"{k}_{m}" for m in MEASURES for k in ("avg", "max")]
    if p["with_count"]:
        keep.append("record_count")
    daily = rollup.select(*keep)
    return {
        "daily_city_aqi": daily,
        "daily_city_ranking": rank_daily(
            daily,
            p["rank_partition"],
            p["rank_method"],
            p["rank_alias"],
            strategy="values" if p["rank_partition"] == "measurement_date" else "window",
        ),
        "data_freshness": freshness_from_rollup(rollup, variant),
        "data_completeness": completeness_from_daily(rollup),
    }


def freshness_from_rollup(rollup: DataFrame, variant: str = "local") -> DataFrame:
    columns = [f"latest_{c}" for c in VARIANTS[variant]["freshness"]]
    return rollup.groupBy("city").agg(*[F.max(c).alias(c) for c in columns])


def gold_tables(silver: DataFrame, variant: str = "local") -> dict[str, DataFrame]:
    """The four Gold tables of a variant. Silver is read once: its (city, date)
    rollup is checkpointed to the shared folder and every table derives from it."""
    ensure_checkpoint_dir(silver.sparkSession)
    return gold_from_rollup(gold_rollup(silver, variant).checkpoint(eager=True), variant)
