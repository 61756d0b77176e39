"""Adapter from the driver's ``events`` table to air-quality inputs.

The test tables hold no air-quality data, so each ``events`` row becomes one
hourly reading. Modulus rules on ``event_id`` inject every bad-data case the
Silver layer must handle; measures are binary fractions so sums are exact in
any order. The same rules are restated in SQL for the DuckDB oracle
(``airlake.plans.oracle``); the two must stay in step.

City modes:

- ``"reference"``: the five fixed cities, picked by ``user_id % 5 + 1``.
- ``"per_user"``: one synthetic city per user (``city_id = user_id + 1``), so
  the number of Silver keys grows with the data (used by the benchmark).

Everything is a column expression over a parquet scan: map-only, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.functions.timestamps import iso_utc_text
from airlake.schemas import CITIES, EVENT_COLUMNS, SOURCE_NAME
from airlake.sources.tables import read_table

# --- fixed values of the adapter (restated in the oracle SQL) ---------------
MOD_OTHER_SOURCE = 23
MOD_NULL_CITY = 41
MOD_BAD_TIMESTAMP = 43
MOD_FUTURE_TIMESTAMP = 37
MOD_NULL_AQI, MOD_NEGATIVE_AQI = 29, 31
MOD_NULL_PM10, MOD_NEGATIVE_PM10 = 47, 53
MOD_NULL_PM2_5, MOD_NEGATIVE_PM2_5 = 59, 61
MOD_NULL_NO2, MOD_NEGATIVE_NO2 = 67, 71
MOD_JUNK_JSON = 73
FUTURE_TEXT = "2099-01-01T00:00"
JUNK_TEXT = "not json {"
# Hourly-response fixture: k = day_number * 31 + city_id, first match wins.
RESPONSE_DAY_ZERO = "2024-01-01"
MOD_CORRUPT_RESPONSE = 23
MOD_EMPTY_RESPONSE = 19
MOD_DROP_AQI_FIELD = 17
MOD_NULL_PM10_FIELD = 13
MOD_SHORT_PM10_ARRAY = 11
MOD_BAD_ELEMENT = 7
BAD_ELEMENT = "n/a"
TRUNCATED_RESPONSE = '{"hourly": {"time": ['
# Default "now" for reproducible Silver runs over the fixture.
FIXTURE_AS_OF = "2025-01-01 00:00:00"
# An earlier "now", before half of the fixture's measurements.
EARLY_AS_OF = "2024-01-15 12:00:00"
# --- end of fixed values ----------------------------------------------------


#: Session setting of a caller who wants a test table, one row group in one file, spread.
SPREAD = "airlake.fixtures.spread"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table, spread over tasks only if the session says so."""
    spread = int(spark.conf.get(SPREAD, "0"))
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", spread=spread)


def _every(n: int) -> Column:
    return (F.col("event_id") % n) == 0


def _city_attributes(city_key: Column, cities: str) -> dict[str, Column]:
    """city_id (before null injection), city, country, latitude, longitude."""
    if cities == "reference":
        idx = (city_key % len(CITIES) + 1).cast("int")
        table = F.array(
            *[
                F.struct(
                    F.lit(name).alias("city"),
                    F.lit(country).alias("country"),
                    F.lit(lat).alias("latitude"),
                    F.lit(lon).alias("longitude"),
                )
                for (_cid, name, country, lat, lon) in CITIES
            ]
        )
        row = F.element_at(table, idx)
        return {
            "city_id": idx,
            "city": row["city"],
            "country": row["country"],
            "latitude": row["latitude"],
            "longitude": row["longitude"],
        }
    if cities == "per_user":
        cid = (city_key + 1).cast("int")
        return {
            "city_id": cid,
            "city": F.concat(F.lit("city_"), cid.cast("string")),
            "country": F.concat(F.lit("country_"), (cid % 20).cast("string")),
            "latitude": ((cid * 7) % 180 - 90).cast("double"),
            "longitude": ((cid * 13) % 360 - 180).cast("double"),
        }
    raise ValueError(f"unknown city mode {cities!r}")


def _measure(value: Column, null_mod: int, neg_mod: int, clean: Column) -> Column:
    return F.when(_every(null_mod), F.lit(None)).when(_every(neg_mod), F.lit(-1)).otherwise(clean)


def aqi_rows(events: DataFrame, cities: str = "reference") -> DataFrame:
    """``event_id`` + the 12 typed event fields, bad cases injected."""
    v = F.col("value")
    city = _city_attributes(F.col("user_id"), cities)
    return events.select(
        "event_id",
        F.when(_every(MOD_OTHER_SOURCE), F.lit("other")).otherwise(F.lit(SOURCE_NAME)).alias("source"),
        city["latitude"].alias("latitude"),
        city["longitude"].alias("longitude"),
        F.when(_every(MOD_NULL_CITY), F.lit(None)).otherwise(city["city_id"]).cast("int").alias("city_id"),
        city["city"].alias("city"),
        city["country"].alias("country"),
        F.when(_every(MOD_BAD_TIMESTAMP), F.lit("bad"))
        .when(_every(MOD_FUTURE_TIMESTAMP), F.lit(FUTURE_TEXT))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:00"))
        .alias("measurement_timestamp"),
        _measure(v, MOD_NULL_AQI, MOD_NEGATIVE_AQI, F.floor(v)).cast("int").alias("european_aqi"),
        _measure(v, MOD_NULL_PM10, MOD_NEGATIVE_PM10, F.floor(v * 4) / 4).cast("double").alias("pm10"),
        _measure(v, MOD_NULL_PM2_5, MOD_NEGATIVE_PM2_5, F.floor(v * 2) / 4).cast("double").alias("pm2_5"),
        _measure(v, MOD_NULL_NO2, MOD_NEGATIVE_NO2, F.floor(v * 8) / 16)
        .cast("double")
        .alias("nitrogen_dioxide"),
        iso_utc_text("ts").alias("ingestion_timestamp_utc"),
    )


def aqi_json(events: DataFrame, cities: str = "reference") -> DataFrame:
    """Raw Bronze form: ``event_id``, ``json_string`` (one JSON object per
    reading; unparseable text for every ``MOD_JUNK_JSON``-th event)."""
    rows = aqi_rows(events, cities)
    text = F.to_json(F.struct(*EVENT_COLUMNS))
    return rows.select(
        "event_id",
        F.when(_every(MOD_JUNK_JSON), F.lit(JUNK_TEXT)).otherwise(text).alias("json_string"),
    )


def aqi_kafka_records(events: DataFrame, cities: str = "reference") -> DataFrame:
    """Kafka-shaped records: ``value BINARY`` (plus ``event_id`` for tracing)."""
    return aqi_json(events, cities).select("event_id", F.col("json_string").cast("binary").alias("value"))


def hourly_responses(events: DataFrame, cities: str = "reference") -> DataFrame:
    """API-response fixture: one JSON response per (city, day).

    Per (city, hour) the latest event (by ``ts``) gives the reading, so each
    response holds at most 24 hourly entries whatever the data volume. Arrays
    are sorted by hour. Defects are injected per response by modulus rules on
    ``k = day_number * 31 + city_id``.

    Columns: city_id, response_date, ingestion_timestamp_utc, response_json.
    """
    city = _city_attributes(F.col("user_id"), cities)
    base = events.where(F.col("ts").isNotNull() & F.col("user_id").isNotNull()).select(
        city["city_id"].alias("city_id"),
        F.date_trunc("hour", "ts").alias("hour"),
        "ts",
        "value",
    )
    # Skew-safe: max_by is a hash aggregate with map-side partial combine.
    hourly = base.groupBy("city_id", "hour").agg(
        F.max_by("value", "ts").alias("value"), F.max("ts").alias("last_ts")
    )
    daily = hourly.groupBy("city_id", F.to_date("hour").alias("response_date")).agg(
        F.sort_array(F.collect_list(F.struct("hour", "value"))).alias("h"),
        F.max("last_ts").alias("ingest_ts"),
    )
    h = F.col("h")
    arrays = {
        "time": F.transform(h, lambda x: F.date_format(x["hour"], "yyyy-MM-dd'T'HH:00")),
        "nitrogen_dioxide": F.transform(h, lambda x: F.floor(x["value"] * 8) / 16),
        "pm10": F.transform(h, lambda x: (F.floor(x["value"] * 4) / 4).cast("double")),
        "pm2_5": F.transform(h, lambda x: F.floor(x["value"] * 2) / 4),
        "european_aqi": F.transform(h, lambda x: F.floor(x["value"]).cast("int")),
    }

    def response(fields: dict[str, Column], keep_nulls: bool = False) -> Column:
        body = F.struct(F.struct(*[c.alias(n) for n, c in fields.items()]).alias("hourly"))
        return F.to_json(body, {"ignoreNullFields": "false"}) if keep_nulls else F.to_json(body)

    empty = {n: F.filter(c, lambda _x: F.lit(False)) for n, c in arrays.items()}
    no_aqi = {n: c for n, c in arrays.items() if n != "european_aqi"}
    null_pm10 = {**arrays, "pm10": F.lit(None).cast("array<double>")}
    short_pm10 = {**arrays, "pm10": F.slice(arrays["pm10"], 1, F.size(arrays["pm10"]) - 1)}

    # one element of another type: the first hour's AQI becomes a string
    bad_element = F.regexp_replace(
        response(arrays), r'("european_aqi":\[)-?[0-9]+', f'$1"{BAD_ELEMENT}"'
    )

    k = F.datediff(F.col("response_date"), F.lit(RESPONSE_DAY_ZERO).cast("date")) * 31 + F.col("city_id")
    text = (
        F.when(k % MOD_CORRUPT_RESPONSE == 0, F.lit(TRUNCATED_RESPONSE))
        .when(k % MOD_EMPTY_RESPONSE == 0, response(empty))
        .when(k % MOD_DROP_AQI_FIELD == 0, response(no_aqi))
        .when(k % MOD_NULL_PM10_FIELD == 0, response(null_pm10, keep_nulls=True))
        .when(k % MOD_SHORT_PM10_ARRAY == 0, response(short_pm10))
        .when(k % MOD_BAD_ELEMENT == 0, bad_element)
        .otherwise(response(arrays))
    )
    return daily.select(
        "city_id",
        "response_date",
        iso_utc_text("ingest_ts").alias("ingestion_timestamp_utc"),
        text.alias("response_json"),
    )


def per_user_cities(events: DataFrame) -> DataFrame:
    """City dimension for ``cities='per_user'``: one row per distinct user.

    Grows with the data, so it is joined without a broadcast hint (AQE picks
    the strategy from runtime sizes)."""
    attrs = _city_attributes(F.col("user_id"), "per_user")
    users = events.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    return users.select(*[attrs[c].alias(c) for c in ["city_id", "city", "country", "latitude", "longitude"]])
