"""Schemas and fixed values shared by all layers."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values (must equal the source system's definitions) -------------
# Fields every hourly response must carry: the time axis, then the variables.
REQUIRED_HOURLY_FIELDS = ["time", "nitrogen_dioxide", "pm10", "pm2_5", "european_aqi"]
# The city dimension: city_id, city, country, latitude, longitude.
CITIES = [
    (1, "Athens", "Greece", 37.9838, 23.7275),
    (2, "Thessaloniki", "Greece", 40.6401, 22.9444),
    (3, "London", "United Kingdom", 51.5072, -0.1276),
    (4, "Paris", "France", 48.8566, 2.3522),
    (5, "Berlin", "Germany", 52.5200, 13.4050),
]
SOURCE_NAME = "openmeteo"
EXPECTED_READINGS_PER_DAY = 24
CITY_COLUMNS = ["city_id", "city", "country", "latitude", "longitude"]
MEASURES = ["european_aqi", "pm10", "pm2_5", "nitrogen_dioxide"]

# One flat reading as it travels on the wire (Bronze structured form).
EVENT_SCHEMA = StructType(
    [
        StructField("source", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("city_id", IntegerType()),
        StructField("city", StringType()),
        StructField("country", StringType()),
        StructField("measurement_timestamp", StringType()),
        StructField("european_aqi", IntegerType()),
        StructField("pm10", DoubleType()),
        StructField("pm2_5", DoubleType()),
        StructField("nitrogen_dioxide", DoubleType()),
        StructField("ingestion_timestamp_utc", StringType()),
    ]
)

# Silver validity flags, in the order they are added.
FLAG_COLUMNS = [
    "is_valid_aqi",
    "is_valid_pm10",
    "is_valid_pm2_5",
    "is_valid_nitrogen_dioxide",
    "is_not_future_measurement",
]
# --- end of fixed values ----------------------------------------------------

EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()

SILVER_COLUMNS = EVENT_COLUMNS + FLAG_COLUMNS
DEDUP_KEYS = ["city_id", "measurement_timestamp"]
