"""Catalog operations: catalogs, schemas, external tables.

Open-source Spark has no ``USE CATALOG`` statement; the current catalog is set
through ``spark.catalog.setCurrentCatalog`` (``SET CATALOG`` in SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GOLD_TABLES = ("daily_city_aqi", "daily_city_ranking", "data_freshness", "data_completeness")


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def use_catalog(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentCatalog(name)


def ensure_schema(spark: SparkSession, schema: str, use: bool = True) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    if use:
        spark.sql(f"USE {schema}")


def drop_schema(spark: SparkSession, schema: str) -> None:
    """Forget a schema and its registrations; files of external tables stay, and
    so does what was already resolved from them."""
    spark.sql(f"DROP SCHEMA IF EXISTS {schema} CASCADE")


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")


def register_tables(spark: SparkSession, schema: str, locations: dict[str, str], fmt: str = "parquet") -> list[str]:
    """Register each ``name -> path`` as an external table ``schema.name``.

    ``CREATE TABLE IF NOT EXISTS`` keeps an existing registration; the table is
    then refreshed, because a location overwritten since the last read would
    otherwise fail with missing files in this session."""
    ensure_schema(spark, schema, use=False)
    names = []
    for name, path in locations.items():
        full = f"{schema}.{name}"
        escaped = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING {fmt} LOCATION '{escaped}'")
        spark.sql(f"REFRESH TABLE {full}")
        names.append(full)
    return names
