"""SQL reports over the Gold tables (Q1-Q4).

Each report is one SQL text with ``{table}`` placeholders. A placeholder is
filled either with a catalog table name (``"air_quality.daily_city_ranking"``)
or with a DataFrame, which PySpark binds as a temporary view for that one
statement (``spark.sql(text, name=df)``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPORTS = {
    # Q1: daily table by date, then city
    "daily_aqi": """
        SELECT * FROM {daily_city_aqi}
        ORDER BY measurement_date, city""",
    # Q2: each city's worst day(s): rank 1 of the within-city ranking
    "worst_day_per_city": """
        SELECT measurement_date, city, avg_european_aqi, {rank_col}
        FROM {daily_city_ranking}
        WHERE {rank_col} = 1
        ORDER BY measurement_date""",
    # Q3: freshness per city
    "freshness": """
        SELECT * FROM {data_freshness}
        ORDER BY city""",
    # Q4: completeness per city and day
    "completeness": """
        SELECT * FROM {data_completeness}
        ORDER BY measurement_date, city""",
}


def run_report(spark: SparkSession, name: str, rank_col: str = "rank", **tables) -> DataFrame:
    """Run report ``name``; ``tables`` maps placeholders to table names or DataFrames."""
    text = REPORTS[name].replace("{rank_col}", rank_col)
    names = {k: v for k, v in tables.items() if isinstance(v, str)}
    frames = {k: v for k, v in tables.items() if isinstance(v, DataFrame)}
    for k, v in names.items():
        text = text.replace("{" + k + "}", v)
    return spark.sql(text, **frames) if frames else spark.sql(text)
