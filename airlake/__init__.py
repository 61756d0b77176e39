"""airlake: a Spark-native medallion engine for hourly air-quality readings.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions, so Catalyst sees the whole plan. Layout:

- ``airlake.schemas``     fixed schemas and constants
- ``airlake.functions``   column-expression helpers (timestamps, rounding, flags)
- ``airlake.sources``     table/stream readers, Kafka options, the test-table adapter
- ``airlake.operators``   ingest (validate/flatten), bronze, silver, gold, ranking
- ``airlake.sinks``       batch/stream writers, Kafka value encoder, file inventory
- ``airlake.streaming``   streaming Bronze jobs, incremental Silver/Gold per micro-batch
- ``airlake.plans``       end-to-end and incremental runs, catalog registration, SQL reports
"""

__version__ = "0.1.0"
