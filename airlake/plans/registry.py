"""Registered queries: one per operator, each over the driver's test tables.

Every query reads ``events`` (or a table of the given folder), adapts it with
:mod:`airlake.sources.fixtures` and runs the operator over the whole table.
Timestamps are presented as TIMESTAMP_NTZ at the edge (measurement = wall
clock, ingestion = UTC wall clock) so results do not depend on the session
time zone. The DuckDB restatement of each query is in
:mod:`airlake.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.functions.timestamps import to_utc_wallclock, to_wallclock
from airlake.operators import bronze, gold, ingest, silver
from airlake.plans import catalog
from airlake.plans.medallion import run_batch, run_incremental, run_silver_incremental
from airlake.plans.reports import run_report
from airlake.schemas import EVENT_SCHEMA, MEASURES
from airlake.session import scratch_path
from airlake.sinks.writers import counted, drain, file_inventory, preview_stream, to_kafka_value, write_json, write_table
from airlake.sources import fixtures
from airlake.sources.tables import city_dimension
from airlake.streaming.bronze_stream import bronze_stream, file_value_stream, start_bronze_stream

AS_OF = fixtures.FIXTURE_AS_OF

_WALLCLOCK = ("measurement_timestamp", "latest_measurement_timestamp")
_UTC = ("ingestion_timestamp_utc", "latest_ingestion_timestamp_utc")


def present(df: DataFrame) -> DataFrame:
    """Zone-free presentation of timestamp columns (TIMESTAMP -> TIMESTAMP_NTZ)."""
    types = dict(df.dtypes)
    cols = []
    for c in df.columns:
        if c in _WALLCLOCK and types[c] == "timestamp":
            cols.append(to_wallclock(c).alias(c))
        elif c in _UTC and types[c] == "timestamp":
            cols.append(to_utc_wallclock(c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.load(spark, sf, "events")


def _bronze(spark, sf, cities="reference") -> DataFrame:
    return bronze.parse_events(fixtures.aqi_json(_events(spark, sf), cities))


def _typed(spark, sf, cities="reference") -> DataFrame:
    return silver.typed_readings(_bronze(spark, sf, cities))


def _flagged(spark, sf, cities="reference") -> DataFrame:
    return silver.flag_readings(silver.key_filtered(_typed(spark, sf, cities)), AS_OF)


def _silver(spark, sf, cities="reference") -> DataFrame:
    return silver.silver(_bronze(spark, sf, cities), as_of=AS_OF, tie_break=MEASURES)


def _daily(spark, sf, variant, sort=False) -> DataFrame:
    p = gold.VARIANTS[variant]
    return gold.daily_city_aqi(_silver(spark, sf), p["scales"], p["with_count"], sort=sort)


def _freshness(spark, sf, variant) -> DataFrame:
    return present(gold.data_freshness(_silver(spark, sf), gold.VARIANTS[variant]["freshness"]))


def _cloud_ranking(spark, sf) -> DataFrame:
    """Days ranked within a city: bounded by the calendar, one lazy plan."""
    p = gold.VARIANTS["cloud"]
    return gold.rank_daily(_daily(spark, sf, "cloud"), p["rank_partition"], p["rank_method"], p["rank_alias"])


def q_decode_value(spark, sf):
    ev = _events(spark, sf).select("event_id", F.col("props").cast("binary").alias("value"))
    return bronze.decode_value(ev, keep=("event_id",))


def q_parse_events(spark, sf):
    return _bronze(spark, sf)


def q_typed_readings(spark, sf):
    return present(_typed(spark, sf))


def q_key_filtered(spark, sf):
    return present(silver.key_filtered(_typed(spark, sf)))


def q_flag_readings(spark, sf):
    return present(_flagged(spark, sf))


def q_valid_readings(spark, sf):
    return present(silver.valid_readings(_flagged(spark, sf)))


def q_latest_readings(spark, sf):
    return present(_silver(spark, sf))


def q_latest_readings_per_user(spark, sf):
    return present(_silver(spark, sf, "per_user"))


def q_latest_readings_incremental(spark, sf):
    """Silver built by two incremental merges (events split by parity, so
    readings of one key arrive in both batches); equals ``latest_readings``."""
    silver_path = scratch_path(spark, "silver-incremental")
    for batch in _halves(spark, sf):
        run_silver_incremental(spark, batch, silver_path, as_of=AS_OF, tie_break=MEASURES)
    return present(spark.read.parquet(silver_path).drop("measurement_date"))


def _halves(spark, sf) -> list[DataFrame]:
    """The events' readings in two batches of whole event ids, by parity."""
    tagged = bronze.parse_events(fixtures.aqi_json(_events(spark, sf)), keep=("event_id",))
    return [tagged.where(F.col("event_id") % 2 == parity).drop("event_id") for parity in (0, 1)]


def q_latest_readings_incremental_advancing(spark, sf):
    """Two incremental merges while the clock advances: most readings of the
    first batch are in the future when they arrive and must become valid
    later. Equals ``latest_readings``, a full recompute at the last ``as_of``."""
    silver_path = scratch_path(spark, "silver-advancing")
    for batch, as_of in zip(_halves(spark, sf), (fixtures.EARLY_AS_OF, AS_OF), strict=True):
        run_silver_incremental(spark, batch, silver_path, as_of=as_of, tie_break=MEASURES)
    return present(spark.read.parquet(silver_path).drop("measurement_date"))


def q_data_freshness_incremental(spark, sf):
    """Freshness after two incremental runs with an advancing clock."""
    root = scratch_path(spark, "freshness-incremental")
    for batch, as_of in zip(_halves(spark, sf), (fixtures.EARLY_AS_OF, AS_OF), strict=True):
        paths = run_incremental(spark, batch, root, "local", as_of=as_of, tie_break=MEASURES)
    return present(spark.read.parquet(paths["data_freshness"]))


def q_gold_incremental_recovery(spark, sf):
    """Gold after a run that stopped between Silver and Gold and was repeated.

    The first batch has the readings of even days, most of them in the future when
    they arrive; the second one those of odd days. The run that stops merges
    what has become valid on even days, so its repetition no longer finds these dates
    in the batch or the pending table: only the journal knows them."""
    root, rows = scratch_path(spark, "gold-recovery"), _bronze(spark, sf)
    day = F.expr("try_cast(substring(measurement_timestamp, 9, 2) AS int)")
    odd = F.coalesce(day % 2 == 1, F.lit(False))
    run_incremental(spark, rows.where(~odd), root, "local", as_of=fixtures.EARLY_AS_OF, tie_break=MEASURES)
    run_silver_incremental(spark, rows.where(odd), f"{root}/silver", as_of=AS_OF, tie_break=MEASURES)
    paths = run_incremental(spark, rows.where(odd), root, "local", as_of=AS_OF, tie_break=MEASURES)
    tables = {k: spark.read.parquet(p) for k, p in paths.items()}
    ranks = tables["daily_city_ranking"].select("city", "measurement_date", "avg_european_aqi", "aqi_rank")
    found = tables["data_completeness"].join(ranks, ["city", "measurement_date"], "full")
    return present(found.join(tables["data_freshness"], "city", "full"))


def q_daily_city_ranking_cloud_incremental(spark, sf):
    """Days ranked within a city after two incremental runs into a bucketed table."""
    root = scratch_path(spark, "ranking-incremental")
    for batch in _halves(spark, sf):
        paths = run_incremental(spark, batch, root, "cloud", as_of=AS_OF, tie_break=MEASURES, ranking_buckets=16)
    return spark.read.parquet(paths["daily_city_ranking"]).drop("city_bucket")


def q_stage_counts(spark, sf):
    return silver.stage_counts(_bronze(spark, sf), as_of=AS_OF)


def q_with_measurement_date(spark, sf):
    return present(gold.with_measurement_date(_silver(spark, sf)))


def q_daily_city_aqi(spark, sf):
    return _daily(spark, sf, "local", sort=True)


def q_daily_city_aqi_cloud(spark, sf):
    return _daily(spark, sf, "cloud", sort=True)


def q_daily_city_ranking(spark, sf):
    return gold.gold_tables(_silver(spark, sf), "local")["daily_city_ranking"]


def q_daily_city_ranking_per_user(spark, sf):
    """Per-user cities: the cities of one day grow with the data."""
    return gold.gold_tables(_silver(spark, sf, "per_user"), "local")["daily_city_ranking"]


def q_daily_city_ranking_exact_values(spark, sf):
    """Per-user cities ranked by unrounded averages: nearly every city of a day
    has a value of its own."""
    daily = gold.daily_city_aqi(_silver(spark, sf, "per_user"), gold.EXACT_SCALES)
    ranked = gold.rank_daily(daily.select("city", "measurement_date", "avg_european_aqi"), strategy="ranges")
    by_row = gold.rank_daily(ranked, method="rank", alias="row_rank", strategy="ranges")
    return by_row.select("city", "measurement_date", "avg_european_aqi", "aqi_rank", "row_rank")


def q_daily_city_ranking_cloud(spark, sf):
    return _cloud_ranking(spark, sf)


def q_data_freshness(spark, sf):
    return _freshness(spark, sf, "local")


def q_data_freshness_cloud(spark, sf):
    return _freshness(spark, sf, "cloud")


def q_data_completeness(spark, sf):
    return gold.data_completeness(_silver(spark, sf))


def q_data_completeness_per_user(spark, sf):
    return gold.data_completeness(_silver(spark, sf, "per_user"))


def q_report_daily_aqi(spark, sf):
    return run_report(spark, "daily_aqi", daily_city_aqi=_daily(spark, sf, "cloud"))


def q_worst_day_per_city(spark, sf):
    return run_report(spark, "worst_day_per_city", daily_city_ranking=_cloud_ranking(spark, sf))


def q_report_freshness(spark, sf):
    return run_report(spark, "freshness", data_freshness=_freshness(spark, sf, "cloud"))


def q_report_completeness(spark, sf):
    return run_report(spark, "completeness", data_completeness=gold.data_completeness(_silver(spark, sf)))


def q_validate_responses(spark, sf):
    resp = fixtures.hourly_responses(_events(spark, sf))
    return ingest.validate_responses(resp).select("city_id", "response_date", "reject_reason", "reject_fields")


def q_validate_responses_per_user(spark, sf):
    ev = _events(spark, sf)
    checked = ingest.validate_responses(
        fixtures.hourly_responses(ev, "per_user"), cities=fixtures.per_user_cities(ev)
    )
    return checked.select("city_id", "response_date", "reject_reason", "reject_fields")


def q_flatten_hourly(spark, sf):
    resp = fixtures.hourly_responses(_events(spark, sf))
    return ingest.flatten_hourly(resp, city_dimension(spark))


def q_flatten_hourly_per_user(spark, sf):
    ev = _events(spark, sf)
    resp = fixtures.hourly_responses(ev, "per_user")
    # the per-user dimension grows with the data: AQE decides from its size
    return ingest.flatten_hourly(resp, fixtures.per_user_cities(ev))


def _lenient_responses(spark, sf) -> DataFrame:
    """The responses as lenient writers put them: in cities with an odd id the
    first PM10 is a bare NaN, in the others the key of PM2.5 is there twice."""
    odd = F.col("city_id") % 2 == 1
    with_nan = F.regexp_replace("response_json", r'("pm10":\[)[^,\]]+', "$1NaN")
    repeated = F.regexp_replace("response_json", '"pm2_5":', '"pm2_5":"first","pm2_5":')
    responses = fixtures.hourly_responses(_events(spark, sf))
    return responses.withColumn("response_json", F.when(odd, with_nan).otherwise(repeated))


def q_validate_responses_lenient(spark, sf):
    checked = ingest.validate_responses(_lenient_responses(spark, sf))
    return checked.select("city_id", "response_date", "reject_reason", "reject_fields")


def q_flatten_hourly_lenient(spark, sf):
    rows = ingest.flatten_hourly(_lenient_responses(spark, sf), city_dimension(spark))
    nan = F.coalesce(F.isnan("pm10"), F.lit(False))
    return rows.withColumn("pm10_is_nan", nan).withColumn("pm10", F.when(~nan, F.col("pm10")))


def q_event_json_roundtrip(spark, sf):
    rows = fixtures.aqi_rows(_events(spark, sf))
    records = to_kafka_value(rows.drop("event_id"))
    return bronze.parse_events(bronze.decode_value(records))


def q_bronze_preview(spark, sf):
    return _bronze(spark, sf).orderBy(F.col("ingestion_timestamp_utc").asc_nulls_last()).limit(20)


def q_bronze_stream(spark, sf):
    """File-backed message stream -> streaming Bronze (availableNow) -> read back."""
    src = scratch_path(spark, "bronze-stream-src")
    out = scratch_path(spark, "bronze-stream-out")
    ckpt = scratch_path(spark, "bronze-stream-ckpt")
    write_table(fixtures.aqi_kafka_records(_events(spark, sf)).select("value"), src)
    q = start_bronze_stream(file_value_stream(spark, src), out, ckpt, form="direct", trigger="availableNow")
    q.awaitTermination()
    return spark.read.parquet(out)


def q_bronze_stream_resume(spark, sf):
    """The stream over two drops of files with one checkpoint: the second run
    resumes behind the first one's offsets."""
    src, out, ckpt = (scratch_path(spark, f"bronze-resume-{n}") for n in ("src", "out", "ckpt"))
    records = fixtures.aqi_kafka_records(_events(spark, sf))
    for parity in (0, 1):
        drop = records.where(F.col("event_id") % 2 == parity).select("value")
        write_table(drop, f"{src}/drop={parity}")
        stream = file_value_stream(spark, f"{src}/*")
        start_bronze_stream(stream, out, ckpt, form="direct", trigger="availableNow").awaitTermination()
    return spark.read.parquet(out)


def q_bronze_stream_default_trigger(spark, sf):
    """Six files drained two at a time with the default trigger, until the query's
    own progress shows nothing left."""
    src, out, ckpt = (scratch_path(spark, f"bronze-default-{n}") for n in ("src", "out", "ckpt"))
    write_table(fixtures.aqi_kafka_records(_events(spark, sf)).select("value").repartition(6), src)
    stream = file_value_stream(spark, src, max_files=2)
    batches = drain(start_bronze_stream(stream, out, ckpt, form="direct", trigger=None))
    return spark.read.parquet(out).withColumn("n_batches", F.lit(len(batches)).cast("long"))


def q_stream_preview(spark, sf):
    """Rows that a preview of the whole stream shows, by name."""
    src = scratch_path(spark, "preview-src")
    records = fixtures.aqi_kafka_records(_events(spark, sf))
    write_table(records.select("value"), src)
    name = f"preview_{uuid.uuid4().hex}"
    preview_stream(bronze_stream(file_value_stream(spark, src), "raw"), name, rows=None)
    parsed = F.from_json("json_string", EVENT_SCHEMA)
    shown = spark.table(name).select((F.col("json_string") == fixtures.JUNK_TEXT).alias("junk"), parsed.alias("r"))
    return shown.select("junk", "r.source", "r.city_id", "r.measurement_timestamp", "r.european_aqi", "r.pm10")


def q_record_count(spark, sf):
    """The count observed while Bronze is written (no job of its own)."""
    df, seen = counted(_bronze(spark, sf), f"records-{uuid.uuid4().hex}")
    write_table(df, scratch_path(spark, "counted"))
    return spark.range(1).select(F.lit(seen.get["n_rows"]).cast("long").alias("n_rows"))


def q_catalog_reports(spark, sf):
    """Batch run, Gold registered as external tables of a schema, and the
    worst-day report by table name, for the tables the schema lists."""
    bronze_path = write_table(_bronze(spark, sf), scratch_path(spark, "catalog-bronze"))
    paths = run_batch(spark, bronze_path, scratch_path(spark, "catalog-lake"), "cloud", as_of=AS_OF, tie_break=MEASURES)
    schema = f"airlake_{uuid.uuid4().hex}"
    catalog.register_tables(spark, schema, {k: v for k, v in paths.items() if k != "silver"})
    listed = catalog.list_tables(spark, schema).count()
    worst = run_report(spark, "worst_day_per_city", daily_city_ranking=f"{schema}.daily_city_ranking")
    catalog.drop_schema(spark, schema)
    return worst.withColumn("n_tables", F.lit(listed).cast("long"))


def q_catalog_switch(spark, sf):
    """The worst-day report by three-part name, after switching to a catalog that
    the session lists."""
    bronze_path = write_table(_bronze(spark, sf), scratch_path(spark, "switch-bronze"))
    paths = run_batch(spark, bronze_path, scratch_path(spark, "switch-lake"), "cloud", as_of=AS_OF, tie_break=MEASURES)
    schema, before = f"airlake_{uuid.uuid4().hex}", spark.catalog.currentCatalog()
    listed = [r.catalog for r in catalog.list_catalogs(spark).collect()]
    try:
        catalog.use_catalog(spark, listed[0])
        catalog.register_tables(spark, schema, {"daily_city_ranking": paths["daily_city_ranking"]})
        worst = run_report(spark, "worst_day_per_city", daily_city_ranking=f"{listed[0]}.{schema}.daily_city_ranking")
        now = spark.sql("SELECT current_catalog() AS catalog").first().catalog
        catalog.drop_schema(spark, schema)
    finally:
        catalog.use_catalog(spark, before)
    return worst.withColumn("catalog", F.lit(now))


def _other_zone(spark: SparkSession) -> SparkSession:
    """A session of the same application in a zone east of UTC."""
    zone = spark.newSession()
    zone.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    return zone


def q_ingestion_stamp(spark, sf):
    """Events stamped with the clock while they are written: whether the stamps lie
    between two instants taken around the action."""
    zone = _other_zone(spark)
    responses = fixtures.hourly_responses(_events(zone, sf)).drop("ingestion_timestamp_utc")
    before = _utc_text()
    path = write_table(ingest.flatten_hourly(responses, city_dimension(zone)), scratch_path(zone, "stamped"))
    after = _utc_text()
    stamp = F.col("ingestion_timestamp_utc")
    return (
        zone.read.parquet(path)
        .groupBy("city_id")
        .agg(
            F.count("*").alias("n_rows"),
            F.bool_and(stamp.between(before, after)).alias("in_bracket"),
            F.count_distinct(stamp).alias("n_stamps"),
        )
    )


def _utc_text() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")


def q_flag_readings_now(spark, sf):
    """The validity flags against the clock, in a zone east of UTC."""
    typed = silver.key_filtered(_typed(_other_zone(spark), sf))
    return present(silver.flag_readings(typed))


def q_json_sample(spark, sf):
    """The JSON sample file, read back as text: absent values are there as null."""
    path = write_json(_bronze(spark, sf), scratch_path(spark, "json-sample"))
    text = spark.read.text(path)
    fields = F.json_object_keys("value")
    return text.select(F.array_join(fields, ",").alias("fields")).groupBy("fields").agg(F.count("*").alias("n_rows"))


def q_file_inventory(spark, sf):
    return file_inventory(spark, f"{sf.rstrip('/')}/events.parquet").select("file_name", "n_rows")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decode_value": q_decode_value,
    "parse_events": q_parse_events,
    "typed_readings": q_typed_readings,
    "key_filtered": q_key_filtered,
    "flag_readings": q_flag_readings,
    "valid_readings": q_valid_readings,
    "latest_readings": q_latest_readings,
    "latest_readings_per_user": q_latest_readings_per_user,
    "latest_readings_incremental": q_latest_readings_incremental,
    "latest_readings_incremental_advancing": q_latest_readings_incremental_advancing,
    "data_freshness_incremental": q_data_freshness_incremental,
    "gold_incremental_recovery": q_gold_incremental_recovery,
    "daily_city_ranking_cloud_incremental": q_daily_city_ranking_cloud_incremental,
    "stage_counts": q_stage_counts,
    "with_measurement_date": q_with_measurement_date,
    "daily_city_aqi": q_daily_city_aqi,
    "daily_city_aqi_cloud": q_daily_city_aqi_cloud,
    "daily_city_ranking": q_daily_city_ranking,
    "daily_city_ranking_per_user": q_daily_city_ranking_per_user,
    "daily_city_ranking_exact_values": q_daily_city_ranking_exact_values,
    "daily_city_ranking_cloud": q_daily_city_ranking_cloud,
    "data_freshness": q_data_freshness,
    "data_freshness_cloud": q_data_freshness_cloud,
    "data_completeness": q_data_completeness,
    "data_completeness_per_user": q_data_completeness_per_user,
    "report_daily_aqi": q_report_daily_aqi,
    "worst_day_per_city": q_worst_day_per_city,
    "report_freshness": q_report_freshness,
    "report_completeness": q_report_completeness,
    "validate_responses": q_validate_responses,
    "validate_responses_per_user": q_validate_responses_per_user,
    "flatten_hourly": q_flatten_hourly,
    "flatten_hourly_per_user": q_flatten_hourly_per_user,
    "validate_responses_lenient": q_validate_responses_lenient,
    "flatten_hourly_lenient": q_flatten_hourly_lenient,
    "event_json_roundtrip": q_event_json_roundtrip,
    "bronze_preview": q_bronze_preview,
    "bronze_stream": q_bronze_stream,
    "bronze_stream_resume": q_bronze_stream_resume,
    "bronze_stream_default_trigger": q_bronze_stream_default_trigger,
    "stream_preview": q_stream_preview,
    "record_count": q_record_count,
    "catalog_reports": q_catalog_reports,
    "catalog_switch": q_catalog_switch,
    "ingestion_stamp": q_ingestion_stamp,
    "flag_readings_now": q_flag_readings_now,
    "json_sample": q_json_sample,
    "file_inventory": q_file_inventory,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)
