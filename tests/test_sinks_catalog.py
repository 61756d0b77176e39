"""Sinks, file inventory, catalog registration and SQL reports."""

import os

from pyspark.sql import functions as F

from airlake.plans import catalog
from airlake.plans.medallion import gold_from_rollup, gold_rollup, run_batch
from airlake.plans.reports import run_report
from airlake.operators.bronze import parse_events
from airlake.operators.gold import gold_tables
from airlake.operators.silver import silver
from airlake.sinks.writers import file_inventory, storage_smoke, write_json, write_table
from airlake.sources import fixtures


def _bronze(spark):
    return parse_events(fixtures.aqi_json(fixtures.load(spark, "/root/testdata/sf0.001", "events")))


def test_storage_smoke(spark, tmp_dir):
    rows = storage_smoke(spark, os.path.join(tmp_dir, "smoke")).collect()
    assert [(r.test_col, r.value) for r in rows] == [("abc", 123)]


def test_file_inventory_counts_files_and_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    write_table(spark.range(100).repartition(4), path)
    spark.range(0).write.mode("append").parquet(path)  # a file without rows
    inv = file_inventory(spark, path).collect()
    assert len(inv) == 5 and sum(r.n_rows for r in inv) == 100
    assert min(r.n_rows for r in inv) == 0
    assert all(r.file_size > 0 and r.file_name.endswith(".parquet") for r in inv)


def test_write_json_lines_round_trip(spark, tmp_dir):
    path = write_json(_bronze(spark).limit(5), os.path.join(tmp_dir, "sample"))
    assert spark.read.json(path).count() == 5


def test_write_json_keeps_null_fields(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rows = spark.read.text(write_json(df, os.path.join(tmp_dir, "nulls"))).collect()
    assert sorted(r.value for r in rows) == ['{"a":1,"b":null}', '{"a":2,"b":"x"}']


def test_batch_run_matches_in_memory_gold(spark, tmp_dir):
    bronze_path = write_table(_bronze(spark), os.path.join(tmp_dir, "bronze"))
    for variant in ("local", "cloud"):
        paths = run_batch(spark, bronze_path, os.path.join(tmp_dir, variant), variant, as_of=fixtures.FIXTURE_AS_OF)
        expected = gold_tables(silver(_bronze(spark), fixtures.FIXTURE_AS_OF), variant)
        for name, df in expected.items():
            got = spark.read.parquet(paths[name])
            assert sorted(got.columns) == sorted(df.columns), name
            assert got.exceptAll(df.select(*got.columns)).count() == 0, name
            assert df.select(*got.columns).exceptAll(got).count() == 0, name


def test_rollup_derivation_equals_direct_gold(spark):
    s = silver(_bronze(spark), fixtures.FIXTURE_AS_OF)
    for variant in ("local", "cloud"):
        derived = gold_from_rollup(gold_rollup(s, variant), variant)
        direct = gold_tables(s, variant)
        for name in direct:
            a, b = derived[name], direct[name].select(*derived[name].columns)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, (variant, name)


def test_register_overwrite_refresh_and_reports(spark, tmp_dir):
    bronze_path = write_table(_bronze(spark), os.path.join(tmp_dir, "bronze"))
    paths = run_batch(spark, bronze_path, os.path.join(tmp_dir, "lake"), "cloud", as_of=fixtures.FIXTURE_AS_OF)
    assert catalog.list_catalogs(spark).count() >= 1
    catalog.use_catalog(spark, "spark_catalog")
    names = catalog.register_tables(spark, "air_quality", {k: v for k, v in paths.items() if k != "silver"})
    assert len(names) == 4
    tables = {r.tableName for r in catalog.list_tables(spark, "air_quality").collect()}
    assert set(catalog.GOLD_TABLES) <= tables
    # overwrite the location, then re-register: refresh makes the new files visible
    run_batch(spark, bronze_path, os.path.join(tmp_dir, "lake"), "cloud", as_of=fixtures.FIXTURE_AS_OF)
    catalog.register_tables(spark, "air_quality", {k: v for k, v in paths.items() if k != "silver"})
    worst = run_report(spark, "worst_day_per_city", daily_city_ranking="air_quality.daily_city_ranking")
    rows = worst.collect()
    assert rows and all(r.rank == 1 for r in rows)
    assert worst.columns == ["measurement_date", "city", "avg_european_aqi", "rank"]
    fresh = run_report(spark, "freshness", data_freshness="air_quality.data_freshness").collect()
    assert [r.city for r in fresh] == sorted(r.city for r in fresh)
    daily = run_report(spark, "daily_aqi", daily_city_aqi="air_quality.daily_city_aqi")
    assert daily.count() == spark.table("air_quality.daily_city_aqi").count()
    comp = run_report(spark, "completeness", data_completeness="air_quality.data_completeness")
    assert comp.where(F.col("completeness_pct") > 100).count() == 0


def test_counted_observes_rows_without_extra_job(spark, tmp_dir):
    from airlake.sinks.writers import counted

    df, obs = counted(_bronze(spark), "bronze")
    write_table(df, os.path.join(tmp_dir, "b"))
    assert obs.get["n_rows"] == _bronze(spark).count()


def test_kafka_options_plain_and_sasl():
    from airlake.sources.tables import eventhub_kafka_options, kafka_options

    plain = kafka_options("localhost:9092", "air_quality_raw")
    assert plain == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "air_quality_raw",
        "startingOffsets": "earliest",
    }
    eh = eventhub_kafka_options("ns", "hub", "listen", "secret")
    assert eh["kafka.bootstrap.servers"] == "ns.servicebus.windows.net:9093"
    assert eh["kafka.security.protocol"] == "SASL_SSL" and eh["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="$ConnectionString"' in eh["kafka.sasl.jaas.config"]
    assert "SharedAccessKeyName=listen;SharedAccessKey=secret" in eh["kafka.sasl.jaas.config"]


def test_kafka_options_bound_micro_batches():
    from airlake.sources.tables import kafka_options

    o = kafka_options("b:9092", "t", max_offsets_per_trigger=1_000_000, min_partitions=64)
    assert o["maxOffsetsPerTrigger"] == "1000000" and o["minPartitions"] == "64"


def test_partitioned_write_gives_one_file_per_value(spark, tmp_dir):
    import glob

    from pyspark.sql import functions as F

    from airlake.sinks.writers import write_table

    # 8 scattered input partitions, 30 dates: without the rebalance every task
    # would write a file into every date folder
    df = spark.range(0, 30_000, numPartitions=8).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("measurement_date"),
        F.col("id"),
    )
    path = write_table(df, f"{tmp_dir}/parted", partition_by=["measurement_date"])
    folders = glob.glob(f"{path}/measurement_date=*")
    assert len(folders) == 30
    assert all(len(glob.glob(f"{d}/*.parquet")) == 1 for d in folders)
    assert spark.read.parquet(path).count() == 30_000


def test_incremental_runs_equal_full_recompute(spark, tmp_dir):
    """Two incremental batches (keys overlap across them) give the same Silver
    and Gold as one full recompute over all rows, for both variants."""
    from airlake.plans.medallion import run_incremental

    raw = fixtures.aqi_json(fixtures.load(spark, "/root/testdata/sf0.001", "events"))
    tagged = parse_events(raw, keep=("event_id",))
    # by parity, so readings of one key land in both batches (in either order)
    batches = [tagged.where(F.col("event_id") % 2 == p).drop("event_id") for p in (0, 1)]
    keys = [silver(b, fixtures.FIXTURE_AS_OF).select("city_id", "measurement_timestamp") for b in batches]
    assert keys[0].intersect(keys[1]).count() > 0  # the merge path is exercised
    bronze = _bronze(spark)
    full = silver(bronze, fixtures.FIXTURE_AS_OF)
    for variant in ("local", "cloud"):
        root = os.path.join(tmp_dir, f"inc-{variant}")
        # the last batch twice: a stream replays a batch after a failure
        for b in batches + batches[-1:]:
            paths = run_incremental(spark, b, root, variant, as_of=fixtures.FIXTURE_AS_OF)
        got = spark.read.parquet(paths["silver"]).drop("measurement_date")
        assert got.count() == full.count()
        assert got.exceptAll(full.select(*got.columns)).count() == 0
        expected = gold_tables(full, variant)
        for name, df in expected.items():
            g = spark.read.parquet(paths[name])
            assert sorted(g.columns) == sorted(df.columns), (variant, name)
            assert g.exceptAll(df.select(*g.columns)).count() == 0, (variant, name)
            assert df.select(*g.columns).exceptAll(g).count() == 0, (variant, name)


def _readings(spark, rows):
    """Structured Bronze rows from (city_id, city, measured, ingested)."""
    from airlake.schemas import EVENT_SCHEMA

    full = [("openmeteo", 1.0, 2.0, i, c, "X", m, 10, 1.0, 2.0, 3.0, t) for i, c, m, t in rows]
    return spark.createDataFrame(full, EVENT_SCHEMA)


def test_readings_in_the_future_at_arrival_become_valid_later(spark, tmp_dir):
    """A day east of UTC, fetched at 20:30 UTC with its last hours still ahead:
    after the next batch the day has all 24 hours, as a full recompute has."""
    from airlake.plans.medallion import run_incremental

    day = [(8, "East", f"2024-03-01T{h:02d}:00", "2024-03-01T20:30:00.000000+00:00") for h in range(24)]
    after = [(8, "East", "2024-03-02T00:00", "2024-03-02T20:30:00.000000+00:00")]
    root = os.path.join(tmp_dir, "east")
    first, second = "2024-03-01 20:30:00", "2024-03-02 20:30:00"
    paths = run_incremental(spark, _readings(spark, day), root, as_of=first)
    assert spark.read.parquet(paths["silver"]).count() == 21
    for _ in range(2):  # the second time as a replay
        run_incremental(spark, _readings(spark, after), root, as_of=second)
        got = spark.read.parquet(paths["silver"]).drop("measurement_date")
        full = silver(_readings(spark, day + after), second)
        assert got.where("to_date(measurement_timestamp) = '2024-03-01'").count() == 24
        assert got.exceptAll(full.select(*got.columns)).count() == 0 and got.count() == full.count()
        for name, df in gold_tables(full, "local").items():
            g = spark.read.parquet(paths[name])
            assert g.exceptAll(df.select(*g.columns)).count() == 0, name
            assert df.select(*g.columns).exceptAll(g).count() == 0, name


def test_lost_freshness_table_is_rebuilt_with_every_city(spark, tmp_dir):
    """An interrupted overwrite left the published table empty and the next
    batch touches one city only."""
    from airlake.plans.medallion import run_incremental

    root, now = os.path.join(tmp_dir, "lost"), "2024-03-05 00:00:00"
    both = [(i, c, "2024-03-01T00:00", "2024-03-01T01:00:00.000000+00:00") for i, c in ((1, "A"), (2, "B"))]
    paths = run_incremental(spark, _readings(spark, both), root, as_of=now)
    spark.createDataFrame([], spark.read.parquet(paths["data_freshness"]).schema).write.mode("overwrite").parquet(
        paths["data_freshness"]
    )
    run_incremental(
        spark, _readings(spark, [(1, "A", "2024-03-02T00:00", "2024-03-02T01:00:00.000000+00:00")]), root, as_of=now
    )
    assert {r.city for r in spark.read.parquet(paths["data_freshness"]).collect()} == {"A", "B"}


def test_unreadable_silver_is_not_taken_for_a_first_run(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException

    from airlake.plans.medallion import run_silver_incremental

    path = os.path.join(tmp_dir, "emptied")
    os.makedirs(path)
    batch = _readings(spark, [(1, "A", "2024-03-01T00:00", "2024-03-01T01:00:00.000000+00:00")])
    with pytest.raises(AnalysisException):
        run_silver_incremental(spark, batch, path, as_of="2024-03-05 00:00:00")


def test_slot_table_keeps_the_old_version_until_the_new_one_is_named(spark, tmp_dir):
    from airlake.plans.medallion import SlotTable

    t = SlotTable(spark, os.path.join(tmp_dir, "slots"))
    assert t.read() is None
    t.write(spark.range(3))
    # a write that was interrupted before its version was named
    spark.range(100).write.mode("overwrite").parquet(f"{t.root}/slot-{(t.version() + 1) % 2}")
    assert t.read().count() == 3
    t.write(t.read().where("id > 0"))
    assert t.read().count() == 2


def test_incremental_rewrites_only_touched_date_partitions(spark, tmp_dir):
    import glob

    from airlake.plans.medallion import run_incremental

    bronze = _bronze(spark)
    day = "2024-01-10"
    first = bronze.where(~F.col("measurement_timestamp").startswith(day))
    second = bronze.where(F.col("measurement_timestamp").startswith(day))
    root = os.path.join(tmp_dir, "lake")
    run_incremental(spark, first, root, "local", as_of=fixtures.FIXTURE_AS_OF)

    def files(table):
        return {
            os.path.basename(d): sorted(os.path.basename(f) for f in glob.glob(f"{d}/*.parquet"))
            for d in glob.glob(os.path.join(root, table, "measurement_date=*"))
        }

    tables = ["silver", "rollup", "gold/daily_city_aqi", "gold/daily_city_ranking", "gold/data_completeness"]
    before = {t: files(t) for t in tables}
    run_incremental(spark, second, root, "local", as_of=fixtures.FIXTURE_AS_OF)
    for t in tables:
        after = files(t)
        touched = {k for k in after if before[t].get(k) != after[k]}
        assert touched == {f"measurement_date={day}"}, (t, touched)


def test_incremental_after_partitioned_full_run_and_refuses_unpartitioned(spark, tmp_dir):
    import pytest

    from airlake.plans.medallion import run_silver, run_silver_incremental

    bronze_path = write_table(_bronze(spark), os.path.join(tmp_dir, "bronze"))
    flat = run_silver(spark, bronze_path, os.path.join(tmp_dir, "flat"), as_of=fixtures.FIXTURE_AS_OF, partition_by=None)
    with pytest.raises(ValueError):
        run_silver_incremental(spark, _bronze(spark), flat, as_of=fixtures.FIXTURE_AS_OF)
    parted = run_silver(
        spark, bronze_path, os.path.join(tmp_dir, "parted"), as_of=fixtures.FIXTURE_AS_OF, partition_by=["measurement_date"]
    )
    run_silver_incremental(spark, _bronze(spark), parted, as_of=fixtures.FIXTURE_AS_OF)  # replay of all rows
    got = spark.read.parquet(parted).drop("measurement_date")
    full = silver(_bronze(spark), fixtures.FIXTURE_AS_OF)
    assert got.count() == full.count() and got.exceptAll(full.select(*got.columns)).count() == 0


def test_producer_options_keep_connection_and_security_only():
    from airlake.sinks.writers import producer_options
    from airlake.sources.tables import eventhub_kafka_options

    opts = eventhub_kafka_options("ns", "hub", "send", "k", max_offsets_per_trigger=10)
    prod = producer_options(opts)
    assert set(prod) == {
        "kafka.bootstrap.servers",
        "kafka.security.protocol",
        "kafka.sasl.mechanism",
        "kafka.sasl.jaas.config",
    }
